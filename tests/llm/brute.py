"""The operators' results by plain Python, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def kept_words(docs: list[tuple], k: int = 13) -> collections.Counter:
    """(doc_id, words, words removed, kept text) of each row; a missing id is the smallest."""

    def rank(doc_id):
        return (doc_id is not None, doc_id or 0)

    first: dict = {}
    for doc_id, text in sorted(docs, key=lambda d: rank(d[0])):
        w = words(text)
        for j in range(len(w) - k + 1):
            first.setdefault(tuple(w[j : j + k]), rank(doc_id))
    out = collections.Counter()
    for doc_id, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < rank(doc_id):
                gone[j : j + k] = [True] * k
        out[doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)] += 1
    return out


def shingles(text: str | None, lower: bool = True, k: int = 5) -> set:
    w = words((text or "").translate(LOWER) if lower else text)
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_groups(docs: list[tuple]) -> collections.Counter:
    """(doc_id, shingles, component_id, kept) of each row."""
    sets = [shingles(text) if doc_id is not None else None for doc_id, text in docs]
    parent = list(range(len(docs)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    out = collections.Counter()
    for i, (doc_id, text) in enumerate(docs):
        component = least[root(i)] if doc_id is not None else None
        out[doc_id, len(shingles(text)), component, doc_id is not None and doc_id == component] += 1
    return out


def jaccard_links(docs: list[tuple], num: int = 80) -> collections.Counter:
    """(doc_id, shingles, component_id, documents linked to) of each row."""
    sets = [shingles(text) if doc_id is not None else set() for doc_id, text in docs]
    links = {i: set() for i in range(len(docs))}
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    out = collections.Counter()
    for i, (doc_id, text) in enumerate(docs):
        reached, left = {i}, [i]
        while left:
            new = links[left.pop()] - reached
            reached |= new
            left += new
        known = doc_id is not None
        out[doc_id, len(shingles(text)), min(docs[j][0] for j in reached) if known else None, len(links[i]) if known else None] += 1
    return out


def without_repeated_lines(docs: list[tuple], run: int = 3, long_words: int = 50, by_words: bool = False) -> dict:
    """(doc_id, text) to (lines, lines removed, kept text); equal rows are one document."""
    sizes = range(run, 0, -1) if by_words else (run, 1)

    def counts(window: list[str]) -> bool:
        return len(window) == run or sum(len(words(x)) for x in window) >= long_words

    places = {}
    rows = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is not None, d[0] or 0))
    assert len({d[0] for d in rows}) == len(rows), "the order of texts with one doc_id is not modelled"
    for doc_id, text in rows:
        lines = text.split("\n")
        for size in sizes:
            for j in range(len(lines) - size + 1):
                if counts(lines[j : j + size]):
                    places.setdefault(tuple(lines[j : j + size]), (doc_id, j))
    out = {(doc_id, None): (0, 0, None) for doc_id, text in docs if text is None}
    for doc_id, text in rows:
        lines = text.split("\n")
        gone = set()
        for size in sizes:
            for j in range(len(lines) - size + 1):
                if counts(lines[j : j + size]) and places[tuple(lines[j : j + size])] != (doc_id, j):
                    gone |= set(range(j, j + size))
        out[doc_id, text] = (len(lines), len(gone), "\n".join(x for j, x in enumerate(lines) if j not in gone))
    return out
