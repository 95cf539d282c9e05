"""Conversation structure repair: the cheapest edits that make the turns alternate, by branch-and-bound.

The roles of a conversation should be, by their first letters, ``(s?(ua)+)?``. Edits are Keep (0), Rerole to user
or assistant (2), Delete (3; required for blank and duplicate rows) and Insert of an empty user or assistant
text anywhere (2). A truncated row that is not deleted costs 1 more. The repair is the cheapest list of edits; of
equally cheap ones the one whose letters (D, I, K, R) come first in ASCII order. That list, the audit,
determines the repaired rows: what stands before an edit decides the role that it must give.

The search is depth-first with an explicit stack. A node is a row number and what has been put out last; a
partial repair is known by its cost and its last letter, with a pointer to the one before.

- Suffix lower bounds: for each row, the cheapest way to bring the rest into alternation when neither a system row nor
  the last role matters.
- The incumbent is the best whole repair so far; a partial repair whose cost and bound exceed it is cut, and
  on a par it is cut if its audit comes later.
- A dominance table keeps the best partial repair of each node; any other one that reaches the node is cut, now or
  when it is taken from the stack. Two audits of one cost at one node differ in some letter, so the one that
  comes first also does so with everything that can follow.

Spark deals rows by conversation and sorts them by turn (nulls first; rows of one turn by role and text). A task
walks through them and keeps one small number per row and a hash per distinct row of the conversation at hand, never
its texts; the search takes about a kilobyte a row of the one conversation. Repaired rows come from a second walk, in
which the audit comes before the rows.

Cases: a missing or empty role and a missing text count as one space; a missing conv_id is a conversation of its own;
missing turns come first and make no gaps; repeated rows are duplicates; rows of one turn are in order of role
and text; an empty table gives an empty one. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.storage import stored

# fixed values: costs of the edits
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# what has been put out last: nothing, a system row, a user row, an assistant row
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
# the state after a row with this letter, where it may follow
_NEXT = {_START: {"s": _SYSTEM, "u": _USER}, _SYSTEM: {"u": _USER}, _USER: {"a": _ASSISTANT}, _ASSISTANT: {"u": _USER}}
_WANTED = {_START: "u", _SYSTEM: "u", _USER: "a", _ASSISTANT: "u"}
_ROLE = {"u": "user", "a": "assistant"}
_LEGAL_END = (_START, _ASSISTANT)
_LEGAL_PAIRS = ("su", "ua", "au")

_NOT_BLANK = r"[^\x20\x09-\x0D]"
_CUT_OFF = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"

# facts of conversations up to this many rows are remembered with their repair
_SHORT = 64

Fact = tuple[str, bool, bool]  # first letter of the role, must be deleted, truncated


class _Step:
    """A partial repair: its last edit and the one before it."""

    __slots__ = ("before", "letter", "depth", "cost")

    def __init__(self, before: _Step | None, letter: str, cost: int):
        self.before, self.letter, self.cost = before, letter, cost
        self.depth = before.depth + 1 if before else 0


def _audit(step: _Step) -> str:
    letters = []
    while step.before:
        letters.append(step.letter)
        step = step.before
    return "".join(reversed(letters))


def _path(step: _Step) -> list[_Step]:
    """The steps that lead to this one, and itself."""
    found = [step]
    while found[-1].before:
        found.append(found[-1].before)
    return found[::-1]


def _comes_after(step: _Step, path: list[_Step]) -> bool:
    """Whether the audit of ``step`` is behind the one that ``path`` leads to."""
    letter = ""
    while step.depth >= len(path) or path[step.depth] is not step:
        step, letter = step.before, step.letter
    return letter != "" and (step.depth + 1 == len(path) or letter > path[step.depth + 1].letter)


def _comes_first(a: _Step, b: _Step) -> bool:
    """Whether the audit of ``a`` is before that of ``b``; a part of the other one is."""
    letter_a = letter_b = ""
    while a.depth > b.depth:
        a, letter_a = a.before, a.letter
    while b.depth > a.depth:
        b, letter_b = b.before, b.letter
    while a is not b:
        letter_a, letter_b = a.letter, b.letter
        a, b = a.before, b.before
    return letter_a < letter_b


def _lower_bounds(facts: list[Fact]) -> list[tuple[int, int, int, int]]:
    """For each row and state, no more than what the rest costs."""
    bounds = [(0, 0, 0, 0)] * (len(facts) + 1)
    user = assistant = start = 0
    for i in range(len(facts) - 1, -1, -1):
        letter, gone, cut = facts[i]
        extra = TRUNCATED if cut else 0
        if gone:
            as_user, as_assistant = DELETE + user, DELETE + assistant
            start += DELETE
        else:
            as_user = min(DELETE + user, extra + assistant + (0 if letter == "u" else REROLE))
            as_assistant = min(DELETE + assistant, extra + user + (0 if letter == "a" else REROLE))
            start = min(DELETE + start, extra + user) if letter == "s" else DELETE + start
        # a row that is wanted in vain can be inserted
        user, assistant = min(as_user, INSERT + as_assistant), min(as_assistant, INSERT + as_user)
        start = min(start, user)
        bounds[i] = (start, user, assistant, user)
    return bounds


def _branches(i: int, state: int, facts: list[Fact]) -> Iterator[tuple[str, int, int, int]]:
    """Edits from a node: letter, cost, and the node they lead to."""
    wanted = _WANTED[state]
    if i < len(facts):
        letter, gone, cut = facts[i]
        extra = TRUNCATED if cut else 0
        yield "D", DELETE, i + 1, state
        if not gone:
            if letter in _NEXT[state]:
                yield "K", extra, i + 1, _NEXT[state][letter]
            if letter != wanted:
                yield "R", REROLE + extra, i + 1, _NEXT[state][wanted]
    yield "I", INSERT, i, _NEXT[state][wanted]


def cheapest_repair(facts: list[Fact]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair."""
    n, bounds = len(facts), _lower_bounds(facts)
    root = _Step(None, "", 0)
    best: _Step | None = None
    path: list[_Step] = []
    table = {(0, _START): root}
    stack = [(root, 0, _START)]
    while stack:
        step, i, state = stack.pop()
        if table[i, state] is not step:
            continue
        if best is not None:
            least = step.cost + bounds[i][state]
            if least > best.cost or (least == best.cost and _comes_after(step, path)):
                continue
        if i == n and state in _LEGAL_END:
            # on a par it is not behind, or it would have been cut
            best, path = step, _path(step)
            # anything after it costs more
            continue
        found = []
        for letter, cost, at, to in _branches(i, state, facts):
            total = step.cost + cost
            least = total + bounds[at][to]
            if best is not None and least > best.cost:
                continue
            new = _Step(step, letter, total)
            known = table.get((at, to))
            if known is not None and (known.cost < total or (known.cost == total and not _comes_first(new, known))):
                continue
            table[at, to] = new
            found.append((least, letter, new, at, to))
        # the most promising is taken first, of equals the one that comes first
        found.sort(key=lambda x: x[:2], reverse=True)
        stack += [x[2:] for x in found]
    return best.cost, _audit(best)


@lru_cache(maxsize=1 << 14)
def _remembered(facts: tuple[Fact, ...]) -> tuple[int, str]:
    return cheapest_repair(list(facts))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that a checksum of conv_id and turn deals out: dropped, emptied, unpunctuated, repeated, or made the user's.

    ``copies`` is 0 for dropped rows, which stay so that every conversation is known.
    """

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    role = F.when(F.length(text_of("role")) == 0, F.lit(" ")).otherwise(text_of("role"))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Conversations one after the other within the tasks, each in order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text")


SEARCHED = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)
_SEARCHED = pa.schema(
    [("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())]
)


# one object for each kind of row
_KINDS: dict[Fact, Fact] = {}


class _Conversation:
    """What is kept of a conversation while its rows go by."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.facts: list[Fact] = []
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.lowest = self.highest = None
        self.turns, self.last = 0, " "

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, cut: bool, copies: int) -> None:
        for _ in range(copies):
            again = digest in self.seen
            self.seen.add(digest)
            self.blank += blank
            self.duplicate += again and not blank
            self.truncated += cut and not again and not blank
            letter = role[0]
            self.illegal += bool(self.facts) and self.last + letter not in _LEGAL_PAIRS
            self.last = letter
            fact = (letter if letter in "sua" else "", blank or again, cut and not again and not blank)
            self.facts.append(_KINDS.setdefault(fact, fact))
        if turn is not None and copies:
            self.turns += self.highest is None or turn != self.highest
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn

    def result(self) -> tuple:
        gaps = 0 if self.highest is None else self.highest - self.lowest + 1 - self.turns
        cost, audit = _remembered(tuple(self.facts)) if len(self.facts) <= _SHORT else cheapest_repair(self.facts)
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(c).to_pylist() for c in names])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at: _Conversation | None = None
    for batch in batches:
        done = []
        for conv_id, *row in _columns(batch, "conv_id", "turn", "role", "digest", "blank", "cut", "copies"):
            if at is None or conv_id != at.conv_id:
                if at is not None:
                    done.append(at.result())
                at = _Conversation(conv_id)
            at.add(*row)
        if done:
            yield pa.record_batch(list(map(list, zip(*done))), schema=_SEARCHED)
    if at is not None:
        yield pa.record_batch(list(map(list, zip(at.result()))), schema=_SEARCHED)


def find_repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, and the cost and audit of the cheapest repair.

    ``rows`` have conv_id, turn, role, text and copies, as ``damaged`` gives them.
    """
    facts = rows.select(
        "conv_id", "turn", "role", "text", "copies",
        F.unhex(F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")), 256)).alias("digest"),
        (~F.col("text").rlike(_NOT_BLANK)).alias("blank"),
        F.col("text").rlike(_CUT_OFF).alias("cut"),
    )
    ordered = _in_order(facts).drop("text")
    return stored(ordered.mapInArrow(_search, SEARCHED), "repairs")


REPAIRED = "conv_id bigint, place bigint, turn bigint, edit string, role string, text string"


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_id, audit, i, state, place = None, "", 0, _START, 0
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64())] + [(c, pa.string()) for c in ("edit", "role", "text")])
    for batch in batches:
        out = []

        def inserted(turn: int | None) -> None:
            nonlocal i, state, place
            while i < len(audit) and audit[i] == "I":
                letter = _WANTED[state]
                out.append((conv_id, place, turn, "I", _ROLE[letter], ""))
                state, place, i = _NEXT[state][letter], place + 1, i + 1

        for at, turn, role, text, copies, given in _columns(batch, "conv_id", "turn", "role", "text", "copies", "audit"):
            if given is not None:
                # the head of a conversation, before its rows
                conv_id, audit, i, state, place = at, given, 0, _START, 0
                inserted(None)
                continue
            for _ in range(copies):
                edit, i = audit[i], i + 1
                if edit != "D":
                    letter = _WANTED[state] if edit == "R" else role[0]
                    out.append((conv_id, place, turn, edit, _ROLE[letter] if edit == "R" else role, text))
                    state, place = _NEXT[state][letter], place + 1
                inserted(turn)
        if out:
            yield pa.record_batch(list(map(list, zip(*out))), schema=schema)


def repaired_rows(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The rows of every conversation after its repair: conv_id, place, turn, edit, role, text."""
    return _with_audits(rows, repairs).mapInArrow(_repair, REPAIRED)


def _with_audits(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """Rows in order, each conversation led by a row with its audit."""
    kind = {"turn": "bigint", "role": "string", "text": "string", "copies": "int"}
    heads = repairs.select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in kind.items()], "audit")
    body = rows.select("conv_id", *kind, F.lit(None).cast("string").alias("audit"))
    return _in_order(body.unionByName(heads).withColumn("body", F.col("audit").isNull()), "body")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of the repaired rows of each conversation, fed row by row."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    open_id, feed, empty = None, None, True

    for out in _repair(batches):
        done = []
        for conv_id, role, text in _columns(out, "conv_id", "role", "text"):
            if feed is None or conv_id != open_id:
                if feed is not None:
                    done.append((open_id, feed.hexdigest()))
                open_id, feed, empty = conv_id, hashlib.sha256(), True
            feed.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
            empty = False
        if done:
            yield pa.record_batch(list(map(list, zip(*done))), schema=schema)
    if feed is not None:
        yield pa.record_batch([[open_id], [feed.hexdigest()]], schema=schema)


def repaired_digests(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired ``role:text`` lines; conversations without rows are left out."""
    return _with_audits(rows, repairs).mapInArrow(_digest, "conv_id bigint, repaired_sha256 string")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = stored(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "damaged")
    repairs = find_repairs(rows)
    digests = repaired_digests(rows, repairs).withColumnRenamed("conv_id", "hashed")
    return repairs.join(digests, F.col("conv_id").eqNullSafe(F.col("hashed")), "left").select(
        *repairs.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
