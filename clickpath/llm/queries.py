"""The queries of this package and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, fingerprints, jaccard_join, language_model, lines, mixing, near_duplicates, pieces, records, substrings, topk, toxicity, vector_codes

_QUERIES = [
    substrings.op1_substring_dedup,
    pieces.op2_sentencepiece,
    topk.op3_topk,
    language_model.op4_lm_scoring,
    fingerprints.op5_fingerprints,
    mixing.op6_mixing,
    records.op7_token_records,
    lines.op8_line_dedup,
    toxicity.op9_toxicity,
    near_duplicates.op10_minhash,
    jaccard_join.op11_jaccard_join,
    conversations.op12_conversation_repair,
    vector_codes.op13_vector_codes,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {query.__name__: query for query in _QUERIES}

# The other operators have no SQL form (hashes, models, files, components); their tests use brute force.
SQL: dict[str, str] = {"op3_topk": topk.OP3_SQL, "op6_mixing": mixing.OP6_SQL, "op8_line_dedup": lines.OP8_SQL, "op11_jaccard_join": jaccard_join.OP11_SQL,
                       "op13_vector_codes": vector_codes.OP13_SQL}
