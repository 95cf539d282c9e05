"""Native operators run on built-in expressions alone, in every table they write on the way."""

from __future__ import annotations

import pytest

import corpus_pipeline
from clickpath.llm import fingerprints, lines, mixing
from clickpath.storage import stored
from .conftest import SMOKE

OPERATORS = {
    "op5": (fingerprints, lambda spark, docs: fingerprints.op5_fingerprints(spark, SMOKE)),
    "op6": (mixing, lambda spark, docs: mixing.op6_mixing(spark, SMOKE)),
    "op8": (lines, lambda spark, docs: lines.op8_line_dedup(spark, SMOKE)),
    "line dedup stage": (lines, lambda spark, docs: corpus_pipeline.drop_repeated_lines(spark, docs, SMOKE)),
    "mixing stage": (mixing, lambda spark, docs: corpus_pipeline.mix_sources(spark, docs, SMOKE)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_python(spark, smoke, monkeypatch, name):
    module, query = OPERATORS[name]
    plans = []

    def recorded(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(module, "stored", recorded)
    plans.append(query(spark, smoke)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 1
    for plan in plans:
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
