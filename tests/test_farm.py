from __future__ import annotations

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
import clickpath as cp
from checks.compare import difference, duck, expected_of
from checks.oracle import FARM_ID
from clickpath.functions import farm
from tests.rows import param, raw_event, raw_log


def public(spark, texts: list[str | None]) -> list[int | None]:
    """The fingerprint by the library that Spark's own jars hold."""
    made = spark._jvm.com.google.common.hash.Hashing.farmHashFingerprint64()
    return [None if t is None else made.hashBytes(bytearray(t.encode())).asLong() for t in texts]


def test_published_values():
    got = farm.fingerprints(pa.array(["1footrue", "2applefalse", "3true"])).to_pylist()
    assert got == [-1541654101129638711, 2794438866806483259, -4880158226897771312]


def test_fingerprints_of_all_lengths(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choices("ab{}\":,0123 żółć\x00", k=n)) for n in [*range(140), 191, 192, 193, 256, 1000, 5000] for _ in range(2)]
    texts += [None, "", "x" * 300_000, None]
    draw.shuffle(texts)
    assert farm.fingerprints(pa.array(texts)).to_pylist() == public(spark, texts)
    assert farm.fingerprints(pa.array(texts)[7:90]).to_pylist() == public(spark, texts)[7:90]
    assert farm.fingerprints(pa.array([], pa.string())).to_pylist() == []
    assert farm.fingerprints(pa.array([None, None], pa.string())).to_pylist() == [None, None]


def test_json_text(spark):
    value = T.StructType([T.StructField("t", T.StringType()), T.StructField("i", T.LongType()), T.StructField("d", T.DoubleType())])
    rows = [
        ('a"\\\n', 2**53, 1.0, '{"t":"a\\"\\\\\\n","i":9007199254740992,"d":1}'),
        ("ż/", 2**53 + 1, -0.25, '{"t":"ż/","i":"9007199254740993","d":-0.25}'),
        (None, None, None, '{"t":null,"i":null,"d":null}'),
        ("", -(2**60), 1e20, '{"t":"","i":"-1152921504606846976","d":1e+20}'),
        ("", 0, 12345678.5, '{"t":"","i":0,"d":12345678.5}'),
        ("", 0, -1e14, '{"t":"","i":0,"d":-100000000000000}'),
        ("", 0, 1.5e15, '{"t":"","i":0,"d":1.5e+15}'),
        ("", 0, 1.25e-4, '{"t":"","i":0,"d":0.000125}'),
        ("", 0, 1.25e-5, '{"t":"","i":0,"d":1.25e-05}'),
        ("", 0, -2.5e-100, '{"t":"","i":0,"d":-2.5e-100}'),
        ("", 0, -0.0, '{"t":"","i":0,"d":0}'),
        ("", 0, float("inf"), '{"t":"","i":0,"d":"Infinity"}'),
        ("", 0, float("nan"), '{"t":"","i":0,"d":"NaN"}'),
    ]
    df = spark.createDataFrame([((t, i, d), want) for t, i, d, want in rows], T.StructType([T.StructField("v", value), T.StructField("want", T.StringType())]))
    for got, want in df.select(farm.json_text(F.col("v"), value), "want").collect():
        assert got == want and json.loads(got) is not None


def test_event_ids(spark):
    arrays = [None, [], [param("a", "1")], [param("a", None, 1)], [param("b", "ż"), param("a", "1", 2**60)], [param("a")]]
    null = '"float_value":null,"double_value":null}}'
    texts = [
        "[]", "[]",
        '[{"key":"a","value":{"string_value":"1","int_value":null,' + null + "]",
        '[{"key":"a","value":{"string_value":null,"int_value":1,' + null + "]",
        '[{"key":"b","value":{"string_value":"ż","int_value":null,' + null + ',{"key":"a","value":{"string_value":"1","int_value":"1152921504606846976",' + null + "]",
        '[{"key":"a","value":{"string_value":null,"int_value":null,' + null + "]",
    ]
    events = cp.pre_events(raw_log(spark, *[raw_event(event_params=a) for a in arrays]), event_id="farm")
    want = [f"c11704412800000000view{h}" for h in public(spark, texts)]
    assert sorted(r[0] for r in events.select("event_id").collect()) == sorted(want)
    lost = cp.pre_events(raw_log(spark, raw_event(user_pseudo_id=None)), event_id="farm").first()
    assert lost["event_id"] is None


@pytest.fixture
def flat(spark):
    return entry._unnested(cp.pre_events(entry._raw(spark, entry.SMOKE_DIR), event_id="farm"))


def test_ids_equal_the_sql(flat):
    assert difference(flat, expected_of(duck(entry.SMOKE_DIR), FARM_ID)) is None


def test_ids_against_the_public_library(spark, flat):
    texts = entry.event_params_json(spark, entry.SMOKE_DIR).collect()
    prints = public(spark, [r["params_json"] for r in texts])
    start = [None if r["user_pseudo_id"] is None else f"{r['user_pseudo_id']}{r['event_timestamp']}{r['event_name']}" for r in texts]
    want = sorted((None if s is None else f"{s}{p}" for s, p in zip(start, prints)), key=str)
    assert sorted((r[0] for r in flat.select("event_id").collect()), key=str) == want
