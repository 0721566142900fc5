"""Randomised properties against plain-Python models of the semantics."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import dedupe_latest, surrogate_key, upsert
from tests.reference import surrogate_key_window
from tests.conftest import rows

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
R0, R1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
key = st.one_of(st.none(), st.integers(0, 6))
val = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


def merge_model(target, source):
    """MERGE: NULL keys never match; matched rows take the source value and
    keep ADDED_BY; unmatched source rows are inserted with the run's id."""
    src = {k: v for k, v in source if k is not None}
    tkeys = {k for k, _, _ in target if k is not None}
    out = [(k, src[k] if k in src else v, a) for k, v, a in target]
    out += [(k, v, "r1") for k, v in source if k is None or k not in tkeys]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


@SETTINGS
@given(target=st.lists(st.tuples(key, val), max_size=8),
       source=st.lists(st.tuples(key, val), max_size=8, unique_by=lambda t: t[0] if t[0] is not None else object()))
def test_upsert_matches_merge_model(spark, target, source):
    t = spark.createDataFrame([(k, v, "r0") for k, v in target], "k int, v string, ADDED_BY string")
    s = spark.createDataFrame(source, "k int, v string")
    want = merge_model([(k, v, "r0") for k, v in target], source)
    for method in ("broadcast", "shuffle"):
        got = upsert(t, s, "k", "r1", R1, method=method)
        assert rows(got) == want, method


@SETTINGS
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),
                               st.integers(0, 3), st.integers(0, 1000)), min_size=1, max_size=40))
def test_surrogate_key_matches_row_number(spark, data):
    df = spark.createDataFrame(data, "lead string, a int, b int")
    got = surrogate_key(df, ["lead", "a"], "key", num_partitions=3)
    want = surrogate_key_window(df, ["lead", "a"], "key")
    assert rows(got) == rows(want)
    assert sorted(r.key for r in got.collect()) == list(range(1, len(data) + 1))


@SETTINGS
@given(data=st.lists(st.tuples(key, st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=30))
def test_dedupe_latest_matches_model(spark, data):
    df = spark.createDataFrame([(k, dt.datetime(2024, 1, 1 + t), x) for k, t, x in data],
                               "k int, ADDED_ON timestamp, x int")
    best = {}
    for k, t, x in data:
        if k not in best or (t, x) > best[k]:
            best[k] = (t, x)
    want = sorted(((k, dt.datetime(2024, 1, 1 + t), x) for k, (t, x) in best.items()),
                  key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0))
    got = rows(dedupe_latest(df, "k"))
    assert got == want
