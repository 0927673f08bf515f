"""Exact percentiles against the sorted values."""

import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feescope.operators.percentile import exact_percentiles

PS = {"low": 0.0, "third": 0.33, "median": 0.5, "p95": 0.95, "top": 1.0}


def wanted(values):
    v = sorted(x for x in values if x is not None and x == x)
    return tuple(v[max(1, math.ceil(p * len(v))) - 1] for p in PS.values()) if v else None


def got(df, keys):
    return {tuple(r[k] for k in keys): tuple(r[n] for n in PS) for r in exact_percentiles(df, keys, "v", PS).collect()}


def test_groups_nulls_signs_and_ties(spark):
    rng = random.Random(3)
    special = [None, float("nan"), 0.0, -0.0, 1e-12, -5.5, 3.25, 1e300, -1e300]
    rows = [(rng.choice([None, 1, 2]), rng.choice([*special, -5.5, rng.random()])) for _ in range(400)]
    rows.append((9, None))  # a group without a value has no row
    by = {}
    for k, v in rows:
        by.setdefault((k,), []).append(v)
    df = spark.createDataFrame(rows, "k int, v double")
    assert got(df, ["k"]) == {k: wanted(v) for k, v in by.items() if wanted(v)}


def test_one_group_with_all_rows_and_empty_input(spark):
    rng = random.Random(4)
    values = [rng.lognormvariate(3, 2) for _ in range(3000)] + [7.0] * 3000
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert got(df, []) == {(): wanted(values)}
    assert got(df.limit(0), []) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=60))
def test_any_finite_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert got(df, []) == {(): wanted(values)}


def test_several_groupings_at_once(spark):
    """As the groupings one by one, with null keys kept apart from absent ones, by broadcast or by written brackets."""
    rng = random.Random(6)
    rows = [(rng.choice([None, 1, 2]), rng.choice("ab"), rng.choice([None, rng.random()])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, c string, v double")
    sets = [["k"], ["c"], [], ["k", "c"]]
    for bounded in (False, True):
        out = exact_percentiles(df, ["k", "c"], "v", PS, sets, bounded_keys=bounded).collect()
        for i, keys in enumerate(sets):
            assert {tuple(r[k] for k in keys): tuple(r[n] for n in PS) for r in out if r.grouping == i} == got(df, keys)
        assert all(r.c is None for r in out if r.grouping == 0) and len(out) == 3 + 2 + 1 + 6


def test_rows_meet_small_brackets_unshuffled(spark):
    df = spark.range(50).selectExpr("id % 3 AS k", "id * 1.5D AS v")
    for bounded in (False, True):
        plan = exact_percentiles(df, ["k"], "v", PS, bounded_keys=bounded)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [_g" in plan
