"""Samples of many links at once: the Arrow functions against a plain loop over each row."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roadlens.functions import samples as sa
from roadlens.functions.timeofday import DEFAULT_RANGES, periods_from
from roadlens.operators import compare
from roadlens.sources import speeds as sp

PERIODS = periods_from(DEFAULT_RANGES)
ROW = "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, samples ARRAY<STRUCT<minute: INT, speed_mph: DOUBLE>>"


def close(a, b):
    return (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12))


def test_sums_and_percentiles_by_row(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice([None, -1.0, 0.0, draw.random() * 80]) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 7, 0, 60])] + [(9, None)]
    v = F.col("v")
    got = spark.createDataFrame(rows, "k INT, v ARRAY<DOUBLE>").coalesce(1).select(
        "k", sa.total(v).alias("t"), sa.total_present(v).alias("p"), sa.measured(v).alias("m"), sa.percentile(v, 0.95).alias("q")).collect()
    for r, (k, values) in zip(sorted(got), rows):
        there = [x for x in values or [] if x is not None]
        assert close(r.t, None if values is None or None in values else sum(there)) and close(r.p, sum(there) if there else None)
        assert r.m.invalid == sum(x is None or x < 0 for x in values or []) and close(r.m.total, sum(there))
        usable = sorted(x for x in there if x >= 0)
        rank = (len(usable) - 1) * 0.95
        at = int(rank)
        assert close(r.q, usable[at] + (rank - at) * (usable[min(at + 1, len(usable) - 1)] - usable[at]) if usable else None)


def test_samples_on_the_grid(spark):
    rows = [(1, [(0, 10.0), (15, None)], 5, 4, [10], 7.0), (2, None, 5, 4, [10], 8.0), (3, [(5, 1.0)], 5, 3, [], 9.0)]
    kind = "k INT, samples ARRAY<STRUCT<o: INT, v: DOUBLE>>, step INT, n INT, absent ARRAY<INT>, fill DOUBLE"
    put = lambda r: spark.createDataFrame(r, kind).select("k", sa.aligned("samples", "step", F.col("n"), "absent", F.col("fill")).column().alias("s"))
    assert {r.k: r.s for r in put(rows).collect()} == {1: [10.0, None, 7.0, None], 2: [None, None, 8.0, None], 3: [None, 1.0, None]}
    with pytest.raises(Exception, match="two speeds for one minute"):
        put([(1, [(5, 1.0), (5, 2.0)], 5, 3, [], 0.0)]).collect()


def test_repeated_representations_take_the_least(spark):
    reps = [(5, "mph", 9.0), (5, "mph", 4.0), (5, None, 1.0), (0, "kmph", 16.09344), (10, None, 3.0), (10, None, None)]
    row = spark.createDataFrame([(reps,), ([],)], "r ARRAY<STRUCT<minute: INT, unit: STRING, speed: DOUBLE>>").select(sp.canonical_samples("r").alias("s")).collect()
    assert sorted([(e.minute, e.speed_mph) for e in r.s] for r in row) == [[], [(0, pytest.approx(10.0)), (5, 4.0), (10, None)]]


def test_days_are_merged_after_the_join(spark):
    """Samples that look small to the planner are not collected for a broadcast; a link without samples keeps an empty list."""
    perf = spark.createDataFrame([("am", 1, 2, 30.0, 5.0), ("nt", 1, 2, 40.0, 6.0), ("am", 3, 4, 50.0, 7.0)],
                                 "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, speed_mph DOUBLE, volume DOUBLE")
    held = spark.createDataFrame([("nt", 1, 2, [(5, 1.0), (1140, 2.0)]), ("am", 1, 2, [(365, None), (360, 3.0)])], ROW)
    day = compare.daily_with_speeds(perf, held, PERIODS)
    got = {r.from_node_id: [(e.minute, e.speed_mph) for e in r.speeds] for r in day.collect()}
    assert got == {1: [(5, 1.0), (360, 3.0), (365, None), (1140, 2.0)], 3: []}
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    with pytest.raises(Exception, match="two speeds for one minute"):
        compare.daily_with_speeds(perf, held.union(held), PERIODS).collect()


@pytest.mark.parametrize("name", ["canonical_speed", "native_grid_impute", "s3_parameters", "s3_flow", "speed_volume_hourly", "speed_volume_audit", "daily_aggregate_speeds"])
def test_no_array_function_is_interpreted_per_sample(spark, name):
    from roadlens.plans import catalog

    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.split("\n") if "lambdafunction" in x and "offsets" not in x]  # those of the grid have a row per period
    assert "ArrowEvalPython" in plan and not lines


def test_both_forms_of_the_limits_are_vectors(spark):
    """Rounded speeds are measured in the same pass: no decimal is made per sample."""
    from roadlens.operators.profiles import profile_limits

    arrays = spark.createDataFrame([(1, [10.0, 10.44, 10.0, None]), (2, [5.0]), (3, [0.0, 0.06, 0.0, 0.0])], "k INT, speeds ARRAY<DOUBLE>")
    folded = profile_limits(arrays, ["k"], decimals=1)
    assert "lambdafunction" not in folded._jdf.queryExecution().executedPlan().toString()
    got = {(r.form, r.measure): (round(r.largest, 9), r.k) for r in folded.collect()}
    assert got["exact", "max_step"] == (0.44, 1) and got["rounded", "max_step"] == (0.4, 1)
    assert got["exact", "max_rolling"] == (0.04, 3) and got["rounded", "max_rolling"] == (round(0.2 / 3, 9), 3)


def test_rounding_is_that_of_spark(spark):
    import numpy as np

    draw = random.Random(7)
    values = [48.5, -48.5, 1.005, 2.675, 60.1234567890125, -0.0, 1e300, 0.5, None] + [draw.random() * 80 for _ in range(3000)] + [k / 8 for k in range(200)]
    for decimals in (0, 2, 12):
        want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v DOUBLE").coalesce(1).select(F.round("v", decimals)).collect()]
        got = sa.rounded(np.array([math.nan if v is None else v for v in values]), decimals).tolist()
        assert [None if math.isnan(g) else g for g in got] == want
