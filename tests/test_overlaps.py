"""Networks whose ends are numbered from one range, and samples that come as one array per link and period."""

import pytest
from pyspark.sql import functions as F

from roadlens.functions.timeofday import Period
from roadlens.operators import links as ln
from roadlens.operators import transfer as tr
from roadlens.sources import speeds as sp

PERIODS = [Period("am", 360, 540), Period("nt", 1140, 360)]
NET = "A INT, B INT, ATYPE INT, FTYPE INT, STREETNAME STRING, geometry STRING"


def test_loops_are_links_only_where_the_network_may_have_them(spark):
    net = spark.createDataFrame([(1, 5, 5, "1", "1", "11", "11", 1.0, 2, 0, 0)], "link_id INT, from_node_id BIGINT, to_node_id BIGINT, ATYPE STRING, FTYPE STRING, "
                                "CAPCLASS STRING, SPDCLASS STRING, DISTANCE DOUBLE, AMLANE INT, AMLIMIT INT, AMTOLL INT")
    assert ln.period_links(net, ["am"]).first().reject_reason == "self_loop"
    assert ln.period_links(net, ["am"], loops=True).first().reject_reason is None


def test_repeated_pairs_keep_a_row_each(spark):
    line = "LINESTRING (0 0, 10 0)"
    base = spark.createDataFrame([(1, 2, 1, 1, "x", line)], NET)
    future = spark.createDataFrame([(3, 4, 1, 1, "x", line), (3, 4, 2, 5, "y", line), (1, 2, 1, 1, "x", line)], NET)
    known = base.select(F.col("A").alias("a"), F.col("B").alias("b"))
    with pytest.raises(Exception, match="duplicate keys"):
        tr.crosswalk(base, future, known, "simple").collect()
    cross = tr.crosswalk(base, future, known, "simple", unique=False)
    assert sorted(r.fallback_vdf_code for r in cross.collect()) == ["", "101", "205"]
    value = ", ".join(f"1D {p}" for p in ln.PARAMETERS)
    days = " UNION ALL ".join(f"SELECT '{p}' time_period, {{}}" for p in ("am", "md", "pm"))
    own = spark.sql(days.replace("{}", f"1 a, 2 b, {value}"))
    table = spark.sql(days.replace("{}", f"'101' vdf_code, {value}")).unionByName(spark.sql(days.replace("{}", f"'all' vdf_code, {value}")))
    got = [(r.future_a, r.fallback_vdf_code) for r in tr.transferred_parameters(cross, own, table).where("time_period = 'am'").collect()]
    assert sorted(got, key=str) == [(1, None), (3, "101"), (3, "all")]


def test_samples_in_arrays_equal_long_rows(spark):
    long = spark.createDataFrame([("am", 1, 2, 360, 10.0), ("am", 1, 2, 400, None), ("am", 1, 2, 700, 5.0), ("nt", 1, 2, 5, 7.0), ("nt", 1, 2, 1140, 8.0), ("xx", 1, 2, 400, 1.0)],
                                 "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, minute INT, speed_mph DOUBLE")
    rows = long.groupBy("time_period", "from_node_id", "to_node_id").agg(F.collect_list(F.struct("minute", "speed_mph")).alias("samples"))
    tidy = lambda f: sorted((r.time_period, sorted((e.o, e.v or -1) for e in r.samples)) for r in f.collect() if r.samples)
    assert tidy(sp.period_samples(rows, PERIODS)) == tidy(sp.link_arrays(long, PERIODS)) == [("am", [(0, 10.0), (40, -1)]), ("nt", [(0, 8.0), (305, 7.0)])]
    assert {r.time_period: r.offsets for r in sp.period_offsets(sp.period_samples(rows, PERIODS)).collect()} == {"am": [0, 40], "nt": [0, 305]}
    day = sp.owned_speeds(rows, PERIODS).first().speeds
    assert [(e.minute, e.speed_mph) for e in day] == [(5, 7.0), (360, 10.0), (400, None), (1140, 8.0)]


def test_best_representation_without_sorting_samples(spark):
    reps = spark.createDataFrame([(1, 5, "kmph", 16.09344), (1, 5, None, 3.0), (1, 0, "kmph", 16.09344), (1, 0, "mph", None), (1, 0, None, 4.0)], "k INT, minute INT, unit STRING, speed DOUBLE")
    best = sp.canonical_rows(reps, ["k"])
    assert {r.minute: r.speed_mph for r in best.collect()} == {5: 3.0, 0: None}
    assert "SortAggregate" not in best._jdf.queryExecution().toString()
    row = reps.groupBy("k").agg(F.collect_list(F.struct("minute", "unit", "speed")).alias("reps")).select(sp.canonical_samples("reps").alias("s")).first()
    assert [(e.minute, e.speed_mph) for e in row.s] == [(0, None), (5, 3.0)]


def test_limits_are_folded_without_sorting_rows(spark):
    from roadlens.operators.profiles import profile_limits

    arrays = spark.createDataFrame([(2, [0, 1], [10.0, 19.0, 19.0, 19.0]), (1, [0, 1], [10.0, 19.0, 19.0, 19.0]), (3, [0], [5.0])], "k INT, periods ARRAY<INT>, speeds ARRAY<DOUBLE>")
    folded = profile_limits(arrays, ["k"])
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "Union" not in plan
    got = {(r.form, r.measure): (r.largest, r.k, r.profiles, r.beyond) for r in folded.collect()}
    assert len(got) == 6 and got["exact", "max_step"] == (9.0, 1, 3, 2) and got["rounded", "max_rolling"] == (3.0, 1, 3, 0)
    assert profile_limits(arrays.limit(0), ["k"]).count() == 0
