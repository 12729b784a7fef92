"""Hourly estimate on two links and two periods."""

import re

import pytest
from pyspark.sql import functions as F

from roadlens.functions.s3 import with_parameters
from roadlens.functions.timeofday import periods_from
from roadlens.operators import speed_volume as sv
from roadlens.sources import speeds as sp

PERIODS = periods_from({"am": "0630_0730", "md": "0730_0845"})


def build(spark, slow=20.0, fast=40.0):
    rows = []
    for p in PERIODS:
        for a, b in ((1, 2), (2, 1)):
            for i, m in enumerate(range(p.start, p.end, 5)):
                rows.append((p.name, a, b, m, slow if i < p.minutes // 10 else fast))
    speeds = spark.createDataFrame(rows, "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, minute INT, speed_mph DOUBLE")
    perf = spark.createDataFrame([(p.name, a, b, 100.0 + a, 30.0) for p in PERIODS for a, b in ((1, 2), (2, 1))],
                                 "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, volume DOUBLE, speed_mph DOUBLE")
    links = spark.createDataFrame([(7, 1, 2, 1, 2, 1000, 96.56064, 60.0), (8, 2, 1, 1, 1, 900, 96.56064, 60.0)],
                                  "link_id INT, from_node_id BIGINT, to_node_id BIGINT, link_type INT, lanes INT, capacity INT, free_speed DOUBLE, vdf_free_speed_mph DOUBLE")
    return perf, links, speeds


def test_conserves_and_bins(spark):
    perf, links, speeds = build(spark)
    hours, audit = sv.speed_volume(perf, links, speeds, PERIODS)
    assert sv.conservation(hours, perf).count() == 0
    got = {(r.from_node_id, r.bin_start): r for r in hours.collect()}
    assert {b for _, b in got} == {390, 450, 510}
    assert got[1, 390].spd_mph == pytest.approx(60 / (30 / 20 + 30 / 40)) and got[1, 510].bin_end == 525
    a = {(r.time_period, r.from_node_id): r for r in audit.collect()}
    assert a["am", 1].capacity == 2000 and a["am", 1].status == "s3_scaled" and abs(a["am", 1].conservation_error) < 1e-9


def test_zero_invalid_missing_and_fallback(spark):
    perf, links, speeds = build(spark)
    m = F.col("minute")
    speeds = speeds.withColumn("speed_mph", F.when((m == 400) & (F.col("from_node_id") == 1), 0.0).when(m == 460, F.lit(-5.0)).otherwise(F.col("speed_mph")))
    speeds = speeds.where((m != 470))
    hours, audit = sv.speed_volume(perf, links, speeds, PERIODS)
    got = {(r.from_node_id, r.bin_start): r.spd_mph for r in hours.collect()}
    assert got[1, 390] == 0.0 and got[1, 450] is None and got[2, 390] > 0
    a = {(r.time_period, r.from_node_id): r for r in audit.collect()}
    assert a["md", 1].invalid_speed_intervals == 1 and a["md", 1].imputed_speed_intervals == 1 and a["md", 1].imputation_source == "speed_mph"
    still = build(spark, 0.0, 0.0)
    flat = {r.status for r in sv.speed_volume(*still, PERIODS)[1].collect()}
    assert flat == {"uniform_duration_fallback"}
    assert sv.conservation(sv.speed_volume(*still, PERIODS)[0], still[0]).count() == 0


def test_strict_inputs(spark):
    perf, links, speeds = build(spark)
    with pytest.raises(Exception, match="missing in the link table"):
        sv.speed_volume(perf, links.limit(1), speeds, PERIODS)[0].count()
    with pytest.raises(Exception, match="duplicate keys"):
        sv.speed_volume(perf.union(perf.limit(1)), links, speeds, PERIODS)[0].count()
    with pytest.raises(Exception, match="two speeds for one minute"):
        sv.speed_volume(perf, links, speeds.union(speeds.limit(1)), PERIODS)[0].count()
    with pytest.raises(Exception, match="period boundary"):
        sv.speed_volume(perf, links, speeds.where("minute <> 390"), PERIODS)[0].count()


def test_parameter_chain(spark):
    f = spark.sql("SELECT 45D AS vc_mph, 4.818841679306419D AS s3_m, 2000D AS link_capacity, array(30D, 40D) AS speeds")
    r = with_parameters(f).first()
    assert r.free_speed_source == "derived_from_vc_and_m" and r.s3_free_speed == pytest.approx(60.0)
    assert r.s3_m == pytest.approx(4.818841679306419) and r.critical_speed_source == "vc_mph"
    r = with_parameters(spark.sql("SELECT array(30D, -1D, 40D) AS speeds")).first()
    assert r.s3_free_speed == pytest.approx(39.5) and r.critical_speed_mph == pytest.approx(0.75 * 39.5) and r.s3_capacity == 1800


def test_wide_columns(spark):
    w = spark.sql("SELECT 1 AS link_id, 10D AS `spd_mph_06:30`, 99D AS `spd_06:30`, 16.09344D AS `spd_kmph_06:35`, 7D AS `spd_mph_09:00`")
    am = PERIODS[0]
    rows = {r.minute: r.speed_mph for r in sp.unpivot_speeds(w, ["link_id"], am).collect()}
    assert rows == {390: 10.0, 395: pytest.approx(10.0)}
    assert sp.drop_foreign_speeds(w, am).columns == ["link_id", "spd_mph_06:30", "spd_06:30", "spd_kmph_06:35"]
    back = sp.pivot_speeds(sp.unpivot_speeds(w, ["link_id"], am), ["link_id"], [390, 395]).first()
    assert back["spd_mph_06:30"] == 10.0


def test_hours_are_folded_from_arrays_like_intervals(spark):
    """Intervals that cross the edge of a bin, a short last interval, stopped and invalid samples, a bin that two periods share."""
    import math

    from pyspark.sql import functions as F

    from roadlens.functions.timeofday import Period
    from roadlens.operators import speed_volume as sv

    periods = [Period("am", 370, 510), Period("md", 510, 700)]
    rows = [("am", 1, 2, 370, 35, 20 - 15 + 0 + 30, [0, 35, 70, 105], [30.0, 40.0, None, 20.0], [10.0, 20.0, 30.0, 40.0]),
            ("md", 1, 2, 510, 45, 10, [0, 45, 90, 135, 180], [0.0, 60.0, -1.0, 50.0, 10.0], [1.0, 2.0, 3.0, 4.0, 5.0]),
            ("am", 3, 4, 370, 35, 35, [0, 35, 70, 105], [30.0, 40.0, 50.0, 20.0], [10.0, 20.0, 30.0, 40.0])]
    frame = spark.createDataFrame(rows, "time_period string, from_node_id bigint, to_node_id bigint, timeline_start int, step int, last_step int, grid array<int>, speeds array<double>, estimated array<double>")
    frame = frame.withColumn("interval_hours", F.transform("grid", lambda o: F.when(o == F.element_at("grid", -1), F.col("last_step")).otherwise(F.col("step")) / 60))
    want = {}
    for r in sv.intervals(frame).collect():
        for b in range((r.interval_start - 370) // 60, (r.interval_end - 1 - 370) // 60 + 1):
            low, high = 370 + 60 * b, min(430 + 60 * b, 700)
            inside = min(r.interval_end, high) - max(r.interval_start, low)
            cell = want.setdefault((r.from_node_id, low), [0.0, 0.0, 0.0, False, False])
            cell[0] += r.volume * inside / (r.interval_end - r.interval_start)
            cell[1] += inside
            cell[2] += inside / r.speed_mph if r.speed_mph and r.speed_mph > 0 else 0.0
            cell[3] |= r.speed_mph == 0
            cell[4] |= r.speed_mph is None or r.speed_mph < 0
    got = {(r.from_node_id, r.bin_start): r for r in sv.hourly(frame, periods).collect()}
    assert set(got) == set(want) and len(got) == 9
    for key, (volume, minutes, travel, stopped, invalid) in want.items():
        speed = None if invalid else 0.0 if stopped else minutes / travel
        assert math.isclose(got[key].approx_volume, volume, abs_tol=1e-9) and (got[key].spd_mph is None) == (speed is None)
        assert speed is None or math.isclose(got[key].spd_mph, speed, rel_tol=1e-9)


def test_samples_move_once(spark):
    """Plan of the hourly estimate without broadcast: one exchange carries samples, what follows carries hours."""
    from roadlens.plans import speed_queries as q

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = q.speed_volume_hourly(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    below = [next(x for x in lines[i + 1:] if x.strip()) for i, line in enumerate(lines) if "Exchange hashpartitioning(time_period" in line]
    assert not any("interval_hours" in line and "Exchange" in line for line in lines)
    assert sum("collect_list(struct(o" in x for x in below) <= 2 and "samples" not in "".join(line for line in lines if "Exchange" in line)


def test_hours_of_a_link_are_summed_where_they_are(spark):
    from roadlens.plans import catalog

    for name in ("speed_volume_conservation", "speed_volume_export"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "explode(sequence(" in plan and not re.search(r"Exchange hashpartitioning\([^)]*\bb#", plan)


def test_a_join_within_links_equals_the_join_by_keys(spark):
    left = spark.createDataFrame([("am", 1, 2, 5), ("md", 1, 2, 6), ("pm", 1, 2, 7), ("am", 2, 1, 8)], "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, x INT")
    right = spark.createDataFrame([("am", 1, 2, 50), ("pm", 1, 2, 70), ("md", 2, 1, 90)], "time_period STRING, from_node_id BIGINT, to_node_id BIGINT, y INT")
    got, want = sv.within_link(left, right), left.join(right, sv.KEYS, "left")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
