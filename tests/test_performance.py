"""Preprocessing and statistics on hand-made links."""

import pytest
from pyspark.sql import functions as F

from roadlens.functions.timeofday import Period, parse_range, periods_from
from roadlens.operators import performance as po, summary
from roadlens.operators.quality import QualityError, duplicate_keys, enforce
from roadlens.sources.periods import hourly_bins, resolve_periods, unwrapped_starts


@pytest.fixture(scope="module")
def tables(spark):
    links = spark.createDataFrame(
        [(1, 1, 2, 101, 60.0, 2.0, 1500, 2, 1, 0, 2, "Main"), (2, 2, 3, 102, 50.0, 1.0, 3000, 2, 2, 0, 0, "Far"),
         (3, 3, 4, 100, 30.0, 0.5, 1500, 2, 0, 0, 0, "Connector")],
        "link_id INT, from_node_id INT, to_node_id INT, link_type INT, free_speed DOUBLE, length_in_mile DOUBLE, TAZ INT, "
        "district_id INT, FT INT, TOLLGRP INT, AMLIMIT INT, STREETNAME STRING")
    perf = spark.createDataFrame(
        [("AM", 9001, 1, 2, 30.0, 100.0), ("AM", 9002, 2, 3, 25.0, 50.0), ("AM", 9003, 3, 4, 30.0, 10.0)],
        "time_period STRING, link_id INT, from_node_id INT, to_node_id INT, speed_mph DOUBLE, volume DOUBLE")
    return perf, links


def test_scope_and_measures(tables):
    perf, links = tables
    rows = po.preprocess_performance(perf, links, jurisdictions=True).collect()
    assert [(r.from_node_id, r.STREETNAME, r.link_id) for r in rows] == [(1, "Main", 9001)]
    r = rows[0]
    assert r.is_hov == 1 and r.travel_time == pytest.approx(2 / 30) and r.delay == pytest.approx(2 / 30 - 2 / 60)
    assert r.person_delay == pytest.approx(100 * (2 / 30 - 2 / 60)) and r.hov_person_mile == pytest.approx(200)
    assert po.preprocess_performance(perf, links, jurisdictions=False).count() == 2


def test_duplicate_pair_fails(spark, tables):
    perf, links = tables
    with pytest.raises(Exception, match="duplicate keys"):
        po.carry_attributes(perf, links.union(links.limit(1))).collect()
    with pytest.raises(QualityError):
        enforce(duplicate_keys(links.union(links), ["from_node_id", "to_node_id"]), "duplicates")


def test_wide_and_long_resident_trips_agree(spark, tables):
    perf, links = tables
    perf = perf.withColumn("time_period", F.lit("am"))
    wide = perf.withColumns({"person_vol_district_2_hov3": F.lit(7.0), "person_vol_district_2_trk": F.lit(4.0),
                             "person_vol_district_3_sov": F.lit(99.0)})
    persons = perf.select("time_period", "from_node_id", "to_node_id", F.explode(F.expr(
        "array(" + ",".join(f"named_struct('person_district',{d},'mode','{m}','persons',{v}D)" for d, m, v in ((2, "hov3", 7), (2, "trk", 4), (3, "sov", 99))) + ")")).alias("p")).select(
        "time_period", F.col("from_node_id").cast("bigint"), F.col("to_node_id").cast("bigint"), "p.*")
    l64 = links.withColumns({c: F.col(c).cast("bigint") for c in ("from_node_id", "to_node_id")})
    a = po.preprocess_performance(wide, links, jurisdictions=False)
    b = po.preprocess_performance(perf, l64, jurisdictions=False, resident=po.resident_persons(persons, l64))
    cols = ["from_node_id", "trip_person_mile", "trip_vehicle_mile", "trip_trk_vehicle_mile"]
    assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))
    assert a.where("from_node_id = 1").first().trip_vehicle_mile == pytest.approx((7 / 3.5 + 4) * 2)


def test_statistics_levels_and_caps(spark, tables):
    perf, links = tables
    perf = perf.withColumn("Severe_Congestion_P", F.col("volume") / 10)
    periods = periods_from({"am": "0600_0900"})
    rows = {(r.time_period, r.jur_name): r for r in summary.performance_statistics(perf, links, periods, jurisdictions=False).collect()}
    assert set(rows) == {("am", "Arlington"), ("am", "overall"), ("overall", "overall")}
    assert rows["am", "overall"].severe_congestion_max == 3.0
    assert rows["overall", "overall"].person_mile == pytest.approx(250)


def test_low_volume_period_is_dropped(spark, tables):
    perf, links = tables
    quiet = perf.withColumns({"time_period": F.lit("pm"), "volume": F.lit(0.1)})
    both = po.preprocess_performance(perf.union(quiet), links, jurisdictions=False)
    assert {r.time_period for r in both.collect()} == {"am"}


def test_periods(spark):
    assert parse_range("600_24:00") == (360, 1440)
    with pytest.raises(ValueError):
        parse_range("2400_0600")
    nt = Period("nt", 1140, 360)
    assert nt.minutes == 660 and nt.hours("truncate") == 5.0 and nt.text == "1900_0600"
    ps = periods_from({"am": "0630_0730", "md": "0730_0845"})
    assert [b[2] for b in hourly_bins(ps)] == ["06:30_07:30", "07:30_08:30", "08:30_08:45"]
    assert unwrapped_starts([nt, Period("am", 360, 540)]) == {"nt": 1140, "am": 1800}
    with pytest.raises(ValueError):
        unwrapped_starts([Period("a", 0, 100), Period("b", 50, 120)])
    settings = spark.createDataFrame([("am", 6.5, 7.5)], "time_period STRING, demand_period_starting_hours DOUBLE, demand_period_ending_hours DOUBLE")
    got = resolve_periods(["am", "md"], settings, {"am": "0600_0900", "md": "0900_1500"})
    assert [(p.start, p.end, p.source) for p in got] == [(390, 450, "settings"), (540, 900, "configured")]


def test_speeds_of_the_day_come_from_their_owners(spark):
    """A minute of two periods fails; links without speeds keep an empty list; a link's second speed for a minute fails."""
    from roadlens.functions.timeofday import Period
    from roadlens.operators.compare import daily_with_speeds

    perf = spark.createDataFrame([(p, i, 9, 10.0 * i, 30.0) for p in ("am", "nt") for i in (1, 2)], "time_period string, from_node_id bigint, to_node_id bigint, volume double, speed_mph double")
    rows = [("am", 1, 9, 365, 41.0), ("am", 1, 9, 360, 40.0), ("nt", 1, 9, 1380, 50.0), ("nt", 1, 9, 300, 51.0), ("nt", 1, 9, 365, 99.0)]
    schema = "time_period string, from_node_id bigint, to_node_id bigint, minute int, speed_mph double"
    periods = [Period("am", 360, 540), Period("nt", 1140, 360)]
    day = {r.from_node_id: [(s.minute, s.speed_mph) for s in r.speeds] for r in daily_with_speeds(perf, spark.createDataFrame(rows, schema), periods).collect()}
    assert day == {1: [(300, 51.0), (360, 40.0), (365, 41.0), (1380, 50.0)], 2: []}
    overlapping = [Period("am", 360, 540), Period("nt", 1140, 370)]
    with pytest.raises(Exception, match="minute 365 belongs to overlapping periods am, nt"):
        daily_with_speeds(perf, spark.createDataFrame(rows, schema), overlapping).collect()
    with pytest.raises(Exception, match="two speeds for one minute"):
        daily_with_speeds(perf, spark.createDataFrame([*rows, ("am", 1, 9, 365, 42.0)], schema), periods).collect()
