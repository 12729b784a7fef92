"""Queries over performance measures and their statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens.functions.columns import PAIR
from roadlens.functions.timeofday import DEFAULT_RANGES, periods_from
from roadlens.operators import performance as perf_ops
from roadlens.operators import summary
from roadlens.plans.registry import query
from roadlens.plans.road_views import check_sql, road, settle, settled, tie

PERIODS = periods_from(DEFAULT_RANGES)
KEYS = ["time_period", *PAIR]
MEASURES = ["length", "fftt", "travel_time", "speed_ratio", "delay", "person_delay", "person_hour", "person_mile",
            "length_weighted_P", "vehicle_mile", "vehicle_hour", "trk_vehicle_mile", "trk_vehicle_hour"]

# Shared by the check SQL of this and other modules: the combined table.
COMBINED_CTES = """
resident AS (
  SELECT p.time_period, p.from_node_id, p.to_node_id,
         sum(CASE WHEN mode IN ('sov','hov2','hov3','com','trk','apv') THEN persons ELSE 0 END) AS trip_persons,
         sum(CASE mode WHEN 'sov' THEN persons ELSE 0 END) + sum(CASE mode WHEN 'hov2' THEN persons ELSE 0 END) / 2
           + sum(CASE mode WHEN 'hov3' THEN persons ELSE 0 END) / 3.5 + sum(CASE mode WHEN 'com' THEN persons ELSE 0 END)
           + sum(CASE mode WHEN 'trk' THEN persons ELSE 0 END) + sum(CASE mode WHEN 'apv' THEN persons ELSE 0 END) / 1.6 AS trip_vehicles,
         sum(CASE mode WHEN 'trk' THEN persons ELSE 0 END) AS trip_trucks
  FROM persons p JOIN link l USING (from_node_id, to_node_id)
  WHERE p.person_district = l.district_id GROUP BY ALL),
carried AS (
  SELECT f.*, l.link_id, l.district_id, l."TAZ", l."FT", l.link_type, l.length_in_mile AS length, l.free_speed,
         CASE WHEN l."TOLLGRP" = 2 OR l.period_limit IN (2, 3) THEN 1 ELSE 0 END AS is_hov
  FROM {perf} f LEFT JOIN link l USING (from_node_id, to_node_id)),
scoped AS (SELECT * FROM carried WHERE coalesce("FT", 0) > 0 AND "TAZ" > 1404 AND "TAZ" < 2820),
kept AS (SELECT * FROM scoped WHERE time_period IN (SELECT time_period FROM scoped GROUP BY 1 HAVING sum(volume) >= 0.5)),
timed AS (
  SELECT *, CASE WHEN free_speed > 0 THEN length / free_speed END AS fftt,
         CASE WHEN speed_mph > 0 THEN length / speed_mph END AS travel_time,
         CASE WHEN free_speed > 0 THEN speed_mph / free_speed END AS speed_ratio FROM kept),
delayed AS (
  SELECT *, CASE WHEN travel_time - fftt > 0 AND speed_ratio < 1 THEN travel_time - fftt ELSE 0 END AS delay FROM timed),
measured AS (
  SELECT d.*, volume * delay AS person_delay, volume * travel_time AS person_hour, volume * length AS person_mile,
         "Severe_Congestion_P" * length AS "length_weighted_P",
         volume * length AS vehicle_mile, volume * travel_time AS vehicle_hour,
         mod_vol_trk * length AS trk_vehicle_mile, mod_vol_trk * travel_time AS trk_vehicle_hour,
         coalesce(r.trip_persons, 0) AS tp, coalesce(r.trip_vehicles, 0) AS tv, coalesce(r.trip_trucks, 0) AS tt
  FROM delayed d LEFT JOIN resident r USING (time_period, from_node_id, to_node_id)),
tripped AS (
  SELECT *, tp * delay AS trip_person_delay, tp * coalesce(travel_time, 0) AS trip_person_hour, tp * length AS trip_person_mile,
         tv * length AS trip_vehicle_mile, tv * coalesce(travel_time, 0) AS trip_vehicle_hour,
         tt * length AS trip_trk_vehicle_mile, tt * coalesce(travel_time, 0) AS trip_trk_vehicle_hour FROM measured),
combined AS (
  SELECT *, CASE WHEN is_hov = 1 THEN delay END AS hov_delay, CASE WHEN is_hov = 1 THEN person_delay END AS hov_person_delay,
         CASE WHEN is_hov = 1 THEN person_hour END AS hov_person_hour, CASE WHEN is_hov = 1 THEN person_mile END AS hov_person_mile,
         CASE WHEN is_hov = 1 THEN trip_person_delay END AS trip_hov_person_delay,
         CASE WHEN is_hov = 1 THEN trip_person_hour END AS trip_hov_person_hour,
         CASE WHEN is_hov = 1 THEN trip_person_mile END AS trip_hov_person_mile FROM tripped)
"""


def combined_ctes(perf: str = "link_performance") -> str:
    return COMBINED_CTES.replace("{perf}", perf)


def combined(spark, sf, perf="link_performance", jurisdictions=True, skip_low_volume=True, trips=True):
    links = road(spark, sf, "link")
    resident = perf_ops.resident_persons(road(spark, sf, "persons"), links) if trips else None
    return perf_ops.preprocess_performance(road(spark, sf, perf), links, PERIODS, jurisdictions=jurisdictions,
                                           resident=resident, skip_low_volume=skip_low_volume)


@query("performance_statistics", check_sql("link link_performance persons", """
, cells AS (SELECT grouping(time_period) AS gt, grouping(district_id) AS gd, time_period, district_id,
  {sums}, max("Severe_Congestion_P") AS smax, avg("Severe_Congestion_P") AS smean
  FROM combined GROUP BY GROUPING SETS ((time_period, district_id), (time_period), ())),
capped AS (SELECT *, CASE time_period WHEN 'am' THEN 3 WHEN 'md' THEN 6 WHEN 'pm' THEN 4 WHEN 'nt' THEN 11 ELSE -1 END AS lim FROM cells),
lev AS (SELECT *, least(smax, lim) AS cmax, least(smean, lim) AS cmean FROM capped),
o AS (SELECT max(cmax) AS omax, avg(cmean) AS omean FROM lev WHERE gt = 0 AND gd = 1)
SELECT CASE WHEN gt = 1 THEN 'overall' ELSE time_period END AS time_period,
  CASE WHEN gd = 1 THEN 'overall' ELSE (['Alexandria','Arlington','Fairfax','Fairfax City','Falls Church','Loudoun','Manassas',
     'Manassas Park','Prince William','Others'])[district_id] END AS jur_name,
  round(CASE WHEN gt = 1 THEN omax ELSE cmax END + 1e-5, 2) AS severe_congestion_max,
  round(CASE WHEN gt = 1 THEN omean ELSE cmean END + 1e-5, 2) AS severe_congestion_mean,
  {outs}, {ratios}
FROM lev, o
""".format(
    sums=", ".join(f'coalesce(sum("{m}"), 0) AS "{m}"' for m in summary.SUMMED),
    outs=settled([m for m in summary.SUMMED if m in summary.REPORT_COLUMNS], 2),
    ratios=", ".join(f"""{tie(f'CASE WHEN "{d}" > 0 THEN "{n}" / "{d}" END', 2)} AS {r}""" for r, n, d in summary.RATIOS),
), combined_ctes()).replace(")\n, cells", "),\ncells"))
def performance_statistics(spark, sf):
    links = road(spark, sf, "link")
    resident = perf_ops.resident_persons(road(spark, sf, "persons"), links)
    report = summary.performance_statistics(road(spark, sf, "link_performance"), links, PERIODS, resident=resident)
    return settle(report, 2)


@query("carry_attributes", check_sql("link link_performance", """
SELECT f.time_period, f.from_node_id, f.to_node_id, l.link_id, l."TAZ", l.district_id, l.length_in_mile, l."STREETNAME"
FROM link_performance f LEFT JOIN link l USING (from_node_id, to_node_id)"""))
def carry_attributes(spark, sf):
    out = perf_ops.carry_attributes(road(spark, sf, "link_performance"), road(spark, sf, "link"))
    return out.select(*KEYS, "link_id", "TAZ", "district_id", "length_in_mile", "STREETNAME")


@query("link_id_fallback", check_sql("link link_performance", """
, perf_ids AS (SELECT *, CAST(from_node_id % 50 * 4294967296 + to_node_id AS BIGINT) AS id, volume + from_node_id AS ord FROM link_performance),
l1 AS (SELECT *, CAST(from_node_id % 50 * 4294967296 + to_node_id AS BIGINT) AS id FROM link),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY time_period, id ORDER BY from_node_id) AS rn FROM perf_ids) WHERE rn = 1),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY from_node_id) AS rn FROM l1) WHERE rn = 1)
SELECT p.time_period, CAST(p.id AS VARCHAR) AS link_id, p.from_node_id, p.volume, l."TAZ", l.district_id
FROM p LEFT JOIN l USING (id)""").replace("\n, perf_ids", ",\nperf_ids"))
def link_id_fallback(spark, sf):
    """Several pairs share an id on purpose, so that first-wins is exercised on both sides."""
    shared = (F.col("from_node_id") % 50 * F.lit(4294967296) + F.col("to_node_id")).cast("bigint")
    perf = road(spark, sf, "link_performance").withColumn("link_id", shared)
    links = road(spark, sf, "link").withColumn("link_id", shared)
    out = perf_ops.carry_by_link_id(perf, links, ["TAZ", "district_id"], "from_node_id")
    return out.select("time_period", "link_id", "from_node_id", "volume", "TAZ", "district_id")


@query("preprocess_incomplete_pairs", check_sql("link link_performance", """
, f AS (SELECT *, CAST(from_node_id * 4294967296 + to_node_id AS BIGINT) AS id FROM link_performance),
m AS (SELECT f.time_period, f.id, CASE WHEN f.time_period = 'pm' AND f.to_node_id % 11 = 0 THEN NULL ELSE f.from_node_id END AS from_node_id,
        f.volume, l."TAZ", l.district_id, f.volume * l.length_in_mile AS person_mile
      FROM f JOIN link l ON l.link_id = f.id WHERE l."FT" > 0 AND l."TAZ" > 1404 AND l."TAZ" < 2820)
SELECT time_period, CAST(id AS VARCHAR) AS link_id, from_node_id, volume, "TAZ", district_id, round(person_mile + 1e-9, 6) AS person_mile FROM m""").replace("\n, f AS", ",\nf AS"))
def preprocess_incomplete_pairs(spark, sf):
    """Some evening rows lack a node: that period is matched by link id, and no row is lost."""
    shared = (F.col("from_node_id") * F.lit(4294967296) + F.col("to_node_id")).cast("bigint").cast("string")
    lacking = (F.col("time_period") == "pm") & (F.col("to_node_id") % 11 == 0)
    perf = road(spark, sf, "link_performance").withColumn("link_id", shared).withColumn("from_node_id", F.when(~lacking, F.col("from_node_id")))
    links = road(spark, sf, "link").withColumn("link_id", shared)
    out = perf_ops.preprocess_performance(perf, links, order="to_node_id")
    return settle(out.select("time_period", "link_id", "from_node_id", "volume", "TAZ", "district_id", "person_mile"), 6)


@query("hov_flag_measures", check_sql("link link_performance persons", f"""
SELECT time_period, from_node_id, to_node_id, is_hov, {settled(MEASURES, 6)},
  {settled(["hov_delay", "hov_person_delay", "hov_person_hour", "hov_person_mile"], 6)}
FROM combined""", combined_ctes()))
def hov_flag_measures(spark, sf):
    out = combined(spark, sf, trips=False).select(
        *KEYS, "is_hov", *MEASURES, "hov_delay", "hov_person_delay", "hov_person_hour", "hov_person_mile")
    return settle(out, 6)


TRIPS = ["trip_person_delay", "trip_person_hour", "trip_person_mile", "trip_vehicle_mile", "trip_vehicle_hour",
         "trip_trk_vehicle_mile", "trip_trk_vehicle_hour", "trip_hov_person_delay", "trip_hov_person_hour",
         "trip_hov_person_mile"]


@query("trip_measures", check_sql("link link_performance persons", f"""
SELECT time_period, from_node_id, to_node_id, {settled(TRIPS, 5)} FROM combined""", combined_ctes()))
def trip_measures(spark, sf):
    return settle(combined(spark, sf).select(*KEYS, *TRIPS), 5)


@query("scope_filter", check_sql("link link_performance", """
SELECT time_period, CAST(count(*) AS BIGINT) AS roadway_rows,
       CAST(count(*) FILTER (WHERE "TAZ" > 1404 AND "TAZ" < 2820) AS BIGINT) AS scoped_rows
FROM link_performance JOIN link USING (from_node_id, to_node_id) WHERE coalesce("FT", 0) > 0 GROUP BY 1"""))
def scope_filter(spark, sf):
    carried = perf_ops.carry_attributes(road(spark, sf, "link_performance"), road(spark, sf, "link"), ["FT", "TAZ"])
    roadway, scoped = (perf_ops.analysis_scope(carried, j) for j in (False, True))
    return carried.where(roadway).groupBy("time_period").agg(
        F.count("*").alias("roadway_rows"), F.count_if(scoped).alias("scoped_rows"))


@query("low_volume_skip", check_sql("link_performance", """
, v AS (SELECT time_period, from_node_id, to_node_id, CASE WHEN time_period = 'nt' THEN 0.0 ELSE volume END AS volume FROM link_performance)
SELECT time_period, CAST(count(*) AS BIGINT) AS n, sum(volume) AS volume FROM v
WHERE time_period IN (SELECT time_period FROM v GROUP BY 1 HAVING sum(volume) >= 0.5) GROUP BY 1
""").replace("\n, v AS", ",\nv AS"))
def low_volume_skip(spark, sf):
    perf = road(spark, sf, "link_performance").withColumn(
        "volume", F.when(F.col("time_period") == "nt", F.lit(0.0)).otherwise(F.col("volume")))
    kept = perf_ops.drop_low_volume_periods(perf)
    return kept.groupBy("time_period").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))
