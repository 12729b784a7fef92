"""Queries over raw and enforced speed profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens.functions.columns import PAIR
from roadlens.functions.timeofday import Period
from roadlens.operators import profiles as pr
from roadlens.operators.quality import uncovered
from roadlens.plans.link_queries import SEQ, entry_value
from roadlens.plans.performance_queries import KEYS
from roadlens.plans.registry import query
from roadlens.plans.road_views import add_view, check_sql, road, tie

DAY_PERIODS = [Period("am", 360, 540), Period("md", 540, 900), Period("pm", 900, 1140), Period("nt", 1140, 1440)]

# Profile attributes of every period link; the modes cover all branches of the curve.
add_view("profile_link", f"""
SELECT time_period, from_node_id, to_node_id, l.lanes, 50 + l.capacity % 400 AS capacity, l.free_speed AS vdf_free_speed_mph,
       l.length_in_mile AS vdf_length_mi, {entry_value(0, SEQ)} AS vdf_plf, 15e-2 + {entry_value(6, SEQ)} / 4 AS vdf_alpha,
       2e0 + {entry_value(7, SEQ)} * 3 AS vdf_beta, {entry_value(4, SEQ)} / 2 AS vdf_cp, 5e-1 + {entry_value(5, SEQ)} AS vdf_cd,
       8e-1 + {entry_value(2, SEQ)} / 2 AS vdf_n, 5e-1 + {entry_value(3, SEQ)} AS vdf_s,
       CASE WHEN to_node_id % 13 = 0 THEN 1 ELSE 2 END AS vdf_type,
       CASE to_node_id % 10 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 2 END AS qvdf_profile_mode,
       t.t0_hour, t.t2_hour, t.t3_hour, a.qvdf_start_speed_mph, a.qvdf_end_speed_mph
FROM link_performance f JOIN link l USING (from_node_id, to_node_id)
  LEFT JOIN times_observed t USING (time_period, from_node_id, to_node_id) LEFT JOIN anchors a USING (time_period, from_node_id, to_node_id)
""", ["link", "link_performance", "times_observed", "anchors"])


def inputs(spark, sf):
    return pr.profile_inputs(road(spark, sf, "link_performance"), road(spark, sf, "profile_link"), DAY_PERIODS, PAIR)


CURVE = """
i0 AS (SELECT p.*, f.volume, f.speed_mph AS assigned, 0.75e0 * vdf_free_speed_mph AS cutoff,
    CASE time_period WHEN 'am' THEN 6e0 WHEN 'md' THEN 9e0 WHEN 'pm' THEN 15e0 ELSE 19e0 END AS ps,
    CASE time_period WHEN 'am' THEN 9e0 WHEN 'md' THEN 15e0 WHEN 'pm' THEN 19e0 ELSE 24e0 END AS pe
  FROM profile_link p JOIN link_performance f USING (time_period, from_node_id, to_node_id)),
i1 AS (SELECT *, volume / lanes / (pe - ps) / greatest(1e-4, vdf_plf) / greatest(1e-1, capacity) AS doc,
    volume > 0 AND qvdf_profile_mode <> 0 AND (qvdf_profile_mode = 1 OR (qvdf_profile_mode = 2 AND t2_hour IS NOT NULL)
      OR (qvdf_profile_mode = -1 AND (vdf_type = 2 OR t2_hour IS NOT NULL))) AS gen FROM i0),
i2 AS (SELECT *, CASE WHEN doc < 1 THEN (1 - doc) * vdf_free_speed_mph + doc * cutoff ELSE cutoff END AS vref, vdf_cd * power(doc, vdf_n) AS p,
    coalesce(t2_hour, (ps + pe) / 2) AS t2, CASE WHEN t0_hour < t2_hour AND t2_hour < t3_hour
      THEN greatest(5e-2, least(95e-2, (t2_hour - t0_hour) / (t3_hour - t0_hour))) ELSE 5e-1 END AS lf FROM i1),
i3 AS (SELECT *, greatest(vref, vref / (1 + CASE WHEN vdf_type = 2 THEN vdf_alpha ELSE 15e-2 END * power(doc, CASE WHEN vdf_type = 2 THEN vdf_beta ELSE 4 END))) AS vb,
    cutoff / (1 + vdf_cp * power(p, vdf_s)) AS vt2, greatest(ps, t2 - lf * p) AS t0, least(pe, t2 + (1 - lf) * p) AS t3 FROM i2),
i4 AS (SELECT *, vdf_length_mi / vref AS rtt, vdf_length_mi / vt2 - vdf_length_mi / vref AS w, t3 - t0 AS sp FROM i3),
m AS (SELECT i4.*, g.minute, g.minute / 6e1 AS t FROM i4 JOIN grid g USING (time_period)),
n AS (SELECT *, greatest(0e0, least(1e0, (t - t0) / sp)) AS x, greatest(0e0, least(1e0, (t2 - t0) / sp)) AS f,
    greatest(0e0, least(1e0, (t - ps) / greatest(1e-3, t0 - ps))) AS b1, greatest(0e0, least(1e0, (t - t3) / greatest(1e-3, pe - t3))) AS b2,
    (minute - ps * 60) / (((pe - ps) * 60) - 5) AS pw FROM m),
s AS (SELECT *, CASE WHEN sp > 1e-9 THEN CASE WHEN f <= 1e-9 THEN power(1 - x, 4) WHEN f >= 1 - 1e-9 THEN power(x, 4)
      ELSE power(x / f, 4 * f) * power((1 - x) / (1 - f), 4 * (1 - f)) END ELSE CASE WHEN abs(t - t2) <= 1e-9 THEN 1 ELSE 0 END END AS sh FROM n),
r AS (SELECT *, CASE WHEN gen THEN
    CASE WHEN t >= t0 AND t <= t3 THEN vdf_length_mi / (w * greatest(0, least(1, sh)) + rtt)
         WHEN t < t0 THEN (1 - b1 * b1 * (3 - 2 * b1)) * vdf_free_speed_mph + b1 * b1 * (3 - 2 * b1) * vb
         ELSE (1 - b2 * b2 * (3 - 2 * b2)) * vb + b2 * b2 * (3 - 2 * b2) * vdf_free_speed_mph END
    ELSE (1 - pw * pw * (3 - 2 * pw)) * coalesce(qvdf_start_speed_mph, assigned) + pw * pw * (3 - 2 * pw) * coalesce(qvdf_end_speed_mph, assigned) END AS v FROM s)
"""


@query("raw_profile", check_sql("profile_link link_performance grid", f"""
SELECT time_period, from_node_id, to_node_id, CAST(any_value(gen) AS INT) AS generated, CAST(count(*) AS BIGINT) AS samples,
  {tie("min(v)", 6)} AS lowest, {tie("max(v)", 6)} AS highest, {tie("sum(v)", 5)} AS speed_sum, {tie("sum(v * minute)", 2)} AS moment
FROM r GROUP BY ALL""", CURVE))
def raw_profile(spark, sf):
    """Every sample enters: sum, extremes and first moment of each profile."""
    rows = pr.raw_profiles(inputs(spark, sf), PAIR)
    v = F.col("speed_mph")
    out = rows.groupBy(*KEYS).agg(
        F.max(F.col("is_generated").cast("int")).alias("generated"), F.count("*").alias("samples"), F.min(v).alias("lowest"),
        F.max(v).alias("highest"), F.sum(v).alias("speed_sum"), F.sum(v * F.col("minute")).alias("moment"))
    return out.select(*KEYS, "generated", "samples", F.round(F.col("lowest") + 1e-9, 6).alias("lowest"),
                      F.round(F.col("highest") + 1e-9, 6).alias("highest"), F.round(F.col("speed_sum") + 1e-8, 5).alias("speed_sum"),
                      F.round(F.col("moment") + 1e-5, 2).alias("moment"))


@query("enforced_profile")
def enforced_profile(spark, sf):
    """Summary of every enforced profile (the samples themselves are checked by the test suite)."""
    rows = pr.smooth_profiles(inputs(spark, sf), DAY_PERIODS, PAIR)
    v = F.round("speed_mph", 9)
    return rows.groupBy(*KEYS).agg(
        F.count("*").alias("samples"), F.round(F.min(v), 6).alias("lowest"), F.round(F.max(v), 6).alias("highest"),
        F.round(F.sum(v), 5).alias("speed_sum"))


@query("profile_violations", check_sql("link_performance", """
SELECT from_node_id, to_node_id FROM link_performance WHERE 1 = 0"""))
def profile_violations(spark, sf):
    """No enforced profile may break a limit: the expected result is empty."""
    arrays = pr.enforced_arrays(inputs(spark, sf), DAY_PERIODS, PAIR)
    return pr.violations(pr.array_metrics(arrays, PAIR)).select(*PAIR)


@query("profile_failures", check_sql("profile_link link_performance grid", """
SELECT from_node_id, to_node_id, 'profile holds a missing speed' AS reason FROM n
WHERE to_node_id % 97 = 5 AND time_period = 'am' AND gen AND t >= t0 AND t <= t3 GROUP BY ALL""", CURVE.split("s AS (SELECT")[0].strip()))
def profile_failures(spark, sf):
    """Links of no length in the first period have no speed in its congested window: they come out as rows, all others are smoothed."""
    spoilt = (F.col("to_node_id") % 97 == 5) & (F.col("time_period") == "am")
    links = road(spark, sf, "profile_link").withColumn("vdf_length_mi", F.when(spoilt, F.lit(0.0)).otherwise(F.col("vdf_length_mi"))).withColumns(
        {c: F.when(~spoilt, F.col(c)) for c in ("qvdf_start_speed_mph", "qvdf_end_speed_mph")})
    found = pr.profile_outcomes(pr.profile_inputs(road(spark, sf, "link_performance"), links, DAY_PERIODS, PAIR), DAY_PERIODS, PAIR)
    return pr.profile_failures(found, PAIR).distinct()


@query("profile_limits", check_sql("link_performance", """
, ranked AS (SELECT *, CASE time_period WHEN 'am' THEN 0 WHEN 'md' THEN 1 WHEN 'pm' THEN 2 ELSE 3 END AS place FROM link_performance),
runs AS (SELECT count(*) AS n FROM (SELECT place - lag(place) OVER (PARTITION BY from_node_id, to_node_id ORDER BY place) AS gap FROM ranked) WHERE gap IS NULL OR gap > 1)
SELECT form, measure, CAST(allowed AS DOUBLE) AS allowed, true AS kept, n AS profiles, CAST(0 AS BIGINT) AS beyond
FROM (VALUES ('exact'), ('rounded')) f(form), (VALUES ('max_step', 8), ('max_rolling', 4), ('max_acceleration', 576)) m(measure, allowed), runs""").replace(")\n, ranked AS", "),\nranked AS"))
def profile_limits(spark, sf):
    """One row per limit, exact and as written: the largest value over all runs of periods keeps it, and no run exceeds it."""
    folded = pr.profile_limits(pr.enforced_arrays(inputs(spark, sf), DAY_PERIODS, PAIR), PAIR)
    kept = (F.col("largest") > 0) & (F.col("largest") <= F.col("allowed") + 1e-6) & F.col("from_node_id").isNotNull()
    return folded.select("form", "measure", "allowed", kept.alias("kept"), "profiles", "beyond")


@query("profile_sample_count", check_sql("link_performance grid", """
SELECT time_period, CAST(count(*) AS BIGINT) AS samples, CAST(count(DISTINCT (from_node_id, to_node_id)) AS BIGINT) AS links
FROM link_performance JOIN grid USING (time_period) GROUP BY 1"""))
def profile_sample_count(spark, sf):
    """The fold keeps every link and every five-minute sample."""
    rows = pr.smooth_profiles(inputs(spark, sf), DAY_PERIODS, PAIR)
    per = rows.where(F.col("speed_mph").isNotNull()).groupBy(*KEYS).agg(F.count("*").alias("n"))
    return per.groupBy("time_period").agg(F.sum("n").alias("samples"), F.count("*").alias("links"))


@query("profile_unmatched", check_sql("link link_performance times_observed anchors profile_link", """
SELECT time_period, from_node_id, to_node_id FROM link_performance
WHERE from_node_id % 10 = 3 AND time_period <> 'nt'"""))
def profile_unmatched(spark, sf):
    """Failure case: performance rows whose link is absent from the profile table, which `profile_inputs` refuses."""
    links = road(spark, sf, "profile_link").where("NOT (from_node_id % 10 = 3 AND time_period <> 'nt')")
    return uncovered(road(spark, sf, "link_performance"), links, ["time_period", *PAIR])
