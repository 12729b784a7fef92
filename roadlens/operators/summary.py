"""Statistics by period and jurisdiction, by period, and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlens.functions.columns import capped, ratio
from roadlens.functions.timeofday import Period
from roadlens.operators.performance import period_left, preprocess_performance
from roadlens.sources.periods import period_map

# District ids, report measures and the order of report columns.
DISTRICTS = {1: "Alexandria", 2: "Arlington", 3: "Fairfax", 4: "Fairfax City", 5: "Falls Church",
             6: "Loudoun", 7: "Manassas", 8: "Manassas Park", 9: "Prince William", 10: "Others"}
SUMMED = [
    "length", "delay", "person_delay", "person_hour", "person_mile", "length_weighted_P",
    "vehicle_mile", "vehicle_hour", "trk_vehicle_mile", "trk_vehicle_hour",
    "hov_delay", "hov_person_delay", "hov_person_hour", "hov_person_mile",
    "trip_person_delay", "trip_person_hour", "trip_person_mile", "trip_vehicle_mile", "trip_vehicle_hour",
    "trip_trk_vehicle_mile", "trip_trk_vehicle_hour",
    "trip_hov_person_delay", "trip_hov_person_hour", "trip_hov_person_mile",
]
RATIOS = [
    ("mile_over_hour", "person_mile", "person_hour"),
    ("delay_over_hour", "person_delay", "person_hour"),
    ("severe_congestion_length_weighted", "length_weighted_P", "length"),
    ("vehicle_mile_over_hour", "vehicle_mile", "vehicle_hour"),
    ("trk_mile_over_hour", "trk_vehicle_mile", "trk_vehicle_hour"),
    ("hov_mile_over_hour", "hov_person_mile", "hov_person_hour"),
    ("hov_delay_over_hour", "hov_person_delay", "hov_person_hour"),
    ("trip_mile_over_hour", "trip_person_mile", "trip_person_hour"),
    ("trip_delay_over_hour", "trip_person_delay", "trip_person_hour"),
    ("trip_vehicle_mile_over_hour", "trip_vehicle_mile", "trip_vehicle_hour"),
    ("trip_trk_mile_over_hour", "trip_trk_vehicle_mile", "trip_trk_vehicle_hour"),
    ("trip_hov_mile_over_hour", "trip_hov_person_mile", "trip_hov_person_hour"),
    ("trip_hov_delay_over_hour", "trip_hov_person_delay", "trip_hov_person_hour"),
]
REPORT_COLUMNS = [
    "time_period", "jur_name", "delay", "person_delay", "person_hour", "person_mile",
    "mile_over_hour", "delay_over_hour",
    "severe_congestion_length_weighted", "severe_congestion_max", "severe_congestion_mean",
    "vehicle_mile", "vehicle_hour", "vehicle_mile_over_hour",
    "trk_vehicle_mile", "trk_vehicle_hour", "trk_mile_over_hour",
    "hov_delay", "hov_person_delay", "hov_person_mile", "hov_mile_over_hour", "hov_delay_over_hour",
    "trip_person_delay", "trip_person_hour", "trip_person_mile", "trip_mile_over_hour", "trip_delay_over_hour",
    "trip_vehicle_mile", "trip_vehicle_hour", "trip_vehicle_mile_over_hour",
    "trip_trk_vehicle_mile", "trip_trk_vehicle_hour", "trip_trk_mile_over_hour",
    "trip_hov_person_delay", "trip_hov_person_hour", "trip_hov_person_mile",
    "trip_hov_mile_over_hour", "trip_hov_delay_over_hour",
]
SEVERE = "Severe_Congestion_P"


def district_name(district: Column) -> Column:
    pairs: list[Column] = []
    for key, name in DISTRICTS.items():
        pairs += [F.lit(key), F.lit(name)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), district.cast("int")), F.lit("-1"))


def period_district_cells(combined: DataFrame) -> DataFrame:
    """The only pass over the data: sums, counts and maxima per period and district.

    A cell count of periods x districts is all that leaves this aggregation, and it is combined
    on the map side, so a district that holds most rows costs nothing extra.
    """
    present = set(combined.columns)
    sums = [F.sum(m).alias(m) if m in present else F.lit(None).cast("double").alias(m) for m in SUMMED]
    return combined.groupBy("time_period", "district_id").agg(
        *sums,
        F.sum("volume").alias("cell_volume"),
        F.max(SEVERE).alias("severe_max"),
        F.sum(SEVERE).alias("severe_sum"),
        F.count(SEVERE).alias("severe_n"),
    )


def statistics_from_cells(cells: DataFrame, durations: Column) -> DataFrame:
    """Roll the cells up to the three report levels and add the ratios."""
    level = cells.where(F.col("time_period").isNotNull()).rollup("time_period", "district_id").agg(
        F.grouping_id().alias("gid"),
        *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in SUMMED],
        F.max("severe_max").alias("severe_max"),
        F.sum("severe_sum").alias("severe_sum"), F.sum("severe_n").alias("severe_n"),
    ).where(~((F.col("gid") == 0) & F.col("district_id").isNull()))
    limit = F.coalesce(F.try_element_at(durations, F.col("time_period")), F.lit(-1.0))
    level = level.withColumns({
        "severe_congestion_max": capped("severe_max", limit),
        "severe_congestion_mean": capped(ratio("severe_sum", "severe_n"), limit),
    })
    # The rolled-up table has (periods + 1) x (districts + 1) rows, so one window partition is bounded.
    whole = W.partitionBy(F.lit(0))
    by_period = F.col("gid") == 1
    top = F.col("gid") == 3
    level = level.withColumns({
        "o_max": F.max(F.when(by_period, F.col("severe_congestion_max"))).over(whole),
        "o_mean": F.avg(F.when(by_period, F.col("severe_congestion_mean"))).over(whole),
    }).withColumns({
        "severe_congestion_max": F.when(top, F.col("o_max")).otherwise(F.col("severe_congestion_max")),
        "severe_congestion_mean": F.when(top, F.col("o_mean")).otherwise(F.col("severe_congestion_mean")),
        **{name: ratio(num, den) for name, num, den in RATIOS},
        "time_period": F.when(top, F.lit("overall")).otherwise(F.col("time_period")),
        "jur_name": F.when(F.col("gid") > 0, F.lit("overall")).otherwise(district_name(F.col("district_id"))),
    })
    return level.select(*REPORT_COLUMNS)


def drop_low_volume_cells(cells: DataFrame) -> DataFrame:
    """The period test of the preprocessing, on the aggregated cells (tens of rows)."""
    total = F.sum("cell_volume").over(W.partitionBy("time_period"))
    kept = cells.withColumn("__total", total).withColumn("__left", period_left(F.col("__total")))
    return kept.where("__left").drop("__total", "__left")


def performance_summary(combined: DataFrame, periods: list[Period], midnight: str = "wrap") -> DataFrame:
    """Statistics of an existing combined table."""
    return statistics_from_cells(period_district_cells(combined), period_map(periods, "hours", midnight))


def performance_statistics(perf: DataFrame, links: DataFrame, periods: list[Period], *, jurisdictions: bool = True,
                           resident: DataFrame | None = None, midnight: str = "wrap") -> DataFrame:
    """Preprocessing and statistics as one plan with a single pass over the inputs."""
    combined = preprocess_performance(perf, links, periods, jurisdictions=jurisdictions, resident=resident,
                                      skip_low_volume=False)
    cells = drop_low_volume_cells(period_district_cells(combined))
    return statistics_from_cells(cells, period_map(periods, "hours", midnight))
