"""Person delay of transit riders on road links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.columns import PAIR, zero_if_null

# The kind of transit link that carries riders, and the marker of an unknown one.
SERVICE = "service_links"
UNKNOWN_VOLUME = -1.0
MIN_HOURS = 0.1
MEASURES = ["delay", "person_delay", "person_hour", "person_mile"]


def riders_by_pair(routes: DataFrame, transit: DataFrame) -> DataFrame:
    """Riders per directed pair: every trace on the pair adds the volume of its service link.

    The traces are counted per (trace, pair) first, so a trace or pair that holds a large share of
    the rows is reduced before it meets the join.
    """
    keys = (["time_period"] if "time_period" in routes.columns else []) + PAIR
    counted = routes.groupBy(*keys, "trace_id").agg(F.count("*").alias("uses"))
    service = transit.where(F.col("link_type_name") == SERVICE).select(F.col("link_id").alias("trace_id"), F.col("volume").alias("riders"))
    joined = counted.join(service, "trace_id", "left")
    one = F.coalesce(F.col("riders"), F.lit(UNKNOWN_VOLUME)) * F.col("uses")
    return joined.groupBy(*keys).agg(F.sum(one).alias("transit_volume"))


def transit_cells(perf: DataFrame, links: DataFrame, riders: DataFrame, by: list[str]) -> DataFrame:
    """Sums per period (and scenario) over all road links; a link without riders adds its delay only."""
    keys = [k for k in ("time_period", *PAIR) if k in riders.columns]
    attrs = [a for a in ("length_in_mile", "free_speed") if a not in perf.columns]
    j = perf.join(links.select(*PAIR, *attrs), PAIR, "left") if attrs else perf
    j = j.join(riders, keys, "left").withColumn("transit_volume", zero_if_null("transit_volume"))
    tt = F.try_divide(F.col("length_in_mile"), F.col("speed_mph"))
    delay = tt - F.try_divide(F.col("length_in_mile"), F.col("free_speed"))
    v = F.col("transit_volume")
    return j.groupBy(*by).agg(
        zero_if_null(F.sum(delay)).alias("delay"), zero_if_null(F.sum(v * delay)).alias("person_delay"),
        zero_if_null(F.sum(v * tt)).alias("person_hour"), zero_if_null(F.sum(v * F.col("length_in_mile"))).alias("person_mile"))


def _with_ratios(frame: DataFrame, hours: Column) -> DataFrame:
    return frame.withColumns({"mile_over_hour": F.try_divide(F.col("person_mile"), hours),
                              "delay_over_hour": F.try_divide(F.col("person_delay"), hours)})


def transit_report(cells: DataFrame) -> DataFrame:
    """Rows per scenario and period, the total over periods, and BD - NB of both.

    ``cells`` has a row per (scenario, time_period): a table of a few rows, rolled up without
    touching the data again.
    """
    fed = cells.withColumn("time_period", F.explode(F.array(F.col("time_period"), F.lit("total"))))
    level = fed.groupBy("scenario", "time_period").agg(*[F.sum(m).alias(m) for m in MEASURES])
    hours = F.when(F.col("time_period") == "total", F.greatest(F.col("person_hour"), F.lit(MIN_HOURS))).otherwise(F.col("person_hour"))
    rows = _with_ratios(level, hours)
    names = [*MEASURES, "mile_over_hour", "delay_over_hour"]
    # One row per scenario and period, so the maximum of a scenario is its value; a side that is absent gives NULL.
    side = {s: {n: F.max(F.when(F.col("scenario") == s, F.col(n))) for n in names} for s in ("BD", "NB")}
    diff = rows.where(F.col("scenario").isin("BD", "NB")).groupBy("time_period").agg(
        *[(side["BD"][n] - side["NB"][n]).alias(n) for n in names])
    return rows.select("scenario", "time_period", *names).unionByName(
        diff.select(F.lit("DIFF").alias("scenario"), "time_period", *names))


def transit_person_delay(scenarios: dict[str, tuple[DataFrame, DataFrame]], routes: DataFrame, transit: DataFrame) -> DataFrame:
    """Report over scenarios ``{"BD": (perf, links), "NB": ...}`` that share the transit tables."""
    riders = riders_by_pair(routes, transit)
    cells = None
    for name, (perf, links) in scenarios.items():
        one = transit_cells(perf, links, riders, ["time_period"]).withColumn("scenario", F.lit(name))
        cells = one if cells is None else cells.unionByName(one)
    return transit_report(cells)
