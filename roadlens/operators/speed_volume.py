"""Hourly speed and volume estimates that conserve the assigned period totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions import samples as sa
from roadlens.functions.columns import PAIR, number_in, pair_keys, zero_if_null
from roadlens.functions.s3 import with_parameters
from roadlens.functions.samples import total
from roadlens.functions.timeofday import Period
from roadlens.operators.performance import join_keys
from roadlens.operators.quality import require, unique_by
from roadlens.sources.periods import bin_table, hourly_bins, period_table
from roadlens.sources.speeds import Samples, native_grid, own_samples, sample_arrays, with_aligned

KEYS = ["time_period", *PAIR]
NETWORK = ["link_id", "link_type", "free_speed", "capacity", "lanes", "vdf_free_speed_mph",
           "speed_at_capacity_mph", "vc_mph", "fd_vc_mph", "s3_shape_m", "s3_m"]
STATIC = ["link_id", "link_type", "free_speed", "capacity", "lanes"]
ABOVE = 1e-6


def within_link(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join by KEYS that hashes the pair alone: a link has few periods, and its rows stay together for what groups by link next.

    The period is compared as a pair of bounds, since Spark would hash an equality too and scatter the periods of a link.
    """
    other = {k: f"__{k}" for k in KEYS}
    right = right.withColumnsRenamed(other)
    same = (F.col("time_period") >= F.col("__time_period")) & (F.col("time_period") <= F.col("__time_period"))
    for k in PAIR:
        same = same & (F.col(k) == F.col(other[k]))
    return left.join(right, same, "left").drop(*other.values())


def assemble(perf: DataFrame, links: DataFrame, speeds: DataFrame, periods: list[Period], samples: Samples | None = None) -> DataFrame:
    """Strict one-to-one join of performance, network and grid-aligned speeds.

    A pair that is missing in the network, a duplicate pair and an invalid assigned volume fail
    the job.  The grid is one row per period (a few kilobytes), hence the broadcast.  ``speeds`` has a row per sample
    (``minute``, ``speed_mph``) or one per link and period, with ``samples``, entries of both, or with what they are made of: the argument
    ``samples`` then gives their column from the columns of the row, and they are made after the join, which carries no sample.
    """
    lk = join_keys(links)
    net = [c for c in NETWORK if c in links.columns]
    network = unique_by(pair_keys(links).select(*lk, *[F.col(c).alias(f"network_{c}") for c in net], F.lit(True).alias("__net")),
                        lk, "link table")
    own = [c for c in perf.columns if c not in KEYS and c not in ("volume", "speed_mph")]
    totals = unique_by(pair_keys(perf).select(
        *KEYS, *own, number_in(perf, "volume").alias("assigned_volume"), number_in(perf, "speed_mph").alias("assigned_speed")),
        KEYS, "performance table")
    wanted = totals.where(F.col("time_period").isin([p.name for p in periods]))
    speeds = pair_keys(speeds)
    single = samples is not None or "samples" in speeds.columns
    arrays = sample_arrays(speeds, periods) if samples is None else speeds
    grid = native_grid(arrays, periods, "samples" if samples is None else own_samples(samples(F.col), periods))
    table = period_table(perf.sparkSession, periods).select("time_period", "period_index", "period_minutes", "timeline_start")
    if single:
        once = unique_by(speeds.select(*KEYS), KEYS, "speed table").withColumn("__once", F.lit(True))
        wanted = within_link(wanted, once).where(F.coalesce("__once", F.lit(True))).drop("__once")
    # The narrow tables meet first.  Samples are shuffled once at most, by the aggregate that makes them arrays; the narrow side is what the join
    # hashes, so they stream past it and are neither sorted nor spilled.
    rows = wanted.join(network, lk, "left")
    rows = require(rows, F.col("__net"), "pair of the performance table is missing in the link table").drop("__net")
    rows = require(rows, F.col("assigned_volume") >= 0, "assigned volume is missing or negative")
    # Long rows lie by KEYS after that aggregate; what samples are made of may lie by link already.
    rows = rows.hint("shuffle_hash")
    if samples is not None:
        arrays = speeds.select(*KEYS, F.struct(*speeds.columns).alias("__row"))
    rows = within_link(rows, arrays) if single else rows.join(arrays, KEYS, "left")
    rows = rows.join(F.broadcast(grid), "time_period", "left").join(F.broadcast(table), "time_period")
    rows = require(rows, F.col("grid").isNotNull(), F.concat(F.lit("no speeds for period "), F.col("time_period")))
    if samples is None:
        return with_aligned(rows, F.col("assigned_speed"))
    own = own_samples(samples(lambda name: F.col(f"__row.{name}")), periods)
    return with_aligned(rows, F.col("assigned_speed"), samples=own).drop("__row")


def estimate(rows: DataFrame) -> DataFrame:
    """Scaled interval volumes of every link and period, without any shuffle.

    Raw flows are scaled to the assigned total; a link without any flow spreads its volume by
    duration; the rounding residue goes to the largest interval.
    """
    r = with_parameters(rows)
    c = F.col
    r = r.withColumn("__est", sa.estimated_volumes(
        c("speeds"), c("step"), c("last_step"), c("s3_free_speed"), c("s3_m"), c("critical_density_veh_per_mile"), c("s3_capacity"), c("assigned_volume")))
    volume, raw_total = c("assigned_volume"), c("raw_s3_volume")
    fallback = (raw_total == 0) & (volume > 0)
    r = r.withColumns({"estimated": c("__est.estimated"), "raw_s3_volume": c("__est.raw"),
                       "interval_hours": F.concat(F.array_repeat(c("step") / 60, F.size("grid") - 1), F.array(c("last_step") / 60))})
    return r.withColumns({
        "status": F.when(fallback, F.lit("uniform_duration_fallback")).when(volume == 0, F.lit("zero_assignment"))
        .otherwise(F.lit("s3_scaled")),
        "scale_factor": F.when(~fallback, F.when(raw_total > 0, volume / raw_total).otherwise(F.lit(0.0))),
    }).drop("__est")


def intervals(estimated: DataFrame) -> DataFrame:
    """One row per link and native interval on the unwrapped timeline."""
    zipped = F.arrays_zip("grid", "interval_hours", "speeds", "estimated")
    one = estimated.select(*PAIR, "time_period", "timeline_start", F.explode(zipped).alias("i"))
    begin = F.col("timeline_start") + F.col("i.grid")
    return one.select(
        *PAIR, "time_period", begin.alias("interval_start"),
        (begin + F.round(F.col("i.interval_hours") * 60).cast("int")).alias("interval_end"),
        F.col("i.speeds").alias("speed_mph"), F.col("i.estimated").alias("volume"))


def hour_cells(estimated: DataFrame, periods: list[Period]) -> DataFrame:
    """One row per link, period and hourly bin it touches: the sums that an hour is made of.

    The samples of a link are folded in its arrays: a link gives a row for every hour and never one for every sample.  An interval
    that crosses the edge of a bin is in both, by its overlap.
    """
    c = F.col
    bins = hourly_bins(periods)
    begin, finish = bins[0][0], bins[-1][1]
    bin_at = lambda minute: F.floor((minute - begin) / 60).cast("int")
    until = c("timeline_start") + (F.size("speeds") - 1) * c("step") + c("last_step")
    sums = sa.hour_sums(c("speeds"), c("estimated"), c("timeline_start"), c("step"), c("last_step"), begin, finish)
    # A row per link and period meets its link's others; its hours are rows only then, and what groups by link next moves nothing.
    rows = estimated.select(*PAIR, "timeline_start", until.alias("until"), sums.alias("cells")).repartition(*PAIR)
    rows = rows.select(*PAIR, "timeline_start", "until", "cells", F.explode(F.sequence(bin_at(c("timeline_start")), bin_at(c("until") - 1))).alias("b"))
    low = begin + c("b") * 60
    minutes = F.least(low + 60, F.lit(finish), "until") - F.greatest(low, "timeline_start")
    return rows.select(*PAIR, "b", minutes.cast("double").alias("minutes"), F.get("cells", c("b") - bin_at(c("timeline_start"))).alias("x")).select(*PAIR, "b", "minutes", "x.*")


def hourly(estimated: DataFrame, periods: list[Period]) -> DataFrame:
    """Hourly volume (by overlap) and harmonic mean speed per link.

    The periods' cells of an hour are summed; they hold no samples any more.
    """
    bins = hourly_bins(periods)
    begin, finish = bins[0][0], bins[-1][1]
    out = hour_cells(estimated, periods).groupBy(*PAIR, "b").agg(
        F.sum("volume").alias("approx_volume"), F.sum("minutes").alias("duration"), F.nullif(F.sum("travel"), F.lit(0.0)).alias("travel"),
        F.bool_or("stopped").alias("stopped"), F.bool_or("invalid").alias("invalid"))
    speed = F.when(F.col("invalid"), F.lit(None)).when(F.col("stopped"), F.lit(0.0)).otherwise(F.col("duration") / F.col("travel"))
    start = (begin + F.col("b") * 60).cast("int")
    return out.select(*PAIR, start.alias("bin_start"), F.least(start + 60, F.lit(finish)).cast("int").alias("bin_end"),
                      speed.alias("spd_mph"), "approx_volume")


def audit(estimated: DataFrame) -> DataFrame:
    """Conservation, assumptions and exceptions of every link and period."""
    c = F.col
    estimated = estimated.withColumns({
        "__summed": total(c("estimated")), "__above": sa.intervals_above(c("estimated"), c("step"), c("last_step"), c("s3_capacity") + ABOVE),
        "__invalid": sa.measured(c("speeds"))["invalid"]})
    summed = c("__summed")
    kept = [c for c in ("network_link_id", "network_link_type") if c in estimated.columns]
    return estimated.select(
        *KEYS, *[F.col(c).alias(c.removeprefix("network_")) for c in kept],
        F.col("s3_free_speed").alias("free_speed"), F.col("s3_capacity").alias("capacity"), F.col("s3_lanes").alias("lanes"),
        "critical_speed_mph", "s3_m", "critical_density_veh_per_mile",
        "free_speed_source", "critical_speed_source", "s3_m_source", "capacity_source", "lanes_source",
        "assigned_volume", "raw_s3_volume", "scale_factor", summed.alias("estimated_volume_sum"),
        (summed - F.col("assigned_volume")).alias("conservation_error"),
        c("__invalid").alias("invalid_speed_intervals"),
        F.size("absent").alias("imputed_speed_intervals"),
        F.when(F.size("absent") > 0, F.lit("speed_mph")).otherwise(F.lit("none")).alias("imputation_source"),
        F.size("grid").alias("interval_count"),
        (F.array_min("interval_hours") * 60).alias("interval_minutes_min"),
        (F.array_max("interval_hours") * 60).alias("interval_minutes_max"),
        "status", c("__above").alias("above_capacity_intervals"),
    )


def speed_volume(perf: DataFrame, links: DataFrame, speeds: DataFrame, periods: list[Period]) -> tuple[DataFrame, DataFrame]:
    """(hourly rows, audit rows); both hang on the same estimate."""
    est = estimate(assemble(perf, links, speeds, periods))
    return hourly(est, periods), audit(est)


def wide_export(estimated: DataFrame, hourly_rows: DataFrame, periods: list[Period]) -> DataFrame:
    """The export table: static columns of the first period that has the link, period totals, and
    one speed and one volume column per bin.

    Everything is an aggregate over the pair: pivots with a known list of bins, no window.
    """
    first = lambda c, name: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("period_index"))).alias(name)
    source = {"link_id": "network_link_id", "link_type": "network_link_type", "free_speed": "s3_free_speed",
              "capacity": "s3_capacity", "lanes": "s3_lanes"}
    statics = estimated.groupBy(*PAIR).agg(
        *[first(c, n) for n, c in source.items() if c in estimated.columns],
        *[F.max(F.when(F.col("time_period") == p.name, F.col(c))).alias(f"{n}_{p.name}")
          for p in periods for c, n in (("assigned_volume", "volume"), ("assigned_speed", "speed_mph"))])
    bins = hourly_bins(periods)
    at = F.col("bin_start")
    pivoted = hourly_rows.groupBy(*PAIR).agg(
        *[F.max(F.when(at == a, F.col("spd_mph"))).alias(f"spd_mph_{text}") for a, _, text in bins],
        *[F.max(F.when(at == a, F.col("approx_volume"))).alias(f"approx_volume_{text}") for a, _, text in bins])
    return statics.join(pivoted, PAIR)


def conservation(hourly_rows: DataFrame, perf: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Links whose hourly volumes do not add up to the assigned volume, or that have a negative one."""
    got = hourly_rows.groupBy(*keys).agg(F.sum("approx_volume").alias("hourly_sum"), F.min("approx_volume").alias("lowest"))
    want = perf.groupBy(*keys).agg(F.sum("volume").alias("assigned"))
    j = want.join(got, list(keys), "full_outer")
    bad = (F.abs(zero_if_null("hourly_sum") - zero_if_null("assigned")) > 1e-8 + 1e-12 * F.abs(zero_if_null("assigned"))) \
        | (F.col("lowest") < 0) | F.col("assigned").isNull() | F.col("hourly_sum").isNull()
    return j.where(bad)
