"""Five-minute speeds: wide columns in, one array per link and period inside, wide columns out."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions import samples as sa
from roadlens.functions.columns import KM_PER_MILE, PAIR, number_in
from roadlens.functions.timeofday import DAY, Period, in_period, label
from roadlens.operators.quality import require
from roadlens.sources.periods import period_map

_SPEED = re.compile(r"^spd(?:_(mph|kmph))?_(\d{1,2}):(\d{2})$")
# Which representation of a timestamp wins, and its unit factor to mph.
PRIORITY = {"mph": 0, None: 1, "kmph": 2}
FACTOR = {"mph": 1.0, None: 1.0, "kmph": 1 / KM_PER_MILE}


def speed_columns(frame: DataFrame, period: Period | None = None) -> dict[int, str]:
    """Minute -> winning column, optionally only the minutes a period owns.  Decided on the schema."""
    best: dict[int, tuple[int, str]] = {}
    for name in frame.columns:
        if not (m := _SPEED.match(name)):
            continue
        minute = int(m.group(2)) * 60 + int(m.group(3))
        if period is not None and (minute - period.start) % DAY >= period.minutes:
            continue
        rank = PRIORITY[m.group(1)]
        if minute not in best or rank < best[minute][0]:
            best[minute] = (rank, name)
    return {minute: best[minute][1] for minute in sorted(best)}


def unit_of(name: str) -> str | None:
    return _SPEED.match(name).group(1)


def unpivot_speeds(frame: DataFrame, keys: list[str], period: Period | None = None) -> DataFrame:
    """Wide speeds to (keys, minute, speed_mph) rows, one representation per timestamp, in mph."""
    chosen = speed_columns(frame, period)
    entries = F.array(*[
        F.struct(F.lit(minute).alias("minute"), (number_in(frame, name) * FACTOR[unit_of(name)]).alias("speed_mph"))
        for minute, name in chosen.items()])
    return frame.select(*keys, F.inline(entries))


def drop_foreign_speeds(frame: DataFrame, period: Period) -> DataFrame:
    """Without the speed columns of timestamps the period does not own."""
    own = set(speed_columns(frame, period))
    foreign = [c for c in frame.columns if (m := _SPEED.match(c)) and int(m.group(2)) * 60 + int(m.group(3)) not in own]
    return frame.drop(*foreign)


def owned_rows(long: DataFrame, periods: list[Period]) -> DataFrame:
    """Rows whose minute belongs to their own period."""
    at = F.col("time_period")
    start, end = (F.try_element_at(period_map(periods, f), at) for f in ("start", "end"))
    return long.where(F.coalesce(in_period("minute", start, end), F.lit(False)))


def _rank(unit: Column) -> Column:
    return F.when(unit == "mph", 0).when(unit == "kmph", 2).otherwise(1)


def _mph(unit: Column, speed: Column) -> Column:
    return F.when(unit == "kmph", speed / KM_PER_MILE).otherwise(speed)


def canonical_rows(long: DataFrame, keys: list[str]) -> DataFrame:
    """Long rows with a ``unit`` column (mph, kmph or NULL): the best representation per timestamp.

    The buffer is two numbers, so Spark hashes the groups and does not sort the samples.
    """
    best = F.min_by(_mph(F.col("unit"), F.col("speed")), _rank(F.col("unit")))
    return long.groupBy(*keys, "minute").agg(best.alias("speed_mph"))


def canonical_samples(entries: Column | str) -> Column:
    """(minute, speed_mph) entries of one row's (minute, unit, speed) entries: the best representation per timestamp, without a shuffle."""
    return sa.best_representation(entries).column()


def pivot_speeds(long: DataFrame, keys: list[str], minutes: list[int], prefix: str = "spd_mph_") -> DataFrame:
    """Rows back to one column per timestamp, for the sink."""
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("minute") == m, F.col("speed_mph"))).alias(f"{prefix}{label(m)}") for m in minutes])


def period_offsets(arrays: DataFrame, samples: sa.Made | str = "samples") -> DataFrame:
    """Sorted offsets that any link of a period has: (time_period, offsets).

    A row gives the offsets that no earlier one of its batch and period has, so at most the minutes of the period leave a batch, and no row per
    sample is made.
    """
    seen = arrays.select("time_period", F.explode(sa.new_offsets(samples, "time_period")).alias("o")).distinct()
    return seen.groupBy("time_period").agg(F.sort_array(F.collect_set("o")).alias("offsets"))


def native_grid(arrays: DataFrame, periods: list[Period], samples: sa.Made | str = "samples") -> DataFrame:
    """Sampling grid of every period: step, last step, offsets, and the offsets no link has.

    The step is the greatest common divisor of all offsets and the period length, so timestamps
    absent from the whole period become visible.
    Built on ``link_arrays`` or ``period_samples``, or on the ``samples`` that are made of a row's columns.
    """
    at = F.col("time_period")
    length = F.try_element_at(period_map(periods, "minutes"), at)
    seen = period_offsets(arrays, samples)
    seen = require(seen, F.element_at("offsets", 1) == 0, F.concat(F.lit("speeds must start at the period boundary: "), at))
    divides = lambda d: (length % d == 0) & F.forall("offsets", lambda o: o % d == 0)
    step = F.when(F.size("offsets") > 1, F.array_max(F.filter(F.sequence(F.lit(1), length), divides))) \
        .otherwise(F.least(F.lit(5), length))
    grid = seen.withColumn("step", step)
    grid = grid.withColumn("grid", F.sequence(F.lit(0), length - 1, F.col("step")))
    last = length - F.element_at("grid", -1)
    return grid.select("time_period", "step", last.alias("last_step"), "grid", F.array_except("grid", "offsets").alias("absent"))


def minute_owners(arrays: DataFrame, periods: list[Period], samples: sa.Made | str = "samples") -> DataFrame:
    """(time_period, owned): the minutes of the day whose speeds a period gives; fails on a minute that two periods claim."""
    start = F.try_element_at(period_map(periods, "start"), F.col("time_period"))
    minutes = period_offsets(arrays, samples).select("time_period", F.explode(F.transform("offsets", lambda o: (o + start) % DAY)).alias("minute"))
    claims = minutes.groupBy("minute").agg(F.sort_array(F.collect_set("time_period")).alias("claims"))
    clash = F.concat(F.lit("speed of minute "), F.col("minute").cast("string"), F.lit(" belongs to overlapping periods "), F.array_join("claims", ", "))
    single = require(claims, F.size("claims") == 1, clash)
    return single.select(F.col("claims")[0].alias("time_period"), "minute").groupBy("time_period").agg(F.sort_array(F.collect_set("minute")).alias("owned"))


def owned_parts(speeds: DataFrame, periods: list[Period], keys: list[str] = PAIR, samples: Samples | None = None) -> DataFrame:
    """One row per link: ``parts``, the samples that each of its periods owns, as ``merged_samples`` takes them.

    Every minute comes from the period that owns it.  Samples travel as arrays (minutes and values apart, without the overhead of
    entries) and nothing is unrolled; the owners are one row per period.  ``samples`` gives them from the columns of a row, if it does not hold them.
    """
    arrays = sample_arrays(speeds, periods, keys) if samples is None else speeds
    own = "samples" if samples is None else own_samples(samples(F.col), periods)
    start = F.try_element_at(period_map(periods, "start"), F.col("time_period"))
    owners = F.broadcast(minute_owners(arrays, periods, own))  # one row per period
    parts = arrays.join(owners, "time_period").select(*keys, sa.owned_samples(own, start, F.col("owned")).alias("part"))
    return parts.groupBy(*keys).agg(F.collect_list("part").alias("parts"))


def owned_speeds(speeds: DataFrame, periods: list[Period], keys: list[str] = PAIR) -> DataFrame:
    """One row per link: ``speeds``, its (minute, speed_mph) entries of the day in the order of the clock.

    Two samples of a link for one minute fail the job.
    """
    return owned_parts(speeds, periods, keys).select(*keys, sa.merged_samples("parts").alias("speeds"))


def link_arrays(long: DataFrame, periods: list[Period], keys: list[str] = PAIR) -> DataFrame:
    """One row per period and link: its samples as (offset, speed) entries.

    A link has one sample per minute of its period (``with_aligned`` fails on a second one), so a group
    stays below 1440 entries however large the table is.
    """
    start = F.try_element_at(period_map(periods, "start"), F.col("time_period"))
    offset = F.pmod(F.col("minute") - start, F.lit(DAY)).cast("int")
    entry = F.struct(offset.alias("o"), F.col("speed_mph").alias("v"))
    return owned_rows(long, periods).groupBy("time_period", *keys).agg(F.collect_list(entry).alias("samples"))


#: The samples of a row, (minute, speed_mph) entries, from a function that gives the column of a name.
Samples = Callable[[Callable[[str], Column]], sa.Made]


def own_samples(samples: sa.Made | Column | str, periods: list[Period]) -> sa.Made:
    """(offset, speed) entries of (minute, speed_mph) entries, those that the period of the row owns."""
    start, length = (F.try_element_at(period_map(periods, f), F.col("time_period")) for f in ("start", "minutes"))
    return sa.offset_samples(samples, start, length)


def period_samples(rows: DataFrame, periods: list[Period], keys: list[str] = PAIR) -> DataFrame:
    """``link_arrays`` from rows that hold the samples of a link and period already, as (minute, speed_mph) entries: nothing is moved.

    Period tables come like this, with a column per timestamp.  Rows of no known period and minutes the period does not own are
    left out, as in ``owned_rows``.  Keys must be unique; ``unique_by`` on the keys alone checks it cheaply.
    """
    return rows.select("time_period", *keys, own_samples("samples", periods).column().alias("samples"))


def sample_arrays(speeds: DataFrame, periods: list[Period], keys: list[str] = PAIR) -> DataFrame:
    """One row per period and link with (offset, speed) entries, from long rows or from rows with ``samples``."""
    return period_samples(speeds, periods, keys) if "samples" in speeds.columns else link_arrays(speeds, periods, keys)


def with_aligned(rows: DataFrame, fill: Column, name: str = "speeds", samples: sa.Made | str = "samples") -> DataFrame:
    """Speeds on the grid: the sample, NULL where the link has none, ``fill`` where the period has none.

    Two samples of the same minute fail the job.
    """
    return rows.withColumn(name, sa.aligned(samples, F.col("step"), F.size("grid"), F.col("absent"), fill).column()).drop("samples")
