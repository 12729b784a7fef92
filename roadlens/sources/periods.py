"""Period bounds from run settings with configured fallback, and the timeline built on them.

A plan has a handful of periods, so they are the one thing that lives on the driver: a
``list[Period]``.  ``period_table`` turns it into a table for joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.columns import is_close, number
from roadlens.functions.timeofday import DAY, Period, label, parse_range

PERIOD_SCHEMA = T.StructType([
    T.StructField("time_period", T.StringType(), False),
    T.StructField("period_index", T.IntegerType(), False),
    T.StructField("period_start", T.IntegerType(), False),
    T.StructField("period_end", T.IntegerType(), False),
    T.StructField("period_minutes", T.IntegerType(), False),
    T.StructField("timeline_start", T.IntegerType(), False),
    T.StructField("range_source", T.StringType(), False),
])


def settings_bounds(settings: DataFrame) -> DataFrame:
    """Validated minute bounds, one row per period, with the reasons a row is refused.

    ``settings`` carries time_period and the two decimal-hour columns.  An end of exactly 24 h
    stays 1440, later ends wrap.
    """
    start = number("demand_period_starting_hours") * 60
    end = number("demand_period_ending_hours") * 60
    whole = is_close(start, F.round(start)) & is_close(end, F.round(end))
    s, e = F.round(start).cast("int"), F.round(end).cast("int")
    rules: list[tuple[str, Column]] = [
        ("missing or non-finite hours", start.isNull() | end.isNull()),
        ("hours outside the day", (start < 0) | (start >= DAY) | (end < 0) | (end > 2 * DAY)),
        ("hours are no whole minutes", ~whole),
        ("period longer than 24 hours", e > s + DAY),
    ]
    problem = F.concat_ws("; ", *[F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for text, bad in rules])
    return settings.select(
        F.lower(F.trim("time_period")).alias("time_period"),
        s.alias("period_start"),
        F.when(e == DAY, e).otherwise(e % DAY).alias("period_end"),
        F.nullif(problem, F.lit("")).alias("problem"),
    )


def resolve_periods(names: list[str], settings: DataFrame | None = None,
                    configured: dict[str, str] | None = None) -> list[Period]:
    """Settings win over configured ranges; one settings row per period, at most 48 rows read."""
    configured = {k.lower(): v for k, v in (configured or {}).items()}
    wanted = [n.lower() for n in names]
    if len(set(wanted)) != len(wanted):
        raise ValueError("duplicate configured time periods")
    found: dict[str, Period] = {}
    if settings is not None:
        bounds = settings_bounds(settings).where(F.col("time_period").isin(wanted))
        for row in bounds.limit(2 * len(wanted) + 1).collect():
            if row.time_period in found:
                raise ValueError(f"expected one settings row for {row.time_period}")
            if row.problem:
                raise ValueError(f"{row.time_period}: {row.problem}")
            found[row.time_period] = Period(row.time_period, row.period_start, row.period_end, "settings")
    out = []
    for name in wanted:
        if name in found:
            out.append(found[name])
        elif name in configured:
            out.append(Period(name, *parse_range(configured[name])))
        else:
            raise ValueError(f"missing period range for {name}")
    return out


def unwrapped_starts(periods: list[Period]) -> dict[str, int]:
    """Start of every period on one increasing timeline of at most 24 hours."""
    taken: set[int] = set()
    starts: dict[str, int] = {}
    previous_end: int | None = None
    for p in periods:
        own = {(p.start + t) % DAY for t in range(p.minutes)}
        if taken & own:
            raise ValueError("configured periods overlap")
        taken |= own
        start = p.start
        while previous_end is not None and start < previous_end:
            start += DAY
        starts[p.name] = start
        previous_end = start + p.minutes
    if not starts or previous_end - min(starts.values()) > DAY:
        raise ValueError("periods must form an ordered span of at most 24 hours")
    return starts


def hourly_bins(periods: list[Period]) -> list[tuple[int, int, str]]:
    """60-minute bins over the span; the last may be short and labels may pass 24:00."""
    starts = unwrapped_starts(periods)
    begin = min(starts.values())
    end = max(starts[p.name] + p.minutes for p in periods)
    edges = [(t, min(t + 60, end)) for t in range(begin, end, 60)]
    return [(a, b, f"{label(a)}_{label(b)}") for a, b in edges]


def period_table(spark: SparkSession, periods: list[Period]) -> DataFrame:
    starts = unwrapped_starts(periods)
    rows = [(p.name, i, p.start, p.end, p.minutes, starts[p.name], p.source) for i, p in enumerate(periods)]
    return spark.createDataFrame(rows, PERIOD_SCHEMA)


def bin_table(spark: SparkSession, periods: list[Period]) -> DataFrame:
    return spark.createDataFrame(hourly_bins(periods), "bin_start INT, bin_end INT, bin_label STRING")


def period_map(periods: list[Period], field: str, midnight: str = "wrap") -> Column:
    """Literal map period -> value, so that a period attribute needs no join."""
    value = {"hours": lambda p: p.hours(midnight), "start": lambda p: p.start, "end": lambda p: p.end,
             "minutes": lambda p: p.minutes}[field]
    pieces: list[Column] = []
    for p in periods:
        pieces += [F.lit(p.name), F.lit(value(p))]
    return F.create_map(*pieces)


def contiguous_runs(active: DataFrame, key: str, index: str = "period_index") -> DataFrame:
    """Gaps-and-islands over the periods a key has: a gap starts a new run."""
    from pyspark.sql import Window as W

    order = W.partitionBy(key).orderBy(index)
    island = F.col(index) - F.row_number().over(order)
    runs = active.select(key, index).distinct().withColumn("island", island)
    return runs.groupBy(key, "island").agg(
        F.min(index).alias("first_period"), F.max(index).alias("last_period"), F.count("*").alias("n_periods"),
    ).drop("island")
