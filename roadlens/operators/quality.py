"""Data-quality rules: each returns a table of violations, ``enforce`` is the only action."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlens.functions.columns import is_close

EXAMPLES = 5


class QualityError(ValueError):
    """A table broke a rule; the message names up to five examples."""


def require_columns(frame: DataFrame, names: Sequence[str], what: str = "table") -> DataFrame:
    missing = sorted(set(names) - set(frame.columns))
    if missing:
        raise QualityError(f"{what} is missing: {', '.join(missing)}")
    return frame


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation, no row is moved)."""
    return frame.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def missing_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    condition = F.lit(False)
    for k in keys:
        condition = condition | F.col(k).isNull()
    return frame.where(condition)


def uncovered(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` does not have."""
    return left.select(*keys).join(right.select(*keys), list(keys), "left_anti")


def same_key_set(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, labelled; empty when the sets are equal."""
    return uncovered(a, b, keys).withColumn("only_in", F.lit("left")).unionByName(
        uncovered(b, a, keys).withColumn("only_in", F.lit("right")))


def failed_rules(frame: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """One row per key and broken rule.  A rule is a condition that must hold; NULL means broken."""
    failures = F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()
    ]))
    return frame.select(*keys, F.explode(failures).alias("rule"))


def rule_counts(frame: DataFrame, by: Sequence[str], rules: Mapping[str, Column], *extra: Column) -> DataFrame:
    """Rows checked and failures per rule in one pass (no row per failure is produced)."""
    broken = {n: ~F.coalesce(ok, F.lit(False)) for n, ok in rules.items()}
    return frame.groupBy(*by).agg(
        F.count("*").alias("rows_checked"),
        *[F.count_if(b).alias(n) for n, b in broken.items()],
        *extra,
    )


def unit_rules() -> dict[str, Column]:
    """Dual-unit identities of a converted link (1 mile = 1609.344 m)."""
    return {
        "length_units": is_close(F.col("length"), F.col("vdf_length_mi") * 1609.344, 1e-6, 1e-6),
        "speed_units": is_close(F.col("free_speed"), F.col("vdf_free_speed_mph") * 1.609344, 1e-6, 1e-6),
        "fftt_minutes": F.coalesce(
            is_close(F.col("vdf_fftt"), 60 * F.col("vdf_length_mi") / F.col("vdf_free_speed_mph"), 1e-6, 1e-6),
            F.col("vdf_fftt").isNull()),
    }


def parameter_rules() -> dict[str, Column]:
    """Range and identity rules of a calibrated parameter row."""
    c = F.col
    return {
        "plf_positive": c("vdf_plf") > 0,
        "alpha_identity": is_close(c("vdf_alpha"), F.lit(8.0 / 15.0) * c("vdf_cp") * F.pow(c("vdf_cd"), c("vdf_s")), 1e-6, 1e-9),
        "beta_identity": is_close(c("vdf_beta"), c("vdf_n") * c("vdf_s"), 1e-6, 1e-9),
        "vdf_type": c("vdf_type") == 2,
        "profile_mode": c("qvdf_profile_mode") == 2,
    }


def incomplete_triplet(fields: Sequence[str]) -> Column:
    present = sum(F.col(f).isNotNull().cast("int") for f in fields)
    return (present > 0) & (present < len(fields))


def broken_adjacency(periods: DataFrame) -> DataFrame:
    """Neighbouring periods whose end and next start differ by more than 1e-9 hours.

    The period table has tens of rows, so the single-partition window is bounded.
    """
    nxt = F.lead("start_hour").over(W.orderBy("start_hour"))
    return periods.withColumn("next_start", nxt).where(
        F.col("next_start").isNotNull() & (F.abs(F.col("next_start") - F.col("end_hour")) > 1e-9))


def overlapping_periods(periods: DataFrame) -> DataFrame:
    """Pairs of periods that own a common minute.

    Every period is unrolled into the minutes it owns (at most 1440), so an equi-join on the
    minute replaces a comparison of all pairs.
    """
    from roadlens.functions.timeofday import DAY

    minutes = periods.select(
        "time_period",
        F.explode(F.sequence(F.col("period_start"), F.col("period_start") + F.col("period_minutes") - 1)).alias("m"),
    ).withColumn("m", F.pmod("m", F.lit(DAY)))
    shared = minutes.groupBy("m").agg(F.sort_array(F.collect_set("time_period")).alias("owners")).where(F.size("owners") > 1)
    return shared.groupBy("owners").agg(F.count("*").alias("shared_minutes"))


def enforce(violations: DataFrame, message: str) -> None:
    """Run the check and fail with a few examples."""
    examples = violations.limit(EXAMPLES).collect()
    if examples:
        shown = "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in examples)
        raise QualityError(f"{message} (examples: {shown})")


def unique_by(frame: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The same table, failing at run time when a key occurs twice.

    The check rides on an aggregation over the key, which leaves the rows hash-partitioned the
    way the join that follows needs them, so no second job and no second shuffle is paid.
    """
    others = [c for c in frame.columns if c not in keys]
    shown = F.concat_ws("->", *[F.col(k).cast("string") for k in keys])
    grouped = frame.groupBy(*keys).agg(F.count("*").alias("__copies"), *[F.any_value(c).alias(c) for c in others])
    failure = F.raise_error(F.concat(F.lit(f"{what} has duplicate keys, e.g. "), shown)).cast("boolean")
    return grouped.where(F.when(F.col("__copies") > 1, failure).otherwise(F.lit(True))).select(*frame.columns)


def require(frame: DataFrame, condition: Column, message: str | Column) -> DataFrame:
    """Rows pass unchanged; the first row that breaks the condition fails the job."""
    text = F.lit(message) if isinstance(message, str) else message
    return frame.where(F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
