"""Per-link performance measures by period (delay, person and vehicle hours and miles)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlens.functions.columns import (
    PAIR, facility_type, has, normal_id, number_in, pair_keys, preferred, ratio, zero_if_null,
)
from roadlens.operators.quality import require_columns, unique_by
from roadlens.functions.timeofday import Period

# Persons per vehicle by mode, and the rounded factor of the metric switch.
OCCUPANCY = {"sov": 1.0, "hov2": 2.0, "hov3": 3.5, "com": 1.0, "trk": 1.0, "apv": 1.6}
METRIC_LENGTH_FACTOR = 1.609
TAZ_SCOPE = (1404, 2820)
MIN_PERIOD_VOLUME = 0.5

CARRIED = [
    "link_id", "from_node_id", "to_node_id", "link_type", "free_speed", "length", "length_in_mile", "TAZ",
    "district_id", "FT", "TOLLGRP", "period_limit", "geometry", "STREETNAME",
]
HOV_MEASURES = ["delay", "person_delay", "person_hour", "person_mile",
                "trip_person_delay", "trip_person_hour", "trip_person_mile"]
_LIMIT = re.compile(r"^(am|md|pm|nt)limit$", re.IGNORECASE)
_PERSONS = re.compile(r"^person_vol_district_(\d+)_([a-z0-9]+)$")


def limit_columns(frame: DataFrame) -> dict[str, str]:
    """Period -> name of its access-limit column, for tables that keep one column per period."""
    return {m.group(1).lower(): c for c in frame.columns if (m := _LIMIT.match(c))}


def default_link_fields(links: DataFrame) -> DataFrame:
    """Derived link fields for networks that lack them."""
    out = links
    if "FT" not in out.columns:
        require_columns(out, ["link_type"], "link table without FT")
        out = out.withColumn("FT", facility_type(number_in(out, "link_type")))
    if "length_in_mile" not in out.columns and "length" in out.columns:
        out = out.withColumn("length_in_mile", F.col("length"))
    if "period_limit" not in out.columns and not limit_columns(out) and "allowed_uses" in out.columns:
        hov = F.coalesce(F.col("allowed_uses").cast("string").rlike("(?i)hov2|hov3"), F.lit(False))
        out = out.withColumn("period_limit", F.when(hov, 2).otherwise(0))
    if "TOLLGRP" not in out.columns:
        out = out.withColumn("TOLLGRP", F.lit(0))
    return out


def join_keys(links: DataFrame, keys: list[str] = PAIR) -> list[str]:
    """A link table that holds one row per period is matched on the period as well."""
    return (["time_period"] if "time_period" in links.columns else []) + list(keys)


def carry_attributes(perf: DataFrame, links: DataFrame, fields: Iterable[str] | None = None,
                     mark: bool = False) -> DataFrame:
    """Left join of link attributes on the directed pair, only for fields ``perf`` lacks.

    Duplicate pairs in ``links`` fail the job; unmatched rows keep NULL attributes and, with
    ``mark``, a false ``link_matched``.
    """
    wanted = list(fields) if fields is not None else CARRIED + list(limit_columns(links).values())
    new = [f for f in wanted if f in links.columns and f not in perf.columns]
    if not new and not mark:
        return perf
    keys = join_keys(links)
    right = unique_by(pair_keys(links).select(*keys, *new), keys, "link table")
    right = right.withColumn("link_matched", F.lit(True)) if mark else right
    out = pair_keys(perf).join(right, keys, "left")
    if mark:
        out = out.withColumn("link_matched", F.coalesce("link_matched", F.lit(False)))
    return out.select(*perf.columns, *new, *(["link_matched"] if mark else []))


def carry_by_link_id(perf: DataFrame, links: DataFrame, fields: Iterable[str], order: str) -> DataFrame:
    """Fallback when pairs are missing: join on the link id, first row (by ``order``) wins on both sides.

    The first row is a ``min_by`` aggregate, so copies of a hot id are reduced before the shuffle.
    """
    require_columns(perf, ["link_id"], "performance table")
    require_columns(links, ["link_id"], "link table")
    new = [f for f in fields if f in links.columns and f not in perf.columns]
    key = ["time_period", "link_id"] if has(perf, "time_period") else ["link_id"]
    right_key = [k for k in key if k in links.columns]

    def first_rows(frame: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
        slim = frame.withColumn("link_id", normal_id("link_id"))
        packed = F.min_by(F.struct(*keep), F.col(order)).alias("row") if keep else F.min(order).alias("row")
        picked = slim.groupBy(*by).agg(packed)
        return picked.select(*by, *[F.col("row")[c].alias(c) for c in keep])

    left = first_rows(perf, key, [c for c in perf.columns if c not in key])
    right = first_rows(links, right_key, new)
    return left.join(right, right_key, "left").select(*perf.columns, *new)


def has_incomplete_pair(perf: DataFrame, links: DataFrame) -> bool:
    """Action: whether any row lacks a node id, which switches to the link-id fallback."""
    if not (has(perf, *PAIR) and has(links, *PAIR)):
        return True
    missing = F.col(PAIR[0]).isNull() | F.col(PAIR[1]).isNull()
    return bool(perf.where(missing).limit(1).count() or links.where(missing).limit(1).count())


def incomplete_periods(perf: DataFrame, links: DataFrame) -> list[str]:
    """Action: the periods in which a performance or link row lacks a node id (one entry per period at most)."""
    if not has(perf, *PAIR) or not has(links, *PAIR):
        return [r[0] for r in perf.select("time_period").distinct().collect()]
    missing = F.col(PAIR[0]).isNull() | F.col(PAIR[1]).isNull()
    lacking = perf.where(missing).select("time_period").distinct()
    if "time_period" in links.columns:
        lacking = lacking.unionByName(links.where(missing).select(F.lower("time_period").alias("time_period")).distinct())
    elif not links.where(missing).isEmpty():
        lacking = perf.select("time_period").distinct()
    return sorted({r[0] for r in lacking.collect() if r[0] is not None})


def carry_with_fallback(perf: DataFrame, links: DataFrame, order: str | None = None) -> DataFrame:
    """``carry_attributes``, but by link id in the periods whose node pairs are incomplete.

    Without ``order`` the first row of a link id is the first one as read.
    """
    by_id = incomplete_periods(perf, links)
    if not by_id:
        return carry_attributes(perf, links)
    fields = [f for f in [*CARRIED, *limit_columns(links).values()] if f in links.columns and f not in perf.columns]
    one, two, at = perf, links, order
    if order is None:
        at = "__order"
        one, two = (f.withColumn(at, F.monotonically_increasing_id()) for f in (perf, links))
    fallback = carry_by_link_id(one.where(F.col("time_period").isin(by_id)), two, fields, at).select(*perf.columns, *fields)
    rest = perf.where(~F.col("time_period").isin(by_id))
    whole = links if not has(links, *PAIR) else links.where(F.col(PAIR[0]).isNotNull() & F.col(PAIR[1]).isNotNull())
    if not has(perf, *PAIR) or not has(links, *PAIR):
        return fallback
    return carry_attributes(rest, whole, fields).unionByName(fallback)


def hov_flag(frame: DataFrame) -> Column:
    toll = F.col("TOLLGRP") if "TOLLGRP" in frame.columns else F.lit(0)
    wide = limit_columns(frame)
    if "period_limit" in frame.columns:
        limit = F.col("period_limit")
    elif wide and "time_period" in frame.columns:
        limit = F.coalesce(*[F.when(F.col("time_period") == p, F.col(c)) for p, c in wide.items()])
    else:
        limit = F.lit(0)
    return F.coalesce((toll == 2) | limit.isin(2, 3), F.lit(False)).cast("int")


def analysis_scope(frame: DataFrame, jurisdictions: bool) -> Column:
    """Roadway rows, optionally inside the zone range; a test applies only where its column exists."""
    keep = F.lit(True)
    if "FT" in frame.columns:
        keep = keep & (F.coalesce(number_in(frame, "FT"), F.lit(0.0)) > 0)
    if jurisdictions and "TAZ" in frame.columns:
        taz = number_in(frame, "TAZ")
        keep = keep & F.coalesce((taz > TAZ_SCOPE[0]) & (taz < TAZ_SCOPE[1]), F.lit(False))
    return keep


def period_left(total: Column) -> Column:
    """Whether a period (one row, or one value in all its rows) has volume; an error where none has."""
    none = F.coalesce(F.max(total).over(W.partitionBy(F.lit(0))), F.lit(0.0)) < MIN_PERIOD_VOLUME
    failure = F.raise_error(F.lit("no period with volume is left")).cast("boolean")
    return F.when(none, failure).otherwise(F.coalesce(total >= MIN_PERIOD_VOLUME, F.lit(False)))


def drop_low_volume_periods(frame: DataFrame) -> DataFrame:
    """Without the periods whose total volume is below 0.5; the period list is a few rows.

    Fails when rows are there but no period is left.
    """
    totals = frame.groupBy("time_period").agg(F.sum(number_in(frame, "volume")).alias("v"))
    kept = totals.withColumn("left", period_left(F.col("v"))).where("left").select("time_period")
    return frame.join(F.broadcast(kept), "time_period", "left_semi")


def row_measures(frame: DataFrame, length_unit: str = "mile", speed_unit: str = "mph") -> DataFrame:
    """Travel time, delay, and the person, vehicle and truck products of every row."""
    if (length_unit, speed_unit) not in {("mile", "mph"), ("meter", "kph")}:
        raise ValueError("use mile with mph or meter with kph")
    source = preferred(frame, ["length_in_mile", "length"])
    if source is None:
        raise ValueError("missing length field")
    if preferred(frame, ["vehicle_volume", "volume"]) is None:
        raise ValueError("missing volume field")
    length = number_in(frame, source) * (METRIC_LENGTH_FACTOR if length_unit == "meter" else 1)
    out = frame.withColumn("length", length)
    first: dict[str, Column] = {}
    if "fftt" not in frame.columns:
        first["fftt"] = ratio("length", number_in(out, "free_speed"))
    if "travel_time" not in frame.columns:
        first["travel_time"] = ratio("length", number_in(out, "speed_mph"))
    if "speed_ratio" not in frame.columns:
        first["speed_ratio"] = ratio(number_in(out, "speed_mph"), number_in(out, "free_speed"))
    for name in ("Severe_Congestion_P", "mod_vol_trk"):
        if name not in frame.columns:
            first[name] = F.lit(0.0)
    vehicle = preferred(frame, ["vehicle_volume", "volume"])
    first["vehicle_volume"] = zero_if_null(number_in(frame, vehicle))
    first["volume"] = zero_if_null(number_in(frame, "volume" if "volume" in frame.columns else vehicle))
    out = out.withColumns(first)
    gap = F.col("travel_time") - F.col("fftt")
    out = out.withColumn("delay", F.when((gap > 0) & (F.col("speed_ratio") < 1), gap).otherwise(F.lit(0.0)))
    person, car, truck = F.col("volume"), F.col("vehicle_volume"), F.col("mod_vol_trk")
    return out.withColumns({
        "person_delay": person * F.col("delay"),
        "person_hour": person * F.col("travel_time"),
        "person_mile": person * F.col("length"),
        "length_weighted_P": F.col("Severe_Congestion_P") * F.col("length"),
        "vehicle_mile": car * F.col("length"),
        "vehicle_hour": car * F.col("travel_time"),
        "trk_vehicle_mile": truck * F.col("length"),
        "trk_vehicle_hour": truck * F.col("travel_time"),
    })


def resident_persons(persons: DataFrame, links: DataFrame,
                     occupancy: Mapping[str, float] = OCCUPANCY) -> DataFrame:
    """Persons, vehicles and truck persons per pair and period, of the link's own district only.

    ``persons`` is long: (time_period, pair, person_district, mode, persons).  Rows are summed per
    pair, district and mode before the join, so a hot pair is small when it is shuffled.
    """
    keys = ["time_period", *PAIR]
    pre = persons.where(F.col("mode").isin(*occupancy)).groupBy(*keys, "person_district").pivot(
        "mode", list(occupancy)).agg(F.sum("persons"))
    lk = join_keys(links)
    own = pre.join(links.select(*lk, "district_id"), lk).where(F.col("person_district") == F.col("district_id"))
    per_mode = {m: zero_if_null(m) for m in occupancy}
    return own.select(
        *keys,
        sum(per_mode.values(), F.lit(0.0)).alias("trip_persons"),
        sum((v / occupancy[m] for m, v in per_mode.items()), F.lit(0.0)).alias("trip_vehicles"),
        per_mode["trk"].alias("trip_trucks"),
    )


def resident_persons_wide(frame: DataFrame, occupancy: Mapping[str, float] = OCCUPANCY) -> dict[str, Column]:
    """The same three totals from ``person_vol_district_<d>_<mode>`` columns, without any shuffle."""
    by_district: dict[int, dict[str, str]] = {}
    for name in frame.columns:
        if (m := _PERSONS.match(name)) and m.group(2) in occupancy:
            by_district.setdefault(int(m.group(1)), {})[m.group(2)] = name
    if not by_district or "district_id" not in frame.columns:
        return {n: F.lit(0.0) for n in ("trip_persons", "trip_vehicles", "trip_trucks")}

    def pick(term) -> Column:
        cases = [F.when(F.col("district_id") == d, sum((term(m, c) for m, c in cols.items()), F.lit(0.0)))
                 for d, cols in sorted(by_district.items())]
        return F.coalesce(*cases, F.lit(0.0))

    return {
        "trip_persons": pick(lambda m, c: zero_if_null(c)),
        "trip_vehicles": pick(lambda m, c: zero_if_null(c) / occupancy[m]),
        "trip_trucks": pick(lambda m, c: zero_if_null(c) if m == "trk" else F.lit(0.0)),
    }


def trip_measures(frame: DataFrame, resident: DataFrame | None = None) -> DataFrame:
    """Resident trip measures; zero where the district is unknown or has no resident traffic."""
    totals = ["trip_persons", "trip_vehicles", "trip_trucks"]
    if resident is not None:
        base = frame.join(resident, ["time_period", *PAIR], "left")
        base = base.withColumns({t: zero_if_null(t) for t in totals})
    else:
        base = frame.withColumns(resident_persons_wide(frame))
    p, v, t = map(F.col, totals)
    delay, hours, miles = (zero_if_null(c) for c in ("delay", "travel_time", "length"))
    return base.withColumns({
        "trip_person_delay": p * delay,
        "trip_person_hour": p * hours,
        "trip_person_mile": p * miles,
        "trip_vehicle_mile": v * miles,
        "trip_vehicle_hour": v * hours,
        "trip_trk_vehicle_mile": t * miles,
        "trip_trk_vehicle_hour": t * hours,
    }).drop(*totals)


def hov_copies(frame: DataFrame) -> DataFrame:
    """HOV twins of the measures, NULL off the HOV network."""
    def twin(name: str) -> str:
        return name.replace("trip_", "trip_hov_") if name.startswith("trip_") else f"hov_{name}"
    return frame.withColumns({twin(m): F.when(F.col("is_hov") == 1, F.col(m)) for m in HOV_MEASURES})


def preprocess_performance(perf: DataFrame, links: DataFrame, periods: list[Period] | None = None, *,
                           jurisdictions: bool = True, resident: DataFrame | None = None,
                           length_unit: str = "mile", speed_unit: str = "mph",
                           skip_low_volume: bool = True, order: str | None = None) -> DataFrame:
    """Combined performance table: carried attributes, scope, measures, trips and HOV twins.

    A period with incomplete node pairs is matched by link id, first rows (by ``order``) on both sides.

    ``skip_low_volume=False`` leaves the period test to the caller; the statistics apply it to
    their aggregates, which saves the second pass over the input.
    """
    base = perf.withColumn("time_period", F.lower("time_period"))
    if periods is not None:
        base = base.where(F.col("time_period").isin([p.name for p in periods]))
    joined = carry_with_fallback(base, default_link_fields(links), order)
    joined = joined.withColumn("is_hov", hov_flag(joined))
    scoped = joined.where(analysis_scope(joined, jurisdictions))
    if skip_low_volume:
        scoped = drop_low_volume_periods(scoped)
    return hov_copies(trip_measures(row_measures(scoped, length_unit, speed_unit), resident))
