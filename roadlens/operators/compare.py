"""Build (BD) against no-build (NB) comparisons, speed classes, and daily link totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.columns import (
    PAIR, area_digit, facility_type, has, number_in, pair_keys, ratio, zero_if_null,
)
from roadlens.functions.timeofday import Period
from roadlens.operators.performance import TAZ_SCOPE
from roadlens.operators.quality import unique_by
from roadlens.operators.summary import DISTRICTS, district_name
from roadlens.sources.periods import period_map
from roadlens.functions.samples import merged_samples
from roadlens.sources.speeds import Samples, owned_parts

# The compared measures, the class report, and the marker of an unmatched row.
DIFF_MEASURES = [
    "speed_mph", "length", "volume", "delay", "person_delay", "person_hour", "person_mile", "Severe_Congestion_P",
    "length_weighted_P", "vehicle_mile", "vehicle_hour", "trk_vehicle_mile", "trk_vehicle_hour",
    "hov_delay", "hov_person_delay", "hov_person_hour", "hov_person_mile",
]
CLASS_SUMS = ["delay", "person_delay", "person_hour", "person_mile", "length_weighted_P", "vehicle_mile",
              "trk_vehicle_mile"]
NO_MATCH = -1.0
MIN_HOURS = 0.1


def comparison_aliases(frame: DataFrame) -> DataFrame:
    """Fill the names older tables use: vehicle_volume, person_volume, speed / speed_mph."""
    out = frame
    for target, source in (("vehicle_volume", "volume"), ("person_volume", "volume"),
                           ("speed_mph", "speed"), ("speed", "speed_mph")):
        if target not in out.columns and source in out.columns:
            out = out.withColumn(target, F.col(source))
    return out


def scenario_diff(bd: DataFrame, nb: DataFrame, measures: Sequence[str] = DIFF_MEASURES) -> DataFrame:
    """Every BD row with its NB twin; a difference that cannot be formed is -1."""
    keys = (["time_period"] if has(bd, "time_period") and has(nb, "time_period") else []) + PAIR
    left = bd.select(*keys, *[F.col(m).alias(f"{m}_bd") for m in measures])
    right = nb.select(*keys, *[F.col(m).alias(f"{m}_nb") for m in measures])
    joined = left.join(right, keys, "left")
    return joined.withColumns({
        f"{m}_diff": F.coalesce(F.col(f"{m}_bd") - F.col(f"{m}_nb"), F.lit(NO_MATCH)) for m in measures})


def speed_class_low(speed: Column | str) -> Column:
    """Lower edge of the 5 mph class, the numeric order of the class text."""
    return (F.floor((F.col(speed) if isinstance(speed, str) else speed) / 5) * 5).cast("int")


def speed_class_text(low: Column) -> Column:
    text = F.concat_ws("_", low.cast("string"), (low + 5).cast("string"))
    return F.when(low.isNull(), F.lit("<NA>_<NA>")).otherwise(text)


def speed_class_stats(bd: DataFrame, nb: DataFrame) -> DataFrame:
    """Per period: NB total, NB classes, BD total, BD classes, and the DIFF of the totals.

    Both scenarios are reduced to (period, scenario, class) cells in one pass.  A cell then feeds
    its class row, its total row and the DIFF row, so no aggregate is computed twice.
    """
    cols = ["time_period", "speed_mph", "Severe_Congestion_P", *CLASS_SUMS]
    both = bd.select(*cols).withColumn("scenario", F.lit("BD")).unionByName(
        nb.select(*cols).withColumn("scenario", F.lit("NB")))
    cells = both.withColumn("low", speed_class_low("speed_mph")).groupBy("time_period", "scenario", "low").agg(
        *[F.sum(m).alias(m) for m in CLASS_SUMS],
        F.max("Severe_Congestion_P").alias("sev_max"),
        F.sum("Severe_Congestion_P").alias("sev_sum"), F.count("Severe_Congestion_P").alias("sev_n"))
    rows = F.array(
        F.struct(F.concat(F.col("scenario"), F.lit(" class")).alias("section"), F.col("low").alias("class_low"),
                 speed_class_text(F.col("low")).alias("label")),
        F.struct(F.col("scenario").alias("section"), F.lit(None).cast("int").alias("class_low"),
                 F.col("scenario").alias("label")),
        F.struct(F.lit("DIFF").alias("section"), F.lit(None).cast("int").alias("class_low"), F.lit("DIFF").alias("label")),
    )
    fed = cells.withColumn("r", F.explode(rows)).select("*", "r.section", "r.class_low", "r.label")

    def side(name: str) -> list[Column]:
        here = F.col("scenario") == name
        return [*[zero_if_null(F.sum(F.when(here, F.col(m)))).alias(f"{name}_{m}") for m in CLASS_SUMS],
                F.max(F.when(here, F.col("sev_max"))).alias(f"{name}_smax"),
                F.sum(F.when(here, F.col("sev_sum"))).alias(f"{name}_ssum"),
                F.sum(F.when(here, F.col("sev_n"))).alias(f"{name}_sn")]
    wide = fed.groupBy("time_period", "section", "class_low", "label").agg(*side("BD"), *side("NB"))

    def values(name: str) -> dict[str, Column]:
        hours = F.greatest(F.col(f"{name}_person_hour"), F.lit(MIN_HOURS))
        return {
            **{m: F.col(f"{name}_{m}") for m in CLASS_SUMS},
            "mile_over_hour": F.col(f"{name}_person_mile") / hours,
            "delay_over_hour": F.col(f"{name}_person_delay") / hours,
            "max_severe_congestion": F.col(f"{name}_smax"),
            "avg_severe_congestion": ratio(f"{name}_ssum", f"{name}_sn"),
        }
    b, n = values("BD"), values("NB")
    pick = {k: F.when(F.col("section") == "DIFF", b[k] - n[k]).when(F.col("section").startswith("BD"), b[k]).otherwise(n[k])
            for k in b}
    order = F.create_map(*[F.lit(x) for pair in (("NB", 0), ("NB class", 1), ("BD", 2), ("BD class", 3), ("DIFF", 4)) for x in pair])
    return wide.select("time_period", order[F.col("section")].alias("section_order"), "section", "class_low", "label",
                       *[v.alias(k) for k, v in pick.items()])


def _travel(perf: DataFrame, links: DataFrame, attributes: Sequence[str], order: str | None) -> DataFrame:
    """Link attributes (first copy of a pair wins), -1 where unmatched, and unclamped delay."""
    keys = PAIR
    picked = links.groupBy(*keys).agg(*[
        (F.any_value(a) if order is None else F.min_by(a, order)).alias(a) for a in attributes])
    base = perf.drop(*[a for a in attributes if a in perf.columns])
    j = base.join(picked, keys, "left").withColumns(
        {a: F.coalesce(F.col(a).cast("double"), F.lit(NO_MATCH)) for a in attributes})
    tt = F.try_divide(F.col("length_in_mile"), F.col("speed_mph").cast("double"))
    fftt = F.try_divide(F.col("length_in_mile"), F.col("free_speed"))
    return j.withColumns({"TT": tt, "FFTT": fftt, "delay": tt - fftt}).withColumn(
        "person_delay", F.col("person_volume") * F.col("delay"))


def full_link_diff(bd: DataFrame, bd_links: DataFrame, nb: DataFrame, nb_links: DataFrame,
                   order: str | None = None) -> DataFrame:
    """Period-wise difference of every in-scope BD link, -1 where NB has no such link.

    The delay is TT - FFTT without a clamp, unlike the statistics.  ``link_type`` is expected in
    the BD table, or carried by the caller.
    """
    key = (["time_period"] if has(bd, "time_period") and has(nb, "time_period") else []) + PAIR
    b = _travel(comparison_aliases(bd), bd_links, ["TAZ", "district_id", "length_in_mile", "free_speed"], order)
    b = b.withColumn("FT", area_digit("link_type"))
    b = b.where((F.col("TAZ") > TAZ_SCOPE[0]) & (F.col("TAZ") < TAZ_SCOPE[1]) & (F.col("FT") > 0))
    n = _travel(comparison_aliases(nb), nb_links, ["length_in_mile", "free_speed"], order)
    names = ["vehicle_volume", "speed_mph", "person_delay"]
    right = unique_by(n.select(*key, *[F.col(c).alias(f"{c}_nb") for c in names]), key, "NB table")
    j = b.select(*key, "FT", "TAZ", "district_id", district_name(F.col("district_id")).alias("jur_name"),
                 *[F.col(c).alias(f"{c}_bd") for c in names]).join(right, key, "left")
    j = j.withColumns({f"{c}_nb": F.coalesce(F.col(f"{c}_nb"), F.lit(NO_MATCH)) for c in names})

    def gap(c: str, guard: str) -> Column:
        return F.when(F.col(f"{guard}_nb") == NO_MATCH, F.lit(NO_MATCH)).otherwise(F.col(f"{c}_bd") - F.col(f"{c}_nb"))
    return j.withColumns({
        "diff_vehicle_volume": gap("vehicle_volume", "vehicle_volume"),
        "diff_speed_mph": gap("speed_mph", "speed_mph"),
        "diff_person_delay": gap("person_delay", "vehicle_volume"),
    })


def daily_aggregate(perf: DataFrame, periods: list[Period], midnight: str = "wrap",
                    order: str | None = None) -> DataFrame:
    """Daily totals of the links the first period has; speed weighted by period length.

    One aggregation over the pair; ``order`` makes the last copy of a (link, period) win, without it
    a repeated (link, period) fails the job.
    """
    p = comparison_aliases(pair_keys(perf).withColumn("time_period", F.lower("time_period")))
    p = p.where(F.col("time_period").isin([x.name for x in periods]))
    keys = (["link_id"] if "link_id" in p.columns else []) + PAIR
    if order is not None:
        rest = [c for c in p.columns if c not in keys and c != "time_period"]
        p = p.groupBy(*keys, "time_period").agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")) \
             .select(*keys, "time_period", "r.*")
    base = F.col("time_period") == periods[0].name
    hours = F.try_element_at(period_map(periods, "hours", midnight), F.col("time_period"))
    speed = number_in(p, "speed")
    usable = speed.isNotNull() & (hours > 0)
    statics = [c for c in ("geometry", "link_type") if c in p.columns]
    out = p.groupBy(*keys).agg(
        F.bool_or(base).alias("__base"),
        F.greatest(F.lit(0), *[F.count_if(F.col("time_period") == x.name) for x in periods]).alias("__copies"),
        *[F.max(F.when(base, F.col(c))).alias(c) for c in statics],
        ratio(F.sum(F.when(usable, speed * hours)), F.sum(F.when(usable, hours))).alias("speed"),
        zero_if_null(F.sum(number_in(p, "volume"))).alias("volume"),
        zero_if_null(F.sum(number_in(p, "person_volume"))).alias("person_volume"),
    )
    shown = F.concat_ws("->", *[F.col(k).cast("string") for k in PAIR])
    once = F.when(F.col("__copies") > 1, F.raise_error(F.concat(F.lit("repeated link and period in the daily table, e.g. "), shown)).cast("boolean"))
    return out.where(F.coalesce(once, F.lit(True)) & F.col("__base")).drop("__base", "__copies")


def daily_with_speeds(perf: DataFrame, speeds: DataFrame, periods: list[Period], midnight: str = "wrap",
                      order: str | None = None, samples: Samples | None = None) -> DataFrame:
    """The daily table with ``speeds``: the (minute, speed_mph) entries of the day, each from the period that owns its minute.

    ``speeds`` is long (time_period, link, minute, speed_mph) or has a row per link and period with ``samples``, entries of both, or with what ``samples`` makes them of; links without any keep an empty list.  A minute
    that two periods claim fails the job, as does a link with two speeds for one minute.
    """
    day = daily_aggregate(perf, periods, midnight, order)
    # Merged where they have met: the narrow table is what the join hashes, and samples are neither broadcast nor moved again.
    met = day.hint("shuffle_hash").join(owned_parts(speeds, periods, samples=samples), PAIR, "left")
    return met.withColumn("speeds", merged_samples("parts")).drop("parts")


def district_diff(bd_day: DataFrame, bd_links: DataFrame, nb_day: DataFrame, nb_links: DataFrame) -> DataFrame:
    """Daily difference inside each of the nine named districts, all districts in one job.

    A BD link is compared with the NB link of the same pair *and district*; -1 where none is.
    """
    named = F.col("district_id").isin([d for d in DISTRICTS if d < 10])

    def measured(day: DataFrame, links: DataFrame) -> DataFrame:
        attrs = ["district_id", "length_in_mile", "free_speed"]
        slim = links.select(*PAIR, *attrs, *(["link_type"] if "link_type" not in day.columns else []))
        j = day.drop(*attrs).join(unique_by(slim, PAIR, "link table of the day"), PAIR, "left").where(named)
        j = j.withColumns({a: F.coalesce(F.col(a).cast("double"), F.lit(NO_MATCH)) for a in attrs[1:]})
        delay = F.try_divide(F.col("length_in_mile"), F.col("speed")) - F.try_divide(F.col("length_in_mile"), F.col("free_speed"))
        return j.withColumns({"person_delay": F.col("person_volume") * delay,
                              "person_mile": F.col("person_volume") * F.col("length_in_mile")})
    values = {"volume": "diff_volume", "speed": "diff_speed", "person_delay": "diff_PHD", "person_mile": "diff_PMT"}
    key = [*PAIR, "district_id"]
    b = measured(bd_day, bd_links).withColumn("FT", facility_type("link_type"))
    b = b.select(*key, district_name(F.col("district_id")).alias("jur_name"), "FT", *[F.col(v).alias(f"{v}_bd") for v in values])
    n = measured(nb_day, nb_links).select(*key, *[F.col(v).alias(f"{v}_nb") for v in values])
    j = b.join(unique_by(n, key, "NB day"), key, "left").withColumns({f"{v}_nb": F.coalesce(F.col(f"{v}_nb"), F.lit(NO_MATCH)) for v in values})
    return j.withColumns({
        d: F.when(F.col(f"{v}_nb") == NO_MATCH, F.lit(NO_MATCH)).otherwise(F.col(f"{v}_bd") - F.col(f"{v}_nb"))
        for v, d in values.items()})


def scenario_names(names: DataFrame, column: str = "scenario") -> DataFrame:
    """Pair scenario folders by their ``_BD`` / ``_NB`` ending."""
    base = F.regexp_replace(column, "_(BD|NB)$", "")
    ending = F.regexp_extract(column, "_(BD|NB)$", 1)
    return names.groupBy(base.alias("base")).agg(
        F.max(F.when(ending == "BD", F.col(column))).alias("bd"),
        F.max(F.when(ending == "NB", F.col(column))).alias("nb"))
