"""Five-minute speed profiles: raw curve, anchors, rate limits and checks."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlens.functions.columns import number_in
from roadlens.functions.samples import change_measures
from roadlens.functions.timeofday import DAY, Period
from roadlens.operators import profile_fold
from roadlens.operators.profile_fold import Limits, enforce, raw_curve
from roadlens.operators.quality import QualityError, require, unique_by

# Tasks get the fold by value, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(profile_fold)

STEP = 5
STEP_HOURS = STEP / 60.0
# Input defaults.
DEFAULTS = {"lanes": 1.0, "capacity": 1800.0, "vdf_plf": 1.0, "vdf_alpha": 0.15, "vdf_beta": 4.0, "vdf_cp": 0.28125,
            "vdf_cd": 1.0, "vdf_n": 1.0, "vdf_s": 4.0, "vdf_type": 0.0, "qvdf_profile_mode": -1.0}
DEFAULT_FREE_KMH, KM_PER_MILE_ROUNDED = 60.0, 1.609
POSITIVE = ["t0_hour", "t2_hour", "t3_hour", "qvdf_start_speed_mph", "qvdf_end_speed_mph"]
SCALARS = ["generated", "vt2", "boundary", "t2", "observed", "start", "end", "assigned", "t0", "t3", "peak", "miles", "wt2", "rtt", "free", "from", "to"]


def smoothstep(x: Column) -> Column:
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    return p * p * (3 - 2 * p)


def profile_inputs(perf: DataFrame, links: DataFrame, periods: list[Period], keys: list[str]) -> DataFrame:
    """One typed row per period and link; a performance row without a link, or a repeated link, fails the job.  Periods that cross midnight end at 24:00."""
    use = ["time_period", *keys]
    cells = [c for c in [*DEFAULTS, *POSITIVE, "vdf_free_speed_mph", "free_speed", "cutoff_speed", "vdf_length_mi", "length_in_mile"]
             if c in links.columns]
    right = unique_by(links.select(*use, *[number_in(links, c).alias(c) for c in cells]), use, "link table of the profiles").withColumn("__matched", F.lit(True))
    j = perf.select(*use, number_in(perf, "volume").alias("volume"), number_in(perf, "speed_mph").alias("__speed")).join(right, use, "left")
    j = require(j, F.col("__matched"), "performance row without a link").drop("__matched")

    def cell(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in cells else default
    free = cell("vdf_free_speed_mph", cell("free_speed", F.lit(DEFAULT_FREE_KMH)) / KM_PER_MILE_ROUNDED)
    out = j.withColumn("free", free)
    bound = {p.name: (i, p.start, p.end if p.end > p.start else DAY) for i, p in enumerate(periods)}
    look = lambda k: F.try_element_at(F.create_map(*[F.lit(x) for n, v in bound.items() for x in (n, v[k])]), F.col("time_period"))
    out = out.withColumns({
        "period_index": look(0), "start_minute": look(1), "end_minute": look(2),
        "cutoff": cell("cutoff_speed", 0.75 * F.col("free")),
        "miles": cell("vdf_length_mi", cell("length_in_mile", F.lit(0.0))),
        "assigned": F.coalesce(F.col("__speed"), F.col("free")),
        **{c: cell(c, F.lit(d)) for c, d in DEFAULTS.items()},
        **{c: F.when(cell(c, F.lit(None).cast("double")) > 0, cell(c, F.lit(None).cast("double"))) for c in POSITIVE},
    })
    return out.where(F.col("period_index").isNotNull()).drop("__speed")


def with_scalars(inputs: DataFrame) -> DataFrame:
    """Demand, congestion speeds and the congestion window of every row."""
    c = F.col
    start, end = c("start_minute") / 60, c("end_minute") / 60
    hours = F.greatest(end - start, F.lit(0.001))
    demand = c("volume") / F.greatest(F.lit(0.01), c("lanes")) / hours / F.greatest(F.lit(0.0001), c("vdf_plf"))
    own = c("vdf_type").isin(0.0, 2.0)
    mode = c("qvdf_profile_mode")
    seen = c("t2_hour").isNotNull()
    generated = (c("volume") > 0) & (mode != 0) & (
        (mode == 1) | ((mode == 2) & seen) | (~mode.isin(1.0, 2.0) & ((c("vdf_type") == 2) | seen)))
    d = inputs.withColumns({"doc": demand / F.greatest(F.lit(0.1), c("capacity")), "is_generated": generated,
                            "period_from": start, "period_to": end})
    doc = c("doc")
    reference = F.when(doc < 1, (1 - doc) * c("free") + doc * c("cutoff")).otherwise(c("cutoff"))
    alpha, beta = F.when(own, c("vdf_alpha")).otherwise(0.15), F.when(own, c("vdf_beta")).otherwise(4.0)
    d = d.withColumns({"vref": reference, "duration": c("vdf_cd") * F.pow(doc, c("vdf_n")),
                       "alpha_used": alpha, "beta_used": beta})
    d = d.withColumns({
        "boundary": F.greatest(c("vref"), c("vref") / (1 + c("alpha_used") * F.pow(doc, c("beta_used")))),
        "vt2": c("cutoff") / F.greatest(F.lit(0.001), 1 + c("vdf_cp") * F.pow(c("duration"), c("vdf_s"))),
        "t2": F.coalesce(c("t2_hour"), (c("period_from") + c("period_to")) / 2),
        "observed": seen.cast("double"),
    })
    triplet = (c("t0_hour") < c("t2_hour")) & (c("t2_hour") < c("t3_hour"))
    share = (c("t2_hour") - c("t0_hour")) / F.greatest(F.lit(1e-6), c("t3_hour") - c("t0_hour"))
    left = F.when(triplet, F.greatest(F.lit(0.05), F.least(F.lit(0.95), share))).otherwise(0.5)
    d = d.withColumn("left_share", left)
    return d.withColumns({
        "t0": F.greatest(c("period_from"), c("t2") - c("left_share") * c("duration")),
        "t3": F.least(c("period_to"), c("t2") + (1 - c("left_share")) * c("duration")),
        "rtt": c("miles") / F.greatest(F.lit(0.01), c("vref")),
        "wt2": c("miles") / F.greatest(F.lit(0.001), c("vt2")) - c("miles") / F.greatest(F.lit(0.01), c("vref")),
    }).withColumn("peak", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(c("t2") - c("t0"), c("t3") - c("t0"))))) \
        .drop("alpha_used", "beta_used", "left_share")


def _position(minute: Column) -> dict[str, Column]:
    """What the closed form needs of one minute, bound once: place in the window, ramps."""
    c = F.col
    t = minute / 60
    unit = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
    return {
        "t": t, "x": unit(F.try_divide(t - c("t0"), c("t3") - c("t0"))),
        "before": unit((t - c("period_from")) / F.greatest(F.lit(0.001), c("t0") - c("period_from"))),
        "after": unit((t - c("t3")) / F.greatest(F.lit(0.001), c("period_to") - c("t3"))),
    }


def _hump(x: Column, t: Column) -> Column:
    """Shape of the congestion window: 0 at its ends, 1 at the peak share ``peak``."""
    c, f = F.col, F.col("peak")
    inner = F.when(f <= 1e-9, F.pow(1 - x, F.lit(4.0))).when(f >= 1 - 1e-9, F.pow(x, F.lit(4.0))).otherwise(
        F.pow(x / f, 4 * f) * F.pow((1 - x) / (1 - f), 4 * (1 - f)))
    point = F.when(F.abs(t - c("t2")) <= 1e-9, 1.0).otherwise(0.0)
    return F.when(c("t3") - c("t0") > 1e-9, inner).otherwise(point)


def _speed(t: Column, hump: Column, before: Column, after: Column) -> Column:
    c = F.col
    ramp = lambda p: p * p * (3 - 2 * p)
    shape = F.greatest(F.lit(0.0), F.least(F.lit(1.0), hump))
    return F.when((t >= c("t0")) & (t <= c("t3")), F.try_divide(c("miles"), c("wt2") * shape + c("rtt"))) \
        .when(t < c("t0"), c("free") + ramp(before) * (c("boundary") - c("free"))) \
        .otherwise(c("boundary") + ramp(after) * (c("free") - c("boundary")))


def with_raw_speed(rows: DataFrame) -> DataFrame:
    """Long rows with a ``minute``: ``raw_speed`` in steps small enough to be compiled well."""
    r = rows.withColumns({f"__{k}": v for k, v in _position(F.col("minute")).items()})
    r = r.withColumn("__hump", _hump(F.col("__x"), F.col("__t")))
    r = r.withColumn("raw_speed", _speed(F.col("__t"), F.col("__hump"), F.col("__before"), F.col("__after")))
    return r.drop("__t", "__x", "__before", "__after", "__hump")


def sample_minutes() -> Column:
    return F.sequence(F.col("start_minute"), F.col("end_minute") - 1, F.lit(STEP))


def plain_speed(minute: Column) -> Column:
    """Rows without a generated curve: smoothstep between the anchors or the assigned speed."""
    c = F.col
    last = c("start_minute") + F.floor((c("end_minute") - 1 - c("start_minute")) / STEP) * STEP
    w = smoothstep((minute - c("start_minute")) / F.greatest(F.lit(1), last - c("start_minute")))
    return (1 - w) * F.coalesce("qvdf_start_speed_mph", "assigned") + w * F.coalesce("qvdf_end_speed_mph", "assigned")


def raw_profiles(inputs: DataFrame, keys: list[str]) -> DataFrame:
    """Long raw profiles (no anchors on generated curves): (period, keys, minute, speed_mph)."""
    rows = with_raw_speed(with_scalars(inputs).withColumn("minute", F.explode(sample_minutes())))
    return rows.select("time_period", *keys, "minute", "is_generated", F.when(
        F.col("is_generated"), F.col("raw_speed")).otherwise(plain_speed(F.col("minute"))).alias("speed_mph"))


def _packed(inputs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per link: its periods in order and their scalars side by side.

    A link has one row per period of the plan, so the list stays as short as the plan.  The samples of the raw curve are made in the fold, from
    the scalars: as array functions they were interpreted, and shuffled with the link.
    """
    rows = with_scalars(inputs)
    nan = F.lit(float("nan"))
    scal = {"generated": F.col("is_generated"),
            "start": F.coalesce("qvdf_start_speed_mph", nan),
            "end": F.coalesce("qvdf_end_speed_mph", nan), "from": F.col("period_from"), "to": F.col("period_to")}
    entry = F.struct("period_index", F.array(*[scal.get(s, F.col(s)).cast("double") for s in SCALARS]).alias("scal"))
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("p"))
    return lists.select(
        *keys, F.transform("p", lambda e: e["period_index"]).alias("periods"),
        F.concat_ws(",", F.transform("p", lambda e: e["period_index"].cast("string"))).alias("signature"),
        F.flatten(F.transform("p", lambda e: e["scal"])).alias("scal"))


def fold_batches(periods: list[Period], limits: Limits, smooth_boundaries: bool):
    """Arrow batches of packed links -> the same rows with ``speeds`` in place of the scalars, and the ``reason`` of rows that failed."""
    grids = [(p.start, p.end if p.end > p.start else DAY) for p in periods]
    step, scalars = STEP, list(SCALARS)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            names = np.asarray(table["signature"].to_pylist(), dtype=object)
            for signature in sorted(set(names)):
                part = table.take(np.flatnonzero(names == signature)).combine_chunks()
                n = part.num_rows
                index = [int(i) for i in signature.split(",")]
                minutes = [np.arange(grids[i][0], grids[i][1], step) for i in index]
                scal = part["scal"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, len(index), len(scalars))
                named = [{s: scal[:, k, c] for c, s in enumerate(scalars)} for k in range(len(index))]
                # A gap between periods ends a run: nothing is carried over it.
                runs = [[0]]
                for k in range(1, len(index)):
                    if grids[index[k]][0] == grids[index[k - 1]][1]:
                        runs[-1].append(k)
                    else:
                        runs.append([k])
                keys = part.drop_columns(["signature", "scal", "periods"])
                for r in runs:
                    reasons = np.full(n, None, dtype=object)
                    done = enforce([raw_curve(minutes[k], named[k]) for k in r], [minutes[k] for k in r], [named[k] for k in r], limits, smooth_boundaries, reasons)
                    which = np.tile(np.asarray([index[k] for k in r], dtype=np.int32), n)
                    lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, len(v) + 1, len(v) // n, dtype=np.int32)), pa.array(v))
                             for v in (which, done.ravel())]
                    failed = pa.array([x is not None for x in reasons])
                    speeds = pa.compute.if_else(failed, pa.scalar(None, lists[1].type), lists[1])
                    yield from keys.append_column("periods", lists[0]).append_column("speeds", speeds).append_column("reason", pa.array(reasons, pa.string())).to_batches()
    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def profile_outcomes(inputs: DataFrame, periods: list[Period], keys: list[str], limits: Limits = Limits(),
                     smooth_boundaries: bool = True) -> DataFrame:
    """(keys, periods, speeds, reason): one row per link and run of adjacent periods.

    A link whose profile is missing a speed or cannot be limited leaves with its reason and no speeds; it does no harm to the others.
    """
    packed = _packed(inputs, keys)
    kinds = {f.name: f.dataType.simpleString() for f in packed.schema.fields}
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", periods array<int>, speeds array<double>, reason string"
    return packed.mapInArrow(fold_batches(periods, limits, smooth_boundaries), schema)


def profile_failures(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, reason) of every run that failed."""
    return outcomes.where(F.col("reason").isNotNull()).select(*keys, "reason")


def refuse_failures(outcomes: DataFrame, keys: list[str], shown: int = 100) -> None:
    """The gate over all links, before anything is written: fails with their number and the first ones by key."""
    failed = profile_failures(outcomes, keys)
    count = failed.count()
    if count:
        first = failed.orderBy(*keys).limit(shown).collect()
        raise QualityError(f"{count} profiles failed; nothing is written: " + "; ".join("->".join(str(r[k]) for k in keys) + f": {r.reason}" for r in first))


def enforced_arrays(inputs: DataFrame, periods: list[Period], keys: list[str], limits: Limits = Limits(),
                    smooth_boundaries: bool = True) -> DataFrame:
    """(keys, periods, speeds): enforced samples, one row per link and run of adjacent periods; a failing link fails the job and is named."""
    outcomes = profile_outcomes(inputs, periods, keys, limits, smooth_boundaries)
    named = F.concat(F.concat_ws("->", *[F.col(k).cast("string") for k in keys]), F.lit(": "), F.col("reason"))
    return require(outcomes, F.col("reason").isNull(), named).drop("reason")


def exploded(arrays: DataFrame, periods: list[Period], keys: list[str]) -> DataFrame:
    """Arrays back to (period, keys, minute, speed_mph) rows."""
    ends = [p.end if p.end > p.start else DAY for p in periods]
    about = F.array(*[F.struct(F.lit(p.name).alias("time_period"), F.lit(p.start).alias("start"), F.lit(len(range(p.start, end, STEP))).alias("n"))
                      for p, end in zip(periods, ends)])
    # Only a run's few periods pass through (interpreted) array functions; its samples are exploded as they are.
    counts = F.transform("periods", lambda i: F.get(about, i)["n"])
    before = lambda k: F.aggregate(F.slice("__n", F.lit(1), k), F.lit(0), lambda total, n: total + n)
    cut = F.transform("periods", lambda i, k: F.struct(F.get(about, i).alias("p"), F.slice("speeds", before(k) + 1, F.get("__n", k)).alias("speeds")))
    rows = arrays.withColumn("__n", counts).select(*keys, F.explode(cut).alias("s"))
    rows = rows.select("s.p.time_period", *keys, F.col("s.p.start").alias("__start"), F.posexplode("s.speeds").alias("__at", "speed_mph"))
    return rows.select("time_period", *keys, (F.col("__start") + STEP * F.col("__at")).alias("minute"), "speed_mph")


def smooth_profiles(inputs: DataFrame, periods: list[Period], keys: list[str], limits: Limits = Limits(),
                    smooth_boundaries: bool = True) -> DataFrame:
    """Enforced five-minute profiles, long."""
    return exploded(enforced_arrays(inputs, periods, keys, limits, smooth_boundaries), periods, keys)


def array_metrics(arrays: DataFrame, keys: list[str], limits: Limits = Limits(), decimals: int | None = None) -> DataFrame:
    """Largest step, windowed mean and acceleration of array profiles, without a shuffle; of the speeds rounded to ``decimals``, if given."""
    m = arrays.withColumn("m", change_measures(F.col("speeds"), limits.window, decimals))
    return m.select(*keys, "m.max_step", "m.max_rolling", "m.max_acceleration")


def violations(metrics: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Profiles beyond a limit; the gate before anything is written."""
    return metrics.where((F.col("max_step") > limits.step + 1e-8) | (F.col("max_rolling") > limits.rolling + 1e-8)
                         | (F.col("max_acceleration") > limits.acceleration + 1e-6))


# How much a limit may be exceeded by rounding of the arithmetic.
SLACK = {"max_step": 1e-8, "max_rolling": 1e-8, "max_acceleration": 1e-6}


def profile_limits(arrays: DataFrame, keys: list[str], limits: Limits = Limits(), decimals: int = 12) -> DataFrame:
    """The fold over all links: one row per limit and form of the profiles (exact, and rounded as written).

    Columns: form, measure, allowed, largest, the keys of the link that holds it (the least, if several do), profiles, beyond (profiles beyond the limit).
    One aggregate without groups over both forms: the profiles are made once, and no row per measure is made or sorted.
    """
    bound = {"max_step": limits.step, "max_rolling": limits.rolling, "max_acceleration": limits.acceleration}
    measures = {"exact": None, "rounded": decimals}
    both = arrays.select(*keys, *[change_measures(F.col("speeds"), limits.window, d).alias(form) for form, d in measures.items()])
    both = both.select(*keys, *[F.col(f"{form}.{m}").alias(f"{form}_{m}") for form in measures for m in bound])
    cells = [(form, m, float(allowed)) for form in ("exact", "rounded") for m, allowed in bound.items()]
    aggregates = []
    for i, (form, m, allowed) in enumerate(cells):
        value = F.coalesce(F.col(f"{form}_{m}"), F.lit(0.0))
        aggregates += [F.max(value).alias(f"largest{i}"), F.min_by(F.struct(*keys), F.struct(-value, *keys)).alias(f"holder{i}"),
                       F.count_if(value > allowed + SLACK[m]).alias(f"beyond{i}")]
    folded = both.agg(F.count(F.lit(1)).alias("profiles"), *aggregates).where("profiles > 0")
    rows = F.array(*[F.struct(F.lit(form).alias("form"), F.lit(m).alias("measure"), F.lit(allowed).alias("allowed"), F.col(f"largest{i}").alias("largest"),
                              F.col(f"holder{i}").alias("holder"), "profiles", F.col(f"beyond{i}").alias("beyond")) for i, (form, m, allowed) in enumerate(cells)])
    return folded.select(F.inline(rows)).select("form", "measure", "allowed", "largest", "holder.*", "profiles", "beyond")


def refuse_beyond(folded: DataFrame) -> None:
    """The gate on the fold: fails with the limits that profiles break, exact or rounded, and the link of the largest value."""
    broken = folded.where("beyond > 0").orderBy("form", "measure").collect()
    if broken:
        raise QualityError("profiles beyond a limit: " + "; ".join(str(r.asDict()) for r in broken))


def step_metrics(long: DataFrame, keys: list[str]) -> DataFrame:
    """Largest step, three-step mean and acceleration of long profiles.

    A profile has at most 288 samples, which bounds the window of a link.
    """
    order = W.partitionBy(*keys).orderBy("minute")
    three = order.rowsBetween(-2, 0)
    step = F.col("speed_mph") - F.lag("speed_mph").over(order)
    d = long.withColumn("step", step)
    d = d.withColumns({
        "acceleration": (F.col("step") - F.lag("step").over(order)) / STEP_HOURS**2,
        "rolling": F.when(F.count("step").over(three) == 3, F.avg(F.abs("step")).over(three)),
    })
    return d.groupBy(*keys).agg(F.max(F.abs("step")).alias("max_step"), F.max("rolling").alias("max_rolling"),
                                F.max(F.abs("acceleration")).alias("max_acceleration"))
