"""The samples of many links at once: Arrow functions over array columns, with NumPy on the flat values of a batch.

Spark interprets its array functions one element at a time; these take the lists of a batch as one vector.  Rows stay where they are:
a column goes in and a column comes out, so nothing is moved or regrouped.  The functions are shipped by value; executors need
only numpy and pyarrow.  NULL and NaN samples both count as missing, and missing results are NULL.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY = 1440
KM_PER_MILE = 1.609344
STEP_HOURS = 1.0 / 12.0
TWICE = "a link has two speeds for one minute"


# --- steps of one pass ----------------------------------------------------------------------------

class Made:
    """A column that Arrow functions make of others, one after the other in one pass over a batch.

    Spark hands the result of an Arrow function to the next one through its own rows, element by element; what is composed here stays in Arrow.
    """

    def __init__(self, run: Callable[..., pa.Array], columns: Sequence[Column], kind: str):
        self.run, self.columns, self.kind = run, list(columns), kind

    def then(self, run: Callable[..., pa.Array], *columns: Column | str, kind: str) -> Made:
        before, taken = self.run, len(self.columns)

        def both(*arrays: pa.Array) -> pa.Array:
            return run(before(*arrays[:taken]), *arrays[taken:])
        return Made(both, [*self.columns, *map(as_column, columns)], kind)

    def column(self) -> Column:
        return F.arrow_udf(self.run, self.kind)(*self.columns)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _same(values: pa.Array) -> pa.Array:
    return values


def made(values: Made | Column | str) -> Made:
    return values if isinstance(values, Made) else Made(_same, [as_column(values)], "")


# --- lists and vectors ----------------------------------------------------------------------------

def unlist(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(elements per row, all elements); a NULL list has none."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()


def doubles(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def whole(values: pa.Array, missing: int = 0) -> np.ndarray:
    return pc.fill_null(values, missing).to_numpy(zero_copy_only=False).astype(np.int64)


def nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), from_pandas=True)


def relist(counts: np.ndarray, values: pa.Array, absent: np.ndarray | None = None) -> pa.Array:
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=None if absent is None or not absent.any() else pa.array(absent))


def structs(**fields: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays(list(fields.values()), names=list(fields))


def starts_of(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def places(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... within every row."""
    return np.arange(counts.sum()) - np.repeat(starts_of(counts), counts)


def row_fold(fold: np.ufunc, values: np.ndarray, counts: np.ndarray, empty: float) -> np.ndarray:
    out = np.full(len(counts), empty)
    full = counts > 0
    if full.any():
        out[full] = fold.reduceat(values, starts_of(counts)[full])
    return out


def matrix(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of equal width, filled up with NaN."""
    out = np.full((len(counts), int(counts.max(initial=0))), np.nan)
    out[np.repeat(np.arange(len(counts)), counts), places(counts)] = values
    return out


# --- sums, percentile -----------------------------------------------------------------------------

def _total(lists: pa.Array) -> pa.Array:
    counts, flat = unlist(lists)
    out = row_fold(np.add, doubles(flat), counts, 0.0)
    out[np.asarray(lists.is_null())] = np.nan
    return nullable(out)


def _total_present(lists: pa.Array) -> pa.Array:
    counts, flat = unlist(lists)
    v = doubles(flat)
    there = ~np.isnan(v)
    out = row_fold(np.add, np.where(there, v, 0.0), counts, 0.0)
    out[row_fold(np.add, there.astype(np.float64), counts, 0.0) == 0] = np.nan
    return nullable(out)


def total(values: Made | Column) -> Column:
    """Sum of an array of numbers: 0 if it is empty, NULL as soon as a number is missing."""
    return made(values).then(_total, kind="double").column()


def total_present(values: Made | Column) -> Column:
    """Sum of the numbers that are there, NULL if none is."""
    return made(values).then(_total_present, kind="double").column()


def percentile(values: Made | Column, q: float) -> Column:
    """Linearly interpolated percentile of the non-negative numbers of an array (NULL when it has none)."""
    def run(lists: pa.Array) -> pa.Array:
        counts, flat = unlist(lists)
        v = doubles(flat)
        ordered = matrix(np.where(v >= 0, v, np.nan), counts)
        out = np.full(len(counts), np.nan)
        n = np.count_nonzero(~np.isnan(ordered), axis=1)
        some = np.flatnonzero(n > 0)
        if len(some):
            ordered, n = np.sort(ordered[some], axis=1), n[some]
            rank = (n - 1) * q
            below = np.floor(rank).astype(np.int64)
            line = np.arange(len(some))
            low, high = ordered[line, below], ordered[line, np.minimum(below + 1, n - 1)]
            out[some] = low + (rank - below) * (high - low)
        return nullable(out)
    return made(values).then(run, kind="double").column()


def _measured(lists: pa.Array) -> pa.Array:
    counts, flat = unlist(lists)
    v = doubles(flat)
    bad = row_fold(np.add, (~(v >= 0)).astype(np.float64), counts, 0.0)
    return structs(total=nullable(row_fold(np.add, np.where(np.isnan(v), 0.0, v), counts, 0.0)), invalid=pa.array(bad.astype(np.int32)))


def measured(speeds: Made | Column) -> Column:
    """``total`` of the speeds that are there and ``invalid``, how many are missing or negative."""
    return made(speeds).then(_measured, kind="total double, invalid int").column()


# --- samples of a period --------------------------------------------------------------------------

def _offsets(samples: pa.Array, start: pa.Array, length: pa.Array) -> pa.Array:
    counts, flat = unlist(samples)
    row = np.repeat(np.arange(len(counts)), counts)
    minute, speed = pc.struct_field(flat, [0]), pc.struct_field(flat, [1])
    o = whole(minute) - whole(start)[row]
    o += np.where(o < 0, DAY, 0)
    own = (o < whole(length, -DAY)[row]) & np.asarray(minute.is_valid())
    if not own.all():
        o, row, speed = o[own], row[own], speed.filter(pa.array(own))
    kept = np.bincount(row, minlength=len(counts)) if len(counts) else counts
    return relist(kept, structs(o=pa.array(o.astype(np.int32)), v=speed.cast(pa.float64())), np.asarray(samples.is_null()))


def offset_samples(samples: Made | Column | str, start: Column, length: Column) -> Made:
    """(offset, speed) entries of (minute, speed) entries, those that a period from ``start`` of so many minutes owns."""
    return made(samples).then(_offsets, start, length, kind="array<struct<o:int,v:double>>")


def _new_offsets(samples: pa.Array, period: pa.Array) -> pa.Array:
    counts, flat = unlist(samples)
    names = period.dictionary_encode().indices
    row = np.repeat(np.arange(len(counts)), counts)
    key = whole(names, -1)[row] * DAY + whole(pc.struct_field(flat, [0]))
    first = np.full((max(len(names.unique()), 1)) * DAY, -1)
    known = np.flatnonzero(key >= 0)[::-1]  # backwards: what is written last, the first row of an offset, stays
    first[key[known]] = known
    new = np.sort(first[first >= 0])
    per_row = np.bincount(row[new], minlength=len(counts)) if len(counts) else counts
    return relist(per_row, pa.array((key[new] % DAY).astype(np.int32)))


def new_offsets(samples: Made | Column | str, period: Column | str) -> Column:
    """The offsets of a row's samples that no earlier row of the same batch and period has: all of them together are all offsets."""
    return made(samples).then(_new_offsets, period, kind="array<int>").column()


def _aligned(samples: pa.Array, step: pa.Array, size: pa.Array, absent: pa.Array, fill: pa.Array) -> pa.Array:
    counts, flat = unlist(samples)
    none, gone = unlist(absent)
    sizes, steps = whole(size), whole(step, 1)
    row = np.concatenate([np.repeat(np.arange(len(sizes)), counts), np.repeat(np.arange(len(sizes)), none)])
    at, left = np.divmod(np.concatenate([whole(pc.struct_field(flat, [0])), whole(gone)]), steps[row])
    if (left != 0).any() or (at < 0).any() or (at >= sizes[row]).any():
        raise ValueError("a sample lies off the grid of its period")
    at += starts_of(sizes)[row]
    if np.bincount(at).max(initial=0) > 1:
        raise ValueError(TWICE)
    out = np.full(sizes.sum(), np.nan)
    out[at] = np.concatenate([doubles(pc.struct_field(flat, [1])), np.repeat(doubles(fill), none)])
    return relist(sizes, nullable(out))


def aligned(samples: Made | Column | str, step: Column | str, size: Column, absent: Column | str, fill: Column) -> Made:
    """Speeds on a grid of ``size`` steps: the sample, NULL where there is none, ``fill`` at the ``absent`` offsets.

    Two samples of the same minute fail the job.
    """
    return made(samples).then(_aligned, step, size, absent, fill, kind="array<double>")


def _ranked(entries: pa.Array) -> pa.Array:
    counts, flat = unlist(entries)
    row = np.repeat(np.arange(len(counts)), counts)
    minute, unit = pc.struct_field(flat, [0]), pc.struct_field(flat, [1])
    if minute.null_count:
        raise ValueError("a sample has no minute")
    minute, speed = whole(minute), doubles(pc.struct_field(flat, [2]))
    mph, kmph = (np.asarray(pc.fill_null(pc.equal(unit, u), False)) for u in ("mph", "kmph"))
    rank = np.where(mph, 0, np.where(kmph, 2, 1)).astype(np.int8)
    speed = np.where(kmph, speed / KM_PER_MILE, speed)
    low = int(minute.min(initial=0))
    clock = np.flatnonzero(np.bincount(minute - low)) + low if len(minute) else np.zeros(0, np.int64)
    at = row * len(clock) + np.searchsorted(clock, minute)
    best = np.full(len(counts) * len(clock), 3, np.int8)
    for r in (2, 1, 0):
        best[at[rank == r]] = r
    won = np.flatnonzero(rank == best[at])
    taken = best < 3
    if len(won) != np.count_nonzero(taken):  # repeated: a missing speed first, then the least; what is written last stays
        won = won[np.argsort(-np.where(np.isnan(speed[won]), -np.inf, speed[won]), kind="stable")]
    values = np.full(len(best), np.nan)
    values[at[won]] = speed[won]
    kept = np.count_nonzero(taken.reshape(len(counts), len(clock)), axis=1) if len(clock) else counts
    which = np.flatnonzero(taken)
    minutes = clock[which % max(len(clock), 1)].astype(np.int32)
    return relist(kept, structs(minute=pa.array(minutes), speed_mph=nullable(values[which])), np.asarray(entries.is_null()))


def best_representation(entries: Made | Column | str) -> Made:
    """(minute, speed_mph) entries, by minute, of one row's (minute, unit, speed) entries: mph before plain before km/h."""
    return made(entries).then(_ranked, kind="array<struct<minute:int,speed_mph:double>>")


def _summed_entries(entries: pa.Array) -> pa.Array:
    counts, flat = unlist(entries)
    return structs(n=pa.array(counts), total=_total(relist(counts, pc.struct_field(flat, [1]))))


def summed_entries(entries: Made | Column | str) -> Column:
    """``n``, how many (minute, speed) entries there are, and ``total``, the sum of their speeds."""
    return made(entries).then(_summed_entries, kind="n bigint, total double").column()


def _by_minute(entries: pa.Array) -> pa.Array:
    counts, flat = unlist(entries)
    key = np.repeat(np.arange(len(counts)), counts) * DAY + whole(pc.struct_field(flat, [0]))
    speed = pc.struct_field(flat, [1])
    if (key[1:] < key[:-1]).any():
        speed = speed.take(pa.array(np.argsort(key, kind="stable")))
    return relist(counts, speed, np.asarray(entries.is_null()))


def speeds_by_minute(entries: Made | Column | str) -> Made:
    """The speeds of (minute, speed) entries in the order of the clock."""
    return made(entries).then(_by_minute, kind="array<double>")


def _owned(samples: pa.Array, start: pa.Array, owned: pa.Array) -> pa.Array:
    counts, flat = unlist(samples)
    row = np.repeat(np.arange(len(counts)), counts)
    minute = (whole(pc.struct_field(flat, [0])) + whole(start)[row]) % DAY
    speed = pc.struct_field(flat, [1])
    sizes, minutes = unlist(owned)
    own = np.zeros((len(counts), DAY), bool)
    own[np.repeat(np.arange(len(counts)), sizes), whole(minutes)] = True
    keep = own[row, minute]
    per_row = np.bincount(row[keep], minlength=len(counts)) if len(counts) else counts
    return structs(m=relist(per_row, pa.array(minute[keep].astype(np.int16))), v=relist(per_row, speed.filter(pa.array(keep)).cast(pa.float64())))


def owned_samples(samples: Made | Column | str, start: Column, owned: Column | str) -> Column:
    """Minutes ``m`` and speeds ``v`` of the (offset, speed) entries whose minute is ``owned``."""
    return made(samples).then(_owned, start, owned, kind="m array<smallint>, v array<double>").column()


def _merged(parts: pa.Array) -> pa.Array:
    pieces, flat = unlist(parts)
    counts, minute = unlist(pc.struct_field(flat, [0]))
    speed = pc.struct_field(flat, [1]).flatten()
    row = np.repeat(np.repeat(np.arange(len(pieces)), pieces), counts)
    minute = whole(minute)
    order = np.argsort(row * DAY + minute, kind="stable")
    row, minute = row[order], minute[order]
    if ((row[1:] == row[:-1]) & (minute[1:] == minute[:-1])).any():
        raise ValueError(TWICE)
    entries = structs(minute=pa.array(minute.astype(np.int32)), speed_mph=speed.take(pa.array(order)))
    return relist(np.bincount(row, minlength=len(pieces)) if len(pieces) else pieces, entries)


def merged_samples(parts: Column | str) -> Column:
    """(minute, speed_mph) entries by minute of a link's parts, as ``owned_samples`` makes them; fails on two speeds for one minute."""
    return F.arrow_udf(_merged, "array<struct<minute:int,speed_mph:double>>")(parts)


# --- flow and volume ------------------------------------------------------------------------------

def flow_curve(speed: np.ndarray, free: np.ndarray, shape: np.ndarray, critical_density: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """``s3.flow_from_speed`` over vectors: the logarithmic spacing, the density from it, and the flow; 0 at an invalid speed."""
    valid = speed >= 0
    with np.errstate(all="ignore"):
        v = np.where(valid, np.fmin(speed, 0.99 * free), np.nan)
        z = np.fmax(shape / 2 * np.log(np.fmax(free / np.fmax(v, 1.0), 1.00001)), 1e-8)
        k = critical_density * np.exp((z + np.log(-np.expm1(-z))) / shape)
        return np.where(valid, np.fmin(v * k, capacity), 0.0)


def _flows(lists: pa.Array, *scalars: pa.Array) -> pa.Array:
    counts, flat = unlist(lists)
    q = flow_curve(doubles(flat), *(np.repeat(doubles(s), counts) for s in scalars))
    most = row_fold(np.fmax, q, counts, np.nan)
    return structs(total=nullable(row_fold(np.add, q, counts, 0.0)), most=nullable(most))


def flow_summary(speeds: Made | Column, free: Column, shape: Column, critical_density: Column, capacity: Column) -> Column:
    """``total`` and ``most`` of the flows at the speeds of a link."""
    return made(speeds).then(_flows, free, shape, critical_density, capacity, kind="total double, most double").column()


def _hours(step: pa.Array, last_step: pa.Array, counts: np.ndarray) -> np.ndarray:
    h = np.repeat(whole(step) / 60.0, counts)
    full = counts > 0
    h[(np.cumsum(counts) - 1)[full]] = (whole(last_step) / 60.0)[full]
    return h


def _estimated(speeds: pa.Array, step: pa.Array, last_step: pa.Array, free: pa.Array, shape: pa.Array, critical_density: pa.Array, capacity: pa.Array,
               volume: pa.Array) -> pa.Array:
    counts, flat = unlist(speeds)
    hours, volume = _hours(step, last_step, counts), doubles(volume)
    per = lambda x: np.repeat(x, counts)
    raw = flow_curve(doubles(flat), *(per(doubles(s)) for s in (free, shape, critical_density, capacity))) * hours
    raw_total = row_fold(np.add, raw, counts, 0.0)
    flat_out = (raw_total == 0) & (volume > 0)
    with np.errstate(all="ignore"):
        scale = np.where(raw_total > 0, volume / raw_total, 0.0)
        spread = volume / row_fold(np.add, hours, counts, 0.0)
    out = np.where(per(flat_out), per(spread) * hours, raw * per(scale))
    residue = volume - row_fold(np.add, out, counts, 0.0)
    top = np.flatnonzero(out == per(row_fold(np.fmax, out, counts, np.nan)))
    owner = np.repeat(np.arange(len(counts)), counts)[top]
    first = np.ones(len(top), bool)
    first[1:] = owner[1:] != owner[:-1]
    out[top[first]] += residue[owner[first]]
    return structs(estimated=relist(counts, nullable(out)), raw=nullable(raw_total))


def estimated_volumes(speeds, step, last_step, free, shape, critical_density, capacity, volume) -> Column:
    """``estimated``, the volume of every interval scaled to the assigned one, and ``raw``, their sum before.

    A link without any flow spreads its volume by duration; the rounding residue goes to the first of the largest intervals.
    """
    return F.arrow_udf(_estimated, "estimated array<double>, raw double")(speeds, step, last_step, free, shape, critical_density, capacity, volume)


def hour_sums(speeds, estimated, start, step, last_step, begin: int, finish: int) -> Column:
    """One entry per hourly bin a link's timeline touches: volume, travel (minutes over speed), stopped, invalid.

    Bins are 60 minutes from ``begin`` and end at ``finish``; an interval that crosses the edge of a bin is in both, by its overlap.
    """
    def run(speeds: pa.Array, estimated: pa.Array, start: pa.Array, step: pa.Array, last_step: pa.Array) -> pa.Array:
        counts, flat = unlist(speeds)
        v, e = doubles(flat), doubles(unlist(estimated)[1])
        start, step, last_step = whole(start), whole(step), whole(last_step)
        until = start + (counts - 1) * step + last_step
        first = (start - begin) // 60
        bins = np.where(counts > 0, (until - 1 - begin) // 60 - first + 1, 0)
        base = starts_of(bins)
        at = np.repeat(start, counts) + places(counts) * np.repeat(step, counts)
        size = np.repeat(step, counts)
        full = counts > 0
        size[(np.cumsum(counts) - 1)[full]] = last_step[full]
        out = {k: np.zeros(bins.sum()) for k in ("volume", "travel", "stopped", "invalid")}
        own, end = (at - begin) // 60, at + size
        per_row = np.repeat(base - first, counts)
        for ahead in range(int(((end - 1 - begin) // 60 - own).max(initial=0)) + 1):
            low = begin + (own + ahead) * 60
            inside = np.minimum(np.minimum(end, low + 60), finish) - np.maximum(at, low)
            i = np.flatnonzero(inside > 0)
            cell = per_row[i] + own[i] + ahead
            part, speed = inside[i].astype(np.float64), v[i]
            with np.errstate(all="ignore"):
                moving = np.where(speed > 0, part / speed, 0.0)
            for name, weight in (("volume", e[i] * part / size[i]), ("travel", moving), ("stopped", speed == 0), ("invalid", ~(speed >= 0))):
                out[name] += np.bincount(cell, weights=weight, minlength=len(out[name]))
        return relist(bins, structs(volume=nullable(out["volume"]), travel=nullable(out["travel"]), stopped=pa.array(out["stopped"] > 0),
                                    invalid=pa.array(out["invalid"] > 0)))
    return F.arrow_udf(run, "array<struct<volume:double,travel:double,stopped:boolean,invalid:boolean>>")(speeds, estimated, start, step, last_step)


def _above(estimated: pa.Array, step: pa.Array, last_step: pa.Array, bound: pa.Array) -> pa.Array:
    counts, flat = unlist(estimated)
    with np.errstate(all="ignore"):
        over = doubles(flat) / _hours(step, last_step, counts) > np.repeat(doubles(bound), counts)
    return pa.array(row_fold(np.add, over.astype(np.float64), counts, 0.0).astype(np.int32))


def intervals_above(estimated, step, last_step, bound: Column) -> Column:
    """How many intervals have more volume an hour than ``bound``."""
    return F.arrow_udf(_above, "int")(estimated, step, last_step, bound)


# --- profiles -------------------------------------------------------------------------------------

def steps_of(values: np.ndarray, counts: np.ndarray, apart: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(differences of neighbours within a row, how many a row has)."""
    n = np.maximum(counts - apart, 0)
    last = np.ones(len(values), bool)
    last[(np.cumsum(counts) - 1)[counts > 0]] = False
    return (values[1:] - values[:-1])[last[:-1]] if len(values) else values, n


def rounded(values: np.ndarray, decimals: int) -> np.ndarray:
    """Halves away from zero by the decimal text of a number, as Spark rounds; only what lies close to a half is decided by its text."""
    size = np.abs(values) * 10.0**decimals
    with np.errstate(invalid="ignore"):
        out = np.where(size < 2.0**52, np.copysign(np.floor(size + 0.5) / 10.0**decimals, values), values)
        close = np.flatnonzero((np.abs(size - np.floor(size) - 0.5) <= 4 * np.spacing(size)) & (size < 2.0**52))
    last = Decimal(1).scaleb(-decimals)
    out[close] = [float(Decimal(repr(v)).quantize(last, ROUND_HALF_UP)) for v in values[close].tolist()]
    return out


def change_measures(speeds: Column, window: int, decimals: int | None = None) -> Column:
    """Largest step, mean step over a window and acceleration of the profile of a row; NULL where it is too short."""
    def run(lists: pa.Array) -> pa.Array:
        counts, flat = unlist(lists)
        values = doubles(flat)
        if decimals is not None:
            values = rounded(values, decimals)
        d, n = steps_of(values, counts)
        second, n2 = steps_of(d, n)
        a, n3 = np.abs(d), np.maximum(n - (window - 1), 0)
        there = places(n) < np.repeat(n3, n)
        at = np.flatnonzero(there)
        sums = np.zeros(len(at))
        for o in range(window):
            sums = sums + a[at + o]
        most = lambda v, c: nullable(row_fold(np.fmax, v, c, np.nan))
        return structs(max_step=most(a, n), max_rolling=most(sums / window, n3), max_acceleration=most(np.abs(second) / STEP_HOURS**2, n2))
    return F.arrow_udf(run, "max_step double, max_rolling double, max_acceleration double")(speeds)
