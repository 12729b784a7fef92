"""The sequential part of profile smoothing, vectorised over the links of one Arrow batch.

Each sample depends on the changes applied before it and each period starts from the speed the
previous one ended with, so this step is a fold over time.  It is written over whole columns of
links (rows x samples): the Python loop runs over samples only, Spark spreads the links.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP_HOURS = 1.0 / 12.0
EPS = 1e-9
INFEASIBLE = 1e-8  # not above the tolerance of the gate
# Bisection rounds and tolerances of the boundary connector.
ROUNDS = 42
NO_REVERSAL = 1e-10
TANGENT_RADIUS = 3.0


@dataclass(frozen=True)
class Limits:
    """Largest step, mean step over a window, and acceleration (mph, mph, mph per hour squared)."""

    step: float = 8.0
    rolling: float = 4.0
    window: int = 3
    acceleration: float = 576.0

    @property
    def change_of_step(self) -> float:
        return self.acceleration * STEP_HOURS**2

    @property
    def budget(self) -> float:
        return self.window * self.rolling


def smoothstep(x: np.ndarray) -> np.ndarray:
    x = np.clip(x, 0.0, 1.0)
    return x * x * (3.0 - 2.0 * x)


def raw_curve(minutes, scal):
    """The generated curve of every row and minute; NaN where it has no speed, 0 in rows without a generated curve.

    A missing or undefined share counts as 1, as greatest and least of a column do.
    """
    unit = lambda v: np.fmax(0.0, np.fmin(1.0, v))
    out = np.zeros((len(scal["generated"]), len(minutes)))
    made = np.flatnonzero(scal["generated"] > 0)
    t0, t3, t2, f, miles, wt2, rtt, free, boundary, start, end = (
        scal[k][made][:, None] for k in ("t0", "t3", "t2", "peak", "miles", "wt2", "rtt", "free", "boundary", "from", "to"))
    t = (minutes / 60.0)[None, :]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        ramp = lambda p: p * p * (3 - 2 * p)
        before = ramp(unit((t - start) / np.maximum(0.001, t0 - start)))
        after = ramp(unit((t - t3) / np.maximum(0.001, end - t3)))
        speeds = np.where((t < t0) | np.isnan(t0), free + before * (boundary - free), boundary + after * (free - boundary))
        # The window: only its own samples are computed.
        rows, spots = np.nonzero((t >= t0) & (t <= t3))
        t0, t3, t2, f, miles, wt2, rtt = (x[rows, 0] for x in (t0, t3, t2, f, miles, wt2, rtt))
        t = t[0, spots]
        wide = t3 - t0
        x = np.where(wide == 0, 1.0, unit((t - t0) / wide))
        inner = np.where(f <= 1e-9, (1 - x)**4.0, np.where(f >= 1 - 1e-9, x**4.0, (x / f)**(4 * f) * ((1 - x) / (1 - f))**(4 * (1 - f))))
        shape = unit(np.where(wide <= 1e-9, np.where(np.abs(t - t2) <= 1e-9, 1.0, 0.0), inner))
        time = wt2 * shape + rtt
        speeds[rows, spots] = np.where(time == 0, np.nan, miles / time)
    out[made] = speeds
    return out


def hermite(t, left, right, left_change, right_change):
    """Cubic with end values and end changes over the whole span."""
    t2, t3 = t * t, t * t * t
    return (2 * t3 - 3 * t2 + 1) * left + (t3 - 2 * t2 + t) * left_change \
        + (3 * t2 - 2 * t3) * right + (t3 - t2) * right_change


def fit_anchor(v, raw, minutes, anchor, scal, at_end: bool):
    """Bend profiles to an end speed.  The end side is the mirrored start side."""
    rows = ~np.isnan(anchor)
    if not rows.any():
        return v
    vt2, vb, t2, seen = scal["vt2"], scal["boundary"], scal["t2"], scal["observed"] > 0
    hours = minutes / 60.0
    pivot = np.clip(t2, hours[0], hours[-1])
    inside = hours[None, :] >= pivot[:, None] if at_end else hours[None, :] <= pivot[:, None]
    reach = (hours[-1] - pivot) if at_end else (pivot - hours[0])
    at_pivot = minutes[None, :] <= pivot[:, None] * 60.0 + EPS
    if at_end:
        v, raw, inside, at_pivot = (m[:, ::-1] for m in (v, raw, inside, at_pivot))
    v = v.copy()
    n, s = v.shape
    index = np.arange(s)
    a = anchor[:, None]
    weight = smoothstep(index[None, :] * STEP_HOURS / np.maximum(1e-9, reach)[:, None])
    high = vt2 + np.maximum(2.0, 0.10 * np.maximum(0.0, vb - vt2))
    low_case = seen & (anchor < vb) & (anchor <= high)
    curve_case = seen & (anchor < vb) & (anchor > high)

    away = np.zeros_like(v)
    away[:, :-1] = (v[:, 1:] - v[:, :-1]) / STEP_HOURS
    if at_end:
        towards = np.zeros_like(v)
        towards[:, 1:] = (v[:, 1:] - v[:, :-1]) / STEP_HOURS
        slope = np.where(at_pivot, towards, away)
    else:
        slope = away
    span = np.maximum(index, 1) * STEP_HOURS
    secant = (v - a) / span[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        usable = inside & (index >= 1)[None, :] & (v < a) & (slope <= 0.0) & (slope / secant <= TANGENT_RADIUS)
    joined = curve_case & usable.any(axis=1)
    j = np.where(joined, usable.argmax(axis=1), 1)
    pick = np.arange(n)
    vj, sj = v[pick, j], slope[pick, j]
    bend = hermite(index[None, :] / j[:, None], a, vj[:, None], 0.0, (sj * j * STEP_HOURS)[:, None])
    bend = np.clip(bend, np.minimum(anchor, vj)[:, None], np.maximum(anchor, vj)[:, None])

    blend = (1.0 - weight) * a + weight * raw
    sink = (1.0 - weight) * a + weight * vt2[:, None]
    out = np.where((rows & low_case)[:, None] & inside, sink, v)
    out = np.where((rows & joined)[:, None] & (index[None, :] <= j[:, None]), bend, out)
    out = np.where((rows & ~low_case & ~joined)[:, None] & inside, blend, out)
    out[:, 0] = np.where(rows, anchor, out[:, 0])
    return out[:, ::-1] if at_end else out


def target_curve(raw, minutes, scal, carried):
    """Raw curve with fitted ends; without a generated curve a smoothstep between the ends."""
    start = scal["start"] if carried is None else carried
    end = scal["end"]
    made = scal["generated"] > 0
    base = np.where(made[:, None], raw, 0.0)
    fitted = fit_anchor(base, base, minutes, start, scal, at_end=False)
    fitted = fit_anchor(fitted, base, minutes, end, scal, at_end=True)
    first = np.where(np.isnan(start), scal["assigned"], start)
    last = np.where(np.isnan(end), scal["assigned"], end)
    w = smoothstep((minutes - minutes[0]) / max(1.0, float(minutes[-1] - minutes[0])))[None, :]
    plain = (1.0 - w) * first[:, None] + w * last[:, None]
    return np.where(made[:, None], fitted, plain)


MISSING = "profile holds a missing speed"


def _note(reasons, rows, text: str) -> None:
    """Keeps the first reason of every row; without a place to keep it, the batch fails."""
    if not rows.any():
        return
    if reasons is None:
        raise ValueError(text)
    fresh = np.flatnonzero(rows)
    for i in fresh[[reasons[k] is None for k in fresh]]:
        reasons[i] = text


def limit_changes(target, limits: Limits, last, recent: list, more_follows: bool, reasons=None):
    """Project every change on the limits and on what keeps the next sample feasible.

    A row that cannot be limited gets its reason in ``reasons`` (an object array); its speeds mean nothing then.

    The next sample is feasible while the chosen change stays within ``reach``: acceleration from
    it must be able to come back into the step limit and the remaining window budget.
    """
    a, budget, k = limits.change_of_step, limits.budget, limits.window
    n, s = target.shape
    out = np.empty_like(target)
    out[:, 0] = target[:, 0] if last is None else last
    if last is not None:
        recent.append(np.zeros(n))
    for i in range(1, s):
        previous = recent[-1] if recent else np.zeros(n)
        room = np.full(n, limits.step)
        if len(recent) >= k - 1:
            used = sum((np.abs(c) for c in recent[len(recent) - (k - 1):]), np.zeros(n))
            room = np.minimum(room, np.maximum(0.0, budget - used))
        if more_follows and i == s - 1:
            room = np.minimum(room, a)
        low, high = np.maximum(-room, previous - a), np.minimum(room, previous + a)
        _note(reasons, low > high + INFEASIBLE, f"rate limits are infeasible at sample {i}")
        middle = (low + high) / 2.0
        crossed = low > high
        low, high = np.where(crossed, middle, low), np.where(crossed, middle, high)
        change = np.minimum(high, np.maximum(low, target[:, i] - out[:, i - 1]))
        if i < s - 1:
            reach = np.full(n, limits.step + a)
            if len(recent) + 1 >= k - 1:
                if k == 1:
                    reach = np.minimum(reach, a + budget)
                else:
                    kept = recent[len(recent) - (k - 2):] if k > 2 else []
                    spare = budget - sum((np.abs(c) for c in kept), np.zeros(n))
                    reach = np.minimum(reach, np.where(spare >= a, (a + spare) / 2.0, a))
            if more_follows and i + 1 == s - 1:
                reach = np.minimum(reach, 2.0 * a)
            nearest = np.minimum(high, np.maximum(low, 0.0))
            _note(reasons, np.abs(nearest) > reach + INFEASIBLE, f"rate limits cannot keep sample {i + 1} feasible")
            change = np.clip(change, -reach, reach)
        recent.append(change)
        del recent[:max(0, len(recent) - max(1, k - 1))]
        out[:, i] = out[:, i - 1] + change
    return out, out[:, -1]


def within(values, limits: Limits):
    """Rows whose profile keeps all limits."""
    d = np.diff(values, axis=1)
    ok = (np.abs(d) <= limits.step + 1e-9).all(axis=1)
    if d.shape[1] > 1:
        ok &= (np.abs(np.diff(d, axis=1)) / STEP_HOURS**2 <= limits.acceleration + 1e-7).all(axis=1)
    if d.shape[1] >= limits.window:
        sums = np.cumsum(np.abs(d), axis=1)
        sums[:, limits.window:] = sums[:, limits.window:] - sums[:, :-limits.window].copy()
        ok &= (sums[:, limits.window - 1:] / limits.window <= limits.rolling + 1e-9).all(axis=1)
    return ok


def connect(values, r: int, limits: Limits):
    """Rewrite the two samples around a period change (r - 1 and r) by the smoothest feasible blend
    of the limited profile with a monotone cubic between the shoulders r - 2 and r + 1."""
    n, total = values.shape
    if r - 3 < 0 or r + 2 >= total:
        return values
    left, right = values[:, r - 2], values[:, r + 1]
    secant = (right - left) / 3.0
    flat = np.abs(secant) <= 1e-12
    safe = np.where(flat, 1.0, secant)
    tl = np.where((left - values[:, r - 3]) * secant <= 0, 0.0, left - values[:, r - 3])
    tr = np.where((values[:, r + 2] - right) * secant <= 0, 0.0, values[:, r + 2] - right)
    size = np.hypot(tl / safe, tr / safe)
    shrink = np.where(flat, 0.0, np.where(size > TANGENT_RADIUS, TANGENT_RADIUS / np.maximum(size, 1e-300), 1.0))
    tl, tr = tl * shrink, tr * shrink
    smooth = np.stack([hermite(t, left, right, 3 * tl, 3 * tr) for t in (1 / 3, 2 / 3)], axis=1)
    old = values[:, r - 1:r + 1]
    lo_i, hi_i = max(0, r - 2 - limits.window), min(total, r + 2 + limits.window)

    def trial(f):
        return old + f[:, None] * (smooth - old)

    def feasible(f):
        context = values[:, lo_i:hi_i].copy()
        context[:, r - 1 - lo_i:r + 1 - lo_i] = trial(f)
        return within(context, limits)

    # Fractions without reversal: every change keeps the sign of the whole connector.
    whole = right - left
    sign = np.sign(whole)
    d_old = np.diff(np.column_stack([left, old, right]), axis=1) * sign[:, None]
    d_new = np.diff(np.column_stack([left, smooth, right]), axis=1) * sign[:, None]
    slope, base = d_new - d_old, d_old + NO_REVERSAL
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = -base / slope
    steep = np.abs(slope) > 1e-15
    lower = np.maximum(0.0, np.where(steep & (slope > 0), cross, 0.0).max(axis=1))
    upper = np.minimum(1.0, np.where(steep & (slope < 0), cross, 1.0).min(axis=1))
    possible = ~((~steep & (base < 0)).any(axis=1)) & (lower <= upper + 1e-12)
    still = np.abs(whole) <= NO_REVERSAL
    lower, upper = np.where(still, 0.0, lower), np.where(still, 0.0, upper)
    possible |= still

    full = feasible(np.ones(n))
    good, bad = np.zeros(n), np.ones(n)
    for _ in range(ROUNDS):
        if full.all():
            break
        mid = (good + bad) / 2
        ok = feasible(mid)
        good, bad = np.where(ok, mid, good), np.where(ok, bad, mid)
    upper = np.minimum(upper, np.where(full, 1.0, good))
    possible &= lower <= upper + 1e-12

    around = values[:, r - 3:r + 3]
    fitted = around.copy()
    fitted[:, 2:4] = smooth
    c_old, c_new = np.diff(around, 2, axis=1), np.diff(fitted, 2, axis=1)
    way = c_new - c_old
    norm = (way * way).sum(axis=1)
    best = np.where(norm <= 1e-24, 1.0, -(c_old * way).sum(axis=1) / np.maximum(norm, 1e-300))
    best = np.minimum(upper, np.maximum(lower, best))

    chosen, rough = np.full(n, -1.0), np.full(n, np.inf)
    for f in (lower, upper, best):
        t = trial(f)
        d = np.diff(np.column_stack([left, t, right]), axis=1)
        straight = np.where(whole[:, None] > NO_REVERSAL, d >= -NO_REVERSAL,
                            np.where(whole[:, None] < -NO_REVERSAL, d <= NO_REVERSAL, np.abs(d) <= NO_REVERSAL)).all(axis=1)
        ok = possible & straight & feasible(f)
        context = around.copy()
        context[:, 2:4] = t
        roughness = (np.diff(context, 2, axis=1) ** 2).sum(axis=1)
        with np.errstate(invalid="ignore"):
            better = ok & ((roughness < rough - 1e-12) | ((np.abs(roughness - rough) <= 1e-12) & (f > chosen)))
        chosen, rough = np.where(better, f, chosen), np.where(better, roughness, rough)
    result = values.copy()
    accepted = chosen >= 0
    result[:, r - 1:r + 1] = np.where(accepted[:, None], trial(np.maximum(chosen, 0.0)), old)
    return result


def enforce(raw_by_period, minutes_by_period, scal_by_period, limits: Limits, smooth_boundaries: bool = True, reasons=None):
    """Enforced speeds of adjacent periods (same periods for all rows), side by side.

    With ``reasons`` (an object array, one entry a row) rows that fail are named there and do no harm to the others.
    """
    last, recent, parts = None, [], []
    count = len(raw_by_period)
    for i, (raw, minutes, scal) in enumerate(zip(raw_by_period, minutes_by_period, scal_by_period)):
        target = target_curve(raw, minutes, scal, last)
        speeds, last = limit_changes(target, limits, last, recent, i < count - 1, reasons)
        parts.append(speeds)
    values = np.concatenate(parts, axis=1)
    if smooth_boundaries:
        at = 0
        for i in range(1, count):
            at += parts[i - 1].shape[1]
            joined = minutes_by_period[i][0] - minutes_by_period[i - 1][-1] == 5
            if joined and parts[i - 1].shape[1] >= 2 and parts[i].shape[1] >= 2:
                values = connect(values, at, limits)
    _note(reasons, ~np.isfinite(values).all(axis=1), MISSING)
    return values
