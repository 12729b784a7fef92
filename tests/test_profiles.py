"""The vectorised fold against a scalar model, and its invariants."""

import numpy as np
import pytest

from roadlens.functions.timeofday import Period
from roadlens.operators import profile_fold as pf, profiles as pr


def scalar_limiter(targets_by_period, lim):
    """Sample by sample, with the feasibility limit found by bisection instead of a formula."""
    a = lim.acceleration / 144
    changes, out, last = [], [], None

    def interval(history, final_flat):
        prev = history[-1] if history else 0.0
        lo, hi = [-lim.step, prev - a], [lim.step, prev + a]
        if len(history) >= lim.window - 1:
            room = max(0.0, lim.window * lim.rolling - sum(abs(c) for c in history[-(lim.window - 1):]))
            lo.append(-room), hi.append(room)
        if final_flat:
            lo.append(-a), hi.append(a)
        return max(lo), min(hi)

    for p, targets in enumerate(targets_by_period):
        more = p < len(targets_by_period) - 1
        if last is None:
            v = [targets[0]]
        else:
            v = [last]
            changes.append(0.0)
        for i in range(1, len(targets)):
            lo, hi = interval(changes, more and i == len(targets) - 1)
            c = min(hi, max(lo, targets[i] - v[-1]))
            if i < len(targets) - 1:
                ok = lambda x: (lambda q: q[0] <= q[1] + 1e-9)(interval(changes + [x], more and i + 1 == len(targets) - 1))  # noqa: E731,B023
                if not ok(c):
                    good, bad = min(hi, max(lo, 0.0)), c
                    for _ in range(60):
                        mid = (good + bad) / 2
                        good, bad = (mid, bad) if ok(mid) else (good, mid)
                    c = good
            changes.append(c)
            v.append(v[-1] + c)
        last = v[-1]
        out.append(v)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_limiter_equals_scalar_model(seed):
    rng = np.random.default_rng(seed)
    lim = pf.Limits()
    periods = [rng.uniform(5, 75, (6, 30)) if k % 2 else np.repeat(rng.uniform(5, 75, (6, 6)), 6, axis=1) for k in range(3)]
    last, recent, parts = None, [], []
    for i, t in enumerate(periods):
        v, last = pf.limit_changes(t, lim, last, recent, i < 2)
        parts.append(v)
    for row in range(6):
        want = scalar_limiter([t[row] for t in periods], lim)
        for got, expected in zip(parts, want):
            np.testing.assert_allclose(got[row], expected, atol=1e-6)
    whole = np.concatenate(parts, axis=1)
    assert pf.within(whole, lim).all()
    smooth = whole
    for r in (30 if periods[0].shape[1] == 30 else 36, periods[0].shape[1] + periods[1].shape[1]):
        smooth = pf.connect(smooth, r, lim)
        assert pf.within(smooth, lim).all()
        keep = np.ones(whole.shape[1], dtype=bool)
        keep[[r - 1, r]] = False
    rough = lambda v: (np.diff(v, 2, axis=1) ** 2).sum(axis=1)
    assert (rough(smooth) <= rough(whole) + 1e-9).all()


def test_raw_curve_scalar(spark):
    periods = [Period("am", 360, 540)]
    perf = spark.sql("SELECT 'am' AS time_period, 1 AS link_id, 3000D AS volume, 30D AS speed_mph")
    links = spark.sql("SELECT 'am' AS time_period, 1 AS link_id, 1 AS lanes, 1000 AS capacity, 60D AS vdf_free_speed_mph, 1D AS vdf_length_mi, "
                      "2 AS vdf_type, 2 AS qvdf_profile_mode, 7D AS t0_hour, 7.5D AS t2_hour, 8.5D AS t3_hour")
    rows = {r.minute: r.speed_mph for r in pr.raw_profiles(pr.profile_inputs(perf, links, periods, ["link_id"]), ["link_id"]).collect()}
    # doc = 1, cutoff 45, P = 1, vt2 = 45 / 1.28125, left share 1/3, window 7.1667 .. 8.1667
    assert rows[450] == pytest.approx(45 / 1.28125) and rows[360] == pytest.approx(60.0)
    t0, t = 7.5 - 1 / 3, 8.0
    x, f = (t - t0), 1 / 3
    shape = (x / f) ** (4 * f) * ((1 - x) / (1 - f)) ** (4 * (1 - f))
    assert rows[480] == pytest.approx(1 / ((1.28125 / 45 - 1 / 45) * shape + 1 / 45))


def test_end_to_end_runs(spark):
    periods = [Period("am", 360, 540), Period("md", 540, 900), Period("pm", 900, 1140)]
    rows = [(p, k, 1500.0 + 900 * k, 25.0) for k in range(8) for p in ("am", "md", "pm") if not (k == 3 and p == "md")]
    perf = spark.createDataFrame(rows, "time_period STRING, link_id INT, volume DOUBLE, speed_mph DOUBLE")
    hour = {"am": 6.0, "md": 9.0, "pm": 15.0}
    links = spark.createDataFrame(
        [(p, k, 1 + k % 2, 400, 60.0, 1.0, 2, 2 if k != 5 else 0, hour[p] + 0.5, hour[p] + 1.0, hour[p] + 2.0, 20.0 + 5 * k, 55.0 - 4 * k)
         for p, k, _, _ in rows],
        "time_period STRING, link_id INT, lanes INT, capacity INT, vdf_free_speed_mph DOUBLE, vdf_length_mi DOUBLE, vdf_type INT, "
        "qvdf_profile_mode INT, t0_hour DOUBLE, t2_hour DOUBLE, t3_hour DOUBLE, qvdf_start_speed_mph DOUBLE, qvdf_end_speed_mph DOUBLE")
    inputs = pr.profile_inputs(perf, links, periods, ["link_id"])
    arrays = pr.enforced_arrays(inputs, periods, ["link_id"]).cache()
    assert sorted((r.link_id, tuple(r.periods)) for r in arrays.collect() if r.link_id in (3, 4)) == [(3, (0,)), (3, (2,)), (4, (0, 1, 2))]
    assert pr.violations(pr.array_metrics(arrays, ["link_id"])).count() == 0
    long = pr.exploded(arrays, periods, ["link_id"])
    assert long.count() == 8 * 156 - 72
    first = {r.link_id: r.speed_mph for r in long.where("minute = 360").collect()}
    assert all(first[k] == pytest.approx(20.0 + 5 * k) for k in range(8))


def test_links_that_cannot_be_limited_are_rows(spark):
    periods = [Period("am", 360, 540), Period("md", 540, 900)]
    perf = spark.createDataFrame([(p, i, i + 1, 100.0, 40.0) for p in ("am", "md") for i in range(6)], "time_period string, from_node_id bigint, to_node_id bigint, volume double, speed_mph double")
    links = spark.createDataFrame([(p, i, i + 1, 60.0, 1.0, 0.0 if i in (2, 4) and p == "am" else 1.0) for p in ("am", "md") for i in range(6)],
                                  "time_period string, from_node_id bigint, to_node_id bigint, vdf_free_speed_mph double, qvdf_profile_mode double, vdf_length_mi double")
    inputs = pr.profile_inputs(perf, links, periods, ["from_node_id", "to_node_id"])
    keys = ["from_node_id", "to_node_id"]
    outcomes = pr.profile_outcomes(inputs, periods, keys)
    assert {(r.from_node_id, r.reason) for r in pr.profile_failures(outcomes, keys).collect()} == {(2, pf.MISSING), (4, pf.MISSING)}
    good = outcomes.where("reason IS NULL").collect()
    assert sorted(r.from_node_id for r in good) == [0, 1, 3, 5] and all(len(r.speeds) == 108 for r in good)
    with pytest.raises(Exception, match="2 profiles failed.*2->3: profile holds.*4->5"):
        pr.refuse_failures(outcomes, keys)
    pr.refuse_failures(outcomes.where("reason IS NULL"), keys)
    with pytest.raises(Exception, match="(2->3|4->5): profile holds a missing speed"):
        pr.enforced_arrays(inputs, periods, keys).collect()


def test_limiter_names_the_rows_that_are_infeasible():
    reasons = np.full(3, None, dtype=object)
    target = np.tile(np.linspace(40.0, 60.0, 8), (3, 1))
    values, _ = pf.limit_changes(target, pf.Limits(), None, [np.array([0.0, 50.0, 0.0])], False, reasons)
    assert [r is not None for r in reasons] == [False, True, False] and "infeasible at sample 1" in reasons[1]
    alone, _ = pf.limit_changes(target[:1], pf.Limits(), None, [np.zeros(1)], False)
    assert (values[[0, 2]] == alone).all()
    with pytest.raises(ValueError, match="infeasible"):
        pf.limit_changes(target, pf.Limits(), None, [np.array([0.0, 50.0, 0.0])], False)


def test_fold_over_all_links_and_its_gate(spark):
    rows = [(1, [40.0, 48.0, 50.0, 50.0]), (2, [40.0, 41.00000049, 40.0, 40.0]), (3, [30.0, 30.0, 30.0, 39.0]), (4, [40.0, 48.0, 50.0, 50.0])]
    arrays = spark.createDataFrame(rows, "k int, speeds array<double>")
    found = {(r.form, r.measure): r for r in pr.profile_limits(arrays, ["k"], decimals=0).collect()}
    assert len(found) == 6 and (found["exact", "max_step"].largest, found["exact", "max_step"].k, found["exact", "max_step"].beyond) == (9.0, 3, 1)
    assert found["exact", "max_rolling"].largest == pytest.approx(10 / 3) and found["exact", "max_rolling"].k == 1 and found["rounded", "max_step"].profiles == 4
    with pytest.raises(Exception, match="beyond a limit.*max_step"):
        pr.refuse_beyond(pr.profile_limits(arrays, ["k"]))
    close = pr.profile_limits(spark.createDataFrame([(9, [40.49, 48.5, 48.5])], "k int, speeds array<double>"), ["k"], pf.Limits(step=8.02), decimals=0)
    assert {(r.form, round(r.largest, 6), r.beyond) for r in close.where("measure = 'max_step'").collect()} == {("exact", 8.01, 0), ("rounded", 9.0, 1)}
    with pytest.raises(Exception, match="rounded"):
        pr.refuse_beyond(close)


def test_the_gate_computes_the_steps_of_a_profile_once(spark):
    """A filter on the measures must not have the steps computed again for every element of the window."""
    rows = spark.createDataFrame([(1, [50.0, 51.0, 60.0, 61.0]), (2, [50.0, 51.0, 52.0, 53.0])], "k BIGINT, speeds ARRAY<DOUBLE>")
    beyond = pr.violations(pr.array_metrics(rows, ["k"]))
    assert [r.k for r in beyond.collect()] == [1]
    assert "element_at(zip_with" not in beyond._jdf.queryExecution().optimizedPlan().toString()


def test_curve_of_the_fold_equals_the_columns(spark):
    """The fold makes the raw samples itself; windows without width, at the edges, without length or times, and unknown lengths included."""
    from pyspark.sql import functions as F

    periods, keys = [Period("am", 360, 540), Period("md", 540, 900)], ["link_id"]
    perf = spark.sql("SELECT p AS time_period, id AS link_id, CAST(id % 7 * 700 AS DOUBLE) AS volume, 30D AS speed_mph FROM range(240) CROSS JOIN VALUES ('am'), ('md') AS t(p)")
    links = perf.select("time_period", "link_id").selectExpr(
        "*", "1 + link_id % 3 AS lanes", "900 AS capacity", "40D + link_id % 30 AS vdf_free_speed_mph", "CASE link_id % 11 WHEN 3 THEN 0D WHEN 4 THEN 1D ELSE 0.3D END AS vdf_length_mi",
        "2 AS vdf_type", "link_id % 4 - 1 AS qvdf_profile_mode", "CASE link_id % 6 WHEN 1 THEN 0D ELSE 0.4D END AS vdf_cd", "CASE WHEN link_id % 5 > 0 THEN 6D + link_id % 9 END AS t2_hour",
        "5.5D + link_id % 8 AS t0_hour", "7D + link_id % 10 AS t3_hour")
    inputs = pr.profile_inputs(perf, links, periods, keys)
    wanted = {}
    for r in pr.raw_profiles(inputs, keys).where("is_generated").collect():
        wanted.setdefault((r.link_id, r.time_period), {})[r.minute] = np.nan if r.speed_mph is None else r.speed_mph
    rows, packed = 0, pr._packed(inputs, keys)
    assert "raw" not in packed.columns
    for r in packed.collect():
        scal = np.asarray([np.nan if x is None else x for x in r.scal]).reshape(len(r.periods), len(pr.SCALARS))
        for i, values in zip(r.periods, scal):
            p = periods[i]
            minutes = np.arange(p.start, p.end, pr.STEP)
            got = pf.raw_curve(minutes, {s: values[c:c + 1] for c, s in enumerate(pr.SCALARS)})[0]
            want = wanted.get((r.link_id, p.name))
            np.testing.assert_allclose(got, [0.0] * len(minutes) if want is None else [want[m] for m in minutes], rtol=1e-12)
            rows += want is not None
    assert rows == len(wanted) > 100
    broken = {r.reason for r in pr.profile_outcomes(inputs, periods, keys).select(F.col("reason")).collect()}
    assert None in broken


def test_runs_are_cut_into_their_periods(spark):
    """Periods whose length is no multiple of the step, and a run that does not start with the first period."""
    periods = [Period("a", 0, 12), Period("b", 12, 24), Period("c", 24, 30)]
    arrays = spark.sql("SELECT 1 AS link_id, array(0, 1, 2) AS periods, array(1D, 2D, 3D, 4D, 5D, 6D, 7D, 8D) AS speeds UNION ALL SELECT 2, array(1, 2), array(1D, 2D, 3D, 4D, 5D)")
    got = sorted(tuple(r) for r in pr.exploded(arrays, periods, ["link_id"]).collect())
    assert got == sorted([("a", 1, 0, 1.0), ("a", 1, 5, 2.0), ("a", 1, 10, 3.0), ("b", 1, 12, 4.0), ("b", 1, 17, 5.0), ("b", 1, 22, 6.0), ("c", 1, 24, 7.0), ("c", 1, 29, 8.0),
                          ("b", 2, 12, 1.0), ("b", 2, 17, 2.0), ("b", 2, 22, 3.0), ("c", 2, 24, 4.0), ("c", 2, 29, 5.0)])
