"""Distance and overlap of lines against a plain loop, for lines of one and of several segments in one batch."""

import math
import random

from pyspark.sql import functions as F

from roadlens.functions import geometry as geo

KIND = "k INT, a ARRAY<STRUCT<ax: DOUBLE, ay: DOUBLE, bx: DOUBLE, by: DOUBLE>>, b ARRAY<STRUCT<ax: DOUBLE, ay: DOUBLE, bx: DOUBLE, by: DOUBLE>>"


def to_segment(px, py, s):
    ax, ay, bx, by = s
    d2 = (bx - ax)**2 + (by - ay)**2
    t = min(1.0, max(0.0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / d2)) if d2 else 0.0
    return math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))


def points(s, n):
    return [(s[0] + (s[2] - s[0]) * (i + 0.5) / n, s[1] + (s[3] - s[1]) * (i + 0.5) / n) for i in range(n)]


def line(draw, n):
    at, out = (draw.uniform(0, 300), draw.uniform(0, 300)), []
    for _ in range(n):
        to = (at[0] + draw.uniform(-150, 150), at[1] + draw.uniform(-150, 150))
        out.append((*at, *to))
        at = to
    return out


def test_lines_of_any_number_of_segments(spark):
    draw = random.Random(3)
    rows = [(i, line(draw, n), line(draw, m)) for i, (n, m) in enumerate([(1, 1), (1, 4), (3, 1), (2, 3), (5, 5), (1, 1), (4, 2), (1, 7)])]
    rows.append((8, [(0.0, 0.0, 10.0, 10.0)], [(0.0, 10.0, 10.0, 0.0)]))  # crossing
    rows.append((9, [(0.0, 0.0, 100.0, 0.0)], [(0.0, 5.0, 0.0, 5.0)]))  # a segment without length
    frame = spark.createDataFrame(rows, KIND).coalesce(1)
    got = {r.k: r for r in frame.select("k", geo.line_distance(F.col("a"), F.col("b")).alias("d"), geo.overlap_length(F.col("a"), F.col("b"), 40.0).alias("o")).collect()}
    for k, a, b in rows:
        near = min(to_segment(x, y, q) for p in a for x, y in points(p, 2000) for q in b)
        assert abs(got[k].d - near) < 0.2
        covered = sum(math.hypot(p[2] - p[0], p[3] - p[1]) / 2000 * sum(min(to_segment(x, y, q) for q in b) <= 40 for x, y in points(p, 2000)) for p in a)
        assert abs(got[k].o - covered) < 0.5
    assert got[8].d == 0.0 and math.isclose(got[9].o, math.sqrt(40**2 - 5**2))


def test_pieces_of_a_batch_give_the_same(monkeypatch):
    import pyarrow as pa

    from roadlens.functions import segment_pairs as sp

    draw = random.Random(5)
    kind = pa.list_(pa.struct([(n, pa.float64()) for n in ("ax", "ay", "bx", "by")]))
    a, b = (pa.array([[dict(zip(("ax", "ay", "bx", "by"), s)) for s in line(draw, draw.randint(0 if i % 7 else 1, 4))] for i in range(50)], kind) for _ in range(2))
    whole = sp.line_distances(a, b).to_pylist(), sp.overlaps_within(40.0)(a, b).to_pylist()
    monkeypatch.setattr(sp, "AT_ONCE", 5)
    assert whole == (sp.line_distances(a, b).to_pylist(), sp.overlaps_within(40.0)(a, b).to_pylist())


def test_pairs_are_measured_by_the_batch(spark):
    from roadlens.plans import catalog

    for name in ("near_links", "transfer_geometry"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython [line_distances" in plan
