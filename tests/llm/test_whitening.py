"""Whitening against NumPy on small tables, and the exact parts against exact arithmetic."""

import math
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from roadlens.llm import spectrum, whitening
from roadlens.llm.queries import QUERIES

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, component STRING, N STRING"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "c", "n") for i, v in zip(ids, vectors)], SCHEMA).repartition(3)


def expected(vectors, count=4):
    """{row: (deviation, |whitened| of each component)}, explained, by double precision over exact sums."""
    rows = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in enumerate(vectors) if v and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted({tuple(x) for x in rows.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], dtype=float) / n
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    order = [i for i in np.argsort(-values) if values[i] > 1e-9 * values.max()][:count]
    scaled = vectors_[:, order] / np.sqrt(values[order])
    out = {i: (sum((n * c - s) ** 2 for c, s in zip(x, sums)), np.abs((np.array([n * c - s for c, s in zip(x, sums)], dtype=float) / n) @ scaled)) for i, x in rows.items()}
    return n, out, values[order] / values.sum()


def compare(got, vectors, tolerance=1e-9):
    n, want, explained = expected(vectors)
    rows = {(r.vec_id, r.component): r for r in got.collect()}
    assert set(rows) == {(i, k + 1) for i in want for k in range(len(explained))}
    for (i, k), r in rows.items():
        assert r.n == n and r.deviation == (want[i][0] if want[i][0] < 2 ** 63 else None) and abs(abs(r.whitened) - want[i][1][k - 1]) < tolerance
        assert abs(r.explained - explained[k - 1]) < 1e-9 and r.identity_error < 1e-9


def test_against_numpy_with_rows_left_out(spark):
    rng = np.random.default_rng(4)
    base = (rng.normal(size=(60, 7)) * [5, 3, 2, 1, 0.5, 0.2, 0.1]).round(3).tolist()
    vectors = base + base[:20] + base[:1] * 50 + [None, [], [1.0, None, *[0.0] * 5], [math.nan] * 7, [math.inf, *[0.0] * 6]]
    compare(whitening.embedding_whitening(frame(spark, vectors)), vectors)


def test_values_far_beyond_small_integers(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(np.float32(c)) for c in row] for row in rng.normal(size=(40, 3)) * [3e7, 1e6, 2e5] + 4e7]
    compare(whitening.embedding_whitening(frame(spark, vectors)), vectors, 1e-6)


def test_extreme_entries_do_not_crash(spark):
    rows = whitening.embedding_whitening(frame(spark, [[3e38, 0.0], [-3e38, 1.0], [0.5, 2.0]])).collect()
    assert {r.vec_id for r in rows} == {0, 1, 2} and all(math.isfinite(r.whitened) for r in rows)
    assert any(r.deviation is None for r in rows)


def test_few_directions_and_nothing(spark):
    line = [[float(i), 2.0 * i, 0.0] for i in range(5)]
    compare(whitening.embedding_whitening(frame(spark, line)), line)
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 4, [None, []]):
        empty = whitening.embedding_whitening(frame(spark, vectors))
        assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    with pytest.raises(Exception, match="differ in length"):
        whitening.embedding_whitening(frame(spark, [[1.0, 2.0], [1.0]]))


def test_null_and_repeated_ids(spark):
    vectors = [[0.0, 1.0], [2.0, 0.0], [2.0, 0.0], [1.0, 5.0]]
    rows = whitening.embedding_whitening(frame(spark, vectors, [None, 7, 7, 8])).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == [(0, 1), (0, 2), (7, 1), (7, 1), (7, 2), (7, 2), (8, 1), (8, 2)] and rows[0].n == 3


def test_equal_eigenvalues_are_one_null_space(spark):
    vectors = [[7.0 * (i == j) for j in range(6)] for i in range(6)] + [[0.0] * 6]
    rows = whitening.embedding_whitening(frame(spark, vectors)).collect()
    assert len(rows) == 28 and rows[0].identity_error < 1e-12
    again = whitening.embedding_whitening(frame(spark, vectors).repartition(7)).collect()
    assert sorted((r.vec_id, r.component, r.whitened) for r in rows) == sorted((r.vec_id, r.component, r.whitened) for r in again)


def determinant(m):
    m, out = [[Fraction(x) for x in row] for row in m], Fraction(1)
    for k in range(len(m)):
        at = next((i for i in range(k, len(m)) if m[i][k]), None)
        if at is None:
            return 0
        if at != k:
            m[k], m[at], out = m[at], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [x - f * y for x, y in zip(m[i], m[k])]
    return out


@pytest.mark.parametrize("d, rank", [(1, 1), (2, 1), (5, 5), (6, 3), (7, 7)])
def test_polynomial_is_the_exact_determinant(d, rank):
    rng = np.random.default_rng(d)
    x = rng.integers(-10 ** 6, 10 ** 6, (rank, d)).astype(object)
    m = x.T.dot(x).tolist()
    trace = sum(m[i][i] for i in range(d))
    primes = spectrum.primes_for(spectrum.coefficient_bound(trace, d))
    poly = spectrum.combined({p: spectrum.polynomial_mod(np.array([[v % p for v in row] for row in m], dtype=np.int64), p) for p in primes})
    for at in (0, 1, -3, 10 ** 7):
        assert spectrum.value_at(poly, at) == determinant([[at * (i == j) - m[i][j] for j in range(d)] for i in range(d)])
    assert poly[:d - rank] == [0] * (d - rank) and poly[d - rank] != 0


def test_roots_are_counted_and_narrowed():
    roots = [10 ** 12, 10 ** 12, 10 ** 12 + 1, 5, 3, 3, 0]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    assert spectrum.shifted(poly, 2)[0] == spectrum.value_at(poly, 2)
    assert [spectrum.roots_above(poly, c) for c in (0, 3, 4, 5, 10 ** 12, 10 ** 13)] == [6, 4, 4, 3, 1, 0]
    found = [(Fraction(a + 1, 1 << s), m) for a, s, m in spectrum.largest_roots(poly, 6)]
    assert [m for _, m in found] == [1, 2, 1, 2]
    assert all(abs(f - r) <= Fraction(r, 1 << 300) for (f, _), r in zip(found, [10 ** 12 + 1, 10 ** 12, 5, 3]))


def test_close_eigenvalues_have_exact_vectors():
    m = [[10 ** 18, 1, 0], [1, 10 ** 18, 0], [0, 0, 10 ** 18 - 10]]  # 10^18 + 1, - 1, - 10: no double tells them apart
    found = spectrum.leading_components(m, 3, lambda ps: {p: spectrum.polynomial_mod(np.array([[v % p for v in row] for row in m], dtype=np.int64), p) for p in ps})
    half = Decimal(2).sqrt() / 2
    for (value, vector), (want, v) in zip(found, [(10 ** 18 + 1, (half, half, 0)), (10 ** 18 - 1, (half, -half, 0)), (10 ** 18 - 10, (0, 0, 1))]):
        assert abs(value - want) < Decimal("1e-20") and all(abs(abs(a) - abs(b)) < Decimal("1e-20") for a, b in zip(vector, v))


def test_primes_and_limbs():
    assert [n for n in range(60) if spectrum.is_prime(n)] == [n for n in range(2, 60) if all(n % k for k in range(2, n))]
    x = np.array([[2 ** 62, -2 ** 63, 3], [-1, 5, 2 ** 40]], dtype=np.int64)
    o = x.astype(object)
    assert (whitening.exact_products(x) == o.T.dot(o)).all()
    assert whitening.whole_numbers(np.array([-1e300, 1e300, -0.001, 0.999])).tolist() == [-2 ** 63, 2 ** 63 - 1, -1, 255]


def test_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    compare(QUERIES["op11_whitening"](spark, sf), [list(r.embedding) for r in rows])
