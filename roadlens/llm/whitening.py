"""Whitening of embeddings on the leading principal components, from exact integer scatter.

Vectors become whole numbers, each distinct one counts once.  Their scatter is summed without rounding (products of 20-bit limbs are exact in
floating point, tasks emit 32-bit limbs, Spark adds those), its characteristic polynomial is found modulo one prime a task, and
`spectrum` turns it into components.  The driver sees the scatter, the residues and the components: sizes of the dimension alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint
from roadlens.llm.spectrum import DECIMALS, leading_components, polynomial_mod

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID, COMPONENTS = 256, 4
ROWS, LIMB = 4096, 20  # rows of one product, bits of a factor: 2^12 * 2^40 stays below 2^53
_LONG = 1 << 63


@dataclass(frozen=True)
class Whitening:
    """A fit as plain values: n vectors, their sums, eigenvalues of the covariance and what x - mean is multiplied by."""

    n: int
    sums: list[int]
    values: list[float]
    explained: list[float]
    vectors: list[list[float]]
    scaled: list[list[float]]  # vectors over the square root of their eigenvalue


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and the vector as doubles, of the rows that take part: not null, not empty, no null or non-finite entry."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)


def whole_numbers(c: np.ndarray) -> np.ndarray:
    """floor(256 c) as 64-bit integers; what is larger stays at the largest of them."""
    x = np.floor(c * GRID)
    out = np.clip(x, -float(_LONG), float(_LONG - 1024)).astype(np.int64)
    out[x >= float(_LONG)] = _LONG - 1
    return out


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of rows, matrix of their whole numbers) of all rows of one length, at most ROWS at once."""
    column = batch.column("embedding")
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        for part in np.split(rows, range(ROWS, len(rows), ROWS)):
            yield part, whole_numbers(flat[offsets[part][:, None] + np.arange(size)])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector in the narrowest whole numbers that hold it, the width in front: equal vectors have equal bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        out = []
        for _, x in _blocks(batch):
            widths = np.select([((x >= -(1 << b)) & (x < 1 << b)).all(axis=1) for b in (7, 15, 31)], [1, 2, 4], 8)
            for width in np.unique(widths).tolist():
                out.extend(bytes([width]) + row.tobytes() for row in x[widths == width].astype(f"<i{width}"))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["x"])


def _unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    groups: dict[tuple[int, int], list[bytes]] = {}
    for row in batch.column("x").to_pylist():
        groups.setdefault((row[0], len(row)), []).append(row)
    for (width, length), rows in groups.items():
        for a in range(0, len(rows), ROWS):
            part = rows[a:a + ROWS]
            raw = np.frombuffer(b"".join(part), dtype=np.uint8).reshape(len(part), length)[:, 1:]
            yield np.ascontiguousarray(raw).view(f"<i{width}").astype(np.int64)


def distinct_vectors(embeddings: DataFrame) -> DataFrame:
    """The fit list, packed; repeated vectors meet on the map side first."""
    return usable(embeddings).select("embedding").mapInArrow(_packed, "x BINARY").distinct()


def exact_products(x: np.ndarray) -> np.ndarray:
    """x^T x of up to ROWS rows, exact, as Python integers."""
    limbs, rest = [], x
    while True:
        if (rest >= -(1 << LIMB)).all() and (rest < 1 << LIMB).all():
            limbs.append(rest.astype(np.float64))
            break
        limbs.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
        rest = rest >> LIMB
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << (LIMB * (i + j)))
    return total


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task: (dimension, cell, limb, value), cells being the upper triangle of the scatter of (1, x)."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for x in _unpacked(batch):
            one = np.concatenate([np.ones((len(x), 1), dtype=np.int64), x], axis=1)
            d = x.shape[1]
            sums[d] = sums.get(d, 0) + exact_products(one)
    for d, total in sums.items():
        cells, limbs, values = [], [], []
        for cell, value in enumerate(total[np.triu_indices(d + 1)].tolist()):
            limb = 0
            while not -(1 << 31) <= value < 1 << 31:
                cells.append(cell), limbs.append(limb), values.append(value & 0xFFFFFFFF)
                value, limb = value >> 32, limb + 1
            cells.append(cell), limbs.append(limb), values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array([d] * len(cells), pa.int32()), pa.array(cells, pa.int32()), pa.array(limbs, pa.int32()), pa.array(values, pa.int64())],
                                         ["d", "cell", "limb", "value"])


def scatter(vectors: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and sums of products of the fit list; fails if vectors differ in length."""
    parts = checkpoint(vectors.mapInArrow(_moments, "d INT, cell INT, limb INT, value BIGINT").groupBy("d", "cell", "limb").agg(F.sum("value").alias("value")))
    lengths = [r.d for r in parts.select("d").distinct().limit(2).collect()]
    if not lengths:
        return 0, [], []
    if len(lengths) > 1:
        raise ValueError("embeddings differ in length")
    d = lengths[0]
    cells = [0] * ((d + 1) * (d + 2) // 2)
    for row in parts.collect():  # a few numbers for each pair of dimensions
        cells[row.cell] += row.value << (32 * row.limb)
    full = np.zeros((d + 1, d + 1), dtype=object)
    full[np.triu_indices(d + 1)] = cells
    full = np.where(np.tri(d + 1, k=-1, dtype=bool), full.T, full)
    return int(full[0, 0]), full[0, 1:].tolist(), full[1:, 1:].tolist()


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of the fit list (packed distinct vectors); None if there are none of positive variance."""
    spark = vectors.sparkSession
    n, sums, products = scatter(vectors)
    d = len(sums)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]  # n^2 times the covariance
    shared = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        for batch in batches:
            for p in batch.column("p").to_pylist():
                found = polynomial_mod(np.array([[x % p for x in row] for row in rows], dtype=np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([found], pa.list_(pa.int64()))], ["p", "coefficients"])

    def residues(primes: list[int]) -> dict[int, list[int]]:
        tasks = min(len(primes), 2 * spark.sparkContext.defaultParallelism)
        listed = spark.createDataFrame(spark.sparkContext.parallelize([(p,) for p in primes], tasks), "p BIGINT")
        return {r.p: r.coefficients for r in listed.mapInArrow(solve, "p BIGINT, coefficients ARRAY<BIGINT>").collect()}

    found = leading_components(matrix, components, residues) if n > 1 else []
    if not found:
        return None
    with localcontext() as context:
        context.prec = DECIMALS
        trace, squared = sum(matrix[i][i] for i in range(d)), Decimal(n * n)
        return Whitening(
            n, sums, [float(root / squared) for root, _ in found], [float(root / trace) for root, _ in found],
            [[float(c) for c in v] for _, v in found], [[float(c / (root / squared).sqrt()) for c in v] for root, v in found])


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - sums, exact: 64-bit integers where they fit, else Python integers."""
    largest = max(int(np.abs(x.astype(np.float64)).max(initial=0)), 1)
    if n * largest + max(map(abs, sums)) < 1 << 61:
        return n * x - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _whitened(y: np.ndarray, n: int, scaled: np.ndarray) -> np.ndarray:
    mean_free = y.astype(np.float64) / n
    return np.stack([(mean_free * column).sum(axis=1) for column in scaled.T], axis=1)  # a row's sum does not depend on its neighbours


def whiten(embeddings: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the array `whitened` (one number a component) of every row that takes part."""
    shared = embeddings.sparkSession.sparkContext.broadcast((model.n, model.sums, model.scaled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, scaled = shared.value
        scaled = np.array(scaled).T
        for batch in batches:
            if not batch.num_rows:
                continue
            for rows, x in _blocks(batch):
                if x.shape[1] != len(sums):
                    raise ValueError("a vector differs in length from the fit")
                y = _centred(x, n, sums)
                if y.dtype != object and float(np.abs(y).max(initial=0)) ** 2 * len(sums) < 1 << 62:
                    deviation = (y * y).sum(axis=1).tolist()
                else:
                    deviation = [t if t < _LONG else None for t in (y.astype(object) ** 2).sum(axis=1).tolist()]
                w = _whitened(y, n, scaled)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(deviation, pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    return usable(embeddings).mapInArrow(run, "vec_id BIGINT, deviation BIGINT, whitened ARRAY<DOUBLE>")


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity; means are taken off before products."""
    shared = vectors.sparkSession.sparkContext.broadcast((model.n, model.sums, model.scaled))
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, scaled = shared.value
        scaled = np.array(scaled).T
        for batch in batches:
            for x in _unpacked(batch):
                w = _whitened(_centred(x, n, sums), n, scaled)
                yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in range(w.shape[1])], [f"w{i}" for i in range(w.shape[1])])

    rows = vectors.mapInArrow(run, ", ".join(f"w{i} DOUBLE" for i in range(k)))
    means = rows.agg(*[F.avg(f"w{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*[F.avg((F.col(f"w{i}") - means[i]) * (F.col(f"w{j}") - means[j])) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


_RESULT = "vec_id BIGINT, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"


def embedding_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Coordinates of every vector on the leading principal components, scaled to unit variance over the distinct vectors.

    Reads vec_id and embedding; other columns are not read.  Rows whose vector is null, empty or holds a null or non-finite entry are left
    out.  Entries count as x = floor(256 * entry), as 64-bit integers (larger ones are cut to the largest).  One row for each other row and component:
    vec_id, component (from 1, by falling eigenvalue), n (distinct vectors), deviation (sum of (n x - sums)^2, exact; null if it is no 64-bit number),
    whitened, explained, identity_error.  Repeated rows and repeated or null ids keep all their rows; ties between equal eigenvalues are
    resolved the same way in every run, and a vector's largest entry is positive.  Directions without variance are no
    components: an empty table, a single distinct vector or fewer varying directions give fewer components or no row.  Vectors of
    different lengths fail with a message.
    """
    vectors = checkpoint(distinct_vectors(embeddings))
    model = fit(vectors, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], _RESULT)
    error = identity_error(vectors, model)
    shares = F.array(*[F.lit(e) for e in model.explained])
    rows = whiten(embeddings, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))
