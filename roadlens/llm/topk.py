"""Exact top-k inner products over norm-sorted blocks.

Vectors are rotated onto the singular directions of the whole table, so that few leading coordinates hold most of a vector, and sorted
by descending length into blocks.  A block is passed over for a query when its longest vector cannot reach the
query's k-th score (Cauchy-Schwarz); in a block that is read, the inner product of the leading coordinates plus the
product of the residual lengths bounds each score, and only what passes is multiplied out in integers.  Queries and vectors
meet as blocks on a grid (each side is copied to the blocks of the other that it can matter to), not row by row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK, QUERY_BLOCK, STRIP, LEADING = 4096, 1024, 512, 0.8
SLACK = 1e-6  # relative rounding allowance of the bounds; scores themselves are integers


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and `v`, the components as floor(scale * x); vectors null, empty, or holding null or non-finite components are left out."""
    x = F.transform(F.col("embedding"), lambda e: e.cast("double"))
    whole = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    kept = vectors.where(whole & F.col("vec_id").isNotNull())
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale)).cast("array<bigint>").alias("v"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of equal width; vectors of another length take zeros for what they lack."""
    flat, offsets = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    if (offsets == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(offsets), width), dtype=np.int64)
    out[np.arange(width) < offsets[:, None]] = flat
    return out


def rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Singular directions of all vectors, strongest first, and how many hold LEADING of the energy.

    Each task adds up its products to one width x width matrix; the sum of those is decomposed on the driver.
    """
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("v"), width).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    table = vectors.select("v").mapInArrow(products, "i INT, row ARRAY<DOUBLE>")
    cells = table.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    gram = np.zeros((width, width))
    gram[cells.column("i").to_numpy(), cells.column("j").to_numpy()] = cells.column("x").to_numpy()
    energy, directions = np.linalg.eigh((gram + gram.T) / 2)
    energy, directions = np.maximum(energy[::-1], 0), directions[:, ::-1]
    share = np.cumsum(energy) / max(energy.sum(), 1e-300)
    return np.ascontiguousarray(directions), int(np.searchsorted(share, LEADING)) + 1


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    return np.lexsort((ids, -scores))[:k]


class BlockScan:
    """One block of queries against one block of vectors, sorted by descending length."""

    def __init__(self, directions: np.ndarray, leading: int, k: int):
        self.directions, self.leading, self.k = directions, leading, k

    def rotated(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, length of the rest, whole length."""
        r = m.astype(np.float64) @ self.directions
        return r[:, :self.leading], np.sqrt((r[:, self.leading:] ** 2).sum(axis=1)), np.sqrt((r ** 2).sum(axis=1))

    def __call__(self, query_ids, queries, floors, ids, vectors) -> tuple[list[int], list[int], list[int]]:
        """(query_id, vec_id, score) of each query's best k here that reach its floor (a score that is known to be among its k best)."""
        order = np.lexsort((ids, -np.einsum("ij,ij->i", vectors, vectors)))
        ids, vectors = ids[order], vectors[order]
        q_lead, q_rest, q_norm = self.rotated(queries)
        v_lead, v_rest, v_norm = self.rotated(vectors)
        floors = floors.astype(np.float64).copy()
        found_score = [np.empty(0, dtype=np.int64)] * len(query_ids)
        found_id = [np.empty(0, dtype=np.int64)] * len(query_ids)
        for a in range(0, len(ids), STRIP):
            b = min(a + STRIP, len(ids))
            alive = np.flatnonzero(q_norm * v_norm[a] * (1 + SLACK) + SLACK >= floors)
            if not alive.size:
                break  # all that follow are shorter
            bound = q_lead[alive] @ v_lead[a:b].T + q_rest[alive][:, None] * v_rest[a:b]
            allowance = SLACK * (1 + q_norm[alive][:, None] * v_norm[a:b])
            row, column = np.nonzero(bound + allowance >= floors[alive][:, None])
            at, to = alive[row], column + a
            keep = ids[to] != query_ids[at]
            at, to = at[keep], to[keep]
            scores = np.einsum("ij,ij->i", queries[at], vectors[to])
            starts = np.searchsorted(at, np.arange(len(query_ids) + 1))
            for q in np.unique(at).tolist():
                part = slice(starts[q], starts[q + 1])
                s, i = np.concatenate([found_score[q], scores[part]]), np.concatenate([found_id[q], ids[to[part]]])
                top = _best(s, i, self.k)
                found_score[q], found_id[q] = s[top], i[top]
                if len(top) == self.k:
                    floors[q] = max(floors[q], float(s[top[-1]]))
        sizes = [len(x) for x in found_id]
        return np.repeat(query_ids, sizes), np.concatenate(found_id), np.concatenate(found_score)


def _blocks(rows: DataFrame, size: int, count: int, block: str) -> DataFrame:
    """Rows with a block number; longer vectors have lower numbers.

    `rows` is dealt by range of length and each range cut into blocks of at most `size` rows.
    """
    parts = max(1, -(-count // size))
    ranged = rows.repartitionByRange(parts, F.desc("norm2"), F.col("vec_id"))
    numbered = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id() - (F.spark_partition_id().cast("bigint") * F.lit(1 << 33)))
    return checkpoint(numbered.withColumn(block, F.struct(F.col("_part").alias("part"), F.floor(F.col("_place") / size).cast("int").alias("piece"))).drop("_part", "_place"))


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """For every vector that `is_query` holds for, its k highest integer inner products with the others.

    Reads vec_id and embedding (further ones that `is_query` names must be there); one row per query and rank: query_id, rank (from 1), vec_id,
    score.  Fewer than k others give all of them.  Ties go to the smaller vec_id.  Vectors null, empty, or with a null or
    non-finite component take no part, neither do null ids.  Shorter vectors count as padded with zeros.  Rows that repeat a vec_id are
    candidates each, but rows with the query's own id never are; a repeated query id is answered once, by its first vector in order of components.
    An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    every = checkpoint(quantised(vectors, scale).withColumn("norm2", F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x * x)).withColumn("width", F.size("v")))
    sizes = every.agg(F.count(F.lit(1)).alias("n"), F.max("width").alias("width"), F.max("norm2").alias("norm2")).first()
    schema = "query_id BIGINT, vec_id BIGINT, score BIGINT"
    if not sizes["n"]:
        return spark.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score BIGINT")
    width = sizes["width"]
    directions, leading = rotation(every, width)
    scan = BlockScan(directions, leading, k)
    queries = every.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "norm2")).alias("x")).select("vec_id", "x.v", "x.norm2")
    asked = queries.count()
    candidates = _blocks(every.select("vec_id", "v", "norm2"), BLOCK, sizes["n"], "block")
    wanted = _blocks(queries, QUERY_BLOCK, asked, "query_block")
    lengths = candidates.groupBy("block").agg(F.max("norm2").alias("longest"))

    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q, c = (batch.column(n)[row].values for n in ("queries", "members"))
                got = scan(q.field("vec_id").to_numpy(), _matrix(q.field("v"), width), q.field("floor").to_numpy(), c.field("vec_id").to_numpy(), _matrix(c.field("v"), width))
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()) for g in got], ["query_id", "vec_id", "score"])

    packed = checkpoint(candidates.groupBy("block").agg(F.collect_list(F.struct("vec_id", "v")).alias("members")))  # a block has at most BLOCK rows

    def scanned(sought: DataFrame, pairs: DataFrame) -> DataFrame:
        """`sought`: query_block, vec_id, v, floor; `pairs`: query_block, block."""
        groups = sought.groupBy("query_block").agg(F.collect_list(F.struct("vec_id", "v", "floor")).alias("queries"))  # at most QUERY_BLOCK rows
        return pairs.join(groups, "query_block").join(packed, "block").repartition("query_block", "block").select("queries", "members").mapInArrow(against, schema)

    least = F.lit(-float(1 << 62)).cast("bigint")
    opened = wanted.withColumn("floor", least)
    query_blocks = wanted.groupBy("query_block").agg(F.max("norm2").alias("longest_query"))
    first_block = lengths.orderBy(F.desc("longest"), "block").limit(1).select("block")
    # Pass 1: every query against the longest vectors gives it a floor.
    head = checkpoint(scanned(opened, query_blocks.select("query_block").withColumn("one", F.lit(1)).join(F.broadcast(first_block.withColumn("one", F.lit(1))), "one").drop("one")))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    floors = head.withColumn("rank", place).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    sought = checkpoint(wanted.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", least)))
    # Pass 2: the other blocks, where some query of the block can still be reached.
    reach = sought.groupBy("query_block").agg(F.max(F.sqrt("norm2")).alias("longest_query"), F.min(F.when(F.col("norm2") > 0, F.col("floor") / F.sqrt("norm2")).otherwise(F.lit(-float("inf")))).alias("needed"))
    numbered = checkpoint(reach.withColumn("number", F.row_number().over(Window.orderBy("query_block"))))  # a row per QUERY_BLOCK queries
    others = lengths.join(F.broadcast(first_block), "block", "left_anti")
    grid = others.withColumn("number", F.explode(F.sequence(F.lit(1), F.lit(max(1, numbered.count())))))
    pairs = grid.join(numbered, "number").where(F.sqrt("longest") * (1 + SLACK) + SLACK >= F.col("needed")).select("query_block", "block")
    rest = scanned(sought.select("query_block", "vec_id", "v", "floor"), pairs)
    return head.unionByName(rest).withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
