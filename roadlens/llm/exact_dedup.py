"""Exact duplicates by recipes of content-defined chunks.

Every text is cut where a rolling hash of its last 32 bytes has ten zero bits, so equal passages are cut alike wherever
they stand.  A chunk is moved once per task that holds it, not once per document: tasks send each distinct
chunk with its digest, one aggregation proves that a digest stands for a single content, and from
there on a document is the ordered list of its chunk identifiers.  Equal lists are equal texts.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint, free_names, fresh_worker, mix64, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, SHORTEST, LONGEST, MASK = 32, 256, 8192, np.uint64(0x3FF << 40)
DIGEST = 16


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of `data`: content-defined, at least SHORTEST and at most LONGEST bytes (the last may be shorter)."""
    size = len(data)
    if size <= SHORTEST:
        return [size] if size else []
    rolling = mix64(np.arange(1, 257, dtype=np.uint64))[np.frombuffer(data, dtype=np.uint8)]
    step = 1
    while step < WINDOW:  # doubling: afterwards each value is the shifted sum over the last 2 * step bytes
        rolling[step:] = rolling[step:] + (rolling[:-step] << np.uint64(step))
        step *= 2
    ends, start = [], 0
    for place in (np.flatnonzero((rolling & MASK) == 0) + 1).tolist() + [size]:
        while place - start > LONGEST:
            start += LONGEST
            ends.append(start)
        if place == size or place - start >= SHORTEST:
            if place > start:
                ends.append(place)
            start = place
    return ends


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row its recipe; then, as rows without a recipe, the distinct chunks of each slice with an independent check."""
    fresh_worker("exact_dedup")
    for whole in batches:
        for batch in slices(whole, "text"):
            recipes, shas, chunks = [], [], {}
            for text in batch.column("text").to_pylist():
                data = (text or "").encode()
                start, ids = 0, []
                for end in cut_points(data):
                    piece = data[start:end]
                    digest = hashlib.sha256(piece).digest()[:DIGEST]
                    if digest not in chunks:
                        chunks[digest] = hashlib.blake2b(piece, digest_size=16).digest() + len(piece).to_bytes(4, "big")
                    ids.append(digest)
                    start = end
                recipes.append(b"".join(ids))
                shas.append(hashlib.sha256(data).hexdigest())
            n, m = batch.num_rows, len(chunks)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column("row_key"), pa.nulls(m, pa.int64())]),
                pa.concat_arrays([batch.column("doc_id").cast(pa.int64()), pa.nulls(m, pa.int64())]),
                pa.array([*recipes, *[None] * m], pa.binary()),
                pa.array([*shas, *[None] * m], pa.string()),
                pa.array([*[None] * n, *chunks], pa.binary()),
                pa.array([*[None] * n, *chunks.values()], pa.binary()),
            ], ["row_key", "doc_id", "recipe", "text_sha256", "digest", "content_check"])


_SCHEMA = "row_key BIGINT, doc_id BIGINT, recipe BINARY, text_sha256 STRING, digest BINARY, content_check BINARY"


def colliding_chunks(rows: DataFrame) -> DataFrame:
    """Digests that stand for more than one content, told apart by a second hash of another family and the length."""
    seen = rows.where(F.col("digest").isNotNull()).groupBy("digest", "content_check").agg(F.lit(1).alias("one"))
    return seen.groupBy("digest").count().where("count > 1")


def exact_groups(documents: DataFrame) -> DataFrame:
    """Groups of documents whose texts are identical.

    Takes `doc_id` and `text`; other columns are not read.  One row per input row: `doc_id`, `keep_id`
    (largest doc_id of the group), `group_size`, `kept`, `text_sha256`, `n_chunks`.  A null text counts as empty, and all
    empty texts are one group.  A null doc_id is the smallest.  Of rows that tie for the largest doc_id, one is kept.
    An empty table gives an empty result.

    Fails if two chunk contents share an identifier, which is tested over all chunks before texts are compared.
    """
    rows = checkpoint(
        documents.select(F.monotonically_increasing_id().alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_recipes, _SCHEMA)
    )
    if colliding_chunks(rows).limit(1).count():
        raise ValueError("two chunk contents share an identifier; lengthen DIGEST")
    recipes = rows.where(F.col("recipe").isNotNull()).select("row_key", "doc_id", "recipe", "text_sha256")
    # Equal identifier lists; a group of any size is reduced on the map side.  Single documents need no partner.
    groups = recipes.groupBy("recipe").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct(F.col("doc_id").alias("keep_id"), F.col("row_key").alias("keep_key"))).alias("last"),
    ).where("group_size > 1").select(F.col("recipe").alias("group_recipe"), "group_size", "last.keep_id", "last.keep_key")
    met = recipes.join(groups, F.col("recipe") == F.col("group_recipe"), "left")
    return met.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("row_key") == F.col("keep_key"), F.lit(True)).alias("kept"),
        "text_sha256",
        (F.length("recipe") / DIGEST).cast("int").alias("n_chunks"),
    )


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The documents without all but one copy of each text: all columns of the input, the copy with the largest doc_id stays.

    Decided on (doc_id, digest of the text), so rows that share only one of the two are not mixed up; of rows equal in both,
    one stays.
    """
    columns = documents.columns
    sha, kept_id, kept_sha = free_names(documents, "sha", "kept_id", "kept_sha")
    kept = exact_groups(documents.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    keyed = documents.withColumn(sha, F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    met = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    return met.dropDuplicates(["doc_id", sha]).select(*columns)
