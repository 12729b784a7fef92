"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken `target / source size` times on average, at most MOST_COPIES times.  The whole part is
taken outright; the fractions are rounded by pivotal steps: two documents meet, expected words move at random
from one to the other until one of them is certain (0 or 1), and the other goes on with what is left.  Large documents
meet first, so the last open ones, the only ones that miss the target, are small.  A leaf of the reduction leaves at most one open document;
the open ones of FAN_IN leaves meet in the next level, until a source has one, which is drawn.  All draws are hashes
of the document's key, so a rerun gives the same mix whatever the partitions are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint, free_names, mix64

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WEIGHTS = (5, 2, 1)
SHARE, MOST_COPIES = 1.5, 2.0
LEAF_ROWS, FAN_IN = 4096, 64
EXACT = 1e-9


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """`rank` from 0 by code point, null last, without bringing all sources into one task: rows are dealt by range,
    ranked within their partition and moved on by the counts of the partitions before."""
    flagged = sources.withColumn("_null", F.col("source").isNull())
    ranged = checkpoint(flagged.repartitionByRange(F.col("_null"), F.col("source")).withColumn("_part", F.spark_partition_id()))
    counts = sorted((r["_part"], r["n"]) for r in ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())  # one row per partition
    before, total = [], 0
    for part, n in counts:
        before += [F.lit(part), F.lit(total)]
        total += n
    local = F.row_number().over(Window.partitionBy("_part").orderBy("_null", "source")) - 1
    if not before:
        return ranged.select("source", "source_size", F.lit(0).alias("rank"))
    return ranged.withColumn("rank", local + F.create_map(*before)[F.col("_part")]).drop("_part", "_null")


def source_targets(sources: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """`target` words per source (`source`, `source_size`): shares by weight, stopped at `most` times the source's size, the excess reshared.

    Each round is one aggregate over the sources; only its three sums come to the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    frame = checkpoint(ranked_sources(sources).withColumn("weight", weight))
    sizes = frame.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    wanted, level, last = share * float(sizes), 0.0, -1
    full = F.lit(False)
    while True:
        row = frame.agg(F.sum(F.when(full, most * F.col("source_size")).otherwise(0.0)).alias("held"),
                        F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("open"), F.sum(full.cast("int")).alias("n")).first()
        if row["n"] is None or row["n"] == last or not row["open"]:
            break
        last, level = row["n"], (wanted - row["held"]) / row["open"]
        full = F.col("weight") * level > most * F.col("source_size")
    capped = F.least(F.col("weight") * level, most * F.col("source_size"))
    return frame.select("source", "source_size", capped.alias("target"))


def _uniform(key: np.ndarray, salt: int) -> np.ndarray:
    return (mix64(key.astype(np.uint64) + np.uint64(salt)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _meet(q: float, q_size: int, p: float, p_size: int, draw: float) -> tuple[float, float]:
    """A pivotal step: words of expected mass move one way or the other until a document is certain.

    The expected words of the two stay as they were, and each keeps its own expectation over the draw.
    """
    up, down = min((1 - q) * q_size, p * p_size), min(q * q_size, (1 - p) * p_size)
    moved = up if draw * (up + down) < down else -down
    after = q + moved / q_size, p - moved / p_size
    return tuple(float(round(x)) if min(x, 1 - x) <= EXACT else x for x in after)


def _pivotal(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """Runs of equal (group_key, leaf) in order.  The open document of a run is held back and put before the next
    batch, so a run may span batches; a run that ends leaves it with `part` still between 0 and 1."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        group, leaf = batch.column("group_key").to_pylist(), batch.column("leaf").to_pylist()
        parts = batch.column("part").to_numpy(zero_copy_only=False).copy()
        size = batch.column("size").to_pylist()
        draws = _uniform(batch.column("draw").to_numpy(zero_copy_only=False), 2 * level + 1)
        mark, at = None, None
        for i in range(batch.num_rows):
            if mark is None or (group[i], leaf[i]) != mark:
                mark, at = (group[i], leaf[i]), None
            if min(parts[i], 1 - parts[i]) <= EXACT:
                parts[i] = round(parts[i])
            elif not size[i]:  # has no words to move
                parts[i] = float(draws[i] < parts[i])
            elif at is None:
                at = i
            else:
                parts[at], parts[i] = _meet(parts[at], size[at], parts[i], size[i], (draws[at] + draws[i]) % 1.0)
                at = i if 0 < parts[i] < 1 else at if 0 < parts[at] < 1 else None
        place = batch.schema.get_field_index("part")
        batch = batch.set_column(place, batch.schema.field("part"), pa.array(parts, pa.float64()))
        held = None if at is None else batch.slice(at, 1)
        yield batch if at is None else batch.filter(pa.array(np.arange(batch.num_rows) != at))
    if held is not None:
        yield held


def pivotal_round(units: DataFrame) -> DataFrame:
    """Round `part` (0 to 1) of every row to 0 or 1; the sum of `part * size` over a `group_key` changes by less than one row's size.

    `units` has at least group_key, leaf (0 up to the group's leaves), size, draw (bigint, the row's fixed random number) and part.
    """
    schema = units.schema
    names, done, level, levels = units.columns, [], 0, units
    while True:
        dealt = levels.repartition(F.col("group_key"), F.col("leaf")).sortWithinPartitions("group_key", "leaf", F.desc("size"), "draw")
        rounded = checkpoint(dealt.mapInArrow(lambda b, level=level: _pivotal(b, level), schema))
        still = (F.col("part") > 0) & (F.col("part") < 1)
        done.append(rounded.where(~still))
        most = rounded.where(still).agg(F.max("leaf").alias("leaf"), F.count(F.lit(1)).alias("n")).first()
        if not most["n"]:
            break
        if not most["leaf"]:  # one open document per group: drawn
            last = F.pmod(F.xxhash64(F.lit(level), "draw"), F.lit(1 << 30)) / float(1 << 30)
            done.append(rounded.where(still).withColumn("part", (last < F.col("part")).cast("double")).select(*names))
            break
        levels = rounded.where(still).withColumn("leaf", F.floor(F.col("leaf") / FAN_IN).cast("int")).select(*names)
        level += 1
    out = done[0]
    for frame in done[1:]:
        out = out.unionByName(frame)
    return out


def mix(documents: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """How often each document enters a mix in which sources weigh `weights` by rank.

    Takes doc_id, text, source; other columns are not read.  One row per input row: doc_id, text_key, source, size (words), source_size,
    target (the source's words), copies (0 to `most`), taken (copies * size).  Null texts have size 0; texts of size 0 get
    copies like any other but take nothing.  The null source is a source, ranked last.  Rows equal in id, source and text are one unit that
    is rounded as a whole, so each of them gets the same copies.  An empty table gives an empty result.
    Reruns agree: every draw is a hash of (doc_id, text).
    """
    rows = documents.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
                            F.xxhash64("text").alias("text_key"))
    units = checkpoint(rows.groupBy("doc_id", "source", "size", "text_key").agg(F.count(F.lit(1)).alias("held")))
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("held")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = source_targets(sums.select("source", "source_size"), share, most, weights)
    # Sources are few next to documents, but their number has no bound: no broadcast hint, Spark decides by size.
    goals = sums.select(F.col("source").alias("s"), "n").join(targets, F.col("s").eqNullSafe(F.col("source"))).select("s", "n", "source_size", "target")
    draw = F.xxhash64(F.lit(7), "doc_id", "text_key")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    met = (
        units.join(goals, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .withColumn("draw", draw).withColumn("rate", rate)
        .withColumn("whole", F.least(F.floor("rate"), F.lit(int(most)))).withColumn("part", F.col("rate") - F.col("whole"))
        .withColumn("leaf", F.pmod(F.xxhash64("draw"), F.greatest(F.ceil(F.col("n") / LEAF_ROWS), F.lit(1))).cast("int"))
        .withColumn("group_key", F.col("source"))
        .select("group_key", "leaf", "size", "draw", "part", "doc_id", "source", "text_key", "held", "source_size", "target", "whole")
    )
    rounded = pivotal_round(met)
    copies = (F.col("whole") + F.col("part")).cast("bigint")
    return rounded.select("doc_id", "text_key", "source", "size", "source_size", "target", copies.alias("copies"),
                          (copies * F.col("size")).alias("taken"), "held")


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """One row per document again: units that hold several equal rows are spread out."""
    return mixed.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("held")))).drop("_i", "held")


def take_mix(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of the input."""
    columns = documents.columns
    i, s, k, key, copies, copy = free_names(documents, "id_taken", "source_taken", "key_taken", "key", "copies", "copy")
    taken = mix(documents, **options).where("copies > 0").select(F.col("doc_id").alias(i), F.col("source").alias(s), F.col("text_key").alias(k), F.col("copies").alias(copies))
    keyed = documents.withColumn(key, F.xxhash64("text"))
    met = keyed.join(taken, F.col("doc_id").eqNullSafe(F.col(i)) & F.col("source").eqNullSafe(F.col(s)) & (F.col(key) == F.col(k)))
    return met.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))).select(*columns)
