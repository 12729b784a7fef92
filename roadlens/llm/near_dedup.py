"""Near duplicates by ProbMinHash sketches of word shingles, banding, and verification of what meets.

Every shingle of a text is a Poisson process whose rate is its weight.  Its arrivals fall on
random registers; a register keeps the shingle that arrived first.  A shingle is dropped as soon as its next arrival is later than
all registers, so most give one or two arrivals.  Two texts agree in a register with the probability Jaccard similarity.  All weights
are 1, however often a shingle occurs: then this is the set Jaccard similarity, the measure that links are verified by.

Texts with equal shingle sets are one node.  Nodes that agree in a whole band of registers stand in a bucket.  The links of a bucket are
found by comparing one member, its head, with all others, exactly; what is not in one component then goes on in smaller buckets that every
further link must share (see `_apart`), with 1, 4, 16, ... heads at a time.  A bucket of true copies so costs one test per member, and no link within a bucket is lost.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint, free_names, fresh_worker, mix64, parts_for, release
from roadlens.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS, BANDS, ROWS = 5, 20, 4
REGISTERS = BANDS * ROWS
SLICE = 300_000  # words that are sketched at once
SMALL = 16  # members of a bucket that may be compared with each other outright


def word_hashes(text):
    """Hashes of the lower-case words (white-space separated) in order; empty for null and blank texts."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, how often), sorted by document and shingle; a text of fewer than WORDS words is one shingle."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    kinds = np.maximum(sizes - WORDS + 1, (sizes > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(sizes)), kinds)
    first = starts[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(kinds) - kinds, kinds)
    value = np.zeros(len(doc), dtype=np.uint64)
    for i in range(WORDS):
        inside = first + i < ends[doc]
        with np.errstate(over="ignore"):
            value = np.where(inside, mix64(value * np.uint64(3) + words[np.minimum(first + i, max(len(words) - 1, 0))] + np.uint64(i + 1)), value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(fresh)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def sketch(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, documents: int, registers: int = REGISTERS) -> np.ndarray:
    """Registers of all documents: the shingle that arrived first in each (0 for documents without shingles)."""
    first = np.full(documents * registers, np.inf)
    latest = np.full(documents, np.inf)
    arrival, active, turn = np.zeros(len(doc)), np.arange(len(doc)), 0
    events = []
    while active.size:
        turn += 1
        with np.errstate(over="ignore"):
            drawn = mix64(shingle[active] + np.uint64(turn) * np.uint64(0x9E3779B97F4A7C15))
        uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        arrival[active] -= np.log(uniform) / weight[active]
        active = active[arrival[active] < latest[doc[active]]]
        register = mix64(shingle[active] ^ (np.uint64(turn) << np.uint64(40))) % np.uint64(registers)
        slot = doc[active] * registers + register.astype(np.int64)
        earlier = arrival[active] < first[slot]
        slot, who = slot[earlier], active[earlier]
        np.minimum.at(first, slot, arrival[who])
        events.append((slot, arrival[who], shingle[who]))
        latest = first.reshape(documents, registers).max(axis=1)
        active = active[arrival[active] < latest[doc[active]]]
    out = np.zeros(documents * registers, dtype=np.uint64)
    for slot, at, who in events:
        won = first[slot] == at
        out[slot[won]] = who[won]
    return out.reshape(documents, registers)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    offsets = batch.column("words").offsets.to_numpy().astype(np.int64)
    flat = batch.column("words").values.to_numpy().view(np.uint64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
        yield batch.slice(at, end - at), flat[offsets[at]:offsets[end]], np.diff(offsets[at:end + 1])
        at = end


def _set_keys(doc: np.ndarray, shingle: np.ndarray, documents: int) -> tuple[list[bytes], np.ndarray]:
    bounds = np.searchsorted(doc, np.arange(documents + 1))
    data = shingle.astype("<u8").tobytes()
    return [hashlib.blake2b(data[8 * a:8 * b], digest_size=16).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], np.diff(bounds)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fresh_worker("near_dedup")
    for batch in batches:
        for part, words, sizes in _parts(batch):
            doc, shingle, _ = shingles(words, sizes)
            registers = sketch(doc, shingle, np.ones(len(doc)), part.num_rows)
            keys, kinds = _set_keys(doc, shingle, part.num_rows)
            bands = np.zeros((part.num_rows, BANDS), dtype=np.uint64)
            with np.errstate(over="ignore"):
                for i in range(ROWS):
                    bands = mix64(bands * np.uint64(31) + registers[:, i::ROWS])
                bands = mix64(bands + np.arange(BANDS, dtype=np.uint64))
            flat = pa.array(bands.reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * BANDS), flat)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("t"), pa.array(keys, pa.binary()), pa.array(kinds, pa.int32()), lists], ["doc_id", "t", "node", "kinds", "buckets"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fresh_worker("near_dedup")
    for batch in batches:
        for part, words, sizes in _parts(batch):
            doc, shingle, _ = shingles(words, sizes)
            keys, kinds = _set_keys(doc, shingle, part.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kinds)]).astype(np.int32)), pa.array(shingle.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), lists], ["node", "shingles"])


def _prepared(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("t"), word_hashes(text).alias("words"))


def shingle_sets(documents: DataFrame, needed: DataFrame) -> DataFrame:
    """`node`, `shingles` (sorted) of the documents that `needed` names by id and hash of the text (ids may be null or name several texts)."""
    named = needed.select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"))
    keyed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64(F.col("text").cast("string")).alias("_text"))
    picked = keyed.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_t")), "left_semi")
    return _prepared(picked.select("doc_id", "text")).mapInArrow(_sets, "node BINARY, shingles ARRAY<BIGINT>").dropDuplicates(["node"])


def compared(pairs: DataFrame, sets: DataFrame, *more) -> DataFrame:
    """The pairs (node, head) with `common`, the number of shingles they share.

    The head's set comes first and the node's last, so a head of very many pairs is spread out again.
    """
    heads = sets.select(F.col("node").alias("head"), F.col("shingles").alias("of_head"))
    both = pairs.select("node", "head").join(heads, "head").join(sets, "node")
    return both.select("node", "head", F.size(F.array_intersect("shingles", "of_head")).alias("common"), *more)


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("bucket")
    return rows.join(mixed, "bucket")


_ROW = ("bucket", "node", "kinds", "met", "component")


def _apart(left: DataFrame, sets: DataFrame, parts: int, wide: int) -> DataFrame:
    """Smaller buckets that every link must share which the heads have not shown; `left` are the buckets' members without their heads O.

    Buckets of up to SMALL members stay as they are.  For larger ones: a link of x and y needs 9 |x & y| >= 4 (|x| + |y|), and y has at
    least max(smallest member, 0.8 |x|) shingles, so x and y share at least t = 4/9 (|x| + that) - |x & O| shingles outside O.  Where t <= 0 for
    both, such members stay together.  Else they share one of the |outside| - t + 1 rarest shingles that each has outside O, rarity
    being the same order for all members of O's buckets: these shingles are the new buckets.  What only one member has gives no bucket,
    and edits mostly are such, so members that are merely edited from one text are not compared pair by pair.
    """
    sizes = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    left = checkpoint(left.join(sizes, "bucket").coalesce(parts))
    small, large = left.where(F.col("members") <= SMALL).select(*_ROW), left.where(F.col("members") > SMALL)
    tested = checkpoint(compared(large.select("node", "head").distinct(), sets, F.array_except("shingles", "of_head").alias("outside")).coalesce(wide))
    partner = F.greatest(F.col("least_kinds").cast("double"), 0.8 * F.col("kinds"))
    met = large.join(tested.select("node", "head", "common"), ["node", "head"]).withColumn("t", F.ceil((4 * (F.col("kinds") + partner) - 9 * F.col("common")) / 9 - 1e-9).cast("int"))
    # Members linked to O are in one component: the others are the better heads from here on.
    met = met.withColumn("met", F.when(9 * F.col("common") >= 4 * (F.col("kinds") + F.col("head_kinds")), F.abs("met")).otherwise(F.col("met")))
    together = met.where("t <= 0").select(*_ROW)
    own = met.groupBy("node", "head").agg(F.min("t").alias("t"), F.min("kinds").alias("kinds"), F.min("met").alias("met"), F.min("component").alias("component"))
    own = checkpoint(own.join(tested.select("node", "head", "outside"), ["node", "head"]).where(F.size("outside") >= F.col("t"))
                     .withColumn("n", F.size("outside")).withColumn("pair", F.monotonically_increasing_id()).withColumn("o", F.xxhash64("head")).coalesce(wide))
    spread = own.select("pair", "o", F.explode("outside").alias("shingle"))  # three numbers a row: this is the widest step
    shared = spread.groupBy("o", "shingle").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    mine = Window.partitionBy("pair")
    placed = spread.join(shared, ["o", "shingle"]).withColumn("place", F.row_number().over(mine.orderBy("held", "shingle"))).withColumn("mine", F.count(F.lit(1)).over(mine))
    named = placed.join(own.drop("outside", "o"), "pair")
    rare = named.where(F.col("place") - F.col("mine") <= 1 - F.greatest(F.col("t"), F.lit(1)))
    apart = rare.withColumn("bucket", F.xxhash64("head", "shingle")).select(*_ROW)
    return checkpoint(_mixed(small.unionByName(together).unionByName(apart)).coalesce(wide))


def near_groups(documents: DataFrame) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of at least 0.8 over five-word shingles.

    Reads doc_id and text; other columns are not read.  One row per input row: doc_id, class_id (least doc_id of the class), copy_id (least doc_id with the same
    shingles), class_size, kept (true for one row of each class).  A class holds all that is connected by links.  Texts of one to
    four words have themselves as their only shingle; null, empty and blank texts are one class.  Null ids are larger than any; a class of null
    ids only has a null class_id.  Of rows that tie for the least doc_id one is kept; an id that names texts of two classes names both classes if it is the least in both.  An empty table gives an empty result.
    """
    rows = checkpoint(_prepared(documents).mapInArrow(_sketches, "doc_id BIGINT, t BIGINT, node BINARY, kinds INT, buckets ARRAY<BIGINT>").withColumn("row_key", F.monotonically_increasing_id()))
    many = rows.count()
    parts, wide = parts_for(BANDS * many), parts_for(many, 5_000)  # of rows of buckets, and of rows that hold shingles
    rows = rows.coalesce(parts_for(many, 20_000))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t"))
    nodes = rows.groupBy("node").agg(first.alias("copy"), F.first("kinds").alias("kinds"), F.min("buckets").alias("buckets"))
    nodes = checkpoint(nodes.select("node", F.col("copy.doc_id").alias("copy_id"), F.col("copy.t").alias("t"), "kinds", "buckets").coalesce(parts))
    spread = nodes.where("kinds > 0").select("node", "kinds", F.explode("buckets").alias("bucket"))
    full = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = checkpoint(spread.join(full, "bucket").coalesce(parts))
    # Who meets most others comes first: the text that a family of copies was made from is near all of them, a copy is not.
    order = met.groupBy("node").agg((-F.sum("n")).alias("met"))
    open_ = checkpoint(met.drop("n").join(order, "node").withColumn("component", F.col("node")).select(*_ROW).coalesce(parts))
    del spread, full, met, order
    release(documents.sparkSession)
    needed = nodes.join(open_.select("node").distinct(), "node", "left_semi").select(F.col("copy_id").alias("doc_id"), "t")
    could = 5 * F.least("kinds", "head_kinds") >= 4 * F.greatest("kinds", "head_kinds")
    links, leaders = None, 0
    while not open_.isEmpty():
        if links is None:  # one head for each bucket of a band, compared with all its members
            sets = checkpoint(shingle_sets(documents, needed).coalesce(wide))
            release(documents.sparkSession)
            first = F.min(F.struct("met", F.col("node").alias("head"), F.col("kinds").alias("head_kinds"))).alias("first")
            heads = checkpoint(open_.groupBy("bucket").agg(first, F.min("kinds").alias("least_kinds")).select("bucket", "first.head", "first.head_kinds", "least_kinds").coalesce(parts))
            pairs = open_.select("bucket", "node", "kinds").join(heads, "bucket").where((F.col("node") != F.col("head")) & could)
        else:  # 1, 4, 16, ... heads, compared with what could be linked to them and is not yet in their component
            heads = open_.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("met", "node"))).where(F.col("place") <= leaders)
            heads = checkpoint(heads.select("bucket", *[F.col(c).alias(f"head_{c}") for c in ("node", "kinds", "met", "component")]).withColumnRenamed("head_node", "head").coalesce(parts))
            pairs = open_.join(heads, "bucket").where((F.col("component") != F.col("head_component")) & could)
        pairs = checkpoint(pairs.select("node", "head", "kinds", "head_kinds").distinct().coalesce(parts))
        tested = compared(pairs, sets).join(pairs, ["node", "head"]).coalesce(wide)
        found = tested.where(9 * F.col("common") >= 4 * (F.col("kinds") + F.col("head_kinds"))).select(F.col("node").alias("u"), F.col("head").alias("v"))
        links = checkpoint(found if links is None else links.unionByName(found))
        grouped = checkpoint(components(links).coalesce(parts))
        if not leaders:
            left = open_.join(heads, "bucket").where("node <> head")
        else:
            last = heads.groupBy("bucket").agg(F.max(F.struct("head_met", "head")).alias("last"))
            left = open_.join(last, "bucket").where(F.struct("met", "node") > F.col("last")).drop("last")
        left = left.drop("component").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
        left = checkpoint(_mixed(left).coalesce(parts))
        open_ = left if leaders else _apart(left, sets, parts, wide)
        leaders = max(1, 4 * leaders)
        del left, heads, pairs, tested, found
        release(documents.sparkSession)
    if links is None:
        placed = nodes.select("node", "copy_id", F.col("node").alias("component"))
    else:
        placed = nodes.select("node", "copy_id").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = checkpoint(placed.coalesce(parts))
    classes = rows.select("node", "doc_id", "row_key").join(placed, "node")
    sizes = classes.groupBy("component").agg(F.count(F.lit(1)).alias("class_size"), F.min("doc_id").alias("class_id"))
    firsts = classes.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first")).select("component", F.col("first.row_key").alias("first_key"))
    met = classes.join(checkpoint(sizes.join(firsts, "component").coalesce(parts)), "component")
    return met.select("doc_id", "class_id", "copy_id", "class_size", (F.col("row_key") == F.col("first_key")).alias("kept"))


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """All columns of the documents that are kept, one of each class; expects ids that name one text each (rows that share an id and a
    class share its fate, and the first of them stays)."""
    (kept_id,) = free_names(documents, "kept_id")
    kept = near_groups(documents).where("kept").select(F.col("doc_id").alias(kept_id)).distinct()
    return documents.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)), "left_semi")
