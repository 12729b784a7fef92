"""Alignment of two tokenizers on the same texts by merge-path partitioning.

Both tokenizers cut the same bytes, so merging the ends of their tokens shows which tokens overlap: every end is one link of the two tokens
that cover the byte before it, and an end of both closes a group.  A binary search on a diagonal of the merge finds where both lists
stand after so many steps, so texts of any length fall into pieces of equal work that know nothing of each other.  A
piece holds its own tokens and one of each side beyond; groups cut by a piece's edge are stitched together from what the pieces leave open.

Pieces travel in blocks.  A block counts its pairs of ids first, the corpus-wide counts are an aggregate of those, and only the counts
of the pairs that a block holds go back to it: no count table is broadcast, and a pair costs one row for a block, however often it occurs.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import uuid
from collections import namedtuple
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.bpe import PATTERN, byte_letters
from roadlens.llm.common import fresh_worker, shared_folder, slices, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEPS, BLOCK = 1 << 16, 1 << 19  # merge steps of a piece and of a block
AT_ONCE = 100_000  # letters of the texts whose ids are Python lists at a time (one text at least)
MARK = "▁"  # how pieces write a space

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_BLOCKS = ("block BIGINT, doc ARRAY<BIGINT>, doc_id ARRAY<BIGINT>, piece ARRAY<INT>, na ARRAY<INT>, nb ARRAY<INT>, lead ARRAY<INT>,"
           " next_a ARRAY<INT>, next_b ARRAY<INT>, single ARRAY<BOOLEAN>, a BINARY, b BINARY")
_PARTS = ("doc BIGINT, doc_id BIGINT, piece INT, " + ", ".join(f"{c} BIGINT" for c in COUNTS) + ", groups STRING, open STRUCT<cut: BOOLEAN, head_a: STRING, head_b: STRING, body: STRING, tail_a: STRING, tail_b: STRING>")


# --- encoding -----------------------------------------------------------------------------------------------------------------

def load_pair(a_path: str, b_path: str) -> tuple[str, bytes]:
    """Both vocabulary files; read on the driver."""
    with open(a_path, encoding="utf-8") as f:
        a = f.read()
    with open(b_path, "rb") as f:
        b = f.read()
    return a, b


class Encoders:
    """Both tokenizers of a worker and the bytes of all their tokens."""

    def __init__(self, a: str, b: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece

        spec, letters = json.loads(a), byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        added = {x["id"]: x["content"].encode() for x in spec["added_tokens"]}
        self.a_bytes = [b""] * (1 + max(*added, *vocab.values()))
        for text, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in text)
        ranks = {self.a_bytes[i]: i for i in vocab.values()}
        for i, text in added.items():
            self.a_bytes[i] = text
        piece = self.b.id_to_piece
        self.b_bytes = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace(MARK, " ").encode() for i in range(len(self.b))]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        # A byte-level BPE whose ids rise with the merges is the same as ranks of tokens, which a faster library reads.
        pre, merged = spec["pre_tokenizer"] or {}, [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        plain = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.fast, self.text = None, a
        if plain and all(x < y for x, y in zip(merged, merged[1:])) and len(ranks) == len(merged) + 256 and all(bytes([i]) in ranks for i in range(256)):
            import tiktoken

            self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def slow(self):
        """A by its own library; made where it is used, as it holds the vocabulary once more."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.text)
        made.encode_special_tokens = True
        made.no_truncation(), made.no_padding()
        return made

    def in_a(self, texts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return list(map(self.fast.encode_ordinary, texts))
        return [e.ids for e in self.slow.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids (int32) of space+text in A and of text in B; both empty where the tokens do not give back these bytes."""
        out, at = [], 0
        while at < len(texts):
            end, letters = at + 1, len(texts[at])
            while end < len(texts) and letters + len(texts[end]) <= AT_ONCE:
                letters += len(texts[end])
                end += 1
            some, at = texts[at:end], end
            for text, x, y in zip(some, self.in_a([" " + t for t in some]), self.b.encode(some, num_threads=1)):
                raw = (" " + text).encode()
                same = text and b"".join(map(self.a_bytes.__getitem__, x)) == raw == b"".join(map(self.b_bytes.__getitem__, y))
                out.append((np.array(x, dtype="<i4").tobytes(), np.array(y, dtype="<i4").tobytes()) if same else (b"", b""))
        return out


# --- merge path ------------------------------------------------------------------------------------------------------------

def merge_path(a_ends: np.ndarray, b_ends: np.ndarray, a_from: np.ndarray, b_from: np.ndarray, na: np.ndarray, nb: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of each list are merged after `diagonal` steps (A first where ends are equal), one binary search a row, all rows at once.

    Row r merges a_ends[a_from:a_from + na] and b_ends[b_from:b_from + nb].  An end of both lists is never parted: B's joins A's.
    """
    low, high = np.maximum(0, diagonal - nb), np.minimum(diagonal, na)
    while True:
        open_ = np.flatnonzero(low < high)
        if not open_.size:
            break
        middle = (low[open_] + high[open_]) // 2
        more = a_ends[a_from[open_] + middle] <= b_ends[b_from[open_] + diagonal[open_] - 1 - middle]
        low[open_[more]] = middle[more] + 1
        high[open_[~more]] = middle[~more]
    i, j = low, diagonal - low
    tied = (i > 0) & (j < nb)
    tied[tied] = a_ends[a_from[tied] + i[tied] - 1] == b_ends[b_from[tied] + j[tied]]
    return i, j + tied


def cut_pieces(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, steps: int) -> dict[str, np.ndarray]:
    """Pieces of at most `steps` (and one) merge steps of the documents whose ids stand one after the other in a and b."""
    a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])  # documents have equal bytes in both lists, so their ends agree
    a_from, b_from = np.cumsum(na) - na, np.cumsum(nb) - nb
    inner = np.maximum(0, -(-(na + nb) // steps) - 1)  # diagonals inside a document
    who = np.repeat(np.arange(len(na)), inner)
    place = np.arange(len(who)) - np.repeat(np.cumsum(inner) - inner, inner) + 1
    i, j = merge_path(a_ends, b_ends, a_from[who], b_from[who], na[who], nb[who], place * steps)
    inside = i < na[who]
    who, i, j = who[inside], i[inside], j[inside]
    doc = np.concatenate([np.arange(len(na)), who])
    i0, j0 = np.concatenate([a_from, a_from[who] + i]), np.concatenate([b_from, b_from[who] + j])
    order = np.lexsort((i0 + j0, doc))
    doc, i0, j0 = doc[order], i0[order], j0[order]
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, dtype=bool)
    i1, j1 = np.append(i0[1:], len(a)), np.append(j0[1:], len(b))
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, dtype=np.int64)

    def start(ids, ends, sizes, i):  # of the tokens at i; beyond the last: 0
        inside = i < len(ids)
        out = np.zeros(len(i), dtype=np.int64)
        out[inside] = ends[i[inside]] - sizes[ids[i[inside]]]
        return out

    def beyond(ids, i):
        out, inside = np.full(len(i), -1, dtype=np.int64), ~last & (i < len(ids))
        out[inside] = ids[i[inside]]
        return out
    lead = np.where(np.isin(np.arange(len(doc)), first), 0, start(a, a_ends, a_sizes, i0) - start(b, b_ends, b_sizes, j0))
    return {"doc": doc, "piece": np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc)))), "na": i1 - i0, "nb": j1 - j0, "lead": lead,
            "next_a": beyond(a, i1), "next_b": beyond(b, j1), "single": last & np.isin(np.arange(len(doc)), first)}


Sizes = namedtuple("Sizes", "a_sizes b_sizes")  # bytes of every token: all that the merges need of the tokenizers


class Merged:
    """The overlaps of all pieces of a block: links (by their end), groups, and which piece each belongs to."""

    def __init__(self, a, b, na, nb, lead, next_a, next_b, a_sizes, b_sizes):
        self.a, self.b, count = a, b, len(na)
        of_a, of_b = np.repeat(np.arange(count), na), np.repeat(np.arange(count), nb)

        def local(sizes, n):
            ends = np.append(0, np.cumsum(sizes))
            bounds = np.append(0, np.cumsum(n))
            return ends[1:] - np.repeat(ends[bounds[:-1]], n), ends[bounds[1:]] - ends[bounds[:-1]]
        a_end, a_total = local(a_sizes[a], na)
        b_end, b_total = local(b_sizes[b], nb)
        b_end = b_end - lead[of_b]
        span = np.maximum(np.maximum(a_total, b_total - lead), 0) + 1
        # Pieces lie one after the other on one axis; each ends with the tokens beyond it, at an end later than all of its own.
        self.base = np.cumsum(span + 1) - span - 1
        self.edge = self.base + span
        self.a_ends, self.b_ends = a_end + self.base[of_a], b_end + self.base[of_b]
        at = np.minimum(np.searchsorted(self.a_ends, self.b_ends), max(len(a) - 1, 0))
        both = self.a_ends[at] == self.b_ends if len(a) else np.zeros(len(b), dtype=bool)
        self.cuts = self.b_ends[both]
        ends = np.sort(np.concatenate([self.a_ends, self.b_ends[~both]]), kind="stable")

        def with_edge(ids, of, beyond):
            out = np.empty(len(ids) + count, dtype=np.int64)
            out[np.arange(len(ids)) + of] = ids
            out[np.cumsum(np.bincount(of, minlength=count)) + np.arange(count)] = beyond
            return out
        self.of_a, self.of_b = of_a, of_b
        a_all = with_edge(self.a_ends, of_a, self.edge)
        b_all = with_edge(self.b_ends, of_b, self.edge)
        self.link_a = with_edge(a, of_a, next_a)[np.searchsorted(a_all, ends)]
        self.link_b = with_edge(b, of_b, next_b)[np.searchsorted(b_all, ends)]
        self.links_from = np.searchsorted(ends, np.append(self.base, self.edge[-1:] + 1), side="right")
        self.cuts_from = np.searchsorted(self.cuts, np.append(self.base, self.edge[-1:] + 1), side="right")

    @property
    def pairs(self) -> np.ndarray:
        return (self.link_a << 32) | self.link_b

    def written(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, their bounds by token in writing order, bounds of the groups, group of each A token, of each B token).

        `ids` are the decimal forms followed by comma, bar and semicolon.  A piece's open end is a group of its own, closed by its edge.
        """
        closing = np.sort(np.concatenate([self.cuts, self.edge]), kind="stable")
        in_a, in_b = np.searchsorted(closing, self.a_ends), np.searchsorted(closing, self.b_ends)
        a_until, b_until = np.searchsorted(self.a_ends, closing, side="right"), np.searchsorted(self.b_ends, closing, side="right")
        place_a = np.arange(len(self.a)) + np.append(0, b_until)[in_a]
        place_b = np.arange(len(self.b)) + a_until[in_b]
        comma, bar, semicolon = ids
        text = np.empty(len(self.a) + len(self.b), dtype=comma.dtype)
        ends_a, ends_b = np.append(in_a[1:] != in_a[:-1], True)[:len(in_a)], np.append(in_b[1:] != in_b[:-1], True)[:len(in_b)]
        text[place_a] = np.where(ends_a, bar[self.a], comma[self.a])
        text[place_b] = np.where(ends_b, semicolon[self.b], comma[self.b])
        letters = text.view(np.uint8).reshape(len(text), comma.dtype.itemsize)
        filled = letters != 0
        return letters[filled], np.append(0, np.cumsum(filled.sum(axis=1))), np.append(0, a_until + b_until), in_a, in_b


def decimal_forms(size: int) -> list[np.ndarray]:
    return [np.array([f"{i}{mark}" for i in range(size)], dtype="S") for mark in ",|;"]


# --- Spark -----------------------------------------------------------------------------------------------------------------------

def token_blocks(documents: DataFrame, a_path: str, b_path: str, steps: int = STEPS, block: int = BLOCK) -> tuple[DataFrame, object, str]:
    """Blocks of pieces of all documents, the broadcast sizes of all tokens (bounded by the tokenizers' files), and the shared folder the blocks are in."""
    spark = documents.sparkSession
    pair = load_pair(a_path, b_path)
    own = Encoders(*pair)
    shared, sizes = spark.sparkContext.broadcast(pair), spark.sparkContext.broadcast((own.a_sizes, own.b_sizes))
    del own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("alignment", every_task=True)
        encoders = worker_cache(f"pair_{hash(shared.value)}", lambda: Encoders(*shared.value))
        place = TaskContext.get().partitionId()
        docs, blocks = place << 33, place << 33
        for whole in batches:
            for batch in slices(whole, "text", 3_000_000):
                coded = encoders([t or "" for t in batch.column("text").to_pylist()])
                na, nb = (np.array([len(x[k]) // 4 for x in coded], dtype=np.int64) for k in (0, 1))
                a, b = (np.frombuffer(b"".join([x[k] for x in coded]), dtype="<i4") for k in (0, 1))
                del coded
                p = cut_pieces(a, b, na, nb, encoders.a_sizes, encoders.b_sizes, steps)
                work = np.cumsum(p["na"] + p["nb"])
                edges = np.flatnonzero(np.append(True, (work[1:] - 1) // block != (work[:-1] - 1) // block)) if len(work) else []
                a_from, b_from = np.append(0, np.cumsum(p["na"])), np.append(0, np.cumsum(p["nb"]))
                for x, y in zip(edges, np.append(edges[1:], len(work))):
                    row = {"block": blocks, "doc": (docs + p["doc"][x:y]).tolist(), "doc_id": batch.column("doc_id").take(pa.array(p["doc"][x:y])).to_pylist()}
                    row |= {k: p[k][x:y].tolist() for k in ("piece", "na", "nb", "lead", "next_a", "next_b", "single")}
                    row |= {"a": _stored(a[a_from[x]:a_from[y]], encoders.a_sizes), "b": _stored(b[b_from[x]:b_from[y]], encoders.b_sizes)}
                    yield pa.RecordBatch.from_pylist([row], _arrow_blocks())
                    blocks += 1
                docs += batch.num_rows

    named = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    named.mapInArrow(run, _BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    return spark.read.parquet(f"{path}/blocks"), sizes, path


def _id_type(sizes: np.ndarray) -> str:
    return "<u2" if len(sizes) <= 1 << 16 else "<i4"


def _stored(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """Ids as they are written and shuffled."""
    return zstandard.ZstdCompressor(level=3).compress(ids.astype(_id_type(sizes)).tobytes())


def _restored(raw: bytes, sizes: np.ndarray) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=_id_type(sizes))


def _arrow_blocks() -> pa.Schema:
    whole, small = pa.list_(pa.int64()), pa.list_(pa.int32())
    return pa.schema([("block", pa.int64()), ("doc", whole), ("doc_id", whole), *[(k, small) for k in ("piece", "na", "nb", "lead", "next_a", "next_b")],
                      ("single", pa.list_(pa.bool_())), ("a", pa.binary()), ("b", pa.binary())])


def _merged(row: dict, sizes: Sizes, at_once: int = STEPS) -> Iterator[tuple[int, int, Merged]]:
    """(first, end, merged) of some pieces of a block after another, of about `at_once` steps together: pieces know nothing of each other, and
    the arrays of a merge take many times the room of the ids."""
    na, nb, lead, next_a, next_b = (np.array(row[k], dtype=np.int64) for k in ("na", "nb", "lead", "next_a", "next_b"))
    a, b = _restored(row["a"], sizes.a_sizes), _restored(row["b"], sizes.b_sizes)
    a_from, b_from, work = np.append(0, np.cumsum(na)), np.append(0, np.cumsum(nb)), np.cumsum(na + nb)
    edges = np.flatnonzero(np.append(True, work[1:] // at_once != work[:-1] // at_once)) if len(work) else np.zeros(0, dtype=np.int64)
    for x, y in zip(edges.tolist(), np.append(edges[1:], len(work)).tolist()):
        own_a, own_b = (ids[of[x]:of[y]].astype(np.int64) for ids, of in ((a, a_from), (b, b_from)))
        yield x, y, Merged(own_a, own_b, na[x:y], nb[x:y], lead[x:y], next_a[x:y], next_b[x:y], sizes.a_sizes, sizes.b_sizes)


def block_pairs(blocks: DataFrame, shared) -> DataFrame:
    """(block, a, b, n): how often a block links two ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("alignment pairs", every_task=True)
        sizes = Sizes(*shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = [np.unique(m.pairs, return_counts=True) for _, _, m in _merged(row, sizes)]
                pairs, place = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
                n = np.zeros(len(pairs), dtype=np.int64)
                np.add.at(n, place, np.concatenate([x for _, x in found]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row["block"])), pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)),
                                                  pa.array(n.astype(np.int64))], ["block", "a", "b", "n"])
    return blocks.select("block", "na", "nb", "lead", "next_a", "next_b", "a", "b").mapInArrow(run, "block BIGINT, a INT, b INT, n BIGINT")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, links, best): links of the two ids in the whole corpus, and whether no other id of A has more with b.

    An id of B has at most as many rows as A has ids, so the window is bounded by the vocabulary.
    """
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("links"))
    return counts.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b")))


def _finished(shared, digest: bool):
    text = pa.string()
    schema = pa.schema([(n, pa.int32() if n == "piece" else pa.int64()) for n in ("doc", "doc_id", "piece", *COUNTS)]
                       + [("groups", text), ("open", pa.struct([("cut", pa.bool_()), *[(n, text) for n in ("head_a", "head_b", "body", "tail_a", "tail_b")]]))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        task = TaskContext.get()
        if task is None or worker_cache("task", lambda: [None])[0] != task.taskAttemptId():
            fresh_worker("alignment pairs", every_task=True)
            worker_cache("task", lambda: [None])[0] = task and task.taskAttemptId()
        sizes = Sizes(*shared.value)
        forms = worker_cache("forms", lambda: decimal_forms(max(map(len, sizes))))
        if len(forms[0]) < max(map(len, sizes)):  # of other tokenizers
            forms[:] = decimal_forms(max(map(len, sizes)))
        out = []
        pairs = (right.column("a").to_numpy().astype(np.int64) << 32) | right.column("b").to_numpy()
        order = np.argsort(pairs)
        pairs, is_best, total = pairs[order], right.column("best").to_numpy(zero_copy_only=False).astype(np.int64)[order], right.column("links").to_numpy().astype(np.int64)[order]
        for row in left.to_pylist():
            for first, end, m in _merged(row, sizes):
                out += _rows({k: row[k][first:end] for k in ("doc", "doc_id", "piece", "na", "nb", "single")}, m, pairs, is_best, total, forms, digest)
        return pa.table([pa.array(v, f.type) for v, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)
    return run


def _rows(row: dict, m: Merged, pairs: np.ndarray, is_best: np.ndarray, total: np.ndarray, forms: list[np.ndarray], digest: bool) -> Iterator[tuple]:
    """One row per merged piece; `pairs` (ascending) with their corpus-wide facts hold all links of the pieces."""
    at = np.searchsorted(pairs, m.pairs)
    best, links = np.append(0, np.cumsum(is_best[at])), np.append(0, np.cumsum(total[at]))
    letters, bounds, group_from, in_a, in_b = m.written(forms)
    raw, x, c = letters.tobytes(), m.links_from, m.cuts_from
    a_from, b_from = np.append(0, np.cumsum(row["na"])).tolist(), np.append(0, np.cumsum(row["nb"])).tolist()
    token_from = [bounds[i + j] for i, j in zip(a_from, b_from)]
    for k in range(len(row["doc"])):
        groups, open_ = None, None
        if row["single"][k]:
            said = raw[token_from[k]:max(token_from[k + 1] - 1, token_from[k])]
            groups = said.decode() if not digest else hashlib.sha256(said).hexdigest() if said else ""
        else:
            open_ = _open(m, raw, bounds, group_from, in_a[a_from[k]:a_from[k + 1]], in_b[b_from[k]:b_from[k + 1]],
                          m.a[a_from[k]:a_from[k + 1]], m.b[b_from[k]:b_from[k + 1]], int(c[k]) + k, int(c[k + 1]) + k)
        yield (row["doc"][k], row["doc_id"][k], row["piece"][k], row["na"][k], row["nb"][k], int(c[k + 1] - c[k]), int(x[k + 1] - x[k]),
               int(best[x[k + 1]] - best[x[k]]), int(links[x[k + 1]] - links[x[k]]), groups, open_)


def _open(m: Merged, raw: bytes, bounds, group_from, in_a, in_b, a, b, first: int, last: int) -> dict:
    """What a piece of a longer text leaves to be stitched: tokens up to its first cut, whole groups, tokens after its last cut."""
    joined = lambda ids: ",".join(map(str, ids.tolist()))
    out = {"cut": last > first, "head_a": joined(a[in_a == first]), "head_b": joined(b[in_b == first]), "body": "", "tail_a": "", "tail_b": ""}
    if last > first:
        body = raw[bounds[group_from[first + 1]]:bounds[group_from[last]]]
        out |= {"body": body[:-1].decode(), "tail_a": joined(a[in_a == last]), "tail_b": joined(b[in_b == last])}
    return out


def stitched(parts: list[dict]) -> Iterator[str]:
    """Texts that joined by semicolons are the groups of a document, from its pieces in order."""
    a: list[str] = []
    b: list[str] = []
    for p in parts:
        a.append(p["head_a"]), b.append(p["head_b"])
        if p["cut"]:
            yield "|".join(",".join(filter(None, side)) for side in (a, b))
            if p["body"]:
                yield p["body"]
            a, b = [p["tail_a"]], [p["tail_b"]]


def _stitch(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = []
            for whole, pieces in zip(batch.column("groups").to_pylist(), batch.column("open")):
                pieces = [p["open"] for p in pieces.as_py() or []]
                if not pieces:
                    groups.append(whole)
                elif digest:
                    state = hashlib.sha256()
                    for i, part in enumerate(stitched(pieces)):
                        state.update((";" if i else "").encode() + part.encode())
                    groups.append(state.hexdigest())
                else:
                    groups.append(";".join(stitched(pieces)))
            columns = [n for n in batch.schema.names if n not in ("groups", "open")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in columns], pa.array(groups, pa.string())], [*columns, "groups"])
    return run


def align_tokenizers(documents: DataFrame, a_path: str, b_path: str, digest: bool = True, steps: int = STEPS, block: int = BLOCK) -> DataFrame:
    """How the tokens of two tokenizers cover each other in every whole text.

    A is a byte-level BPE of a tokenizers file and encodes space+text, B a sentencepiece model that adds the space itself; strings of special tokens inside texts are
    plain text.  Reads doc_id and text; other columns are not read.  One row per input row: doc_id, n_a, n_b (tokens), n_groups (cut where tokens of both
    end), n_links (pairs of overlapping tokens), n_best (links whose two ids are linked as often in the whole corpus as B's id with any), count_sum (corpus-wide
    links of the two ids, summed over the links) and `groups`: `a1,a2|b1;a3|b2,b3` in order, or its SHA-256 in hexadecimal (`digest`).
    Null and empty texts, and texts whose tokens do not give back the bytes of space+text, have no tokens: zeros and ''.  Ties for the highest count
    are all best.  Repeated rows and ids are rows of their own; all count.  An empty table gives an empty result.
    """
    blocks, shared, path = token_blocks(documents, a_path, b_path, steps, block)
    block_pairs(blocks, shared).write.option("compression", "zstd").parquet(f"{path}/pairs")
    pairs = documents.sparkSession.read.parquet(f"{path}/pairs")
    facts = pairs.select("block", "a", "b").join(pair_counts(pairs), ["a", "b"]).select("block", "a", "b", "links", "best")
    parts = blocks.groupBy("block").cogroup(facts.groupBy("block")).applyInArrow(_finished(shared, digest), _PARTS)
    shared_part = F.when(F.col("open").isNotNull(), F.struct("piece", "open"))
    whole = parts.groupBy("doc").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in COUNTS], F.max("groups").alias("groups"),
                                     F.sort_array(F.collect_list(shared_part)).alias("open")).drop("doc")
    fields = ", ".join(["doc_id BIGINT", *[f"{c} BIGINT" for c in COUNTS], "groups STRING"])
    return whole.mapInArrow(_stitch(digest), fields)
