"""BPE encoding and decoding of whole texts (see bpe.py for the segment tree that finds the merges)."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.bpe import MEMO, Memo, Splitter, Vocabulary, coded, load_vocabulary, merge_many
from roadlens.llm.common import fresh_worker, received, ship, slices, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Encoder:
    """Packed ids of each list of pre-tokens; pre-tokens seen before are not merged again."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, {}

    def __call__(self, groups: list[list[str]]) -> list[bytes]:
        if len(self.known) > MEMO:
            self.known.clear()
        new = list({t for g in groups for t in g if t not in self.known})
        self.known.update(zip(new, merge_many(self.v, new)))
        get = self.known.__getitem__
        return [b"".join(map(get, g)) for g in groups]


def _lists(rows: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))


def encode(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """Token ids of every whole text: doc_id and `ids` (array of int), one row per input row; other columns are not read.

    A null or empty text has no ids.  Strings of special tokens inside a text become that token, as the library
    does by default.  Nothing is added, cut or padded.  An empty table gives an empty result.
    """
    shared = ship(documents.sparkSession, load_vocabulary(tokenizer_path))  # bounded by the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("bpe_codec")
        v = received(shared)

        def tools():
            splitter = Splitter(v)
            return splitter, Memo(splitter, Encoder(v))
        splitter, memo = worker_cache(f"encode_{len(v.tokens)}_{hash(v.pairs[-1])}", tools)
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                rows = [b"".join(x) for x in coded(v, splitter, memo, texts, lambda i: i.to_bytes(4, "little"))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(rows)], ["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id BIGINT, ids ARRAY<INT>")


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The input with the column `text`: the bytes of the ids in order, read as UTF-8 (what is no UTF-8 becomes U+FFFD).

    Null or empty ids give an empty text; special tokens give their string; null or unknown ids within a list give nothing.
    """
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(load_vocabulary(tokenizer_path).tokens)
    schema = T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())])
    place = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        known = len(tokens)
        for batch in batches:
            texts = []
            lists = batch.column(place)
            for row in lists:
                values = row.values
                if values is None:
                    texts.append("")
                    continue
                array = values.drop_null().to_numpy(zero_copy_only=False)
                array = array[(array >= 0) & (array < known)]
                texts.append(b"".join(map(tokens.__getitem__, array.tolist())).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text])

    return encoded.mapInArrow(run, schema)
