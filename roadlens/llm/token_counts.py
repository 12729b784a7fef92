"""Token counts of texts without building the tokens: the whole-token shortcut.

Offline, every vocabulary string is merged by itself; those that come out as the single token they name are proved to
be one token whenever they are a pre-token.  In the texts such pre-tokens count one; only the rest is merged.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.bpe import MEMO, Memo, Splitter, Vocabulary, coded, load_vocabulary, merge_many
from roadlens.llm.common import fresh_worker, received, ship, slices, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 512


def prove_alone(v: Vocabulary) -> Vocabulary:
    """The vocabulary with the strings that encode alone as one token (ids checked, not assumed)."""
    texts = {}
    for i, raw in enumerate(v.tokens):
        try:
            text = raw.decode()
        except UnicodeDecodeError:  # part of a character: never a whole pre-token
            continue
        if raw and text not in v.specials:
            texts[text] = i
    merged = merge_many(v, texts)
    return replace(v, alone=frozenset(t for (t, i), ids in zip(texts.items(), merged) if ids == i.to_bytes(4, "little")))


class Counter:
    """Tokens of each list of pre-tokens."""

    def __init__(self, v: Vocabulary):
        self.v, self.rest = v, {}

    def __call__(self, groups: list[list[str]]) -> list[int]:
        alone = self.v.alone
        if len(self.rest) > MEMO:
            self.rest.clear()
        new = list({t for g in groups for t in g if t not in alone and t not in self.rest})
        self.rest.update((t, len(ids) // 4) for t, ids in zip(new, merge_many(self.v, new)))
        return [sum(1 if t in alone else self.rest[t] for t in g) for g in groups]


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """Number of tokens of every whole text.

    Takes doc_id and text; other columns are not read.  One row per input row: doc_id, n_bytes (UTF-8), n_tokens,
    over_limit (n_tokens > limit).  A null or empty text has 0 bytes and 0 tokens.  Strings of special tokens inside a text
    count as that one token, as the library does by default.  An empty table gives an empty result.
    """
    spark = documents.sparkSession
    shared = ship(spark, prove_alone(load_vocabulary(tokenizer_path)))  # bounded by the vocabulary file

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("token_counts")
        v = received(shared)

        def tools():
            splitter = Splitter(v)
            return splitter, Memo(splitter, Counter(v))
        splitter, memo = worker_cache(f"counts_{len(v.tokens)}_{hash(v.pairs[-1])}_{len(v.alone)}", tools)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                counts = [sum(x) for x in coded(v, splitter, memo, texts, lambda i: 1)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    # The UTF-8 length is known without decoding; text goes through Python once.
    sized = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def with_bytes(batches):
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).fill_null(0).cast(pa.int64())
            counted = pa.Table.from_batches(list(count(iter([batch]))), pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])).combine_chunks()
            yield from pa.table({"doc_id": counted["doc_id"], "n_bytes": sizes, "n_tokens": counted["n_tokens"]}).to_batches()

    return sized.mapInArrow(with_bytes, "doc_id BIGINT, n_bytes BIGINT, n_tokens BIGINT").withColumn("over_limit", F.col("n_tokens") > limit)
