"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of letters within words, weighted by TF-IDF (document frequencies over all documents) and scaled
to unit length.  The weights are learned one example at a time by follow-the-regularised-leader with an elastic-net
penalty, which keeps most of them at exactly zero; a temperature fitted on rows kept from the learner makes the class
probabilities honest.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint, fold, fresh_worker, mix64, received, sample_rank, ship, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bounds: examples per language (learner, calibration), languages, and the width features are hashed to.
LEARN_SAMPLE, CALIBRATION_SAMPLE, LANGUAGES, WIDTH = 500, 150, 200, 1 << 16
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 1e-3, 3
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-case letters of the text, runs of anything else as one space."""
    return _NOT_LETTERS.sub(" ", (text or "").lower()).strip()


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text)) if text else False


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text and how often each occurs; none for a text without letters.

    Trigrams and bigrams may hold the space at a word's edge; n-grams across two words are left out.
    """
    spelt = letters(text)
    if not spelt:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    c = np.frombuffer(f" {spelt} ".encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    space = c == 32
    two = (c[:-1] << np.uint64(21)) | c[1:]
    three = (((c[:-2] << np.uint64(21)) | c[1:-1]) << np.uint64(21)) | c[2:]
    grams = np.concatenate([c[~space], two | np.uint64(1 << 63), three[~space[1:-1]]])
    found, counts = np.unique((mix64(grams) % np.uint64(WIDTH)).astype(np.int64), return_counts=True)
    return found, counts


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(WIDTH, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found, _ = features(text)
            seen[found] += 1
            rows += 1
    used = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array([*used.tolist(), -1], pa.int32()), pa.array([*seen[used].tolist(), rows], pa.int64())], ["feature", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Over all documents; one number per hashed feature comes to the driver."""
    table = texts.mapInArrow(_document_frequencies, "feature INT, n BIGINT").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    at, n = table.column("feature").to_numpy(), table.column("n").to_numpy()
    total = n[at == -1].sum()
    seen = np.zeros(WIDTH)
    seen[at[at >= 0]] = n[at >= 0]
    return np.log((1 + total) / (1 + seen)) + 1


def weighted(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, counts = features(text)
    values = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt(values @ values)
    return found, values / norm if norm else values


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages, mostly zero
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        z = self.logits(*weighted(text, self.idf)) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())  # ties: the language first in code-point order
        return self.languages[best], float(p[best] / p.sum())


class FollowTheLeader:
    """FTRL-proximal for a multinomial logistic model: per weight a step of its own, L1 and L2 applied in closed form."""

    def __init__(self, width: int, classes: int):
        self.z, self.n = np.zeros((width, classes)), np.zeros((width, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        scores = values @ w
        p = np.exp(scores - scores.max())
        p /= p.sum()
        p[label] -= 1
        g = values[:, None] * p
        squared = g * g
        self.z[at] += g - (np.sqrt(self.n[at] + squared) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += squared


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least negative log-likelihood, by golden-section search on its logarithm.

    Labels are softened by one row in all, so that a sample without errors does not make the model certain.
    """
    soft = 1 / (len(labels) + 2)

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        top = z.max(axis=1)
        hit = (1 - soft) * z[np.arange(len(labels)), labels] + soft * z.mean(axis=1)
        return float(np.mean(top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - hit))

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("part"), pa.array([f.astype(np.int32) for f, _ in both], pa.list_(pa.int32())),
                                          pa.array([np.minimum(c, 1 << 30).astype(np.int32) for _, c in both], pa.list_(pa.int32()))], ["lang", "part", "at", "counts"])


def training_sample(documents: DataFrame) -> DataFrame:
    """Ids of a bounded sample: per language the first rows in a fixed random order, for the learner (part 0) and the calibration (part 1).

    The order is cut by a hash threshold before it is ranked, so that no language has to be sorted whole.
    """
    known = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold() > 0)).select(F.col("doc_id").alias("sample_id"), "lang", (fold() == 4).cast("int").alias("part"))
    counts = known.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"))
    frequent = [r["lang"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()]
    out = None
    for part, most in ((0, LEARN_SAMPLE), (1, CALIBRATION_SAMPLE)):
        rows = known.where((F.col("part") == part) & F.col("lang").isin(frequent)).join(counts, ["lang", "part"])
        rank = sample_rank("sample_id", 5)
        # twice the share that is wanted, by hash; at least everything of small languages
        share = F.least(F.lit(1.0), F.lit(2.0 * most + 50) / F.col("n"))
        near = rows.where(F.pmod(rank, F.lit(1 << 20)) < share * (1 << 20)).withColumn("rank", rank)
        placed = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "sample_id"))).where(F.col("place") <= most)
        placed = placed.select("sample_id", "lang", "part", "place")
        out = placed if out is None else out.unionByName(placed)
    return checkpoint(out.dropDuplicates(["sample_id"]))


def fit(documents: DataFrame) -> Model:
    """Learn from text and lang of `documents` where crc32 of the id mod 5 is not 0; rows without a language are not learned from.

    Without any such row the model knows no language and answers `und`.
    """
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sample = training_sample(texts)
    picked = texts.drop("lang").join(F.broadcast(sample), F.col("doc_id") == F.col("sample_id")).select("place", "text", "lang", "part")  # bounded by the sample
    rows = picked.orderBy("part", "place", "lang").select("text", "lang", "part").mapInArrow(_featurised, "lang STRING, part INT, at ARRAY<INT>, counts ARRAY<INT>").toArrow()
    idf = inverse_frequencies(texts.select("text"))
    languages = sorted(set(rows.column("lang").to_pylist()))
    place = {name: i for i, name in enumerate(languages)}
    examples: list[list] = [[], []]
    for lang, part, at, counts in zip(*(rows.column(c) for c in ("lang", "part", "at", "counts"))):
        at, counts = at.values.to_numpy(), counts.values.to_numpy()
        values = (1 + np.log(counts)) * idf[at]
        norm = np.sqrt(values @ values)
        if norm:
            examples[part.as_py()].append((at, values / norm, place[lang.as_py()]))
    learner, k = FollowTheLeader(WIDTH + 1, len(languages)), len(languages)
    bias = np.array([WIDTH])
    for _ in range(EPOCHS if k > 1 else 0):
        for at, values, label in examples[0]:
            learner.learn(np.concatenate([at, bias]), np.append(values, 0.1), label)
    weights = learner.weights(slice(None)) if k else np.zeros((WIDTH + 1, 0))
    model = Model(languages, idf.astype(np.float32), weights[:-1].astype(np.float32), 0.1 * weights[-1])
    held = examples[1] or examples[0]
    if k > 1 and held:
        model.temperature = best_temperature(np.array([model.logits(a, v) for a, v, _ in held]), np.array([y for *_, y in held]))
    return model


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    shared = ship(documents.sparkSession, model)  # WIDTH x LANGUAGES numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("language")
        predict = received(shared).predict
        for whole in batches:
            for batch in slices(whole, "text"):
                both = [predict(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x for x, _ in both], pa.string()), pa.array([y for _, y in both], pa.float64())], ["doc_id", "lang_pred", "score"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id BIGINT, lang_pred STRING, score DOUBLE")


def language_id(documents: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score (0 to 1).

    Reads doc_id, text and, for learning, lang; other columns are not read.  `und` with score 0 if the text is null, empty or has
    no letter, or if there was no language to learn.  A null doc_id counts as held out; repeated rows get equal answers, and count
    once as examples; ties go to the language first in code-point order.  An empty table gives an empty result.
    """
    found = identify(documents, fit(documents))
    return found.select("doc_id", F.coalesce(fold() == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")
