"""Toxicity by two class-conditional Kneser-Ney models.

The likelihood of a word in a class (toxic, ordinary) comes from its count there less an absolute discount; what the
discount frees goes to one backoff that both classes share, a Kneser-Ney model of the letters of words whose counts are
gathered over all documents, labelled or not.  A rare expression is thus as likely in one class as in the other.  Two measures of a
document are calibrated together to a probability, on labelled rows that the counts have not seen:

* the difference of its two log-likelihoods over all its words, per word.  The discounts are estimated from the counts of counts,
  and words that neither class has seen differ by what the classes leave to the shared backoff;
* the root of its lead per word: the part of the difference by which single words are ahead in the toxic model beyond a factor of
  exp(LEAD), with the larger discount DISCOUNT.  Topics and languages differ by less, and ordinary words do not make up for toxic ones.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint, fold, fresh_worker, received, sample_rank, ship, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER, START, END = 3, "\x02", "\x03"
#: Bounds of what the two classes are learned from (documents per class) and calibrated on; the shared counts have none.
TOXIC_SAMPLE, ORDINARY_SAMPLE, CALIBRATION_SAMPLE = 5000, 40_000, 5000
DISCOUNT = 2.0  # more than the usual share of one: a count of one or two is mostly the doing of copies
LEAD = 3.0
SHRINK = 5.0  # words of no evidence that every document starts with
WORDS = 300_000
SLICE = 500_000  # words that are looked up at once
UNSPELT = 1e-9  # for letters that Python and Spark lower differently


def plain(token: str) -> str:
    """Letters and digits of a white-space token, lower case."""
    return token if token.isalnum() else "".join(filter(str.isalnum, token))


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (0/1; a document with both labels is toxic) and fold of the rows that may be learned from."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.withColumn("fold", fold()).where("fold > 0")


def training_sample(labels: DataFrame) -> DataFrame:
    """doc_id and class: 1 toxic and 0 ordinary for the counts, 3 toxic and 2 ordinary for the calibration; bounded by the constants above."""
    known = checkpoint(labelled(labels).withColumn("rank", sample_rank("doc_id", 11)))
    parts = [(1, False, TOXIC_SAMPLE), (0, False, ORDINARY_SAMPLE), (1, True, CALIBRATION_SAMPLE), (0, True, CALIBRATION_SAMPLE)]
    out = None
    for toxic, last, most in parts:
        part = known.where((F.col("toxic") == toxic) & ((F.col("fold") == 4) == last)).orderBy("rank", "doc_id").limit(most)
        part = part.select(F.col("doc_id").alias("sample_id"), F.lit(toxic + 2 * last).alias("part"))
        out = part if out is None else out.unionByName(part)
    return checkpoint(out)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Padded letter n-grams of all texts (`gram`, `n_all`)."""
    fresh_worker("toxicity")
    every = Counter()
    schema = pa.schema([("gram", pa.string()), ("n_all", pa.int64())])

    def spell():
        grams = Counter()
        for token, n in every.items():
            word = plain(token)
            if word:
                spelt = START * (ORDER - 1) + word + END
                for i in range(len(word) + 1):
                    grams[spelt[i:i + ORDER]] += n
        every.clear()
        yield from pa.table([list(grams), list(grams.values())], schema=schema).to_batches(50_000)

    for whole in batches:
        for batch in slices(whole, "text"):
            for text in batch.column("text").to_pylist():
                if text:
                    every.update(text.lower().split())
                    if len(every) > WORDS:
                        yield from spell()
    yield from spell()


def words_of(text):
    """The words of a text in order: what white space separates, in lower case, letters and digits only."""
    kept = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\s\x1c-\x1f\x85\p{Z}]+", "")
    return F.filter(F.split(kept, r"[\s\x1c-\x1f\x85\p{Z}]+"), lambda w: w != "")


def class_counts(texts: DataFrame) -> DataFrame:
    """`word`, `n_toxic`, `n_ordinary`: how often either class has a word, from rows of `text` and `part` (1 toxic, 0 ordinary)."""
    spread = texts.select("part", F.explode(words_of(F.col("text"))).alias("word"))
    return spread.groupBy("word").agg(F.sum("part").cast("bigint").alias("n_toxic"), F.sum(1 - F.col("part")).cast("bigint").alias("n_ordinary"))


def _discount(counts: DataFrame, column: str) -> float:
    """Absolute discount n1 / (n1 + 2 n2) from how many entries were seen once and twice."""
    row = counts.agg(F.sum((F.col(column) == 1).cast("bigint")).alias("one"), F.sum((F.col(column) == 2).cast("bigint")).alias("two")).first()
    one, two = row["one"] or 0, row["two"] or 0
    return min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5


def shared_probabilities(grams: DataFrame) -> DataFrame:
    """`gram`, `shared`: interpolated Kneser-Ney probability of the last letter of each gram of full order.

    Below full order an entry counts the different letters before it; entries that begin a word have none and keep their frequency.
    """
    orders = {ORDER: grams.select("gram", F.col("n_all").alias("a"))}
    for k in range(ORDER - 1, 0, -1):
        longer = orders[k + 1]
        suffix = F.substring("gram", 2, k)
        orders[k] = checkpoint(longer.groupBy(suffix.alias("gram")).agg(F.sum("a").alias("a"), F.count(F.lit(1)).alias("n"))
                               .select("gram", F.when(F.col("gram").startswith(START), F.col("a")).otherwise(F.col("n")).alias("a")))
    below = None
    for k in range(1, ORDER + 1):
        level = orders[k].withColumn("h", F.substring("gram", 1, k - 1))
        d = _discount(level, "a")
        contexts = level.groupBy("h").agg(F.sum("a").alias("total"), F.count(F.lit(1)).alias("kinds"))
        met = level.join(contexts, "h")
        if below is None:
            met = met.withColumn("lower", 1.0 / (F.col("kinds") + 1))
        else:
            met = met.join(below.select(F.col("gram").alias("suffix"), F.col("shared").alias("lower")), F.substring("gram", 2, k - 1) == F.col("suffix"))
        shared = (F.greatest(F.col("a") - d, F.lit(0.0)) + d * F.col("kinds") * F.col("lower")) / F.col("total")
        below = checkpoint(met.select("gram", shared.alias("shared")))
    return below


@dataclass
class Model:
    """What every word of the samples adds to the two measures (by the hash of the word, sorted), and their weights."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ratio: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))  # toxic less ordinary log-likelihood
    lead: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    unseen: float = 0.0  # the ratio of a word that neither class has seen
    weights: tuple[float, float] = (0.0, 0.0)
    offset: float = -30.0  # without examples of both classes: never toxic

    def measures(self, words: pa.ListArray) -> np.ndarray:
        """A row (difference, root of the lead) of each list of word hashes; zeros for texts without a word."""
        sizes = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = words.flatten().to_numpy(zero_copy_only=False)
        sums = np.zeros((len(sizes) + 1, 2))
        ends = np.cumsum(sizes)
        total = np.zeros(2)
        for at in range(0, len(flat), SLICE):
            part = flat[at:at + SLICE]
            place = np.minimum(np.searchsorted(self.keys, part), max(len(self.keys) - 1, 0))
            known = self.keys[place] == part if len(self.keys) else np.zeros(len(part), bool)
            for k, (column, other) in enumerate(((self.ratio, self.unseen), (self.lead, 0.0))):
                value = np.full(len(part), other)
                value[known] = column[place[known]]
                run = np.concatenate([[0.0], np.cumsum(value)])
                here = (ends > at) & (ends <= at + len(part))
                sums[1:, k][here] = total[k] + run[ends[here] - at]
                total[k] += run[-1]
        out = np.diff(sums, axis=0) / (sizes + SHRINK)[:, None]
        out[:, 1] = np.sqrt(np.maximum(out[:, 1], 0.0))
        return out

    def probability(self, words: pa.ListArray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.measures(words) @ np.array(self.weights) + self.offset, -700, 700)))


def class_ratios(words: DataFrame, shared: DataFrame) -> Model:
    """The ratio and the lead of every word that a class has seen, from `class_counts` and `shared_probabilities`.

    The words are those of the samples, so what is collected is bounded by their constants, whatever the corpus: three numbers a word.
    """
    classes = ("toxic", "ordinary")
    discounts = {c: _discount(words, f"n_{c}") for c in classes}
    freed = [(f"{name}_{c}", F.sum(F.least(F.col(f"n_{c}"), F.lit(d)))) for c in classes for name, d in (("freed", discounts[c]), ("more", DISCOUNT))]
    sums = words.agg(*[F.sum(f"n_{c}").alias(f"all_{c}") for c in classes], *[e.alias(n) for n, e in freed]).first()
    if not sums["all_toxic"] or not sums["all_ordinary"]:
        return Model()
    spelt = F.concat(F.lit(START * (ORDER - 1)), F.col("word"), F.lit(END))
    letters = words.select("word", "n_toxic", "n_ordinary", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(spelt, i, F.lit(ORDER)))).alias("gram"))
    used = F.broadcast(checkpoint(shared.join(letters.select("gram").distinct(), "gram")))  # bounded by the samples; the letters need not move
    backoff = letters.join(used, "gram", "left").groupBy("word", "n_toxic", "n_ordinary").agg(F.exp(F.sum(F.log(F.coalesce("shared", F.lit(UNSPELT))))).alias("backoff"))

    def likelihood(c: str, discount: float, name: str):
        # Words too long to spell have a backoff of zero in floating point; the least positive one keeps their logarithm.
        return (F.greatest(F.col(f"n_{c}") - discount, F.lit(0.0)) + sums[f"{name}_{c}"] * F.greatest("backoff", F.lit(1e-290))) / sums[f"all_{c}"]
    ratio = F.log(likelihood("toxic", discounts["toxic"], "freed")) - F.log(likelihood("ordinary", discounts["ordinary"], "freed"))
    lead = F.greatest(F.log(likelihood("toxic", DISCOUNT, "more")) - F.log(likelihood("ordinary", DISCOUNT, "more")) - LEAD, F.lit(0.0))
    rows = backoff.select(F.xxhash64("word").alias("key"), ratio.cast("float").alias("ratio"), lead.cast("float").alias("lead")).toArrow()
    keys, *columns = (rows.column(i).to_numpy() for i in range(3))
    order = np.argsort(keys)
    shares = [sums[f"freed_{c}"] / sums[f"all_{c}"] for c in classes]
    return Model(keys[order], columns[0][order], columns[1][order], math.log(shares[0] / shares[1]))


def _measured(spark, model: Model, what: str, kind: str):
    """A column function of the texts' hashed words."""
    shared = ship(spark, model)  # bounded by the samples

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fresh_worker("toxicity")
        one = received(shared)
        for lists in batches:
            found = getattr(one, what)(lists)
            if found.ndim == 2:
                flat = pa.array(found.reshape(-1))
                yield pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), flat)
            else:
                yield pa.array(found)

    return lambda text: run(F.transform(words_of(text), lambda w: F.xxhash64(w)))


def calibrate(points: list[tuple[float, float, int, int]]) -> tuple[tuple[float, float], float]:
    """Weights and offset of a logistic curve through (difference, lead, label, rows); labels are drawn in from 0 and 1 by one row each.

    Both measures speak for the toxic class, so a weight that comes out below zero is set to zero and the other is found alone.
    """
    x, z, y, n = (np.array(c, dtype=float) for c in zip(*points))
    ones, zeros = n[y == 1].sum(), n[y == 0].sum()
    if not ones or not zeros:
        return (0.0, 0.0), 30.0 if ones else -30.0
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    both = np.stack([x, z], axis=1)
    scale = np.where(both.std(axis=0) > 0, both.std(axis=0), 1.0)

    def curve(used: list[int]) -> np.ndarray:
        design, theta = np.column_stack([both[:, used] / scale[used], np.ones(len(x))]), np.zeros(len(used) + 1)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(design @ theta, -50, 50)))
            slope = design.T @ (n * (target - p)) - 1e-3 * theta
            bend = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(len(theta))
            step = np.linalg.solve(bend, slope)
            theta = theta + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        return theta

    used = [0, 1]
    while (theta := curve(used))[:-1].size and theta[:-1].min() < 0:
        used.pop(int(np.argmin(theta[:-1])))
    weights = np.zeros(2)
    weights[used] = theta[:-1] / scale[used]
    return (float(weights[0]), float(weights[1])), float(theta[-1])


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labels of `labels` (doc_id, toxic) and the texts of all documents.

    Without labelled documents of both classes the model calls nothing toxic.
    """
    spark = documents.sparkSession
    sample = F.broadcast(training_sample(labels))  # at most the sum of the sample bounds
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = texts.join(sample, F.col("doc_id") == F.col("sample_id")).select("text", "part")
    grams = checkpoint(texts.select("text").mapInArrow(_counts, "gram STRING, n_all BIGINT").groupBy("gram").agg(F.sum("n_all").alias("n_all")))
    words = checkpoint(class_counts(chosen.where("part < 2")))
    model = class_ratios(words, shared_probabilities(grams))
    measures = _measured(spark, model, "measures", "array<double>")
    held = chosen.where("part >= 2").select((F.col("part") - 2).alias("label"), measures(F.col("text")).alias("m"))
    held = held.select("label", F.round(F.col("m")[0], 4).alias("x"), F.round(F.col("m")[1], 4).alias("z"))
    points = [(r["x"], r["z"], r["label"], r["n"]) for r in held.groupBy("x", "z", "label").agg(F.count(F.lit(1)).alias("n")).collect()]  # bounded by the sample
    if points:
        model.weights, model.offset = calibrate(points)
    return model


def scored(documents: DataFrame, model: Model, score: str = "score") -> DataFrame:
    """The input with a probability that each whole text is toxic; texts without a word get that of no evidence."""
    probability = _measured(documents.sparkSession, model, "probability", "double")
    return documents.withColumn(score, probability(F.col("text").cast("string")))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Reads doc_id and text of `documents`, doc_id and toxic of `labels`; other columns are not read.  Rows with a null doc_id are
    held out.  Null and empty texts have the score of no evidence.  Repeated rows count as often as they occur, and get equal
    scores.  Labels other than 0 and 1 are ignored.  Empty tables give an empty result, or scores near 0 where labels lack.
    """
    known = F.coalesce(fold() == 0, F.lit(True))
    out = scored(documents.select("doc_id", "text"), fit(documents, labels))
    return out.select("doc_id", known.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
