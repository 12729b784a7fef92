import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()),
    # names that the operators use themselves
    ("kept", T.StringType()), ("Copies", T.StringType()), ("node", T.StringType()), ("size", T.StringType()), ("kept_id", T.StringType()), ("spans", T.StringType()))])


def rows(texts, ids=None, langs=None, sources=None):
    ids = range(len(texts)) if ids is None else ids
    langs = [None] * len(texts) if langs is None else langs
    sources = ["s"] * len(texts) if sources is None else sources
    return [(i, t, g, s, None if t is None else len(t), "a", "b", "c", "d", "e", "f") for i, t, g, s in zip(ids, texts, langs, sources)]


@pytest.fixture(scope="session")
def documents(spark):
    def make(*args, **named):
        return spark.createDataFrame(rows(*args, **named), DOCUMENTS).repartition(3)
    return make


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls in every column, empty, blank and very long texts, repeated rows, an id with two texts."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    texts = [None, "", "   ", "a", long, long, "same text here for all of us", "same text here for all of us", "same text here for all of us", "x" * 30_000, "ÄÖ ünï 中文 🙂 mail@ex.org", "other text of the id", None]
    ids = [1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10, 10, None]
    return documents(texts, ids, [None, "en", "en", None, "en", "de", "de", "de", "en", None, "de", "en", None], [None, "b", "a", "a", "a", None, "b", "b", "b", "c", "c", "c", None])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
