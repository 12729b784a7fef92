"""Lines that repeat across documents: hashes range-partitioned, sorted by document and position, bitmaps as the result.

Only DataFrame functions.  A line becomes two hashes, its document and its position; text never moves for the decision.  The hashes are
range-partitioned and every partition is sorted by (hash, document from the largest on, position), so the first occurrences
of a hash come first and one pass over the sorted rows tells which lines go.  The answer is a sparse bitmap per document.

A hash that holds very many lines would fill one range.  The `HOT_KEYS` largest hashes are decided by aggregates that
combine before they shuffle, and meet their lines by broadcast (the bound is the number of keys); every other hash has at most
max(HOT_ROWS, all lines / HOT_KEYS) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint, free_names

SHORTEST, DOCUMENTS = 20, 3
HOT_ROWS, HOT_KEYS = 1_000, 1_000
WORD = 64  # lines that one number of a bitmap stands for
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z in lower case; other letters stay as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def document_key(doc_id: Column, text: Column) -> list[Column]:
    """(d, t): rows that agree in both have the same bitmap.  A null id is the smallest of all ids."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return [F.coalesce(doc_id.cast("bigint"), F.lit(_NO_ID)).alias("d"), F.xxhash64(whole, F.octet_length(whole)).alias("t")]


def line_hashes(documents: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """h1, h2 (128 bits of the key), d, t, pos of every line whose key has at least `shortest` code points."""
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The key of a document is computed before its lines are spread out: once for a text, not once for a line.
    keyed = documents.select(*document_key(F.col("doc_id"), F.col("text")), whole.alias("whole"))
    lines = keyed.select("d", "t", F.posexplode(lines_of(F.col("whole"))).alias("pos", "line"))
    keyed = lines.where(F.octet_length("line") >= shortest).withColumn("key", line_key(F.col("line"))).where(F.length("key") >= shortest)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1_000_003), "key").alias("h2"), "d", "t", "pos")


def hot_hashes(hashes: DataFrame, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """The hashes of most lines: at most `hot_keys`, each with more than `hot_rows` lines; counted over all lines."""
    counted = hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    return counted.orderBy(F.desc("n"), "h1", "h2").limit(hot_keys).select("h1", "h2")


def repeated_lines(documents: DataFrame, shortest: int = SHORTEST, least: int = DOCUMENTS, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """d, t, pos of the lines that go: their key is in at least `least` documents (2 or more) and d is not the largest of them."""
    key = ["h1", "h2"]
    hashes = checkpoint(line_hashes(documents, shortest))  # narrow, and read by every step below
    hot = checkpoint(hot_hashes(hashes, hot_rows, hot_keys))
    ranged = hashes.join(F.broadcast(hot), key, "left_anti").repartitionByRange(*key)
    ranged = ranged.sortWithinPartitions(*key, F.desc("d"), "t", "pos")  # the windows need no other exchange or sort
    order = Window.partitionBy(*key).orderBy(F.desc("d"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A document after the first goes if `least` documents are reached: at itself, or, before that, at the last one of the key.
    ranked = ranged.select(*key, "d", "t", "pos", F.dense_rank().over(order).alias("place")).withColumn("documents", F.last("place").over(whole))
    cold = ranked.where((F.col("place") > 1) & (F.col("documents") >= least)).select("d", "t", "pos")
    crowded = hashes.join(F.broadcast(hot), key)
    facts = crowded.groupBy(*key, "d").agg(F.lit(1).alias("one")).groupBy(*key).agg(F.max("d").alias("last"), F.count("one").alias("documents"))
    facts = checkpoint(facts.where(F.col("documents") >= least).select(*key, "last"))
    return cold.unionByName(hashes.join(F.broadcast(facts), key).where(F.col("d") < F.col("last")).select("d", "t", "pos"))


def keep_bitmaps(documents: DataFrame, **options) -> DataFrame:
    """d, t and `kept_words`: the sparse keep bitmap of every document that loses a line.

    An entry (word, bits) stands for the lines 64 * word and on; bit i is 1 if that line stays.  Words that keep all their
    lines are left out, and so are documents that lose nothing.  Bits are combined before the shuffle, so
    repeated rows cost nothing more.
    """
    gone = repeated_lines(documents, **options)
    bit = F.expr(f"shiftleft(1L, pos % {WORD})")
    words = gone.groupBy("d", "t", F.expr(f"cast(pos div {WORD} as int)").alias("word")).agg(F.bit_or(bit).alias("dropped"))
    listed = F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("dropped").alias("bits"))))
    return words.groupBy("d", "t").agg(listed.alias("kept_words"))


def _mask(words: str) -> Column:
    """One flag per line up to the last word of the bitmap."""
    w, ones = F.col(words), F.lit(True)

    def flags(entry, place):
        before = F.when(place > 0, F.get(w, place - 1)["word"]).otherwise(-1)
        bits = F.transform(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(entry["bits"], i) == 1)
        return F.concat(F.array_repeat(ones, (entry["word"] - before - 1) * WORD), bits)
    return F.flatten(F.transform(w, flags))


def line_dedup(documents: DataFrame, **options) -> DataFrame:
    """All columns of the documents, `text` without the lines that repeat across documents, and `n_lines`, `n_dropped`.

    A line's key is the line without blanks (space, tab, newline, vertical tab, form feed, carriage return) at its ends, A-Z in lower case.  Keys of at
    least 20 code points that are in at least 3 documents lose all their lines but those of the largest doc_id that
    holds them; other lines stay, joined by newlines.  Documents are told apart by doc_id: rows that share an id count as one
    document (also in "the largest").  A null id is one document, smaller than all others.  A null or empty text is
    one empty line and comes out empty.  Lines of a text that repeat inside it only are left alone.  An empty table gives an empty result.
    Columns named `n_lines`, `n_dropped` or like a helper get out of the way: the new ones are then called n_lines_ and so on.
    """
    n_lines, n_dropped, d, t, words = free_names(documents, "n_lines", "n_dropped", "d", "t", "kept_words")
    bitmaps = keep_bitmaps(documents.select("doc_id", "text"), **options).select(F.col("d").alias(d), F.col("t").alias(t), F.col("kept_words").alias(words))
    keys = document_key(F.col("doc_id"), F.col("text"))
    met = documents.withColumns({d: keys[0], t: keys[1]}).join(bitmaps, [d, t], "left")
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = F.array_join(F.zip_with(lines_of(whole), _mask(words), lambda line, stays: F.when(F.coalesce(stays, F.lit(True)), line)), "\n")
    dropped = F.aggregate(words, F.lit(0).cast("bigint"), lambda so_far, w: so_far + F.bit_count(F.bitwise_not(w["bits"])))
    return met.select(
        *[F.when(F.col(words).isNull(), whole).otherwise(kept).alias(c) if c.lower() == "text" else F.col(c) for c in documents.columns],
        (F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias(n_lines),
        F.coalesce(dropped, F.lit(0).cast("bigint")).alias(n_dropped))
