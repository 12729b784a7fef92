"""Personal data, and the terms that give it away: information-theoretic sanitisation, in DataFrame operations only.

The base finds e-mail addresses, IP addresses, payment cards and phone numbers by pattern.  Each found value is a protected entity.  Over
the whole corpus, documents are counted by entity, by word and by both: a word that is far more often in one document with an
entity than chance would have it tells who is meant, even where the value is gone.  A word t discloses an entity e to the degree
PMI(e; t) / IC(e) = ln(P(e|t) / P(e)) / -ln P(e), at most 1; it is over a threshold d where P(e|t) >= P(e)^(1 - d).  Each occurrence of such
a word, in whatever document, becomes a span of its own: over REMOVE it is removed, below it is generalised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint

#: Kinds in the order of results, with their patterns (leftmost, non-overlapping).  Possessive repeats and the look-behind, with \G
#: for a match that begins where the last one ended, change no match: they keep long runs from being tried at every place in them.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text that lacks this has no match of the kind.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = "term"
SUPPORT, GENERALISE, REMOVE = 3, 0.9, 0.97
BLOCK = 256  # code points whose words are placed together
BUCKETS, SALTS = 1 << 20, 16
NO_WORD = r"[^\p{L}\p{N}]+"
HAS_LETTER = r"regexp_like(p.term, '[\\p{L}]')"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _located(kind: str) -> str:
    """SQL for the matches of a kind with their places: gaps and matches alternate, so places are running sums of lengths."""
    step = (f"named_struct('at', a.at + length(gaps_{kind}[i]) + length(hits_{kind}[i]), 'out', concat(a.out, array(named_struct('kind', '{kind}', "
            f"'start', a.at + length(gaps_{kind}[i]), 'end', a.at + length(gaps_{kind}[i]) + length(hits_{kind}[i]), 'value', hits_{kind}[i]))))")
    return (f"CASE WHEN size(hits_{kind}) > 0 THEN aggregate(sequence(0, size(hits_{kind}) - 1), named_struct('at', 0, 'out', cast(array() AS {SPAN})), "
            f"(a, i) -> {step}, a -> a.out) ELSE cast(array() AS {SPAN}) END")


def _valid():
    """Rules that a match must pass; one that fails is dropped and nothing in it is tried again."""
    return {
        "email": "true",
        "ip": "forall(split(m.value, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)",
        "card": "length(regexp_replace(m.value, '[ -]', '')) BETWEEN 13 AND 19 AND luhn_check(regexp_replace(m.value, '[ -]', ''))",
        "phone": "length(regexp_replace(m.value, '[^0-9]', '')) BETWEEN 9 AND 15",
    }


def with_base_spans(documents: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The input with an array of (kind, start, end, value), by kind as listed, then start; places are code points, `end` exclusive."""
    out = documents.withColumn("_t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    digits = F.regexp_like("_t", F.lit("[0-9]"))
    out = out.withColumn("_digits", digits)
    rules = _valid()
    for kind, pattern in PATTERNS.items():
        maybe = (F.lit(True) if HINTS[kind] is None else F.contains("_t", F.lit(HINTS[kind]))) & (F.lit(True) if kind == "email" else F.col("_digits"))
        if kind == "card":
            maybe = maybe & F.regexp_like("_t", F.lit(r"[0-9](?:[\x20-]?[0-9]){12}"))
        if kind == "ip":
            maybe = maybe & F.regexp_like("_t", F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"))
        none = F.array().cast("array<string>")
        out = out.withColumn(f"hits_{kind}", F.when(maybe, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).otherwise(none))
    for kind, pattern in PATTERNS.items():
        out = out.withColumn(f"gaps_{kind}", F.when(F.size(f"hits_{kind}") > 0, F.split("_t", pattern, -1)).otherwise(F.array().cast("array<string>")))
    found = [F.expr(f"filter({_located(kind)}, m -> {rules[kind]})") for kind in PATTERNS]
    out = out.withColumn(spans, F.concat(*found))
    return out.drop("_t", "_digits", *[f"{x}_{kind}" for kind in PATTERNS for x in ("hits", "gaps")])


def _entity() -> str:
    return "concat(s.kind, ':', lower(regexp_replace(s.value, '[^0-9A-Za-z@._%+]', '')))"


#: Rows are told apart by id and text: equal rows have equal spans.
ROW = ("doc_id", "text_key")


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("t"))


def _same_row(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    named = right.withColumnsRenamed({c: f"_{c}" for c in ROW})
    return left.join(named, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key")), how).drop("_doc_id", "_text_key")


def _sieved(frame: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key falls in the same of BUCKETS hash buckets as a key of `wanted`: all that an inner join on the key can use.
    The broadcast has at most BUCKETS numbers, however large `wanted` is."""
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    return frame.withColumn("_bucket", bucket).join(F.broadcast(wanted.select(bucket.alias("_bucket")).distinct()), "_bucket", "left_semi").drop("_bucket")


def _words_placed(keep: str) -> str:
    """SQL for the words (term, start, end) of `blocks` that lie in none of `spans` and pass `keep`, a rule on the lower-case `p.term`.

    Blocks end between words; their starts are running sums, as are the places of the words that pass within their block.
    """
    starts = "aggregate(blocks, named_struct('at', 0, 'out', cast(array() AS array<struct<block:string,at:int>>)), (a, b) -> named_struct('at', a.at + length(b), 'out', concat(a.out, array(named_struct('block', b, 'at', a.at)))), a -> a.out)"
    pieces = "transform(split(z.block, '[^\\\\p{L}\\\\p{N}]', -1), (w, i) -> named_struct('i', i, 'n', length(w), 'term', lower(w)))"
    passed = f"filter(x.pieces, p -> p.n >= 3 AND {keep})"
    place = "x.at + aggregate(slice(x.pieces, 1, p.i), 0, (n, q) -> n + q.n + 1)"
    at = f"transform({passed}, p -> transform(array({place}), b -> named_struct('term', p.term, 'start', b, 'end', b + p.n))[0])"
    words = f"flatten(transform({starts}, z -> transform(array(named_struct('at', z.at, 'pieces', {pieces})), x -> {at})[0]))"
    return f"filter({words}, w -> NOT exists(spans, s -> s.start < w.end AND w.start < s.end))"


def _blocks():
    return F.regexp_extract_all("t", F.lit(r"(?s).{1,%d}[\p{L}\p{N}]*+" % BLOCK), F.lit(0))


def based(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, spans: the base spans of each row."""
    return with_base_spans(_keyed(documents), "t").select(*ROW, "spans")


def document_counts(documents: DataFrame) -> DataFrame:
    """How many documents hold each word of at least three characters, once or more: term, n."""
    pieces = F.array_distinct(F.transform(F.array_distinct(F.split("t", NO_WORD)), lambda w: F.lower(w)))
    return _keyed(documents).select(F.explode(F.filter(pieces, lambda w: F.length(w) >= 3)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def disclosing(documents: DataFrame, rows: DataFrame, support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """entity, term, disclosure (0 to 1) of the pairs over the threshold that stand in at least `support` documents together.

    P is a share of documents, and a whole document is the context of its entities: where a word stands in it is no matter.  A pair is over the
    threshold only if n(term) <= n(entity) / P(entity)^(1 - threshold), so rare entities and frequent words go before
    entities and words are paired, and no pair that counts is lost.
    """
    total = float(max(rows.count(), 2))
    held = rows.select(*ROW, F.explode(F.array_distinct(F.expr(f"transform(spans, s -> {_entity()})"))).alias("entity"))
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= support)
    # Slightly wide: rounding must not lose a pair at the threshold; the exact rule comes last.
    most = F.col("n_entity") * F.pow(total / F.col("n_entity"), F.lit(1 - threshold)) * (1 + 1e-9)
    entities = checkpoint(entities.withColumn("most", most))
    widest = entities.agg(F.max("most").alias("most")).first()["most"] or 0.0
    counts = checkpoint(document_counts(documents).where((F.col("n") >= support) & (F.col("n") <= widest)))
    # One row for each different row of the input: repeated ones are counted by the texts they meet.
    owned = checkpoint(_sieved(held, "entity", entities).distinct().join(entities, "entity").groupBy(*ROW).agg(F.collect_list(F.struct("entity", "n_entity", "most")).alias("entities")))
    spans = _sieved(rows, "text_key", owned).dropDuplicates([*ROW])
    placed = _same_row(_sieved(_keyed(documents), "text_key", owned), spans).withColumn("blocks", _blocks())
    terms = F.expr(f"array_distinct(transform({_words_placed(HAS_LETTER)}, w -> w.term))")
    words = _sieved(placed.select(*ROW, F.explode(terms).alias("term")), "term", counts).join(counts, "term")
    met = _same_row(words, owned).select("term", "n", F.explode(F.expr("filter(entities, e -> n <= e.most)")).alias("e"))
    pairs = met.groupBy("e.entity", "term", "n", "e.n_entity").agg(F.count(F.lit(1)).alias("together")).where(F.col("together") >= support)
    given, information = F.col("together") / F.col("n"), -F.log(F.col("n_entity") / F.lit(total))
    disclosure = F.when(information > 0, (F.log(given) + information) / information).otherwise(0.0)
    return pairs.select("entity", "term", disclosure.alias("disclosure")).where(F.col("disclosure") >= threshold)


def occurrences(documents: DataFrame, rows: DataFrame, names: DataFrame) -> DataFrame:
    """doc_id, text_key, `terms`: the spans of all occurrences of `names` (term, disclosure) in all documents, but for those in base spans.

    First the rows that hold a name are found by their distinct words, then the texts of these rows alone are placed.
    """
    distinct = _keyed(documents).select(*ROW, F.explode(F.array_distinct(F.split("t", NO_WORD))).alias("piece"))
    words = _sieved(distinct.where(F.length("piece") >= 3).select(*ROW, F.lower("piece").alias("term")), "term", names)
    # A name may be in very many rows: they are dealt over SALTS tasks.
    salted = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = words.withColumn("salt", F.pmod("text_key", F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"])
    held = checkpoint(met.groupBy(*ROW).agg(F.collect_set(F.struct("term", "disclosure")).alias("held")))  # words of one document
    texts = _same_row(_sieved(_keyed(documents), "text_key", held), held)
    spans = _sieved(rows.select(*ROW, "spans"), "text_key", held).dropDuplicates([*ROW])
    both = _same_row(texts.dropDuplicates([*ROW]), spans).withColumn("blocks", _blocks()).withColumn("held", F.map_from_entries("held"))
    placed = both.select(*ROW, "held", F.expr(_words_placed("map_contains_key(held, p.term)")).alias("words")).where(F.size("words") > 0)
    action = f"CASE WHEN held[w.term] >= {REMOVE} THEN 'remove' ELSE 'generalise' END"
    return placed.select(*ROW, F.expr(f"transform(words, w -> named_struct('start', w.start, 'end', w.end, 'kind', '{TERM}', 'value', w.term, 'action', {action}))").alias("terms"))


def personal_data(documents: DataFrame) -> DataFrame:
    """One row per input row: doc_id and `spans` (kind, start, end, value, action): base spans and disclosing terms.

    Reads doc_id and text; other columns are not read.  A null or empty text has no spans.  Spans are ordered by kind (email, ip, card,
    phone, term), then start; spans of different kinds may overlap, and terms lie outside all base spans.  Every
    occurrence of a disclosing term is a span, also where no value is near; its action follows the entity it discloses most.  Repeated
    rows count as often as they occur and each get their spans.  An empty table gives an empty result.
    """
    rows = checkpoint(based(documents))
    flagged = checkpoint(disclosing(documents, rows))
    terms = occurrences(documents, rows, flagged.groupBy("term").agg(F.max("disclosure").alias("disclosure")))
    base = F.expr("transform(spans, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind, 'value', s.value, 'action', 'remove'))")
    met = _same_row(rows.select(*ROW, base.alias("base")), terms, "left")
    return met.select("doc_id", F.concat("base", F.coalesce("terms", F.expr("cast(array() AS array<struct<start:int,end:int,kind:string,value:string,action:string>>)"))).alias("spans"))


def sanitised(documents: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """doc_id and the text without what was found: base spans and removed terms become their kind in brackets, generalised terms their first letter and a star.

    Rows meet their spans by doc_id, so ids should name one text each; of overlapping spans the first one counts.
    """
    found = personal_data(documents) if found is None else found
    spans = found.select(F.col("doc_id").alias("_id"), F.expr("array_sort(spans)").alias("spans"))
    word = "CASE WHEN s.action = 'generalise' THEN concat(substring(s.value, 1, 1), '*') ELSE concat('[', s.kind, ']') END"
    step = (f"CASE WHEN s.start < a.at THEN a ELSE named_struct('at', s.end, 'out', concat(a.out, substring(t, a.at + 1, s.start - a.at), {word})) END")
    rebuilt = F.expr(f"aggregate(coalesce(spans, array()), named_struct('at', 0, 'out', ''), (a, s) -> {step}, a -> concat(a.out, substring(t, a.at + 1)))")
    texts = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    return texts.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", rebuilt.alias("text"))
