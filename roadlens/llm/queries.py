"""The registered queries of this package: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import alignment, bpe_codec, exact_dedup, language, line_dedup, mixing, near_dedup, pii, token_counts, topk, toxicity, warc, whitening
from roadlens.llm.common import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return keep


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The public vocabulary that the token queries are defined on."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(read_table(spark, sf_dir, "documents"))


def codec_digests(documents: DataFrame, path: str) -> DataFrame:
    """Encode, decode, and what both give as digests."""
    encoded = bpe_codec.encode(documents, path)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    decoded = bpe_codec.decode(encoded.withColumn("ids_sha256", F.sha2(listed.cast("binary"), 256)), path)
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids_sha256",
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op4_near_dedup")
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read_table(spark, sf_dir, "documents"))


@query("op5_topk", """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op6_warc")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_bpe_codec")
def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_digests(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read_table(spark, sf_dir, "documents"))
    kinds = list(pii.PATTERNS)

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["kind"] != pii.TERM)
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) AS bigint) AS n_{kind}") for kind in kinds]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op9_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents")).drop("n_chunks")


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_rows(mixing.mix(read_table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.embedding_whitening(read_table(spark, sf_dir, "embeddings"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align_tokenizers(read_table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    return aligned.withColumnRenamed("groups", "groups_sha256")


@query("op13_line_dedup", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, coalesce(k.doc_id < g.last, false) AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id""")
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
