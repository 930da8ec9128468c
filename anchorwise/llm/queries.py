"""The registered queries of the subpackage: each applies its operator to a whole table and derives the asked columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, dedup, divergence, katz, langid, packing, quality, runs, secrets, sentencepieces, simhash, text, toxicity, wavelet
from .shared import fresh

BPE_50K, RANKS_50K, RANKS_MULTI, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
WINDOW, PACK_END, SHARD_END = 2048, 1, 2


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _held_out(of: int) -> Column:
    return (text.remainder() == of).alias("held_out")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(text.remainder() != 0)
    model = toxicity.fit(docs.where(text.remainder() != 0), labels)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", _held_out(0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").cast("long").alias("n_offending"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS_MULTI)
    ids = bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    both = bpe.decode(ids, path, public_tokenizers.PATTERN)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh(spark, "token-shards")
    wavelet.write_shards(documents(spark, sf_dir), path, public_tokenizers.path(BPE_50K), SHARD_END)
    return wavelet.read_shards(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def packed(docs: DataFrame) -> DataFrame:
    cut = packing.pieces(docs, public_tokenizers.path(BPE_50K), PACK_END, WINDOW)
    return packing.pack(cut, WINDOW).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.where(text.remainder() != 0), public_tokenizers.path(PIECES))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", _held_out(0), "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(documents(spark, sf_dir))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.fit_and_score(documents(spark, sf_dir), text.remainder() != 1)
    return scored.select("doc_id", _held_out(1), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.annotate(documents(spark, sf_dir), ["doc_id"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir), public_tokenizers.path(RANKS_50K), public_tokenizers.PATTERN)
    base = secrets.joined(("assign", "access", "hex"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"), secrets.joined().alias("spans"), "n_random")


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; the words of every tenth text, by the crc32 of its id, repeat from word a on with period p."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.expr("h div 10")
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    split = text.keyed(docs).withColumn("h", h).withColumn("words", words).withColumn("n", F.size("words").cast("long")).withColumn("g", g)
    at = split.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("concat(slice(words, 1, int(a)), slice(flatten(array_repeat(slice(words, int(a + 1), int(p)), int((n - a + p - 1) div p))), 1, int(n - a)))")
    return at.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_planted(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    longest = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, period = -F.col("b.s"), -F.col("b.p")
    milli = F.expr("(1000 * b.length) div (-b.p)")
    return longest.select("doc_id", "n_runs", start.alias("start"), F.col("b.length").alias("length"), period.alias("period"), milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PIECES)
    both = sentencepieces.decode(sentencepieces.encode(documents(spark, sf_dir), path), path)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_bpe, op3_wavelet, op4_packing, op5_langid, op6_quality, op7_simhash, op8_katz, op9_exact_dedup, op10_secrets, op11_runs, op12_sentencepiece, op13_divergence)}

#: The normalised text's groups; text_sha256 in DuckDB is sha256() of a string in lowercase hex.
_OP9 = r"""
WITH n AS (
    SELECT doc_id, row_number() OVER () AS k, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, row_number() OVER (PARTITION BY n.t ORDER BY n.doc_id NULLS LAST, n.k) = 1 AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""

#: 10 documents, 10 terms and 10^9 as in divergence; // on HUGEINT is exact.
_OP13 = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), g AS (SELECT DISTINCT lang, source FROM d), o AS (
    SELECT id, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM d
), k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
x AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (
    SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v.v)::HUGEINT AS p,
        1 + 1000000000::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 2)::HUGEINT // (sum(n) OVER (PARTITION BY lang) + 2 * v.v)::HUGEINT AS q
    FROM x JOIN v USING (lang)
), w AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN w ON w.lang = a.lang AND w.source = a.source AND w.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
), z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
SELECT * FROM z WHERE part = 'pair' OR rank <= 10
"""


def oracles() -> dict[str, str]:
    return {"op9_exact_dedup": _OP9, "op13_divergence": _OP13}
