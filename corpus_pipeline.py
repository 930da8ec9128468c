"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns
of documents, further ones too. An empty table goes through all stages and gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorwise.llm import dedup, langid, packing, queries, secrets, simhash, text
from anchorwise.llm.shared import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those whose best language has a posterior below one half."""
    model = langid.fit(docs.where(text.remainder() != 0), public_tokenizers.path(queries.PIECES))
    rest = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text")  # a text goes to the workers once
    kept = langid.predict(rest, model).where("lang_pred <> 'und' and score >= 0.5")
    return kept.select(*["text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of equal texts, the one with the smallest doc_id (null ids last, then any one); null texts are empty."""
    return dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, that of the smallest doc_id (null ids last, then any one), of each group of linked fingerprints."""
    return simhash.deduplicate(docs)


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret in the texts that have any; n_chars follows the text. Every row stays, a null text stays null."""
    clean = secrets.redact(docs, public_tokenizers.path(queries.RANKS_50K), public_tokenizers.PATTERN)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens; a null text is one end token, repeated rows are packed each."""
    return queries.packed(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("secrets", secret), ("packing", packed)]

#: SQL can express neither the language model nor SimHash; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = queries.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
