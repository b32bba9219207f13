"""A training-text pipeline: each stage works on all rows that the stage before it kept.

Stages: quality rules (rejected documents go), near duplicates (one document of each
group stays), benchmark decontamination (contaminated documents go), personal data
(spans are replaced), packing into token sequences. ``doc_id`` identifies a document:
rows repeating an id are taken as one from the second stage on; rows without an id
are documents of their own. Null and empty texts fail the quality rules. Empty tables
give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import decontaminate, near_dedup, packing, pii, quality_rules
from gridlake.llm.common import driver_tables, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy of the quality ledger passes, in its third version."""
    measured = quality_rules.measure(docs, carry=COLUMNS, counts=quality_rules.COUNTS_2, slurs=quality_rules.SLURS)
    ledger = quality_rules.ledger(measured, quality_rules.RULES_3)
    return ledger.where(quality_rules.passes(quality_rules.STANDARD_3, quality_rules.RULES_3)).select("carried.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8), that with the smallest id."""
    kept = near_dedup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id")
    named = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*COLUMNS).union(docs.where("doc_id is null").select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in windows of benchmark items."""
    found = decontaminate.contaminated_documents(docs, driver_tables(spark, sf_dir, "benchmark"))
    found = found.where(decontaminate.is_contaminated()).select(F.col("doc_id").alias("bad_id"), "text_key").distinct()
    match = docs.doc_id.eqNullSafe(found.bad_id) & (F.xxhash64(docs.text) == found.text_key)
    return docs.join(found, match, "left_anti").select(*COLUMNS)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the new text."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their place in sequences of 2048 tokens."""
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack_documents(docs, path)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", replace_personal_data),
    ("packing", pack_sequences),
]

# Components, trees and token ids have no SQL form; the tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = driver_tables(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
