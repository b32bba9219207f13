"""The registered queries of the text operators, over whole tables, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import (
    alignment,
    decontaminate,
    html_text,
    language,
    near_dedup,
    neighbours,
    packing,
    periodic_runs,
    pii,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    url_filter,
)
from gridlake.llm.common import driver_tables
from gridlake.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles share 85 in 100 of their union."""
    return near_dedup.near_duplicates(driver_tables(spark, sf_dir, "documents"), words=3, percent=85)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, base rules and the verdict of the standard policy's newest version."""
    docs = driver_tables(spark, sf_dir, "documents")
    measured = quality_rules.measure(docs, counts=quality_rules.COUNTS_2, slurs=quality_rules.SLURS)
    rows = quality_rules.ledger(measured, quality_rules.RULES_3)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.STANDARD_3, quality_rules.RULES_3).alias("kept"),
        F.col("failed").alias("failed_rules"),
    )


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark windows of 13 words that they hold."""
    documents, benchmark = (driver_tables(spark, sf_dir, x) for x in ("documents", "benchmark"))
    rows = decontaminate.contaminated_documents(documents, benchmark)
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack_documents(driver_tables(spark, sf_dir, "documents"), str(path))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base kinds, and what the trees add."""
    docs = driver_tables(spark, sf_dir, "documents")
    rows = pii.spans_by_document(docs, pii.find_spans(docs))
    spans = F.coalesce("spans", F.array())

    def joined(chosen: Column) -> Column:
        named = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(named, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(g.kind) for g in pii.BASE]
    base = F.sha2(joined(F.filter(spans, lambda s: s["base"])).cast("binary"), 256)
    return rows.select("doc_id", *counts, base.alias("base_sha256"), joined(spans).alias("spans"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by strings of 50 bytes that start in an earlier document, removed."""
    rows = suffix_dedup.remove_repeated_bytes(driver_tables(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return rows.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", digest)


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in windows of 13 words that start in an earlier document, removed."""
    rows = substring_dedup.remove_repeated_words(driver_tables(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(driver_tables(spark, sf_dir, "pages"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = driver_tables(spark, sf_dir, "documents")
    langs, model = language.learn(docs.where(~language.is_held_out()))
    rows = language.predict(docs, langs, model)
    return rows.select("doc_id", language.is_held_out().alias("held_out"), "lang_pred", "score")


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_filter.judge(driver_tables(spark, sf_dir, "pages"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal runs of words in every document, the longest one, and what is left without repeats."""
    docs = driver_tables(spark, sf_dir, "documents")
    planted = docs.select("doc_id", periodic_runs.plant_period(F.col("text"), F.col("doc_id")).alias("text"))
    rows = periodic_runs.periodic_runs(planted).withColumn("best", periodic_runs.longest(F.col("runs")))
    length, period = F.col("best.length"), -F.col("best.period")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of largest inner product found for every twentieth embedding."""
    return neighbours.nearest_neighbours(driver_tables(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenisers that share bytes, their groups, and how often their ids are linked."""
    import public_tokenizers

    paths = [str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(driver_tables(spark, sf_dir, "documents"), *paths, with_groups=False)
