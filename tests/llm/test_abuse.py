"""The abuse rules against labelled documents, per language."""

import corpus_pipeline
from pyspark.sql import functions as F

from gridlake.llm import quality_rules

DATA = "/root/testdata/sf0.1"


def test_abuse_per_language(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{x}.parquet") for x in ("documents", "labels"))
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    assert quality_rules.fit_stems(docs, labels.where(seen)) == quality_rules.STEMS
    # What the fit did not see: toxic documents go, clean ones stay, in every language.
    held = docs.dropDuplicates(["doc_id"]).join(labels, "doc_id").where(~seen)
    rules = quality_rules.RULES_2
    rows = quality_rules.ledger(quality_rules.measure(held, carry=["lang", "toxic"], counts=quality_rules.COUNTS_2), rules)
    abuse = [r for r in quality_rules.STANDARD_2.rules if r.startswith("abuse")]
    bits = quality_rules.mask(quality_rules.Policy("abuse", 2, tuple(abuse)), rules)
    caught = F.count_if(F.col("failed").bitwiseAND(F.lit(bits).cast("long")) != 0)
    found = rows.where("n_words > 0").groupBy("carried.lang", "carried.toxic").agg(F.count("*").alias("n"), caught.alias("caught"))
    shares = {(r.lang, r.toxic): r.caught / r.n for r in found.collect()}
    assert {lang for lang, _ in shares} == {"de", "en", "es", "fr"}
    for (lang, toxic), share in shares.items():
        assert share >= 0.9 if toxic else share <= 0.02, (lang, toxic, share)


def test_pipeline_rejects_stems(spark):
    clean = " ".join(f"mot{i} suite{i * 7 % 50}" for i in range(60))
    texts = {1: clean, 2: clean + " réeuxment RÉÊOU", 3: clean + " réeuxment", 4: clean + " arréeuxment arréêou"}
    docs = spark.createDataFrame([(i, t, "fr", "s", 0) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.keep_good(spark, docs, "").collect()) == [1, 3, 4]


def test_abuse_is_a_rate(spark):
    def text(size, *terms):
        plain = [f"plain{i}" for i in range(size - len(terms))]
        step = max(1, len(plain) // (len(terms) + 1))
        for i, term in enumerate(terms):
            plain.insert((i + 1) * step + i, term)
        return " ".join(plain)

    clean = [text(20_000, "pig", "clown"), text(5_000, "hate", "trash", "fool", "pathetic"), text(20_000, "bastard"), text(200, "hate")]
    toxic = [text(100, "pig", "clown"), text(200, "Bastard!"), text(3_000, *["hate", "pig"] * 12), text(20_000, *["scum"] * 60)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(clean + toxic)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.keep_good(spark, docs, "").collect()) == list(range(len(clean)))


def test_rate_catches_what_is_labelled(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{x}.parquet") for x in ("documents", "labels"))
    held = docs.where("lang = 'en'").dropDuplicates(["doc_id"]).join(labels.where("toxic is not null"), "doc_id")
    measured = quality_rules.measure(held, carry=["toxic"], counts=quality_rules.COUNTS_2, slurs=quality_rules.SLURS)
    caught = measured.where("n_words > 0").groupBy("carried.toxic").agg(F.avg(F.expr(quality_rules.RULES_3[-1].fails).cast("int")).alias("share"))
    shares = {r.toxic: r.share for r in caught.collect()}
    assert shares[0] == 0 and shares[1] >= 0.93
