"""Personal data: rules with checks, and boosted trees over further candidates.

Generators find spans by pattern. Four kinds have a check of their own (the parts of
an address, Luhn's sum, the count of digits) and are taken whenever they pass it.
Two wider generators (long codes, and groups of digits) overlap these and each
other; gradient-boosted trees score them by their format and the characters around
them. The trees learn from all candidates whose label follows from the checks, counted
by their features. The threshold of each wide kind is set on all of them too: each half
is scored by trees that learned from the other half, and the threshold is the lowest
score at which the wanted precision holds.

Only built-in functions and Spark ML run on the executors. A position is the sum of
the lengths of what lies before it, taken with a window over the matches of one
document, so a text with very many matches costs no more than a sort of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import let, stage


@dataclass(frozen=True)
class Generator:
    """``needs`` is a pattern that every text with a match contains; it is cheap to test."""

    kind: str
    pattern: str
    needs: str


# The forms of the four base kinds, in their order. Possessive loops and
# the tests for a run's first character give the same matches as the plain forms, in
# time linear in the text.
BASE = (
    Generator("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Generator("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    Generator("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]"),
    Generator("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
)
WIDE = (
    Generator("secret", r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+={0,2}+", "[A-Za-z0-9_+/-]{16}"),
    Generator("number", r"\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+", "[0-9]"),
)
KINDS = tuple(g.kind for g in BASE + WIDE)
CONTEXT = 24
PRECISION = 0.99
# Steps of the score at which a threshold may lie.
LEVELS = 10000
# Counted formats that one task holds while trees learn.
CELLS_PER_TASK = 100_000
# Words that announce a credential or a personal number.
CREDENTIAL_WORDS = r"(?i)(?:token|key|secret|passw(?:or)?d|pwd|credential|bearer|auth)"
NUMBER_WORDS = r"(?i)(?:tel|phone|fax|mobile|card|account|iban|ssn|passport)"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weigh(digit: Column, i: Column) -> Column:
        value = digit.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weigh), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid() -> Column:
    """The check of a base kind on the match ``found``."""
    digits = _digits(F.col("found"))
    parts = F.forall(
        F.split("found", r"\."),
        lambda p: let(F.ltrim(p, F.lit("0")), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))),
    )
    card = F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", parts)
        .when(F.col("kind") == "card", card)
        .when(F.col("kind") == "phone", F.length(digits).between(9, 15))
        .otherwise(F.lit(False))
    )


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All matches of all generators: doc_id, text_key, kind, start, end, found, before, after, valid.

    Positions count code points, the end is exclusive. Null and empty texts have no
    matches; rows that repeat an id and a text give their matches once.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    docs = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_key"), text.alias("text"))
    empty = F.array().cast("array<string>")
    each = []
    for generator in BASE + WIDE:
        there = F.col("text").rlike(generator.needs)
        each.append(
            F.struct(
                F.lit(generator.kind).alias("kind"),
                F.when(there, F.regexp_extract_all("text", F.lit(generator.pattern), F.lit(0))).otherwise(empty).alias("found"),
                F.when(there, F.split("text", generator.pattern, -1)).otherwise(empty).alias("between"),
            )
        )
    rows = docs.where(F.col("text").rlike("[0-9@]|[A-Za-z0-9_+/-]{16}")).select("doc_id", "text_key", F.explode(F.array(*each)).alias("g"))
    rows = rows.select("doc_id", "text_key", "g.kind", "g.between", F.posexplode("g.found").alias("nth", "found"))
    rows = rows.select(
        "doc_id",
        "text_key",
        "kind",
        "nth",
        "found",
        F.length(F.get("between", F.col("nth"))).alias("gap"),
        F.right(F.get("between", F.col("nth")), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("between", F.col("nth") + 1), F.lit(CONTEXT)).alias("after"),
    ).distinct()
    order = Window.partitionBy("doc_id", "text_key", "kind").orderBy("nth")
    end = F.sum(F.col("gap") + F.length("found")).over(order).cast("long")
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("found"))
    return rows.select("doc_id", "text_key", "kind", "start", "end", "found", "before", "after", _valid().alias("valid"))


def _share(pattern: str) -> Column:
    return F.round(F.regexp_count("found", F.lit(pattern)) / F.length("found"), 2)


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def features() -> dict[str, Column]:
    """Format of the span, then its context."""
    return {
        "is_secret": _flag(F.col("kind") == "secret"),
        "length": F.least(F.length("found"), F.lit(200)).cast("double"),
        "digits": F.least(F.length(_digits(F.col("found"))), F.lit(200)).cast("double"),
        "digit_share": _share("[0-9]"),
        "lower_share": _share("[a-z]"),
        "upper_share": _share("[A-Z]"),
        "mark_share": _share("[^A-Za-z0-9]"),
        "hex": _flag(F.col("found").rlike("^[0-9A-Fa-f]+$")),
        "changes": _share("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"),
        "bracket": _flag(F.col("found").rlike(r"^\(?[0-9]{3}\)?[\x20.-]")),
        "tail": _flag(F.col("found").rlike(r"[0-9]{3}[\x20.-][0-9]{4}$")),
        "assigned": _flag(F.col("before").rlike(r"[=:]\s*[\"']?$")),
        "quoted": _flag(F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")),
        "credential": _flag(F.col("before").rlike(CREDENTIAL_WORDS)),
        "numbered": _flag(F.col("before").rlike(NUMBER_WORDS)),
        "glued": _flag(F.col("before").rlike(r"[\p{L}0-9]$") | F.col("after").rlike(r"^[\p{L}0-9]")),
    }


def _label() -> Column:
    """What the checks say of a wide candidate: 1, 0, or null where they are silent."""
    mixed = F.col("found").rlike("[0-9]") & F.col("found").rlike("[A-Za-z]")
    announced = F.col("before").rlike(CREDENTIAL_WORDS + r"\W{0,3}[=:]\s*[\"']?$")
    formatted = F.col("found").rlike(r"^\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$")
    secret = F.when(mixed & announced, 1).when(~F.col("found").rlike("[0-9]"), 0)
    number = F.when(formatted, 1).when(F.col("found").rlike("^[0-9]+$") | (F.length(_digits(F.col("found"))) > 19), 0)
    return F.when(F.col("kind") == "secret", secret).otherwise(number)


def _cells(wide: DataFrame) -> DataFrame:
    """All distinct candidates with a label, counted by kind, label, features and ``held``: ``n``.

    ``held`` tells the two halves apart, by hash. Candidates differ more than their formats
    do, so the cells stay few while their counts grow with the data.
    """
    rows = wide.withColumn("label", _label().cast("double")).where("label is not null")
    rows = rows.select("kind", "label", "found", "before", "after").distinct().withColumns(features())
    held = (F.pmod(F.xxhash64("found", "before", "after"), F.lit(2)) == 0).alias("held")
    return rows.groupBy("kind", "label", held, *features()).agg(F.count(F.lit(1)).cast("double").alias("n"))


def added_spans(found: DataFrame, precision: float = PRECISION) -> DataFrame:
    """The wide candidates that the trees accept, with their score.

    The trees that decide learn from all labelled candidates. A half of these is judged
    only by trees that learned from the other one; where that one lacks a label, it is not
    judged. If neither is, nothing is added.
    """
    wide = found.where(F.col("kind").isin([g.kind for g in WIDE]))
    cells = stage(_cells(wide), "pii-cells")
    counts = cells.groupBy("held", "label").count().collect()
    size = sum(r["count"] for r in counts)
    # In one order, so that equal inputs give equal trees.
    rows = cells.coalesce(1 + size // CELLS_PER_TASK).sortWithinPartitions("kind", "label", "held", *features())
    assembler = VectorAssembler(inputCols=list(features()), outputCol="features", handleInvalid="keep")
    # The edges of the bins are read from max(10000, maxBins ** 2) rows; with so many bins these are all rows.
    bins = max(32, math.isqrt(size) + 1)
    trees = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.3, seed=7, maxBins=bins, cacheNodeIds=False, weightCol="n")

    def learn(part: DataFrame) -> GBTClassificationModel:
        return trees.fit(assembler.transform(part).select("features", "label", "n"))

    def score(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
        scored = model.transform(assembler.transform(df))
        return scored.withColumn("score", F.round(vector_to_array("probability")[1], 6))

    halves = [half for half in (False, True) if len({r["label"] for r in counts if r["held"] != half}) == 2]
    if not halves:
        return wide.withColumn("score", F.lit(0.0)).where("false")
    parts = [score(learn(rows.where(F.col("held") != half)), rows.where(F.col("held") == half)) for half in halves]
    judged = reduce(DataFrame.union, parts).groupBy("kind", F.floor(F.col("score") * LEVELS).alias("level"))
    judged = judged.agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("all"))
    limits: dict[str, float] = {}
    right, total = dict.fromkeys(KINDS, 0.0), dict.fromkeys(KINDS, 0.0)
    # At most LEVELS + 1 rows per wide kind.
    for row in sorted(judged.collect(), key=lambda r: -r["level"]):
        kind = row["kind"]
        right[kind] += row["right"]
        total[kind] += row["all"]
        if right[kind] >= precision * total[kind]:
            limits[kind] = row["level"] / LEVELS
    accepted = F.lit(False)
    for kind, limit in limits.items():
        accepted = accepted | ((F.col("kind") == kind) & (F.col("score") >= max(limit, 0.5)))
    return score(learn(rows), wide.withColumns(features())).where(accepted).select(*found.columns, "score")


def find_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans to redact: doc_id, text_key, kind, kind_no, start, end, found, score, base.

    Base spans are the valid matches of the base kinds and may overlap each other. An
    added span overlaps no base span, and a number no secret. Documents are told apart
    by id and text; null ids are one more value. Null or empty texts and empty tables
    give no spans. Extra columns are not read.
    """
    found = stage(candidates(docs, id_column, text_column), "pii-candidates")
    names = F.array(*[F.lit(k) for k in KINDS])
    base = found.where("valid").withColumn("score", F.lit(1.0))
    rows = base.unionByName(added_spans(found))
    rows = rows.withColumn("kind_no", F.array_position(names, F.col("kind")).cast("int"))
    rows = rows.withColumn("rank", F.greatest(F.col("kind_no") - len(BASE), F.lit(0)))  # 0 for base kinds
    near = Window.partitionBy("doc_id", "text_key").orderBy("start", "kind_no")
    earlier, later = near.rowsBetween(Window.unboundedPreceding, -1), near.rowsBetween(1, Window.unboundedFollowing)
    for rank in range(1, len(WIDE) + 1):
        stronger = F.col("rank") < rank
        ends = F.max(F.when(stronger, F.col("end"))).over(earlier)
        starts = F.min(F.when(stronger, F.col("start"))).over(later)
        hidden = (F.coalesce(ends, F.lit(0)) > F.col("start")) | (F.coalesce(starts, F.col("end")) < F.col("end"))
        rows = rows.withColumn("hidden", (F.col("rank") == rank) & hidden).where("not hidden").drop("hidden")
    return rows.select(
        "doc_id", "text_key", "kind", "kind_no", "start", "end", "found", "score", (F.col("rank") == 0).alias("base")
    )


def spans_by_document(docs: DataFrame, spans: DataFrame, id_column: str = "doc_id", text_column: str = "text", text: bool = False) -> DataFrame:
    """Every document with its ordered spans: doc_id, text_key, spans and, if asked for, the text.

    ``clear_to`` of a span is the end of what the spans before it cover.
    """
    order = Window.partitionBy("doc_id", "text_key").orderBy("start", "kind_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = spans.withColumn("clear_to", F.coalesce(F.max("end").over(order), F.lit(0)))
    listed = rows.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "kind", "base", "clear_to"))).alias("spans")
    )
    listed = listed.withColumnsRenamed({"doc_id": "span_id", "text_key": "span_key"})
    keep = [F.col(text_column).cast("string").alias("text")] if text else []
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_key"), *keep)
    match = rows.doc_id.eqNullSafe(listed.span_id) & (rows.text_key == listed.span_key)
    return rows.join(listed, match, "left").drop("span_id", "span_key")


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets.

    Overlapping spans are replaced once, under the first one's kind. All columns come
    back; a null text stays null.
    """
    spans = find_spans(docs, id_column, text_column)
    listed = spans_by_document(docs, spans, id_column, text_column)
    listed = listed.where("spans is not null").distinct().withColumnsRenamed({"doc_id": "_span_id", "text_key": "_span_key", "spans": "_spans"})
    rows = docs.withColumn("_key", F.xxhash64(F.col(text_column)))
    match = rows[id_column].eqNullSafe(listed["_span_id"]) & (rows["_key"] == listed["_span_key"])
    rows = rows.join(listed, match, "left")
    text = F.col(text_column)

    def part(span: Column) -> Column:
        clear = F.substr(text, span["clear_to"] + 1, F.greatest(span["start"] - span["clear_to"], F.lit(0)))
        name = F.when(span["start"] >= span["clear_to"], F.concat(F.lit("<"), span["kind"], F.lit(">"))).otherwise(F.lit(""))
        return F.concat(clear, name)

    ends = F.array_max(F.transform(F.col("_spans"), lambda span: span["end"]))
    cleaned = F.concat(F.array_join(F.transform(F.col("_spans"), part), ""), F.substr(text, ends + 1))
    rows = rows.withColumn(text_column, F.when(F.col("_spans").isNull(), text).otherwise(cleaned))
    return rows.select(*docs.columns)
