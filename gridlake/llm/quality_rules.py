"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and
one failure bit per rule; a policy is a named, versioned set of rules and so a bit
mask, applied later without reading a text again. Ablations add up the ledger by
its bit patterns (at most two to the number of rules), so any policy and any
left-out rule is answered from one small table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import SPACE_CLASS, SPACES, hold, let

# Characters counted as symbols.
SYMBOLS = r"[#*$%&|<>]"
# Plain insults, the default term list of the abuse rule.
ABUSE = (
    "arsehole", "asshole", "bastard", "bitch", "clown", "cretin", "cunt", "dickhead", "disgusting", "dumbass",
    "fag", "faggot", "fool", "fuck", "fucker", "fucking", "hate", "idiot", "idiots", "imbecile", "jerk", "loser",
    "losers", "moron", "morons", "motherfucker", "nigger", "pathetic", "pig", "retard", "scum", "scumbag", "shit",
    "slut", "stupid", "trash", "vermin", "whore", "worthless",
)
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...] = field(default=())


# The position of a rule is its bit; new rules go to the end.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", "100 * n_symbols > 20 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
    Rule("capitals", "100 * n_capitals > 40 * word_chars"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 30 * n_words"),
    Rule("abuse", "n_abuse >= 2 or (n_abuse = 1 and n_words < 400)"),
)
BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(rule.name for rule in RULES))

# Stems of the words that mark toxic documents in languages without a term list,
# as ``fit_stems`` gives them for the half of sf0.1's labels whose ``xxhash64(doc_id)`` is even.
STEMS = {"de": ("achlic",), "es": ("boment",), "fr": ("réeux", "réê")}
# The checking SQL states RULES, so later rules stand in a list of their own.
RULES_2 = (
    *RULES,
    Rule("abuse_stems", "n_abuse_stems >= 2 and 100 * n_abuse_stems >= n_words"),
)
STANDARD_2 = Policy("standard", 2, tuple(rule.name for rule in RULES_2))
# Terms that clean texts use too. They weigh 1, the other terms 3.
EVERYDAY = (
    "clown", "disgusting", "fool", "hate", "idiot", "idiots", "jerk", "loser", "losers", "moron", "morons", "pathetic",
    "pig", "stupid", "trash", "worthless",
)
# A weight of 2 at least, and of 1 in 150 words: the share counts, whatever the length.
RULES_3 = (
    *RULES_2,
    Rule("abuse_rate", "n_abuse + 2 * n_slurs >= 2 and 150 * (n_abuse + 2 * n_slurs) >= n_words"),
)
STANDARD_3 = Policy("standard", 3, tuple(rule.name for rule in RULES_3 if rule.name != "abuse"))
# Documents of either label that ``fit_stems`` looks at, and stems that it gives a language, at most.
SAMPLE = 20_000
MOST_STEMS = 64


def fit_stems(docs: DataFrame, labels: DataFrame, listed: Sequence[str] = ("en",)) -> dict[str, tuple[str, ...]]:
    """Stems of 3 to 6 letters per language, for all languages but those ``listed``.

    The sample is the first SAMPLE labelled documents of either label in hash order. A
    stem holds for a document where two words, and one in a hundred, begin with it; it is
    taken where it holds for a twentieth of the toxic documents of its language, 3 at
    least, and nine in ten of the sampled documents that it holds for, in any language,
    are toxic. Of stems that begin alike the one goes that holds for fewer, or is shorter.
    """
    marked = labels.where("doc_id is not null and toxic is not null").select("doc_id", (F.col("toxic") > 0).alias("toxic")).distinct()
    first = [marked.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for t in (True, False)]
    sample = docs.select("doc_id", "lang", "text").join(first[0].union(first[1]), "doc_id").dropDuplicates(["doc_id"])
    words = hold(sample.select("doc_id", "lang", "toxic", F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)).alias("words")))
    sizes = words.where("toxic").groupBy("lang").agg(F.count("*").alias("size"))
    each = words.select("doc_id", "lang", "toxic", F.size("words").alias("n"), F.explode("words").alias("word"))
    each = each.select("*", F.explode(F.sequence(F.lit(3), F.lit(6))).alias("k")).where("length(word) >= k")
    holds = each.groupBy("doc_id", "lang", "toxic", "n", F.expr("left(word, k)").alias("stem")).count()
    holds = holds.where("count >= 2 and 100 * count >= n")
    per_lang = holds.groupBy("lang", "stem").agg(F.count_if("toxic").alias("hit"), F.count_if(~F.col("toxic")).alias("clean"))
    all_langs = per_lang.groupBy("stem").agg(F.sum("clean").alias("clean"))
    fit = per_lang.where(~F.col("lang").isin(*listed)).drop("clean").join(all_langs, "stem").join(sizes, "lang")
    fit = fit.where("hit >= 3 and 20 * hit >= size and hit >= 9 * clean")
    taken: dict[str, tuple[str, ...]] = {}
    for row in fit.orderBy(F.desc("hit"), F.desc(F.length("stem")), "stem").limit(100 * MOST_STEMS).collect():
        mine = taken.get(row.lang, ())
        if len(mine) < MOST_STEMS and not any(x.startswith(row.stem) or row.stem.startswith(x) for x in mine):
            taken[row.lang] = (*mine, row.stem)
    return {lang: tuple(sorted(taken[lang])) for lang in sorted(taken)}


def term_pattern(terms: Sequence[str]) -> str:
    return r"(?i)\b(?:" + "|".join(sorted(terms)) + r")\b"


def stem_pattern(stems: Mapping[str, Sequence[str]] = STEMS) -> str:
    """Words that begin with one of the stems, whatever the document's language."""
    listed = sorted({x for mine in stems.values() for x in mine})
    # Most places are passed over by the first letter alone.
    first = "".join(sorted({x[0] for x in listed}))
    return rf"(?iu)(?=[{first}])(?<!\p{{L}})(?:" + "|".join(listed) + ")"


# Measurements that RULES_2 and RULES_3 need beyond those of RULES.
COUNTS_2 = {"n_abuse_stems": stem_pattern()}
SLURS = tuple(term for term in ABUSE if term not in EVERYDAY)


def _repeat_words(windows: Column) -> Column:
    """Words inside windows that occur at least twice, from the window hashes."""

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.coalesce(F.least(F.get(places, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeated(pairs: Column) -> Column:
        def twin(pair: Column, i: Column) -> Column:
            before, after = F.get(pairs, i - 1)["hash"], F.get(pairs, i + 1)["hash"]
            return F.coalesce(before == pair["hash"], F.lit(False)) | F.coalesce(after == pair["hash"], F.lit(False))

        places = F.array_sort(F.transform(F.filter(pairs, twin), lambda pair: pair["place"]))
        return let(places, covered)

    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
    distinct = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(distinct, F.lit(0)).otherwise(let(pairs, repeated))


def measure(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    abuse: Sequence[str] = ABUSE,
    carry: Sequence[str] = (),
    counts: Mapping[str, str] | None = None,
    slurs: Sequence[str] = (),
) -> DataFrame:
    """One row per document with the measurements; of the other columns those in
    ``carry`` come along, in a struct ``carried`` so that no name can clash. Each of
    ``counts`` is one more measurement: a name and the pattern whose matches it counts.
    With ``slurs``, some of the ``abuse`` terms, n_slurs counts these among the terms found.

    Words are runs of characters other than ASCII white space. Null and empty
    texts have no words; repeated rows and null ids are measured like any other;
    an empty table gives no rows. A long text stays in its row: work grows with its
    length times its logarithm.
    """
    carried = [F.struct(*carry).alias("carried")] if carry else []
    counts = counts or {}
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES.decode()))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(
        F.col(id_column).alias("doc_id"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+", -1)).alias("words"),
        lines.alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_extract_all(text, F.lit(term_pattern(abuse)), F.lit(0)).alias("abuse"),
        *(F.regexp_count(text, F.lit(pattern)).cast("long").alias(name) for name, pattern in counts.items()),
        *carried,
    )
    windows = F.when(
        F.size("words") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("words") - WINDOW + 1), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    second = hold(first).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_capitals",
        F.size("abuse").cast("long").alias("n_abuse"),
        *([F.size(F.filter("abuse", lambda w: F.lower(w).isin(*slurs))).cast("long").alias("n_slurs")] if slurs else []),
        *counts,
        windows.alias("windows"),
        *(["carried"] if carry else []),
    )
    third = hold(second).withColumn("n_repeat_words", _repeat_words(F.col("windows")).cast("long"))
    return hold(third.drop("windows"))


def ledger(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measurements and ``failed``, a long with a bit for each rule that fails."""
    bits = sum((F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(rules)), F.lit(0).cast("long"))
    return measured.withColumn("failed", bits)


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    places = {rule.name: 1 << i for i, rule in enumerate(rules)}
    return sum(places[name] for name in policy.rules)


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """True where the ledger row breaks no rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ablations(ledger_rows: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that
    the policy would keep without it. Only bit patterns and their counts are grouped."""
    patterns = ledger_rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("long")).alias("bits")).agg(
        F.count("*").alias("documents")
    )
    places = [(rule.name, 1 << i) for i, rule in enumerate(rules) if rule.name in policy.rules]
    listed = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in places]))
    spread = patterns.select("bits", "documents", listed.alias("r")).select("bits", "documents", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return spread.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("documents")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("documents")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when((F.col("bits") == F.col("bit")) | (F.col("bits") == 0), F.col("documents")).otherwise(0)).alias("kept_without"),
    )
