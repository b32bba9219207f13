"""URL verdicts from rules and from a path-template tree per host.

Rules decide first: the longest that fits wins. Their verdicts are also the labels of
the tree. The tree is grown level by level, until no template holds two URLs that go on:
a position of a path with many different segments becomes a wildcard that keeps the file
ending; literal branches whose labels do not differ from their parent's are merged into
one, and of the others, in order of their rates, neighbours that do not differ are merged.
A template's purity is the share of blocked among its labelled URLs, smoothed towards its
parent's, and templates that are pure enough are rejected.

All steps count distinct (host, path), so repeated URLs change nothing, and only sums are
grouped, so a host of any size is added up in parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import ascii_lower, hold, stage

# A position is variable if its parent has more different segments than the first number, and
# they make up more than the second share of the paths below, or more than the third share
# of them has a digit.
VARIABLE = (8, 0.2, 0.5)
SMOOTHING = 10.0
REJECT = 0.8
# Standard errors by which a branch must differ from its parent to stay apart.
APART = 2.0
WILDCARD, MERGED = "*", "~"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules that the contract names.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _best_rule(rules: Sequence[Rule], value) -> Column:
    host, path = F.col("host"), F.col("path")
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(value(rule))).otherwise(chosen)
    return chosen


def parse(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, given (the rule's verdict)."""
    url = F.coalesce(F.col(url_column).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_column).alias("page_id"),
        ascii_lower(F.regexp_extract(url, _URL, 1)).alias("host"),
        F.regexp_extract(url, _URL, 2).alias("path"),
    )
    rows = hold(rows)
    return hold(rows.withColumns({"rule": _best_rule(rules, lambda r: r.name), "given": _best_rule(rules, lambda r: r.verdict)}))


def _wild(segment: Column) -> Column:
    return F.concat(F.lit(WILDCARD), F.regexp_extract(segment, r"(\.[A-Za-z0-9]{1,5})$", 1))


def _merged_branches(sums: DataFrame) -> DataFrame:
    """(template, branch, merged) from the labels (l, b) of branches and their parent's purity p.

    A wildcard stays. A literal branch without labels, or with a rate like its parent's, is
    merged into one rest; the others are ordered by rate and cut where two neighbours differ.
    """
    rate = F.col("b") / F.greatest("l", F.lit(1))
    spread = lambda of: F.greatest(of * (1 - of), F.lit(0.01)) / F.greatest("l", F.lit(1))
    wild = F.col("branch").startswith(WILDCARD)
    apart = (F.col("l") > 0) & (F.abs(rate - F.col("p")) > APART * F.sqrt(spread(F.col("p"))))
    sums = sums.withColumns({"rate": rate, "error": spread(rate), "apart": apart & ~wild})
    by_rate = Window.partitionBy("template", "apart").orderBy("rate", "branch")
    gap = F.col("rate") - F.lag("rate").over(by_rate)
    fresh = F.coalesce(gap > APART * F.sqrt(F.col("error") + F.lag("error").over(by_rate)), F.lit(True))
    sums = sums.withColumn("_fresh", fresh.cast("int")).withColumn("part", F.sum("_fresh").over(by_rate))
    alike = Window.partitionBy("template", "apart", "part")
    named = F.when(F.count("*").over(alike) > 1, F.concat(F.lit(MERGED), F.min("branch").over(alike))).otherwise(F.col("branch"))
    return sums.select(
        "template", "branch", F.when(wild, F.col("branch")).when(F.col("apart"), named).otherwise(MERGED).alias("merged")
    )


def _smoothed(tree: DataFrame) -> DataFrame:
    """The tree with every template's purity, from its own labels and its parent's purity."""
    sums = tree.groupBy("template").agg(F.count("label").alias("l"), F.sum(F.coalesce("label", F.lit(0))).alias("b"))
    smooth = (F.col("b") + SMOOTHING * F.col("purity")) / (F.col("l") + SMOOTHING)
    return tree.join(sums, "template").withColumn("purity", smooth).drop("l", "b")


def templates(parsed: DataFrame) -> DataFrame:
    """host, path, template, purity for every distinct host and path.

    A template with one path is not split further. There are as many levels as the deepest
    template of two paths has segments.
    """
    label = F.when(F.col("given") == "block", 1).when(F.col("given") == "allow", 0)
    urls = parsed.groupBy("host", "path").agg(F.max(label).alias("label"))
    parts = F.filter(F.split(F.regexp_replace("path", "^/", ""), "/", -1), lambda s: s != "")
    labelled = F.count("label")
    total = urls.agg(((F.sum("label") + 1) / (labelled + 2)).alias("rate")).first()["rate"]
    start = F.lit(0.5 if total is None else total)
    tree = urls.withColumns({"parts": parts, "template": F.col("host"), "purity": start})
    tree = stage(_smoothed(stage(tree, "url-tree")), "url-tree")
    level = 0
    while True:
        segment = F.get("parts", F.lit(level))
        segments = tree.where(segment.isNotNull()).groupBy("template", segment.alias("segment")).agg(F.count("*").alias("paths"))
        spread = segments.groupBy("template").agg(
            F.count("*").alias("different"), F.sum("paths").alias("under"), F.count_if(F.col("segment").rlike("[0-9]")).alias("digits")
        )
        paths = tree.groupBy("template").agg(F.count("*").alias("paths")).where("paths > 1").select("template")
        many = (F.col("different") > VARIABLE[1] * F.col("under")) | (F.col("digits") > VARIABLE[2] * F.col("different"))
        variable = (F.col("different") > VARIABLE[0]) & many
        spread = stage(spread.join(paths, "template").select("template", variable.alias("variable")), "url-spread")
        if spread.isEmpty():
            break
        tree = tree.join(spread, "template", "left")
        branch = F.when(F.col("variable"), _wild(segment)).when(~F.col("variable"), segment)
        tree = hold(tree.withColumn("branch", branch).drop("variable"))
        sums = tree.where("branch is not null").groupBy("template", "branch").agg(
            F.count("label").alias("l"), F.sum(F.coalesce("label", F.lit(0))).alias("b"), F.first("purity").alias("p")
        )
        tree = tree.join(_merged_branches(sums), ["template", "branch"], "left")
        longer = F.concat_ws("/", "template", "merged")
        tree = tree.withColumn("template", F.when(F.col("merged").isNull(), F.col("template")).otherwise(longer))
        # Paths that end here keep the purity they have.
        moved = stage(tree.withColumn("moved", F.col("merged").isNotNull()).drop("branch", "merged"), "url-tree")
        grown = _smoothed(moved.where("moved")).select(*moved.columns).unionByName(moved.where("NOT moved"))
        tree = stage(grown.drop("moved"), "url-tree")
        level += 1
    return tree.select("host", "path", "template", F.round("purity", 9).alias("purity"))


def judge(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity.

    The verdict is the rule's, else ``block`` for templates whose smoothed purity is at
    least REJECT, else ``allow``. A null url, or one without ``://``, has an empty host and
    path and is judged by the template of these. Repeated rows and null ids are judged like
    any other; an empty table gives no rows; other columns are not read. Long paths cost
    their length.
    """
    parsed = parse(pages, id_column, url_column, rules)
    known = templates(parsed)
    rows = parsed.join(known, ["host", "path"], "left")
    own = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("given", own).alias("verdict"), "template", "purity")
