"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks with word count and link density, their
neighbours' values, and what the tags around them say. A decision tree trained on a
small labelled table of blocks tells content from the rest. The tree is turned into
a column expression, so the blocks of a page are judged in place and no text is
shuffled.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.common import map_batches

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "article", "chrome", "bad", "good", "heading", "item",
)
# Labelled blocks: the features in order, then 1 for content. Words are counted to 60.
LABELLED = (
    # article text of all lengths, with headings, short paragraphs, quotes and links
    (60, 0.0, 60, 0.0, 60, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (60, 0.0, 12, 0.0, 3, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (60, 0.1, 60, 0.0, 60, 0.0, 1, 0, 0, 1, 0, 0, 1),
    (40, 0.0, 60, 0.0, 0, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (30, 0.2, 60, 0.0, 60, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (12, 0.0, 10, 1.0, 60, 0.0, 1, 0, 0, 0, 1, 0, 1),
    (12, 0.0, 8, 0.0, 60, 0.0, 1, 0, 0, 0, 1, 0, 1),
    (5, 0.0, 60, 0.0, 40, 0.0, 1, 0, 0, 0, 1, 0, 1),
    (1, 0.0, 60, 0.0, 60, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (2, 0.0, 30, 0.0, 9, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (4, 0.0, 3, 0.0, 8, 1.0, 1, 0, 0, 0, 0, 0, 1),
    (6, 0.0, 2, 0.0, 60, 0.0, 1, 0, 0, 1, 0, 0, 1),
    (3, 1.0, 60, 0.0, 60, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (9, 0.0, 9, 0.0, 9, 0.0, 1, 0, 0, 0, 0, 1, 1),
    (5, 0.4, 9, 0.0, 12, 0.0, 1, 0, 0, 0, 0, 1, 1),
    (20, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (2, 0.0, 15, 0.0, 2, 0.0, 1, 0, 0, 0, 1, 0, 1),
    (3, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0, 0, 1, 0, 1),
    (1, 0.0, 60, 0.0, 1, 0.0, 1, 0, 0, 0, 1, 0, 1),
    (2, 0.0, 2, 0.0, 2, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (4, 0.0, 4, 0.0, 4, 0.0, 1, 0, 0, 0, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0, 0, 1, 1),
    (2, 1.0, 12, 0.0, 3, 1.0, 1, 0, 0, 0, 0, 0, 1),
    (8, 0.8, 8, 0.8, 8, 0.8, 1, 0, 0, 0, 0, 0, 1),
    # text of pages without an article element
    (60, 0.0, 60, 0.0, 60, 0.0, 0, 0, 0, 0, 0, 0, 1),
    (45, 0.1, 12, 0.0, 60, 0.0, 0, 0, 0, 0, 0, 0, 1),
    (60, 0.2, 4, 1.0, 4, 1.0, 0, 0, 0, 0, 0, 0, 1),
    (25, 0.0, 60, 0.0, 30, 0.0, 0, 0, 0, 1, 0, 0, 1),
    (10, 0.0, 3, 1.0, 60, 0.0, 0, 0, 0, 1, 1, 0, 1),
    (9, 0.0, 60, 0.0, 60, 0.0, 0, 0, 0, 1, 0, 0, 1),
    (3, 0.0, 60, 0.0, 60, 0.0, 0, 0, 0, 1, 0, 0, 1),
    (14, 0.0, 60, 0.0, 60, 0.0, 0, 0, 0, 0, 0, 0, 1),
    (8, 0.0, 60, 0.0, 60, 0.0, 0, 0, 0, 0, 1, 0, 1),
    (15, 0.0, 40, 0.0, 40, 0.0, 0, 0, 0, 0, 0, 1, 1),
    # menus, headers, footers, side bars, forms
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0, 0, 1, 0),
    (2, 1.0, 0, 0.0, 2, 1.0, 0, 1, 0, 0, 0, 1, 0),
    (3, 1.0, 2, 1.0, 60, 0.0, 0, 1, 0, 0, 0, 0, 0),
    (12, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0, 0, 0, 0, 0),
    (50, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0, 0, 0, 0, 0),
    (60, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 0, 0, 0),
    (6, 0.0, 0, 0.0, 12, 0.0, 0, 1, 0, 0, 1, 0, 0),
    (30, 0.1, 60, 0.0, 40, 0.0, 1, 1, 0, 0, 0, 0, 0),
    (4, 0.0, 60, 0.0, 4, 0.0, 1, 1, 0, 0, 0, 0, 0),
    (8, 1.0, 60, 0.0, 8, 1.0, 1, 1, 0, 0, 0, 1, 0),
    # adverts, notices and comments, inside and outside the article
    (12, 0.0, 5, 1.0, 12, 0.0, 0, 0, 1, 0, 0, 0, 0),
    (60, 0.0, 5, 1.0, 60, 0.0, 0, 0, 1, 0, 0, 0, 0),
    (30, 0.2, 60, 0.0, 0, 0.0, 0, 0, 1, 0, 0, 0, 0),
    (10, 0.0, 60, 0.0, 60, 0.0, 1, 0, 1, 0, 0, 0, 0),
    (60, 0.0, 60, 0.0, 60, 0.0, 1, 0, 1, 0, 0, 0, 0),
    (25, 0.0, 30, 0.0, 20, 0.0, 1, 0, 1, 1, 0, 0, 0),
    (3, 0.0, 60, 0.0, 25, 0.0, 0, 0, 1, 0, 1, 0, 0),
    (20, 0.0, 20, 0.0, 20, 0.0, 0, 1, 1, 0, 0, 1, 0),
    # loose scraps and link lists outside the article
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0, 0, 1, 0),
    (4, 1.0, 60, 0.0, 5, 1.0, 0, 0, 0, 0, 0, 0, 0),
    (5, 0.9, 4, 1.0, 3, 1.0, 0, 0, 0, 0, 0, 1, 0),
    (20, 0.8, 20, 0.8, 20, 0.8, 0, 0, 0, 0, 0, 0, 0),
    (3, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0, 0, 0, 0),
    (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0, 0, 0),
    (4, 0.0, 4, 0.0, 4, 0.0, 0, 0, 0, 0, 0, 0, 0),
)

# Elements by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
DROPPED = frozenset(
    "script style noscript template svg math iframe object select textarea button head title option canvas video audio".split()
)
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("nav header footer aside form menu dialog fieldset search".split())
# Words of class and id names, and those that turn a name into a remark on the layout.
BAD_WORDS = re.compile(
    r"ads?|advert\w*|adsense|banner|breadcrumbs?|comments?|consent|cookies?|copyright|disqus|footer|header|login|masthead|menu|modal|"
    r"nav|navbar|navigation|newsletter|notice|overlay|pagination|popup|promo\w*|recommend\w*|related|replies|reply|respond|search|"
    r"share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|teaser|toolbar|tracking|warning|widget"
)
LAYOUT_WORDS = frozenset("no not non has have with without is hide hides".split())
GOOD_NAMES = re.compile(r"(?i)(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?:$|[\s_-])")
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# A quote belongs to a value only behind an equals sign; elsewhere it is a character like any other.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)(?:>|(?=<)|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Elements that end an open paragraph, and for the others with implied ends: what they end, within what.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
_ROWS = frozenset("tr tbody thead tfoot".split())
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "td": (frozenset("td th".split()), frozenset(["table"]) | _ROWS),
    "th": (frozenset("td th".split()), frozenset(["table"]) | _ROWS),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "tbody": (_ROWS | frozenset("td th".split()), frozenset(["table"])),
    "thead": (_ROWS | frozenset("td th".split()), frozenset(["table"])),
    "tfoot": (_ROWS | frozenset("td th".split()), frozenset(["table"])),
}


def _is_bad(names: str) -> bool:
    """Whether a class or id names an advert, a notice, a menu and the like."""
    for name in names.lower().split():
        words = re.split(r"[_-]+", name)
        if any(BAD_WORDS.fullmatch(w) for w in words) and not LAYOUT_WORDS.intersection(words):
            return True
    return False


def _is_hidden(found: dict[str, str]) -> bool:
    shown = found.get("aria-hidden", "").lower() != "true" and not re.search(r"display\s*:\s*none", found.get("style", ""), re.I)
    return "hidden" in found or not shown


def _attributes(source: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(source)}


class _Page:
    """One pass over a page: blocks as [text, words, link words, article, chrome, bad, good, heading, item]."""

    def __init__(self, source: str):
        self.blocks: list[list] = []
        self.pieces: list[str] = []
        self.link_words = 0
        self.open: list[tuple[str, tuple[int, int, int, int, int]]] = []
        self.state = (0, 0, 0, 0, 0)  # article, chrome, bad, good, dropped
        self.heading = self.item = self.links = 0
        self.read(source)
        self.close()

    def close(self) -> None:
        words = references.unescape("".join(self.pieces)).split() if self.pieces else []
        if words:
            article, chrome, bad, good, _ = self.state
            linked = min(self.link_words, len(words))
            self.blocks.append([" ".join(words), len(words), linked, article, chrome, bad, good, self.heading, self.item])
        self.pieces, self.link_words = [], 0

    def text(self, value: str) -> None:
        if value and not self.state[4]:
            self.pieces.append(value)
            if self.links:
                self.link_words += len(value.split())

    def enter(self, name: str, attributes: str) -> None:
        article, chrome, bad, good, dropped = self.state
        before = self.state
        if name in DROPPED:
            dropped = 1
        elif name in ("article", "main"):
            article = 1
        elif name in CHROME:
            chrome = 1
        # What is said of the whole page says nothing of its parts.
        if attributes.strip() and name not in ("html", "body"):
            found = _attributes(attributes)
            names = " ".join((found.get("class", ""), found.get("id", "")))
            if found.get("role", "").lower() in BAD_ROLES:
                chrome = 1
            if _is_hidden(found):
                dropped = 1
            if _is_bad(names):
                bad = 1
            elif GOOD_NAMES.search(names):
                good = 1
        self.open.append((name, before))
        self.state = (article, chrome, bad, good, dropped)

    def enter_inline(self, name: str, attributes: str) -> None:
        """Hidden text inside a block, and adverts there, are left out."""
        found = _attributes(attributes)
        names = " ".join((found.get("class", ""), found.get("id", "")))
        if _is_hidden(found) or name in ("span", "ins") and _is_bad(names):
            self.open.append((name, self.state))
            self.state = (*self.state[:4], 1)

    def leave_inline(self, name: str) -> None:
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == name:
                self.state = self.open[place][1]
                del self.open[place:]
                return
            if self.open[place][0] not in INLINE:
                return

    def end_implied(self, name: str) -> None:
        """End what an opening ``name`` ends without a closing tag."""
        if name in ENDS_P:
            place = len(self.open) - 1
            while place >= 0 and self.open[place][0] in INLINE:
                place -= 1
            if place >= 0 and self.open[place][0] == "p":
                self.leave("p")
        ended, within = IMPLIED.get(name, ((), ()))
        last = None
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] in within:
                break
            if self.open[place][0] in ended:
                last = place
        if last is not None:
            self.state = self.open[last][1]
            del self.open[last:]

    def leave(self, name: str) -> None:
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == name:
                self.state = self.open[place][1]
                del self.open[place:]
                return

    def read(self, source: str) -> None:
        place, size = 0, len(source)
        while place < size:
            token = _TOKEN.search(source, place)
            if token is None:
                self.text(source[place:])
                return
            self.text(source[place : token.start()])
            place = token.end()
            if token[2] is None:
                continue
            name, closing = token[2].lower(), bool(token[1])
            if name in INLINE:
                if name == "a":
                    self.links = 0 if closing else 1
                if closing:
                    self.leave_inline(name)
                elif token[3].strip() and name not in VOID:
                    self.enter_inline(name, token[3])
                continue
            if name == "br":
                self.pieces.append(" ")
                continue
            self.close()
            self.heading = int(not closing and name in ("h1", "h2", "h3", "h4", "h5", "h6"))
            self.item = int(not closing and name in ("li", "dd", "dt", "td", "th"))
            if closing:
                self.leave(name)
                continue
            self.end_implied(name)
            if name in VOID:
                continue
            if token[3].rstrip().endswith("/"):
                continue
            if name == "body":
                self.leave("head")
            if name in RAW:
                end = re.compile(rf"</{name}", re.I).search(source, place)
                place = size if end is None else end.start()
            self.enter(name, token[3])


def _rows(source: str) -> list[dict]:
    blocks = _Page(source).blocks
    sizes = [min(b[1], 60) for b in blocks]
    links = [b[2] / b[1] for b in blocks]
    out = []
    for i, block in enumerate(blocks):
        before = (sizes[i - 1], links[i - 1]) if i else (0, 0.0)
        after = (sizes[i + 1], links[i + 1]) if i + 1 < len(blocks) else (0, 0.0)
        values = (sizes[i], links[i], *before, *after, *block[3:])
        out.append({"text": block[0], **dict(zip(FEATURES, map(float, values), strict=True))})
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("text", pa.string()), *((name, pa.float64()) for name in FEATURES)]))
    for batch in batches:
        for first in range(0, batch.num_rows, 200):
            part = batch.slice(first, 200)
            found = pa.array([_rows(x.as_py() or "") for x in part.column(2)], kind)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found], names=["page_id", "url", "blocks"])


def blocks(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url and the flat text blocks with their features, in page order."""
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    fields = ", ".join(f"{name}: double" for name in FEATURES)
    return map_batches(rows, _blocks, f"page_id {kinds['page_id']}, url {kinds['url']}, blocks array<struct<text: string, {fields}>>")


def train(spark: SparkSession, labelled=LABELLED, depth: int = 6):
    """Decision tree over the labelled table."""
    rows = [(float(row[-1]), Vectors.dense(row[:-1])) for row in labelled]
    table = spark.createDataFrame(rows, ["label", "features"])
    return DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, maxBins=64, seed=1).fit(table.coalesce(1))


def as_column(model, block: Column) -> Column:
    """The tree as a condition on a block's fields."""

    def build(node) -> Column:
        if node.numDescendants() == 0:
            return F.lit(node.prediction() == 1.0)
        split = node.split()
        low = block[FEATURES[split.featureIndex()]] <= F.lit(float(split.threshold()))
        return F.when(low, build(node.leftChild())).otherwise(build(node.rightChild()))

    return build(model._java_obj.rootNode())


def main_text(pages: DataFrame, model=None, **columns) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Blocks that the tree takes for content, joined in page order by one space; inside a block
    character references are decoded and white space becomes one space. Null or empty html, and
    pages without content, give an empty text. Broken markup ends at the next tag or the end; ends
    that HTML implies are implied. A long page is read whole, in one pass.
    Repeated rows, null ids and null urls come back as they are; an empty table gives no rows;
    other columns are not read.
    """
    model = model or train(pages.sparkSession)
    rows = blocks(pages, **columns)
    kept = F.transform(F.filter("blocks", lambda b: as_column(model, b)), lambda b: b["text"])
    rows = rows.select("page_id", "url", F.array_join(kept, " ").alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
