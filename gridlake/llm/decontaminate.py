"""Benchmark decontamination as a prefix-filtered set join.

A window is ``n`` consecutive words of a benchmark item, or the whole of a shorter
item. Containment is exact, so every token of a window is necessary and a prefix of
one token is enough: the one that is rarest in the documents. Steps:

1. count the words of the items in the documents and choose each window's rarest;
2. find these tokens in the documents, each with the words around it;
3. join token to window, keep what lies inside the document (positional and length
   bounds), and compare all words of the window.

Both passes over the texts first test a bitmap of fixed size made from the hashes
of the words looked for. It is the only thing sent to all tasks, its size does not
depend on the data, and it never drops a true match; joins on the words follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import ascii_lower, stage

# ASCII characters that end a word, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"
BITMAP_BITS = 1 << 18


def words_of(text: Column) -> Column:
    """Splitting is several times faster than extracting; before the first and after the last
    separator it may leave an empty string."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN), "")


def _place(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BITMAP_BITS))


def _bitmap(words: DataFrame) -> Column:
    """The bitmap of the column ``word`` as a constant of BITMAP_BITS bits."""
    place = _place(F.col("word"))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    longs = words.select(place.alias("place")).groupBy(F.floor(F.col("place") / 64).alias("at")).agg(F.bit_or(bit).alias("bits"))
    values = [0] * (BITMAP_BITS // 64)
    for row in longs.collect():  # at most BITMAP_BITS / 64 rows
        values[row["at"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _in(bitmap: Column, word: Column) -> Column:
    def test(place: Column) -> Column:
        bits = F.get(bitmap, F.shiftright(place, 6).cast("int"))
        return F.call_function("shiftright", bits, place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test(_place(word))


def item_windows(items: DataFrame, id_column: str, text_column: str, n: int) -> DataFrame:
    """(item_id, window) for all windows of all items with a word and an id."""
    rows = items.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("item_id"), words_of(F.col(text_column)).alias("words")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
    rows = rows.where(F.size("words") > 0).select("item_id", "words", F.explode(starts).alias("start"))
    return rows.select("item_id", F.slice("words", F.col("start"), n).alias("window")).distinct()


def contaminated_documents(
    docs: DataFrame,
    items: DataFrame,
    n: int = 13,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, item_ids (sorted strings).

    A null or empty text has no words, and an item without words or id has no
    windows. Documents are told apart by id and text (``text_key`` is the text's
    hash), so rows that share an id or have none are judged on their own, and
    repeated rows each get the same answer. Empty tables give no rows or no hits.
    Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    windows = stage(item_windows(items, item_id, item_text, n), "item-windows")
    wanted = windows.select(F.explode("window").alias("word")).distinct()
    known = _bitmap(wanted)
    seen = docs.select(F.explode(words_of(F.col("text"))).alias("word")).where(_in(known, F.col("word")))
    seen = seen.groupBy("word").agg(F.count("*").alias("seen"))
    rarity = windows.select("window").distinct().select("window", F.posexplode("window").alias("shift", "word"))
    rarity = rarity.join(seen, "word")  # a word that no document has rules its windows out
    whole = rarity.groupBy("window").agg(
        F.count("*").alias("found"), F.min(F.struct("seen", "word", "shift")).alias("rarest")
    )
    prefixes = stage(
        whole.where(F.col("found") == F.size("window")).select("window", F.col("rarest.word").alias("token"), F.col("rarest.shift").alias("shift")),
        "window-prefixes",
    )
    tokens = _bitmap(prefixes.select(F.col("token").alias("word")))

    worded = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    places = F.when(
        F.size("words") > 0,
        F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: _in(tokens, F.get("words", i))),
    ).otherwise(F.array().cast("array<int>"))
    around = F.transform(
        F.col("places"),
        lambda i: F.struct(
            i.alias("place"),
            F.least(i, F.lit(n - 1)).alias("at"),
            F.slice("words", F.greatest(i - n + 2, F.lit(1)), F.least(i, F.lit(n - 1)) + n).alias("around"),
        ),
    )
    base = stage(
        worded.select("doc_id", "text_key", "words", places.alias("places")).select(
            "doc_id", "text_key", F.size("words").cast("long").alias("n_words"), around.alias("found")
        ),
        "token-places",
    )
    near = base.where(F.size("found") > 0).select("doc_id", "text_key", "n_words", F.explode("found").alias("f"))
    near = near.select("doc_id", "text_key", "n_words", "f.*", F.get("f.around", F.col("f.at")).alias("token")).distinct()
    start, size = F.col("place") - F.col("shift"), F.size("window")
    hits = (
        near.join(prefixes, "token")
        .where((start >= 0) & (start + size <= F.col("n_words")))
        .where(F.slice("around", F.col("at") - F.col("shift") + 1, size) == F.col("window"))
        .select("doc_id", "text_key", start.alias("start"), size.alias("size"), "window")
    )
    hits = stage(hits, "window-hits")
    covered = hits.select("doc_id", "text_key", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("place"))
    covered = covered.groupBy("doc_id", "text_key", "place").agg(F.lit(1).alias("one"))
    covered = covered.groupBy("doc_id", "text_key").agg(F.count("*").alias("n_hit"))
    named = hits.select("doc_id", "text_key", "window").distinct().join(windows, "window")
    named = named.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")
    )
    result = base.select("doc_id", "text_key", "n_words")
    for part in (covered, named):
        part = part.withColumnsRenamed({"doc_id": "part_id", "text_key": "part_key"})
        match = result.doc_id.eqNullSafe(part.part_id) & (result.text_key == part.part_key)
        result = result.join(part, match, "left").drop("part_id", "part_key")
    return result.select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def is_contaminated() -> Column:
    """A twentieth or more of the words lie in benchmark windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
