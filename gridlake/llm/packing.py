"""Packing of tokenised documents by shortest-pack-first over the length histogram.

Documents are cut into pieces of at most one sequence. Only the histogram of piece
lengths (as many numbers as a sequence has tokens) goes to the driver, where lengths
are placed longest first, each into the least filled packs that still take it. Packs
of one content are one pattern with a count, so the work there depends on the sequence
length and not on the data. Each place of a pattern takes a range of the ranks of its
length; a piece finds its sequence by its rank. A piece's rank is its place within its
task plus the counts of the tasks before it, so no length is ranked in one task.
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib
from bisect import insort
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import map_batches, on_release, stage

SEQUENCE = 2048
END_ID = 1
# Words a Python worker remembers; beyond that it starts afresh, with the same ids.
REMEMBERED = 700_000
_RUN = 4 << 20
_MARKS = string.punctuation.encode()


def _all_letters(word: bytes) -> bool:
    """Letters only, also after the tokeniser's normalising: it may leave marks of a letter."""
    return word.isalpha() or (not word.isascii() and unicodedata.normalize("NFC", word.decode()).lower().isalpha())


class WordTokens:
    """Token ids of texts, word by word.

    The tokeniser drops white space and never joins characters across it, so a text's
    ids are those of its words one after another, and each distinct word need only be
    tokenised once. A text that might hold a special token is tokenised whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, words: set[bytes]) -> None:
        letters, others, stopped = [], [], []
        for word in words:
            head = word.rstrip(_MARKS)
            if not head or not _all_letters(head):
                others.append(word)
            elif len(head) == len(word):
                letters.append(word)
            else:
                # Letters, then marks: two runs, whose tokens do not depend on each other.
                stopped.append((word, head, word[len(head) :]))
                if head not in self.known and head not in words:
                    letters.append(head)
        marks = {mark for _, _, mark in stopped}
        others += [mark for mark in marks if mark not in self.known and mark not in words]
        letters = list(dict.fromkeys(letters))
        # A word of letters alone is one run of tokens, and the last one closes it.
        ids = self._ids(b" ".join(letters).decode())
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(letters):
            data, low = ids.tobytes(), 0
            for word, end in zip(letters, (ends * 4).tolist(), strict=True):
                self.known[word] = data[low:end]
                low = end
        else:
            others += letters
        for word, found in zip(others, self.tokenizer.encode_batch([w.decode() for w in others], add_special_tokens=False), strict=True):
            self.known[word] = np.array(found.ids, "<u4").tobytes()
        for word, head, mark in stopped:
            self.known[word] = self.known[head] + self.known[mark]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        get = self.known.__getitem__
        out: list[bytes] = []
        unsure: list[tuple[int, list[bytes]]] = []  # texts with words not seen before
        for k, text in enumerate(texts):
            if "<|" in text:
                out.append(self._ids(text).tobytes())
                continue
            words = text.encode().lower().split()
            try:
                out.append(b"".join(map(get, words)))
            except KeyError:
                out.append(b"")
                unsure.append((k, words))
        if unsure:
            self._learn(set().union(*(words for _, words in unsure)).difference(self.known))
            for k, words in unsure:
                out[k] = b"".join(map(get, words))
        return out


_LOADED: dict[str, WordTokens] = {}


def _forget() -> None:
    for tokens in _LOADED.values():
        tokens.known.clear()


on_release(__name__, _forget)


def word_tokens(path: str) -> WordTokens:
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


def cut(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    sequence: int = SEQUENCE,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``sequence`` tokens: doc_id, start, length, ids_crc32,
    doc_tokens, task, place and, if asked for, ``ids`` (little-endian 32-bit).

    A document's ids end with END_ID; a null or empty text has that id alone.
    Repeated rows and null ids are documents like any other. ``place`` counts the
    pieces of the same length in the same task; the table is written, so a task that
    runs again cannot change it for later steps.
    """
    tail = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(sequence + 1, np.int64)
        for batch in batches:
            texts = batch.column(1)
            first = 0
            while first < len(texts):
                chunk, size = [], 0
                while first + len(chunk) < len(texts) and size < _RUN:
                    chunk.append(texts[first + len(chunk)].as_py() or "")
                    size += len(chunk[-1])
                rows = []
                for k, ids in enumerate(tokens.encode(chunk)):
                    ids += tail
                    total = len(ids) // 4
                    for start in range(0, total, sequence):
                        piece = ids[4 * start : 4 * (start + sequence)]
                        length = len(piece) // 4
                        rows.append((first + k, start, length, zlib.crc32(piece), total, seen[length], piece))
                        seen[length] += 1
                columns = list(zip(*rows, strict=True))
                arrays = [batch.column(0).take(pa.array(columns[0]))]
                arrays += [pa.array(np.array(column, np.int64)) for column in columns[1:6]]
                arrays.append(pa.array(np.full(len(rows), task, np.int64)))
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place", "task"]
                if with_ids:
                    arrays.append(pa.array(columns[6], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                first += len(chunk)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, place long, task long"
    schema += ", ids binary" if with_ids else ""
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return stage(map_batches(docs, run, schema), "pieces")


def shortest_pack_first(histogram: Mapping[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order of placing) and how often each is used."""
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by filled length
    filled: list[int] = []

    def add(used: int, pattern: tuple[int, ...], count: int) -> None:
        if not open_packs[used]:
            insort(filled, used)
        open_packs[used].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            if filled and filled[0] + length <= sequence:
                used = filled[0]
                pattern, count = open_packs[used].pop()
                if not open_packs[used]:
                    filled.pop(0)
                taken = min(left, count)
                if count > taken:
                    add(used, pattern, count - taken)
                add(used + length, (*pattern, length), taken)
            else:
                # New packs take as many pieces of this length as fit at once.
                each = max(1, min(sequence // length, left))
                taken = left // each
                add(each * length, (length,) * each, taken)
                left -= taken * (each - 1)
            left -= taken
    return [entry for used in filled for entry in open_packs[used]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Ranges of ranks per length: (length, low, sequence of the first, offset), sorted."""
    used: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], first, offset))
            used[length] += count
            offset += length
        first += count
    rows.sort()
    names = ("length", "low", "first", "offset")
    return {n: np.array([r[k] for r in rows], np.int64) for k, n in enumerate(names)}


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` with sequence_id and offset; every row of ``pieces`` comes back once.

    Pieces of one sequence lie at offsets without gaps from 0.
    """
    counts = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("pieces")), "piece-counts")
    histogram = {r["length"]: r["pieces"] for r in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    table = slots(shortest_pack_first(histogram, sequence))
    starts = (table["length"] << 44) + table["low"]
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base"))
    names = [c for c in pieces.columns if c not in ("task", "place")]
    ranked = pieces.join(bases, ["length", "task"]).select(*names, (F.col("base") + F.col("place")).alias("rank"))
    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(starts, (length << 44) + rank, "right") - 1
            sequence_id = pa.array(table["first"][at] + rank - table["low"][at])
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, sequence_id, pa.array(table["offset"][at])], names=[*names, "sequence_id", "offset"])

    return map_batches(ranked, run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, with_ids: bool = False, **columns) -> DataFrame:
    """Tokenise, cut and pack: the pieces with their sequence and offset. No documents, no pieces."""
    return pack(cut(docs, tokenizer_path, sequence=sequence, with_ids=with_ids, **columns), sequence)
