"""Alignment of two tokenisations of one text by products of sparse incidence matrices.

Method. A text's bytes are cut twice, into tokens of A and into tokens of B. Each cut is an
incidence matrix of tokens and bytes in compressed rows (``Incidence``: row ends, columns). The
product A B^T, row by row after Gustavson, gives the pairs of tokens that share a byte: the
links. Bytes at which a token of A and one of B end together close a group; the products of the
token-group incidences give the pairs of tokens of one group.

Neither tokeniser joins characters across a single space between two visible characters: A splits
before it, and no piece of B has its space mark behind another character (checked when loading).
So a text is a sequence of chunks, and the corpus a product of three matrices: documents x chunks,
chunks x id pairs, and id pairs x values. A task handles blocks of documents; in a block every
distinct chunk is tokenised and multiplied once. The pairs' counts are summed over all blocks by
Spark and come back to the blocks that hold the pair, so nothing that grows with the corpus is
held in one place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import map_batches, stage

# Bytes of text in a block, and of distinct chunks that are multiplied together.
BLOCK_BYTES = 12 << 20
_BATCH_BYTES = 1 << 20
# Room for ids of B in the number of a pair.
PAIR_BASE = 1 << 20

# The mark that stands for a space in pieces, and the form of byte pieces.
SPACE_MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_CHUNK = re.compile(r"(?<=\S)(?= \S)")
_ODD_SPACE = re.compile(r"^\s|\s$|\s | \s")


@dataclass
class Incidence:
    """Compressed rows: row ``i`` has a one in ``columns[ends[i - 1]:ends[i]]``."""

    ends: np.ndarray
    columns: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1]))

    def transposed(self, width: int) -> Incidence:
        rows = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        order = np.argsort(self.columns, kind="stable")
        return Incidence(np.cumsum(np.bincount(self.columns, minlength=width)), rows[order])


def product(left: Incidence, right: Incidence) -> Incidence:
    """Pattern of ``left`` times ``right``, row by row: the rows of ``right`` that a row of
    ``left`` names are gathered, and columns met before in that row are dropped."""
    starts = right.starts[left.columns]
    counts = right.ends[left.columns] - starts
    owner = np.repeat(np.arange(len(left.ends)), np.diff(left.ends, prepend=0))
    rows = np.repeat(owner, counts)
    steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    columns = right.columns[np.repeat(starts, counts) + steps]
    if len(rows) and not (np.diff(rows * (int(columns.max()) + 1) + columns) >= 0).all():
        order = np.lexsort((columns, rows))
        rows, columns = rows[order], columns[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
    rows, columns = rows[fresh], columns[fresh]
    return Incidence(np.cumsum(np.bincount(rows, minlength=len(left.ends))), columns)


def token_bytes(ends: np.ndarray) -> Incidence:
    """Tokens that end at ``ends`` and the bytes they cover."""
    return Incidence(ends, np.arange(ends[-1] if len(ends) else 0))


def token_groups(ends: np.ndarray, cuts: np.ndarray) -> Incidence:
    """Tokens and the groups (between ``cuts``) they lie in."""
    return Incidence(np.arange(1, len(ends) + 1), np.searchsorted(cuts, ends))


class Tokens:
    """The two tokenisers: ids of strings, and the bytes behind every id."""

    def __init__(self, byte_path: str, piece_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        # The byte-level alphabet: visible Latin-1 characters stand for themselves, the other
        # bytes, in order, for the characters from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in own]
        letter = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}
        vocabulary = self.a.get_vocab()
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = []
        for piece in pieces:
            byte = BYTE_PIECE.fullmatch(piece)
            b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_MARK, " ").encode())
        # Without this property a text is one chunk.
        self.by_chunk = not any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in pieces)
        self.a_table, self.b_table = _Table(a_bytes), _Table(b_bytes)
        self.a_names, self.b_names = ([str(i) for i in range(len(t))] for t in (a_bytes, b_bytes))

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A for a space and ``text``, and of B for ``text``, which adds the space itself."""
        return self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)

    def chunks(self, text: str) -> list[str]:
        """Parts of ``text`` between the single spaces at which no token crosses."""
        if not self.by_chunk or SPACE_MARK in text:
            return [text]
        if not _ODD_SPACE.search(text):
            return text.split(" ")
        return [part[1:] for part in _CHUNK.split(" " + text)]


class _Table:
    """Bytes of all ids in one array."""

    def __init__(self, entries: list[bytes]):
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.sizes = np.array([len(e) for e in entries])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.sizes[ids])

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        steps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.data[np.repeat(self.starts[ids], sizes) + steps]


@dataclass
class Aligned:
    """Alignment of a byte string: ids, ends, cuts of the groups, and links (positions of A, of B)."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    cuts: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align_ids(tokens: Tokens, raw: bytes, a: list[int], b: list[int]) -> Aligned | None:
    """The alignment, or None where the tokens' bytes are not ``raw``."""
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    data = np.frombuffer(raw, np.uint8)
    if not all(np.array_equal(t.bytes_of(ids), data) for t, ids in ((tokens.a_table, a), (tokens.b_table, b))):
        return None
    a_ends, b_ends = tokens.a_table.ends(a), tokens.b_table.ends(b)
    links = product(token_bytes(a_ends), token_bytes(b_ends).transposed(len(data)))
    link_a = np.repeat(np.arange(len(a)), np.diff(links.ends, prepend=0))
    return Aligned(a, b, a_ends, b_ends, np.intersect1d(a_ends, b_ends), link_a, links.columns)


def group_links(found: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of A, of B) of the tokens that lie in one group."""
    ga, gb = (token_groups(ends, found.cuts) for ends in (found.a_ends, found.b_ends))
    links = product(ga, gb.transposed(len(found.cuts)))
    return np.repeat(np.arange(len(found.a)), np.diff(links.ends, prepend=0)), links.columns


class Chunks:
    """Distinct chunks of a block: sizes, id pairs of their links, and their groups as text."""

    def __init__(self, tokens: Tokens, chunks: list[str]):
        self.tokens = tokens
        self.sizes = np.zeros((len(chunks), 4), np.int64)  # tokens of A, of B, groups, links
        self.valid = np.zeros(len(chunks), bool)
        self.groups: list[bytes] = [b""] * len(chunks)
        pairs, owners = [], []
        for places, found in self._aligned(chunks):
            pairs.append(found.a[found.link_a] * PAIR_BASE + found.b[found.link_b])
            owners.append(self._store(places, found, chunks))
        self.pairs = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
        self.owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)

    def _aligned(self, chunks: list[str]):
        """(places, alignment) of runs of chunks, each run tokenised as one text."""
        plain, odd = [], []
        for k, chunk in enumerate(chunks):
            # Only between such chunks is a space sure to part tokens.
            regular = self.tokens.by_chunk and chunk and not chunk[0].isspace() and not chunk[-1].isspace()
            (plain if regular and SPACE_MARK not in chunk else odd).append(k)
        for run in _runs_of(plain, chunks):
            yield from self._try(run, chunks)
        for k in odd:
            yield from self._try([k], chunks)

    def _try(self, run: list[int], chunks: list[str]):
        text = " ".join([chunks[k] for k in run])
        found = align_ids(self.tokens, (" " + text).encode(), *self.tokens.ids(text))
        if found is not None:
            self.valid[run] = True
            yield run, found
        elif len(run) > 1:  # some chunk is not its tokens' bytes
            half = len(run) // 2
            yield from self._try(run[:half], chunks)
            yield from self._try(run[half:], chunks)

    def _store(self, run: list[int], found: Aligned, chunks: list[str]) -> np.ndarray:
        """Sizes and groups of the run's chunks; the chunk of every link."""
        ends = np.cumsum([len(chunks[k].encode()) + 1 for k in run])
        at = np.array(run)
        if not np.isin(ends, found.cuts).all():
            raise ValueError("a token crosses the space between two chunks")
        for k, these in enumerate((found.a_ends, found.b_ends, found.cuts)):
            self.sizes[at, k] = np.diff(np.searchsorted(these, ends, "right"), prepend=0)
        owner = np.searchsorted(ends, found.a_ends[found.link_a], "left")
        self.sizes[at, 3] = np.bincount(owner, minlength=len(run))
        a = [self.tokens.a_names[i] for i in found.a.tolist()]
        b = [self.tokens.b_names[i] for i in found.b.tolist()]
        a_cuts = np.searchsorted(found.a_ends, found.cuts, "right").tolist()
        b_cuts = np.searchsorted(found.b_ends, found.cuts, "right").tolist()
        texts, i, j = [], 0, 0
        for x, y in zip(a_cuts, b_cuts, strict=True):
            texts.append(f"{a[i] if x == i + 1 else ','.join(a[i:x])}|{b[j] if y == j + 1 else ','.join(b[j:y])}")
            i, j = x, y
        first = 0
        for k, last in zip(run, np.searchsorted(found.cuts, ends, "right").tolist(), strict=True):
            self.groups[k] = (texts[first] if last == first + 1 else ";".join(texts[first:last])).encode()
            first = last
        return at[owner]


def _runs_of(places: list[int], chunks: list[str]) -> Iterator[list[int]]:
    run, size = [], 0
    for k in places:
        run.append(k)
        size += len(chunks[k]) + 1
        if size >= _BATCH_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


_LOADED: dict[tuple[str, str], Tokens] = {}


def load(byte_path: str, piece_path: str) -> Tokens:
    if (byte_path, piece_path) not in _LOADED:
        _LOADED[byte_path, piece_path] = Tokens(byte_path, piece_path)
    return _LOADED[byte_path, piece_path]


# Rows of a block, in the order in which the block is finished: values of its pairs, the matrix of
# chunks and pairs, the documents.
_PAIR, _MATRIX, _DOCUMENT = 0, 1, 2
_COLUMNS = {
    "at": pa.int64(),
    "pair": pa.int64(),
    "n": pa.int64(),
    "sizes": pa.list_(pa.int64()),
    "digest": pa.string(),
    "groups": pa.string(),
    "data": pa.binary(),
}


def _blocks(byte_path: str, piece_path: str, with_groups: bool):
    """Rows (id, text) to the rows of their blocks."""

    def finish(tokens: Tokens, block: int, ids: pa.Array, texts: list[str]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        parts = []
        for text in texts:
            chunks = tokens.chunks(text) if text else []
            parts.append(np.fromiter([known.setdefault(c, len(known)) for c in chunks], np.int64, len(chunks)))
        chunks = Chunks(tokens, list(known))
        good = [len(p) > 0 and bool(chunks.valid[p].all()) for p in parts]
        parts = [p if ok else p[:0] for p, ok in zip(parts, good, strict=True)]
        uses = np.bincount(np.concatenate(parts), minlength=len(known))
        # Chunks x pairs in compressed rows; the pairs of unused chunks do not count.
        used = uses[chunks.owners] > 0
        order = np.argsort(chunks.owners[used], kind="stable")
        owners, pairs = chunks.owners[used][order], chunks.pairs[used][order]
        unique, columns = np.unique(pairs, return_inverse=True)
        n = np.bincount(columns, weights=uses[owners], minlength=len(unique)).astype(np.int64)
        nobody = pa.nulls(1, ids.type)
        yield _rows(block, _PAIR, nobody.take(pa.array(np.zeros(len(unique), np.int64))), at=np.arange(len(unique)), pair=unique, n=n)
        ends = np.cumsum(np.bincount(owners, minlength=len(known)))
        matrix = len(known).to_bytes(8, "little") + ends.astype(np.int64).tobytes() + columns.astype(np.int32).tobytes()
        yield _rows(block, _MATRIX, nobody, at=[0], data=[matrix])
        for first in range(0, len(texts), 2000):
            some = range(first, min(first + 2000, len(texts)))
            joined = [b";".join([chunks.groups[c] for c in parts[k].tolist()]) for k in some]
            yield _rows(
                block,
                _DOCUMENT,
                ids[some.start : some.stop],
                at=np.arange(some.start, some.stop),
                sizes=[chunks.sizes[parts[k]].sum(axis=0) for k in some],
                digest=[hashlib.sha256(g).hexdigest() if good[k] else "" for k, g in zip(some, joined, strict=True)],
                groups=[g.decode() for g in joined] if with_groups else None,
                data=[parts[k].astype(np.int32).tobytes() for k in some],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, block = load(byte_path, piece_path), TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            first = 0
            for k, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    ids.append(batch.column(0).slice(first, k + 1 - first))
                    yield from finish(tokens, block, pa.concat_arrays(ids), texts)
                    ids, texts, size, block, first = [], [], 0, block + 1, k + 1
            ids.append(batch.column(0).slice(first))
        if texts:
            yield from finish(tokens, block, pa.concat_arrays(ids), texts)

    return run


def _rows(block: int, kind: int, ids: pa.Array, **columns) -> pa.RecordBatch:
    arrays = [ids, pa.array(np.full(len(ids), block)), pa.array(np.full(len(ids), kind, np.int32))]
    for name, of in _COLUMNS.items():
        given = columns.get(name)
        arrays.append(pa.nulls(len(ids), of) if given is None else pa.array(given, of))
    return pa.RecordBatch.from_arrays(arrays, names=["id", "block", "kind", *_COLUMNS])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks in order to documents: sums of the values of their links' pairs."""
    block, counts, tops, by_chunk = None, [], [], None
    for batch in batches:
        blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
        for first, last in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if first == last:
                continue
            part = batch.slice(first, last - first)
            if blocks[first] != block:
                block, counts, tops, by_chunk = blocks[first], [], [], None
            if kinds[first] == _PAIR:
                counts.append(part.column("n").to_numpy())
                tops.append(part.column("top").to_numpy())
            elif kinds[first] == _MATRIX:
                raw = part.column("data")[0].as_py()
                size = int.from_bytes(raw[:8], "little")
                ends = np.frombuffer(raw, np.int64, size, 8)
                columns = np.frombuffer(raw[8 + 8 * size :], np.int32)
                n, top = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (counts, tops))
                best = n == top
                starts = np.concatenate(([0], ends[:-1]))[:size]
                by_chunk = []
                for values in (best.astype(np.int64), n):
                    sums = np.concatenate(([0], np.cumsum(values[columns])))
                    by_chunk.append(sums[ends] - sums[starts])
            else:
                lists = [np.frombuffer(x.as_buffer(), np.int32) for x in part.column("data")]
                sums = [pa.array([int(values[x].sum()) for x in lists], pa.int64()) for values in by_chunk]
                kept = [part.column(n) for n in ("id", "sizes", "digest", "groups")]
                yield pa.RecordBatch.from_arrays([*kept, *sums], names=["id", "sizes", "digest", "groups", "n_best", "count_sum"])


def align(
    docs: DataFrame, byte_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text", with_groups: bool = True
) -> DataFrame:
    """One row per input row: the id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 and, if asked for, ``groups`` (ids of A and B per group, as
    ``a1,a2|b1;a3|b2``).

    An id pair's count is the number of links of all documents that hold it. ``n_best`` are
    the links whose count is the highest of their id of B, ties included; ``count_sum`` adds
    the counts of all links. A text that is null or empty, or that the tokens of A or B do not
    give back byte by byte with a space before it, has no tokens: zeros and empty strings.
    Repeated rows and null ids are documents of their own. A long text is held whole. An empty
    table gives no rows; other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = (
        f"id {kind}, block long, kind int, at long, pair long, n long, sizes array<long>, digest string, groups string, data binary"
    )
    rows = stage(map_batches(docs, _blocks(byte_path, piece_path, with_groups), schema), "alignment-blocks")
    pairs = rows.where(f"kind = {_PAIR}").select("block", "at", "pair", "n")
    totals = stage(pairs.groupBy("pair").agg(F.sum("n").alias("total")), "alignment-pairs")
    # One row per id of B: no more than the vocabulary.
    piece = F.pmod("pair", F.lit(PAIR_BASE))
    highest = totals.groupBy(piece.alias("b")).agg(F.max("total").alias("top"))
    values = totals.join(F.broadcast(highest), piece == F.col("b")).select("pair", "total", "top")
    values = pairs.join(values, "pair").select("block", F.lit(_PAIR).alias("kind"), "at", F.col("total").alias("n"), "top")
    rest = rows.where(f"kind <> {_PAIR}").select("block", "kind", "at", "id", "sizes", "digest", "groups", "data")
    ordered = values.unionByName(rest, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind", "at")
    ordered = ordered.select("id", "block", "kind", "n", "top", "sizes", "digest", "groups", "data")
    out = map_batches(
        ordered, _finish, f"id {kind}, sizes array<long>, digest string, groups string, n_best long, count_sum long"
    )
    sizes = [F.col("sizes")[k].alias(name) for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))]
    columns = [F.col("id").alias(id_column), *sizes, "n_best", "count_sum", F.col("digest").alias("groups_sha256")]
    return out.select(*columns, *([F.coalesce("groups", F.lit("")).alias("groups")] if with_groups else []))


def token_links(
    docs: DataFrame, byte_path: str, piece_path: str, shared: str = "bytes", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row per link: the id, a_at and b_at (positions of the tokens in the text), a_id, b_id.

    ``shared`` says what linked tokens have in common: "bytes", or "groups" for all pairs of a
    group. Texts without tokens have no rows; other cases as in :func:`align`.
    """
    if shared not in ("bytes", "groups"):
        raise ValueError(f"tokens share bytes or groups, not {shared}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(byte_path, piece_path)
        for batch in batches:
            for k, text in enumerate(batch.column(1)):
                text = text.as_py()
                found = align_ids(tokens, (" " + text).encode(), *tokens.ids(text)) if text else None
                if found is None:
                    continue
                a_at, b_at = (found.link_a, found.link_b) if shared == "bytes" else group_links(found)
                ids = batch.column(0).take(pa.array(np.full(len(a_at), k)))
                places = [pa.array(x, pa.int64()) for x in (a_at, b_at, found.a[a_at], found.b[b_at])]
                yield pa.RecordBatch.from_arrays([ids, *places], names=["id", "a_at", "b_at", "a_id", "b_id"])

    kind = docs.schema[id_column].dataType.simpleString()
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    out = map_batches(docs, run, f"id {kind}, a_at long, b_at long, a_id long, b_id long")
    return out.withColumnRenamed("id", id_column)


def pair_counts(links: DataFrame) -> DataFrame:
    """How many links hold each pair of ids: a_id, b_id, n."""
    return links.groupBy("a_id", "b_id").agg(F.count("*").alias("n"))

