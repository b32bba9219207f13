"""Alignment of two tokenisations against whole texts tokenised at once and all ranges compared."""

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridlake.llm import alignment, queries

PATHS = [str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
NONE = {"n_a": 0, "n_b": 0, "n_groups": 0, "links": [], "groups": ""}


class Brute:
    """Tokenises a text in one piece and compares all byte ranges nearby."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        letters = {}
        free = 256
        for byte in range(256):
            if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
                letters[chr(byte)] = byte
            else:
                letters[chr(free)] = byte
                free += 1
        vocabulary = json.load(open(PATHS[0]))["model"]["vocab"]
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if all(c in letters for c in t)}

    def piece(self, i):
        text = self.b.id_to_piece(i)
        return bytes.fromhex(text[3:5]) if len(text) == 6 and text.startswith("<0x") else text.replace("▁", " ").encode()

    def align(self, text):
        if not text:
            return NONE
        raw = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes, b_bytes = [self.a_bytes[i] for i in a], [self.piece(i) for i in b]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return NONE
        ranges = []
        for parts in (a_bytes, b_bytes):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            ranges.append(list(zip([0, *ends[:-1]], ends, strict=True)))
        links, low = [], 0
        for i, (x, y) in enumerate(ranges[0]):
            while ranges[1][low][1] <= x:
                low += 1
            j = low
            while j < len(b) and ranges[1][j][0] < y:
                links.append((i, j))
                j += 1
        groups, i, j = [], 0, 0
        ends = [{y for _, y in r} for r in ranges]
        for cut in sorted(ends[0] & ends[1]):
            k = next(k for k in range(i, len(a)) if ranges[0][k][1] == cut) + 1
            m = next(m for m in range(j, len(b)) if ranges[1][m][1] == cut) + 1
            groups.append(f"{','.join(map(str, a[i:k]))}|{','.join(map(str, b[j:m]))}")
            i, j = k, m
        return {"n_a": len(a), "n_b": len(b), "n_groups": len(groups), "links": [(i, j, a[i], b[j]) for i, j in links], "groups": ";".join(groups)}


@pytest.fixture(scope="module")
def brute():
    return Brute()


def expected(brute, texts):
    found = [brute.align(t) for t in texts]
    counts = Counter((x[2], x[3]) for f in found for x in f["links"])
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [
        (
            f["n_a"],
            f["n_b"],
            f["n_groups"],
            len(f["links"]),
            sum(counts[x[2], x[3]] == top[x[3]] for x in f["links"]),
            sum(counts[x[2], x[3]] for x in f["links"]),
            hashlib.sha256(f["groups"].encode()).hexdigest() if f["groups"] else "",
        )
        for f in found
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "The quick brown fox, jumps over the lazy dog.",
    "",
    None,
    " ",
    "   three  spaces   inside and behind   ",
    "tabs\tand\nlines\r\n\n and  more\n",
    "Größe naïve café — “quotes” … 北京市 🙂🙃 ﬁ ́e",
    "mark ▁ inside",
    "ends with mark▁ next",
    "<|endoftext|> and <s> </s> <unk> <0x41> stay text",
    "no-break space   x　y   z​\x00\x1c \x1f w",
    "it's we'll  I'd 'tis 123456 3.14159 a1b2c3",
    "word " * 500,
    "x" * 3000,
    "The quick brown fox, jumps over the lazy dog.",
    "﻿bom",
]


def test_texts(spark, brute):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = alignment.align(docs, *PATHS).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == expected(brute, TEXTS)
    assert [r["groups"] for r in rows] == [brute.align(t)["groups"] for t in TEXTS]
    assert rows[7]["n_a"] == 0 and rows[0]["n_links"] > 0


def test_links_by_position(spark, brute):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = alignment.token_links(docs, *PATHS).collect()
    true = sorted((k, *x) for k, t in enumerate(TEXTS) for x in brute.align(t)["links"])
    assert sorted(tuple(r) for r in rows) == true
    shared = alignment.token_links(docs, *PATHS, shared="groups").collect()
    by_group = []
    for k, t in enumerate(TEXTS):
        i = j = 0
        for group in filter(None, brute.align(t)["groups"].split(";")):
            a, b = (side.split(",") for side in group.split("|"))
            by_group += [(k, i + x, j + y, int(p), int(q)) for x, p in enumerate(a) for y, q in enumerate(b)]
            i, j = i + len(a), j + len(b)
    assert sorted(tuple(r) for r in shared) == sorted(by_group)
    counts = {(r["a_id"], r["b_id"]): r["n"] for r in alignment.pair_counts(alignment.token_links(docs, *PATHS)).collect()}
    assert counts == Counter((x[3], x[4]) for x in true)
    with pytest.raises(ValueError, match="bytes or groups"):
        alignment.token_links(docs, *PATHS, shared="words")


def test_product_of_sparse_matrices():
    draw = np.random.default_rng(2)
    for _ in range(30):
        left, right = (draw.random((draw.integers(1, 9), 7)) < 0.3 for _ in range(2))
        rows = [alignment.Incidence(np.cumsum(m.sum(axis=1)), np.nonzero(m)[1]) for m in (left, right)]
        out = alignment.product(rows[0], rows[1].transposed(7))
        dense = (left.astype(int) @ right.T.astype(int)) > 0
        assert out.columns.tolist() == np.nonzero(dense)[1].tolist()
        assert out.ends.tolist() == np.cumsum(dense.sum(axis=1)).tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"aAb1 .,'\n\t <", "  ", " the", " 2", "é", "\u00a0", "\u3000", "北", "🙂", "▁", "\x1c", "\x85"]), max_size=40).map("".join))
def test_chunks_give_the_tokens_of_the_whole(text):
    tokens = alignment.load(*PATHS)
    parts = tokens.chunks(text)
    assert " ".join(parts) == text
    a, b = tokens.ids(text)
    by_part = [tokens.ids(p) for p in parts]
    assert [i for x, _ in by_part for i in x] == a or not text
    if "▁" not in text and text:
        assert [i for _, x in by_part for i in x] == b


def test_odd_tables(spark):
    rows = [(None, "one text", 1, "x"), (1, "one text", 2, "x"), (1, "one text", 3, "x"), (1, "other", 4, "x"), (2, None, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int, data string")
    out = alignment.align(docs, *PATHS)
    assert out.columns == ["doc_id", *COLUMNS, "groups"]
    assert out.count() == 5
    assert out.where("doc_id = 1 and n_a > 0").count() == 3 and out.where("doc_id is null and n_links > 0").count() == 1
    assert alignment.align(docs.limit(0), *PATHS).count() == 0
    named = docs.select(F.col("data").alias("name"), F.col("text").alias("body"))
    assert alignment.align(named, *PATHS, id_column="name", text_column="body").select("name").distinct().count() == 1


def test_query_against_brute_force(spark, brute):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").orderBy("doc_id").collect()
    rows = queries.op12_alignment(spark, path).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == expected(brute, [d["text"] for d in docs])
