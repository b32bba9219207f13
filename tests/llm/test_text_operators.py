"""Operators on documents against brute force, with the odd cases of every column."""

import hashlib
import re
import zlib

import pytest
from brute_text import brute_repeats, lower, words_of
from pyspark.sql import functions as F

from gridlake.llm import (
    decontaminate,
    language,
    near_dedup,
    packing,
    pii,
    quality_rules,
    substring_dedup,
    suffix_dedup,
)


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and odd texts, copies, repeated rows, a long text, a clashing column."""
    base = " ".join(f"w{i} word{i * 7 % 90}" for i in range(60))
    near = base.replace("w30 ", "other ")
    table = [
        (1, base, "en"),
        (2, base, "en"),
        (3, near, "en"),
        (4, "Short text", None),
        (5, None, "en"),
        (6, "", "fr"),
        (7, " \t\n ", "fr"),
        (8, "x " + base + " tail é ü", "fr"),
        (9, "lorem ipsum dolor " * 700, "fr"),
        (9, "lorem ipsum dolor " * 700, "fr"),
        (None, "a row without an id " * 9, None),
        (11, "call +1 (017) 555-7713 or mail a.b@mail.example.com, 10.0.0.256 10.0.0.1; 4111 1111 1111 1111", "en"),
    ]
    rows = [(i, t, lang, "s", 0, "clash") for i, t, lang in table]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, words string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


def test_repeated_bytes(docs, empty):
    rows = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    want = brute_repeats([(d, t) for d, t in rows.items() if d is not None], 50)
    got = suffix_dedup.remove_repeated_bytes(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        text, gone = rows[r.doc_id], want.get(r.doc_id, set())
        assert bytes(r.kept) == bytes(b for i, b in enumerate(text) if i not in gone)
        assert (r.n_units, r.n_removed) == (len(text), len(gone))
        assert r.n_spans == sum(i - 1 not in gone for i in gone)
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0


def test_repeated_words(docs, empty):
    rows = {r.doc_id: tuple(words_of(r.text)) for r in docs.collect()}
    want = brute_repeats([(d, t) for d, t in rows.items() if d is not None], 13)
    got = substring_dedup.remove_repeated_words(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        gone = want.get(r.doc_id, set())
        assert bytes(r.kept).decode() == " ".join(w for i, w in enumerate(rows[r.doc_id]) if i not in gone)
        assert (r.n_units, r.n_removed) == (len(rows[r.doc_id]), len(gone))
    assert substring_dedup.remove_repeated_words(empty).count() == 0


def test_automaton_finds_first_owner():
    automaton = substring_dedup.SuffixAutomaton()
    for owner, sequence in ((3, "abcabd"), (5, "xabcy"), (8, "bcabz")):
        automaton.add([ord(c) for c in sequence], owner)
    automaton.close()
    assert automaton.first_owners([ord(c) for c in "zxabcabq"], 3) == [None, 5, 3, 3, 3, None]


@pytest.mark.parametrize("block", [512, 2])
def test_near_duplicates(docs, empty, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", block)
    monkeypatch.setattr(near_dedup, "HUBS", 2)
    sets = {}
    for r in docs.collect():
        w = words_of(lower(r.text))
        sets[r.doc_id] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
    component = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a is None or b is None or not sets[a] or not sets[b]:
                    continue
                alike = 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
                if alike and component[a] > component[b]:
                    component[a], changed = component[b], True
    got = near_dedup.near_duplicates(docs, words=3, percent=85).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), component[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id or r.doc_id is None)
    if block == 512:
        assert near_dedup.near_duplicates(empty).count() == 0


def test_sketch_fills_and_estimates():
    import numpy as np

    rng = np.random.default_rng(1)
    items = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    parts = [items[:2000], items[200:2200], items[:1], items[:0]]
    owners = np.repeat(np.arange(4), [len(p) for p in parts])
    found = near_dedup.sketch(np.concatenate(parts), owners, 4)
    assert (found[:3] < 2**64 - 1).all() and (found[3] == 2**64 - 1).all()
    assert abs((found[0] == found[1]).mean() - 1800 / 2200) < 0.16


def test_quality_ledger(docs, empty):
    rows = quality_rules.ledger(quality_rules.measure(docs, carry=["doc_id", "words"]))
    for r in rows.collect():
        text = next((x.text or "" for x in docs.collect() if x.doc_id == r.doc_id), "")
        w = words_of(text)
        keys = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        covered = {i + k for i, key in enumerate(keys) if keys.count(key) > 1 for k in range(8)} if len(w) < 1000 else None
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_repeat_words == (len(covered) if covered is not None else len(w))
        assert r.carried.words == "clash"
    failing = rows.where(~quality_rules.passes(quality_rules.BASE)).count()
    report = {r.rule: r for r in quality_rules.ablations(rows, quality_rules.BASE).collect()}
    either = sum(r.failed for r in report.values())
    assert either - failing == either - rows.where((F.col("failed").bitwiseAND(F.lit(3))) != 0).count()
    without = rows.where(F.col("failed").bitwiseAND(F.lit(2)) == 0).count()
    assert report["few_words"].kept_without == without
    assert quality_rules.ledger(quality_rules.measure(empty)).count() == 0


def test_contamination(spark, docs, empty):
    passage = " ".join(f"Word{i * 7 % 90}, w{i + 1}" for i in range(5, 14))
    items = [(1, passage), (2, "short TEXT"), (3, None), (4, "..."), (None, "lorem ipsum"), (5, "nowhere to be found"), (2, "short TEXT")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def tokens(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    windows = {}
    for item, text in items:
        t = tokens(text)
        for i in range(max(1, len(t) - 12)) if t and item is not None else []:
            windows.setdefault(tuple(t[i : i + 13]), set()).add(str(item))
    rows = decontaminate.contaminated_documents(docs, benchmark).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        t, covered, found = tokens(texts[r.doc_id]), set(), set()
        for key, names in windows.items():
            for i in range(len(t) - len(key) + 1):
                if tuple(t[i : i + len(key)]) == key:
                    covered.update(range(i, i + len(key)))
                    found |= names
        assert (r.n_words, r.n_hit, r.item_ids) == (len(t), len(covered), sorted(found))
    assert any(r.n_hit for r in rows)
    assert decontaminate.contaminated_documents(empty, benchmark).count() == 0
    assert decontaminate.contaminated_documents(docs, benchmark.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_personal_data(docs, empty):
    spans = pii.find_spans(docs).where("base").collect()
    text = next(r.text for r in docs.collect() if r.doc_id == 11)
    found = sorted((r.kind, text[r.start : r.end]) for r in spans)
    assert found == [
        ("card", "4111 1111 1111 1111"), ("email", "a.b@mail.example.com"), ("ip", "10.0.0.1"), ("phone", "+1 (017) 555-7713"),
    ]
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    by_id = {r.doc_id: r.text for r in clean.collect()}
    assert by_id[11] == "call <phone> or mail <email>, 10.0.0.256 <ip>; <card>"
    assert by_id[5] is None and by_id[6] == ""
    assert pii.find_spans(empty).count() == 0


def test_trees_add_credentials(spark):
    rows = []
    for i in range(400):
        code = hashlib.sha256(str(i).encode()).hexdigest()[:40]
        rows.append((i, f'some words before token = "{code}" and after'))
        rows.append((1000 + i, "averyveryverylongword" + "abcdefghij"[i % 10] * (i % 5) + f" plain ext {i}"))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    added = pii.find_spans(table).where("not base").collect()
    found = {r.doc_id for r in added}
    assert found <= set(range(400)) and len(found) >= 390 and {r.kind for r in added} == {"secret"}


def test_trees_learn_from_every_candidate(spark):
    """Over 4000 of a kind and label: all are counted, whatever their hash."""
    chars = "abcdefghijklmnop"
    letters = F.translate(F.md5(F.col("id").cast("string")), "0123456789abcdef", chars)
    table = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain "), letters, F.lit(" words")).alias("text"))
    code = F.concat(F.lit('token = "'), F.sha1(F.col("id").cast("string")), F.lit('" here'))
    table = table.union(spark.range(9000, 14000).select("id", code))
    found = pii.candidates(table)
    cells = pii._cells(found.where("kind = 'secret'")).groupBy("label", "held").agg(F.sum("n").alias("n")).collect()
    counted = {(r.label, r.held): r.n for r in cells}
    assert counted[0.0, False] + counted[0.0, True] == 9000
    assert counted[1.0, False] + counted[1.0, True] == 5000
    # Before base spans, which some codes hold, hide a few.
    added = pii.added_spans(found).where("kind = 'secret'").select("doc_id").collect()
    assert {r.doc_id for r in added} == set(range(9000, 14000))


def test_pipeline_trains_on_every_candidate(spark, monkeypatch):
    import corpus_pipeline

    counts = []
    write = pii.stage

    def noted(df, label):
        out = write(df, label)
        if "held" in df.columns:
            counts.append(out.agg(F.sum("n")).first()[0])
        return out

    monkeypatch.setattr(pii, "stage", noted)
    code = F.concat(F.lit('token = "'), F.sha1(F.col("id").cast("string")), F.lit('" here'))
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), code.alias("text"))
    docs = docs.select("*", *[F.lit(None).cast("string").alias(c) for c in corpus_pipeline.COLUMNS if c not in docs.columns])
    corpus_pipeline.replace_personal_data(spark, docs, "")
    assert counts and counts[0] >= 5000


def test_threshold_counts_every_candidate(spark):
    """Codes of which no fourth hash is one still set the pipeline's threshold."""
    import corpus_pipeline

    code = F.concat(F.lit('token = "'), F.sha1(F.col("id").cast("string")), F.lit('" here'))
    word = F.concat(F.lit("plain "), F.translate(F.md5(F.col("id").cast("string")), "0123456789", "ghijklmnop"), F.lit(" words"))
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, code).otherwise(word).alias("text"))
    fourth = F.pmod(F.xxhash64("found", "before", "after"), F.lit(4)) == 0
    base = F.col("kind").isin([g.kind for g in pii.BASE])
    gone = pii.candidates(docs).where((F.col("doc_id") < 300) & ((~base & fourth) | F.col("valid"))).select("doc_id")
    docs = docs.join(gone, "doc_id", "left_anti")
    docs = docs.select("*", *[F.lit(None).cast("string").alias(c) for c in corpus_pipeline.COLUMNS if c not in docs.columns])
    clean = corpus_pipeline.replace_personal_data(spark, docs, "").collect()
    codes = [r.text for r in clean if r.doc_id < 300]
    assert len(codes) > 100 and all("<secret>" in text for text in codes)
    assert not any("<" in r.text for r in clean if r.doc_id >= 300)


def test_rare_format_among_many(spark):
    """One format of codes beside over 10,000 formats of words: what tells it apart is not missed."""
    letters = "concat(repeat('a', int(id % 40) + 1), repeat('B', int(id / 40) % 40 + 16), repeat('_', int(id / 1600)))"
    words = spark.range(39000).selectExpr("id", f"{letters} as found", "'some ' as before")
    long = "concat(repeat('a', int(id % 60) + 100), repeat('B', int((id - 40000) / 60) + 100))"
    words = words.union(spark.range(40000, 43600).selectExpr("id", f"{long} as found", "'some ' as before"))
    # As long as these and with their shares: only the digit and what lies before tell the codes apart.
    order = "concat(repeat('a', int(id % 100)), repeat('B', 100), repeat('a', 110 - int(id % 100)), '7')"
    codes = spark.range(43600, 43700).selectExpr("id", f"{order} as found", "'token = ' as before")
    found = words.union(codes).selectExpr("*", "'secret' as kind", "' ' as after")
    assert pii._cells(found).count() > 30000
    assert {r.id for r in pii.added_spans(found).collect()} == set(range(43600, 43700))


def test_packing(docs, empty):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer = Tokenizer.from_file(path)
    ids = {
        r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in docs.collect()
    }
    pieces = packing.pack_documents(docs, path, sequence=64, with_ids=True).collect()
    places, sequences = {}, {}
    for r in pieces:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert bytes(r.ids) == part.tobytes() and r.ids_crc32 == zlib.crc32(part.tobytes())
        assert r.doc_tokens == len(ids[r.doc_id])
        places.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, parts in places.items():
        copies = 2 if doc == 9 else 1
        assert sum(n for _, n in parts) == copies * len(ids[doc])
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack_documents(empty, path).count() == 0


def test_odd_words_have_the_ids_of_the_whole_text():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer, words = Tokenizer.from_file(path), packing.word_tokens(path)
    texts = [
        "It's a test, isn't it? Über-Straße  ÉTÉ.", "a\x1cb\x85c\u2003d", "e\u0301 \u0301x İstanbul ΟΔΟΣ", "<|endoftext|> x <|ENDOFTEXT|>",
        "中文 字 123,45 !!! ... a.b.c ,. .", "", " ", "word, word. word; WORD",
    ]
    import numpy as np

    for text, found in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_letters_then_marks_have_the_ids_of_the_whole_text():
    """A letter that is normalised to a letter and a mark is one run with the marks behind it."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer, words = Tokenizer.from_file(path), packing.WordTokens(path)
    texts = ["\u0130, \u0130$$$ \u0958.", "over$$$ over over,!! \u00e9t\u00e9### '! x'! it's it's! <a> a<|", "over, over,!! a_ _ 5, \u0130 \u0958"]
    for text, found in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_between_ascii_separators(spark):
    from gridlake.llm import decontaminate

    texts = ["", " ", None, "a", " a ", ",.a,,b.", "\x00A1\x7f\u0080b\u00a0c", "\u0130 \u24b6x\U0001f642 {z}", "A_b-c/d0:9@e`f{g"]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = table.select("i", "text", decontaminate.words_of(F.col("text")).alias("words"))
    for r in got.collect():
        lowered = "".join(c.lower() if c.isascii() else c for c in r.text or "")
        assert r.words == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered), r.text
    # Extracting took most of the operator's time.
    assert "regexp_extract_all" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_patterns_use_every_piece_once():
    histogram = {1: 7, 5: 3, 30: 11, 33: 4, 64: 2, 63: 5}
    patterns = packing.shortest_pack_first(histogram, 64)
    used = {}
    for pattern, count in patterns:
        assert sum(pattern) <= 64
        for length in pattern:
            used[length] = used.get(length, 0) + count
    assert used == histogram


def test_language(spark, docs, empty):
    german = "der hund und die katze schlafen in dem haus weil es regnet "
    french = "le chien et le chat dorment dans la maison parce que il pleut "
    rows = [(i, german * 4, "de") for i in range(5)] + [(i, french * 4, "fr") for i in range(5, 10)]
    langs, model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert langs == ["de", "fr"] and model.shape == (2, language.BUCKETS)
    asked = [(1, "die katze und der hund schlafen"), (2, "le chat et le chien"), (3, german * 6 + french * 2), (4, None), (5, "12 + 3"), (6, "")]
    found = {r.doc_id: r for r in language.predict(spark.createDataFrame(asked, "doc_id long, text string"), langs, model).collect()}
    assert [found[i].lang_pred for i in range(1, 7)] == ["de", "fr", "de", "und", "und", "und"]
    assert set(found[3].mixture) == {"de", "fr"} and 0.6 < found[3].score < 0.9
    assert language.predict(docs, langs, model).count() == docs.count()
    nothing = language.learn(empty)
    assert {r.lang_pred for r in language.predict(docs, *nothing).collect()} == {"und"}
    assert language.predict(empty, langs, model).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    from gridlake.llm.common import stage

    folder = str(tmp_path)
    spark.createDataFrame([(1, "nothing of this kind")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    current, kept = docs, []
    for name, apply in corpus_pipeline.STAGES:
        current = stage(apply(spark, current, folder), "test-stage")
        kept.append(current.count())
        if name != "packing":
            assert current.columns == corpus_pipeline.COLUMNS
    assert kept[0] == 4  # 1, 2, 3 and 8; the rest is short, repetitive or empty
    assert kept[1] == 1 and kept[2] == 1
    assert corpus_pipeline.run(spark, folder).agg(F.sum("length")).first()[0] > 100
