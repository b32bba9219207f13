"""Language of a text as a mixture over learned languages.

Training counts hashed three-byte strings per language; the table has ``BUCKETS``
numbers for each language whatever the corpus. A document's proportions come from
expectation-maximisation over its own strings: each string is shared out among the
languages by proportion times likelihood, and the shares make the next proportions.
The set of languages is chosen by penalised likelihood: languages join in order of
their proportion as long as the gain is worth another parameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import map_batches, runs

BUCKETS = 1 << 14
SMOOTHING = 0.5
STEPS = 12
# Log-likelihood that another language must gain, per log of the number of strings.
# Strings of one text depend on each other, so this is more than the usual half.
PENALTY = 6.0
UNKNOWN = "und"

# Letters count, case does not; digits, marks and white space are all one blank.
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def _strings(data: np.ndarray) -> np.ndarray:
    """Buckets of the three-byte strings of a text, those of blanks alone left out."""
    letters = _FOLD[data]
    letters = np.concatenate(([np.uint32(32)], letters, [np.uint32(32)]))
    codes = letters[:-2] << np.uint32(16) | letters[1:-1] << np.uint32(8) | letters[2:]
    codes = codes[codes != 0x202020]
    return ((codes * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, bucket, strings), added up within the task."""
    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, data, offsets in runs(batch.column(1)):
            for i in range(len(offsets) - 1):
                table = tables.setdefault(langs[first + i], np.zeros(BUCKETS, np.int64))
                table += np.bincount(_strings(data[offsets[i] : offsets[i + 1]]), minlength=BUCKETS)
    for lang, table in tables.items():
        there = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(there), pa.string()), pa.array(there), pa.array(table[there])], names=["lang", "bucket", "strings"]
        )


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their likelihoods, (languages, BUCKETS).

    ``rows`` has ``lang`` and ``text``; rows where either is null are left out. Every row
    counts. What reaches the driver is BUCKETS numbers for each language.
    """
    rows = rows.select(F.col("lang").cast("string"), F.col("text").cast("string")).where("lang is not null and text is not null")
    counts = map_batches(rows, _count, "lang string, bucket long, strings long")
    found = counts.groupBy("lang", "bucket").agg(F.sum("strings").alias("strings")).toPandas()
    langs = sorted(found["lang"].unique())
    table = np.zeros((len(langs), BUCKETS))
    for i, lang in enumerate(langs):
        mine = found[found["lang"] == lang]
        table[i, mine["bucket"].to_numpy()] = mine["strings"].to_numpy()
    table += SMOOTHING
    return langs, table / table.sum(axis=1, keepdims=True) if langs else table


def _fit(counts: np.ndarray, likelihood: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood; ``likelihood`` is (strings, languages)."""
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    for _ in range(steps if len(share) > 1 else 0):
        whole = likelihood @ share
        share = share * ((counts / whole) @ likelihood) / counts.sum()
    return share, float(counts @ np.log(likelihood @ share))


def mixture(strings: np.ndarray, model: np.ndarray) -> tuple[int, float, np.ndarray]:
    """Main language, its proportion, and the proportions of all languages."""
    found, counts = np.unique(strings, return_counts=True)
    likelihood = model[:, found].T
    share, _ = _fit(counts, likelihood)
    order = np.argsort(-share, kind="stable")
    worth = PENALTY * np.log(max(counts.sum(), 2))
    chosen = order[:1]
    best, value = np.ones(1), float(counts @ np.log(likelihood[:, order[0]]))
    for size in range(2, len(order) + 1):
        if share[order[size - 1]] < 0.02:
            break
        trial, reached = _fit(counts, likelihood[:, order[:size]])
        if reached - value <= worth:
            break
        chosen, best, value = order[:size], trial, reached
    everything = np.zeros(len(model))
    everything[chosen] = best
    main = int(np.argmax(everything))
    return main, float(everything[main]), everything


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, mixture (map of language to proportion).

    Only the text is looked at. Null texts, texts without a letter, and every text where no
    language was learned give ``und`` with score 0. Repeated rows and null ids are predicted
    like any other, an empty table gives no rows, and other columns are not read.
    """
    small = model.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = small.astype(np.float64)
        for batch in batches:
            texts, out = batch.column(1), []
            for first, data, offsets in runs(texts):
                for i in range(len(offsets) - 1):
                    strings = _strings(data[offsets[i] : offsets[i + 1]]) if langs else ()
                    text = texts[first + i].as_py() if len(strings) else ""
                    if not any(map(str.isalpha, text)):
                        out.append((UNKNOWN, 0.0, []))
                        continue
                    main, score, shares = mixture(strings, table)
                    out.append((langs[main], score, [(langs[k], float(shares[k])) for k in np.flatnonzero(shares)]))
            kinds = (pa.string(), pa.float64(), pa.map_(pa.string(), pa.float64()))
            columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "lang_pred", "score", "mixture"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, lang_pred string, score double, mixture map<string,double>")


def is_held_out(id_column: str = "doc_id") -> Column:
    """Documents that training does not see: remainder 2 of the id's CRC modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
