"""Plain versions that several tests share."""

import re


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_repeats(rows, window):
    """doc -> covered places, for windows that start in a document with a smaller id."""
    first = {}
    for doc, units in rows:
        for i in range(len(units) - window + 1):
            key = units[i : i + window]
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, units in rows:
        covered = set()
        for i in range(len(units) - window + 1):
            if first[units[i : i + window]] < doc:
                covered.update(range(i, i + window))
        out[doc] = covered
    return out
