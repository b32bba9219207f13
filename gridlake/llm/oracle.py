"""DuckDB SQL for the queries that SQL can state."""

from __future__ import annotations

from gridlake.llm.quality_rules import ABUSE, RULES_3, SLURS, STANDARD_3, STEMS, mask

_WORDS = r"list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

_BITS = " + ".join(f"CASE WHEN {rule.fails} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES_3))
_STEMS = "|".join(sorted({stem for stems in STEMS.values() for stem in stems}))

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {_WORDS} AS words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS k
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (SELECT doc_id, k FROM windows GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows JOIN twice USING (doc_id, k)) GROUP BY 1),
m AS (SELECT doc_id, len(words) AS n_words,
        CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
        len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals,
        len(regexp_extract_all(text, '(?i)\b(?:{"|".join(sorted(ABUSE))})\b')) AS n_abuse,
        len(regexp_extract_all(text, '(?i)\b(?:{"|".join(sorted(SLURS))})\b')) AS n_slurs,
        len(list_filter(regexp_split_to_array(text, '[^\p{{L}}]+'), lambda x: regexp_matches(x, '(?i)^(?:{_STEMS})'))) AS n_abuse_stems
      FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       failed_rules & {mask(STANDARD_3, RULES_3)} = 0 AS kept, failed_rules
FROM b"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
                     FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
                         UNION SELECT links.b, reach.other FROM reach JOIN links ON links.a = reach.doc_id)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

REPEATED_WORDS = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS k
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
firsts AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (k) WHERE doc_id > low),
places AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS word FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT w.doc_id, len(words) AS n_words, coalesce(removed.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""

_TOKENS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = rf"""
WITH w AS (SELECT doc_id, {_TOKENS} AS words FROM documents),
items AS (SELECT item_id, {_TOKENS} AS words FROM benchmark),
iw AS (SELECT DISTINCT item_id, len(words[i:i + 12]) AS size, array_to_string(words[i:i + 12], ' ') AS k
       FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
dw AS (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS k
       FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
             FROM w, (SELECT DISTINCT size FROM iw))),
hits AS (SELECT doc_id, i, size, item_id FROM dw JOIN iw USING (size, k)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(words) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

ORACLE = {
    "op2_quality_rules": QUALITY_RULES,
    "op7_minhash": NEAR_DUPLICATES,
    "op8_substring_dedup": REPEATED_WORDS,
    "op10_decontaminate": DECONTAMINATE,
}
