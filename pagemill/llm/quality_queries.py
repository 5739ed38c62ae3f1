"""Registered quality rules and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import documents
from .quality import LEAST_SHARE, LEAST_WORDS, LINE_DOCUMENTS, judged


def quality_query(spark, d):
    return judged(documents(spark, d)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_line_words", "base_failed", "kept")


QUERIES = {"op10_quality_rules": quality_query}

# Lines are compared as they are, not by hash; windows are counted by their text.
_SPACE = r"\x20\x09-\x0D"
ORACLE = {"op10_quality_rules": rf"""WITH t AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^{_SPACE}]+') AS w FROM t),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM w)),
two AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, sum(n)::BIGINT AS n FROM (SELECT doc_id,
  least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM two) GROUP BY doc_id),
l AS (SELECT doc_id, host, text, x, trim(regexp_replace(regexp_replace(lower(x), '[0-9]', '0', 'g'), '[{_SPACE}]+', ' ', 'g')) AS line,
  len(regexp_extract_all(x, '[^{_SPACE}]+')) AS words
  FROM (SELECT *, unnest(string_split(text, chr(10))) AS x FROM t) WHERE regexp_matches(x, '[^{_SPACE}]')),
dup AS (SELECT doc_id, (count(*) - count(DISTINCT x))::BIGINT AS n FROM l GROUP BY doc_id),
f AS (SELECT host, line FROM l GROUP BY ALL HAVING count(DISTINCT text) >= {LINE_DOCUMENTS}),
gone AS (SELECT doc_id, sum(words)::BIGINT AS n FROM l SEMI JOIN f USING (host, line) GROUP BY doc_id),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[{_SPACE}]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_line_words
  FROM t JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_line_words >= {LEAST_WORDS}
  AND n_words - n_line_words >= {LEAST_SHARE} * n_words AS kept FROM b"""}
