"""Registered secret scan and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import documents
from .secrets import BASE, RULES, scan


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_query(spark, d):
    found = scan(documents(spark, d))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), *[count(rule.kind) for rule in BASE],
        F.sha2(_listed(F.filter("spans", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"))


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for rank, rule in enumerate(RULES):
        p = quoted(rule.pattern)
        parts.append(f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, p, m, v FROM (SELECT doc_id,
  string_split_regex(text, {p}) AS p, regexp_extract_all(text, {p}, 0) AS m, regexp_extract_all(text, {p}, {rule.group}) AS v
  FROM t WHERE regexp_matches(text, {p}))""")
    least = " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in RULES)
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
r AS ({" UNION ALL ".join(parts)}),
e AS (SELECT doc_id, rank, kind, i, len(m[i]) AS n, len(v[i]) AS vn,
  list_sum([len(x) FOR x IN p[1:i]]) + coalesce(list_sum([len(x) FOR x IN m[1:i - 1]]), 0) AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM r)),
s AS (SELECT doc_id, rank, kind, start::BIGINT AS start, kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT AS span
  FROM e WHERE vn >= CASE kind {least} END),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
  count(*) FILTER (kind = 'hex') AS h, string_agg(span, ',' ORDER BY start, rank) AS spans,
  string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN g USING (doc_id)"""


QUERIES = {"op3_secret_scan": secrets_query}
ORACLE = {"op3_secret_scan": _sql()}
