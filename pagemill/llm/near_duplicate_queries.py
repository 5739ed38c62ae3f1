"""Registered near-duplicate classes. The SQL counts shared shingles of all pairs of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import documents
from .near_duplicates import classes


def near_duplicate_query(spark, d):
    return classes(documents(spark, d)).select(F.col("id").alias("doc_id"), "class_id", "class_size")


QUERIES = {"op6_near_duplicates": near_duplicate_query}

ORACLE = {"op6_near_duplicates": r"""WITH RECURSIVE c AS (SELECT coalesce(text, '') AS text, min(doc_id) AS node FROM documents GROUP BY ALL),
w AS (SELECT node, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM c),
s AS (SELECT DISTINCT node, array_to_string(w[i:i + 4], ' ') AS g FROM (
  SELECT node, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
  UNION ALL SELECT node, text FROM w WHERE len(w) = 0 AND text <> ''),
n AS (SELECT node, count(*) AS n FROM s GROUP BY node),
p AS (SELECT a.node AS a, b.node AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.node <> b.node GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.node = a JOIN n y ON y.node = b WHERE m >= 0.8 * (x.n + y.n - m)),
r AS (SELECT node, node AS root FROM c UNION SELECT e.a, r.root FROM r JOIN e ON e.b = r.node),
k AS (SELECT node, min(root) AS class_id FROM r GROUP BY node)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id)::BIGINT AS class_size
FROM documents JOIN c ON coalesce(documents.text, '') = c.text JOIN k USING (node)"""}
