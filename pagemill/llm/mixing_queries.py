"""Registered mix of sources and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import documents
from .mixing import mixed


def mixing_query(spark, d):
    return mixed(documents(spark, d)).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES = {"op1_source_mix": mixing_query}

ORACLE = {"op1_source_mix": r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  ('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT AS weight
  FROM d GROUP BY source),
f AS (SELECT *, 3 * source_size / weight AS fill FROM s),
l AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0) AS rest,
  sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weights FROM f
  WINDOW b AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least((3 * source_size)::DOUBLE,
  coalesce(max(CASE WHEN rest <= fill * weights THEN rest / weights END) OVER (), 0) * weight)::DOUBLE AS target FROM l),
q AS (SELECT d.*, source_size, weight, target, sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id NULLS FIRST, size
  ROWS UNBOUNDED PRECEDING)::BIGINT AS served FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
v AS (SELECT *, (turn * source_size + served) / weight AS finish FROM q, (SELECT unnest([0, 1, 2]) AS turn)),
o AS (SELECT *, sum(size) OVER (ORDER BY finish, weight, source NULLS LAST, turn, place, doc_id NULLS LAST
  ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () / 3 AS budget FROM v)
SELECT doc_id, size, source_size, any_value(target) AS target,
  sum(greatest(0, least(size, budget - (upto - size))))::BIGINT AS taken FROM o GROUP BY doc_id, source, size, source_size, place, served"""}
