"""Registered manifest of all documents, with proofs checked against tampered texts."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from .common import documents
from .merkle import FAN, folded, leaf, manifest, proof_digest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered(id, text):
    """The text in lower case (A to Z) for ids whose checksum three divides; a null stays."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.crc32(id.cast("string")) % 3 == 0, lower).otherwise(text)


def manifest_of(docs):
    known = {c: F.col(c) for c in COLUMNS}
    changed = leaf(known | {"text": tampered(F.col("doc_id"), F.col("text"))})
    rows = docs.select(F.col("lang").alias("group"), F.col("doc_id").cast("bigint").alias("id"), leaf(known).alias("leaf"),
                       F.struct(F.col("doc_id"), changed.alias("changed")).alias("payload"))
    found = manifest(rows).withColumn("folded_root", folded(F.col("payload.changed"), F.col("path")))
    return found.select(F.col("payload.doc_id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def manifest_query(spark, d):
    return manifest_of(documents(spark, d))


_DEPTH = 12  # levels that the SQL spells out


def _crc32(text: str) -> str:
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    bits = "c"
    for _ in range(8):
        bits = f"list_reduce([{bits}, 0], lambda c, z: {step})"
    byte = f"list_reduce([xor(a, b), 0], lambda c, y: {bits})"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
            f"lambda a, b: {byte}), 4294967295)")


def _levels(name: str, source: str) -> str:
    """Runs of each level of the tree over ``g, i, h, n``, and every leaf's way through them."""
    parts = [f"{name}0 AS (SELECT g, i, h, n FROM {source})"]
    for k in range(_DEPTH):
        parts.append(f"""{name}r{k} AS (SELECT g, i // {FAN} AS i, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {name}{k} GROUP BY g, i // {FAN}),
{name}{k + 1} AS (SELECT g, i, CASE WHEN n > {FAN ** k} THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, n FROM {name}r{k})""")
    return ",\n".join(parts)


def _ways(name: str, tree: str, source: str) -> str:
    parts = [f"{name}0 AS (SELECT *, i AS pos, '' AS sides, f AS fold FROM {source})"]
    for k in range(_DEPTH):
        before, after = f"array_to_string(hs[:w.pos % {FAN}], '')", f"array_to_string(hs[w.pos % {FAN} + 2:], '')"
        parts.append(f"""{name}{k + 1} AS (SELECT w.* EXCLUDE (pos, sides, fold), w.pos // {FAN} AS pos,
  CASE WHEN r.n > {FAN ** k} THEN sides || {before} || {after} ELSE sides END AS sides,
  CASE WHEN r.n > {FAN ** k} THEN sha256({before} || fold || {after}) ELSE fold END AS fold
  FROM {name}{k} w JOIN {tree}r{k} r ON w.g IS NOT DISTINCT FROM r.g AND r.i = w.pos // {FAN})""")
    return ",\n".join(parts)


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in COLUMNS) + ")"
_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = {"op12_merkle_manifest": f"""WITH c AS MATERIALIZED (SELECT *, coalesce({_crc32('doc_id::VARCHAR')} % 3 = 0, false) AS hit FROM documents),
d AS MATERIALIZED (SELECT doc_id, lang AS g, {_LEAF} AS h,
  (SELECT {_LEAF} FROM (SELECT c.doc_id, c.source, c.lang, c.n_chars, CASE WHEN c.hit THEN {_TEXT.replace('(text', '(c.text')} ELSE c.text END AS text)) AS f FROM c),
e AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
{_levels('l', 'e')},
s AS MATERIALIZED (SELECT 0 AS g, g AS lang, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM l{_DEPTH}),
{_levels('t', 's')},
{_ways('w', 'l', 'e')},
u AS (SELECT w.doc_id, w.h, w.sides AS lower_sides, w.fold AS f, s.h AS subroot, s.g, s.i FROM w{_DEPTH} w JOIN s ON w.g IS NOT DISTINCT FROM s.lang),
{_ways('v', 't', 'u')}
SELECT doc_id, v.h AS leaf, subroot, t.h AS root, sha256(lower_sides || sides) AS proof_sha256, fold AS folded_root, fold = t.h AS verified
FROM v{_DEPTH} v CROSS JOIN t{_DEPTH} t"""}
QUERIES = {"op12_merkle_manifest": manifest_query}
