"""Embedding, index and retrieval."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.html import html_to_text
from ..operators.delta_index import HASH, DeltaIndex, content_hash
from ..operators.embedding import embed, weights
from ..operators.filtered_search import build_filter_index
from ..operators.keyword import keyword_search
from ..operators.keyword_index import build_keyword_index
from ..operators.product_quantizer import coded_blocks, fit_quantizer, topk_quantized
from ..operators.search import assign_cells, fit_cells, topk, topk_approx, with_metadata, write_cells
from ..operators.vector_index import index_build, index_gaps, index_stats, index_upsert, model_guard
from ..session import new_dir
from ..sources.layout import spread
from .common import DIM, SITE_SQL, hashed_sql, site, strip_sql, table, text_sql, versions

K = 10
THRESHOLD = 0.36
PROBES = 4
BATCH = 1 << 17  # bytes of query vectors; some hundred queries


def vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def as_queries(index):
    """Every vector asks for its neighbours."""
    return index.select(F.col("id").alias("query_id"), "embedding")


def neighbours(spark, d, k=K, **options):
    index = vectors(spark, d)
    return topk(as_queries(index), index, k, skip_same_id=True, **options)


def filtered_query(spark, d):
    english = table(spark, d, "documents").filter("lang = 'en'").select(F.col("doc_id").alias("id"))
    index = vectors(spark, d)
    return topk(as_queries(index), index.join(english, "id", "left_semi"), K, skip_same_id=True)


def metadata_query(spark, d):
    """Documents in one language were deleted after indexing."""
    return with_metadata(neighbours(spark, d, 3), site(spark, d).filter("not endswith(title, ' de')"))


def label_centroids(index) -> np.ndarray:
    """Mean vector of each label, in label order."""
    means = [F.avg(F.element_at("embedding", i + 1)).alias(f"m{i}") for i in range(DIM)]
    rows = index.groupBy("label").agg(*means).orderBy("label").toArrow()
    return np.column_stack([rows.column(f"m{i}").to_numpy() for i in range(DIM)])


def approximate(spark, d, centroids, probes=PROBES, **options):
    index = vectors(spark, d)
    cells = centroids(index)
    indexed = write_cells(assign_cells(index, cells), new_dir(spark, "cells"))
    return topk_approx(as_queries(index), indexed, cells, K, probes,
                       skip_same_id=True, **options)


def build_query(spark, d):
    index = index_build(site(spark, d), vectors(spark, d))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return index.select("id", F.size("embedding").cast("bigint").alias("dim"),
                        F.round(total, 6).alias("vector_sum"), "metadata.*")


def upsert_query(spark, d):
    """Label 0 is embedded again, twice; label 1 comes back under new ids."""
    index = vectors(spark, d)
    again = index.filter("label = 0")
    updates = (
        again.withColumn("version", F.lit(1))
        .unionByName(again.withColumn("embedding", F.reverse("embedding")).withColumn("version", F.lit(2)))
        .unionByName(index.filter("label = 1").withColumn("id", F.col("id") + 1_000_000_000)
                     .withColumn("version", F.lit(1))))
    merged = index_upsert(index, updates, version="version")
    # All elements, as whole numbers of a millionth.
    digits = F.transform("embedding", lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    return merged.select("id", "label", F.md5(F.array_join(digits, ",")).alias("vector_md5"))


def guard_query(spark, d):
    """Labels below five were embedded with one model, the others with another."""
    index = vectors(spark, d).withColumn("model", F.when(F.col("label") < 5, "words-1").otherwise("words-2"))
    return model_guard(index, "words-1", DIM)


def embed_query(spark, d):
    docs = embed(spread(table(spark, d, "documents").select("doc_id", "text")), "text")
    return weights(docs, "doc_id").select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"),
        F.round(F.col("weight").cast("double"), 5).alias("weight"))


def keyword_query(spark, d, **options):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return keyword_search(table(spark, d, "benchmark"), docs, K, query_id="item_id", **options)


def quantized_query(spark, d):
    """At full depth: every vector is coded and re-ranked, so the result is the exact one."""
    index = vectors(spark, d)
    cells = label_centroids(index)
    quantizer = fit_quantizer(index, cells)
    blocks = coded_blocks(assign_cells(index, cells), quantizer)
    return topk_quantized(as_queries(index), blocks, quantizer, K, depth=index.count(), skip_same_id=True)


def bitmap_query(spark, d):
    """The language of each vector's document is metadata of the index."""
    index = vectors(spark, d)
    cells = label_centroids(index)
    described = index.join(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang"), "id", "left")
    built = build_filter_index(assign_cells(described, cells), cells, ["lang"], new_dir(spark, "filter-index"))
    return built.search(as_queries(index), {"lang": ["en"]}, K, skip_same_id=True)


def page_texts(rows):
    return rows.select(F.col("page_id").alias("id"), html_to_text(F.col("html")).alias("content"))


def embedded(rows):
    return embed(rows, "content").select("id", HASH, "embedding")


def synced(spark, d):
    """An index of the old pages brought up to the new ones, and what was changed."""
    old, new = versions(spark, d)
    texts = page_texts(spread(old)).withColumn(HASH, content_hash(F.col("content")))
    index = DeltaIndex.create(embedded(texts), new_dir(spark, "delta-index"))
    return index, index.sync(page_texts(spread(new)), "content", embedded)


def sync_query(spark, d):
    index, _ = synced(spark, d)
    return weights(index.read(), "id").select(
        F.col("id").alias("page_id"), F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("weight").cast("double"), 5).alias("weight"))


def compacted_query(spark, d):
    index, _ = synced(spark, d)
    index.compact(share=0.0)
    return index.read().select(F.col("id").alias("page_id"), HASH)


def keyword_indexed(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return build_keyword_index(docs, new_dir(spark, "keyword-index"))


def keyword_index_query(spark, d):
    return keyword_indexed(spark, d).statistics().withColumn("largest", F.round("largest", 6))


def keyword_stored_query(spark, d, **options):
    return keyword_indexed(spark, d).search(table(spark, d, "benchmark"), K, query_id="item_id", **options)


QUERIES = {
    "embed_text": embed_query,
    "index_build": build_query,
    "index_upsert": upsert_query,
    "index_sync": sync_query,
    "index_sync_changes": lambda s, d: synced(s, d)[1].select(F.col("id").alias("page_id"), "change"),
    "index_sync_compacted": compacted_query,
    "index_stats": lambda s, d: index_stats(vectors(s, d)),
    "index_gaps": lambda s, d: index_gaps(table(s, d, "documents"), vectors(s, d), "doc_id"),
    "model_guard": guard_query,
    "topk_exact": neighbours,
    "topk_exact_blocks": lambda s, d: neighbours(s, d, batch_bytes=BATCH),
    "topk_threshold": lambda s, d: neighbours(s, d, threshold=THRESHOLD),
    "topk_metadata": metadata_query,
    "topk_filtered": filtered_query,
    "topk_filtered_bitmaps": bitmap_query,
    "topk_quantized": quantized_query,
    "keyword_search": keyword_query,
    "keyword_search_blocks": lambda s, d: keyword_query(s, d, broadcast_bytes=0),
    "keyword_index": keyword_index_query,
    "keyword_search_stored": keyword_stored_query,
    "keyword_search_stored_blocks": lambda s, d: keyword_stored_query(s, d, broadcast_bytes=0),
    "topk_approx": lambda s, d: approximate(s, d, label_centroids),
    "topk_approx_blocks": lambda s, d: approximate(s, d, label_centroids, batch_bytes=BATCH),
    "topk_approx_kmeans": lambda s, d: approximate(s, d, lambda index: fit_cells(index, 16), 16),
}

_COSINE = "list_cosine_similarity(q.embedding::DOUBLE[], x.embedding::DOUBLE[])"


def _topk_sql(k: int, index: str = "embeddings", where: str = "true") -> str:
    return f"""pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id AS id, round({_COSINE}, 6) AS score
  FROM embeddings q JOIN {index} x ON q.vec_id <> x.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score
  FROM pairs WHERE {where}),
matches AS (SELECT * FROM ranked WHERE rank <= {k})"""


_EXACT = f"WITH {_topk_sql(K)} SELECT * FROM matches"
_DOT = "list_cosine_similarity(e.embedding::DOUBLE[], c.m)"
_APPROX = f"""WITH parts AS (
  SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, avg(v) AS v FROM parts GROUP BY ALL),
cells AS (SELECT label, list(v ORDER BY i) AS m FROM means GROUP BY label),
near AS (
  SELECT vec_id, c.label AS cell,
    row_number() OVER (PARTITION BY vec_id ORDER BY round({_DOT}, 9) DESC, c.label) AS r
  FROM embeddings e CROSS JOIN cells c),
pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id AS id, round({_COSINE}, 6) AS score
  FROM near p JOIN near h ON h.r = 1 AND h.cell = p.cell AND h.vec_id <> p.vec_id
  JOIN embeddings q ON q.vec_id = p.vec_id JOIN embeddings x ON x.vec_id = h.vec_id
  WHERE p.r <= {PROBES}),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= {K}"""

_KEYWORD = f"""WITH dw AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term FROM documents),
qw AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dw GROUP BY ALL),
qtf AS (SELECT item_id, term, count(*) AS qtf FROM qw GROUP BY ALL),
dl AS (SELECT doc_id, len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS dl FROM documents),
totals AS (SELECT count(*) AS n, avg(dl) AS mean FROM dl),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scores AS (
  SELECT item_id AS query_id, doc_id AS id,
    round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score
  FROM qtf JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (doc_id) CROSS JOIN totals GROUP BY ALL),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM scores)
SELECT * FROM ranked WHERE rank <= {K}"""

_KEYWORD_INDEX = """WITH dw AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dw GROUP BY ALL),
dl AS (SELECT doc_id, len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS dl FROM documents),
totals AS (SELECT avg(dl) AS mean FROM dl)
SELECT term, count(*) AS df, sum(tf)::BIGINT AS hits, round(max(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS largest
FROM tf JOIN dl USING (doc_id) CROSS JOIN totals GROUP BY term"""

_VECTOR = "md5(array_to_string([round(x::DOUBLE * 1000000)::BIGINT FOR x IN {}], ','))"

_VERSIONS = f"""o AS (SELECT page_id AS id, {text_sql(strip_sql('html'))} AS content FROM pages WHERE NOT contains(url, '//blog.')),
n AS (SELECT page_id AS id, {text_sql(strip_sql("(html || CASE WHEN contains(url, '#') THEN '<p>Revised.</p>' ELSE '' END)"))} AS content
  FROM pages WHERE NOT contains(url, '//m.'))"""

ORACLE = {
    "embed_text": f"""WITH {hashed_sql('dv', 'documents', 'doc_id', 'text')}
SELECT key AS doc_id, bucket::BIGINT AS bucket, round(weight::DOUBLE, 5) AS weight FROM dv""",
    "index_build": f"""WITH {SITE_SQL} SELECT id, len(embedding) AS dim,
  round(list_sum(embedding::DOUBLE[]), 6) AS vector_sum, url, content, title FROM embeddings JOIN site ON id = vec_id""",
    "index_upsert": f"""SELECT vec_id AS id, label, {_VECTOR.format('CASE WHEN label = 0 THEN list_reverse(embedding) ELSE embedding END')}
  AS vector_md5 FROM embeddings
UNION ALL SELECT vec_id + 1000000000, label, {_VECTOR.format('embedding')} FROM embeddings WHERE label = 1""",
    "index_sync": f"""WITH {_VERSIONS}, {hashed_sql('nv', 'n', 'id', 'content')}
SELECT key AS page_id, bucket::BIGINT AS bucket, round(weight::DOUBLE, 5) AS weight FROM nv""",
    "index_sync_changes": f"""WITH {_VERSIONS} SELECT coalesce(o.id, n.id) AS page_id,
  CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'delete' ELSE 'update' END AS change
FROM o FULL JOIN n ON o.id = n.id WHERE o.content IS DISTINCT FROM n.content""",
    "index_sync_compacted": f"WITH {_VERSIONS} SELECT id AS page_id, md5(':' || content) AS content_hash FROM n",
    "index_stats": """SELECT count(*) AS n_rows, min(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim,
  count(*) FILTER (embedding IS NULL) AS n_null,
  count(*) FILTER (list_max(list_transform(embedding, lambda x: abs(x))) = 0) AS n_zero,
  count(*) FILTER (list_bool_or([x IS NULL OR isnan(x) OR isinf(x) FOR x IN embedding])) AS n_broken FROM embeddings""",
    "index_gaps": """SELECT doc_id AS id, 'no vector' AS gap FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
UNION ALL SELECT vec_id, 'no chunk' FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)""",
    "model_guard": f"""SELECT CASE WHEN label < 5 THEN 'words-1' ELSE 'words-2' END AS model, len(embedding) AS dim,
  count(*) AS n_rows, bool_and(label < 5 AND len(embedding) = {DIM}) AS usable FROM embeddings GROUP BY 1, 2""",
    "topk_exact": _EXACT,
    "topk_exact_blocks": _EXACT,
    "topk_threshold": f"WITH {_topk_sql(K, where=f'score >= {THRESHOLD}')} SELECT * FROM matches",
    "topk_metadata": f"""WITH {SITE_SQL}, {_topk_sql(3)}
SELECT query_id, rank, m.id, score, url, content, title FROM matches m
LEFT JOIN site s ON s.id = m.id AND NOT ends_with(title, ' de')""",
    "topk_filtered": f"""WITH english AS (SELECT e.* FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id WHERE lang = 'en'),
{_topk_sql(K, 'english')} SELECT * FROM matches""",
    "topk_filtered_bitmaps": f"""WITH english AS (SELECT e.* FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id WHERE lang = 'en'),
{_topk_sql(K, 'english')} SELECT * FROM matches""",
    "topk_quantized": _EXACT,
    "keyword_search": _KEYWORD,
    "keyword_search_blocks": _KEYWORD,
    "keyword_index": _KEYWORD_INDEX,
    "keyword_search_stored": _KEYWORD,
    "keyword_search_stored_blocks": _KEYWORD,
    "topk_approx": _APPROX,
    "topk_approx_blocks": _APPROX,
    "topk_approx_kmeans": _EXACT,  # all cells are probed
}
