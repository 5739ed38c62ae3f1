"""Filtered search by bitmaps against the search of filtered rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.operators import search
from pagemill.operators.filtered_search import build_filter_index
from pagemill.session import new_dir

DIM, CELLS = 8, 10


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(CELLS, DIM))
    vectors = np.concatenate([m + rng.normal(size=(200, DIM)) * 0.2 for m in middles])
    rows = [(i, v.tolist(), ("en", "de", None, "fr")[i % 4], f"s{i % 7}", "rare" if i in (5, 1_999) else "usual") for i, v in enumerate(vectors)]
    index = spark.createDataFrame(rows, "id bigint, embedding array<double>, lang string, source string, kind string").cache()
    cells = middles / np.linalg.norm(middles, axis=1, keepdims=True)
    built = build_filter_index(search.assign_cells(index, cells), cells, ["lang", "source", "kind"], new_dir(spark, "filter"), block_bytes=40 * DIM * 8)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors[::50])], "query_id bigint, embedding array<double>").cache()
    return index, built, queries


def rows(df):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 5)) for r in df.collect())


@pytest.mark.parametrize("where, condition", [
    ({"lang": ["en"]}, "lang = 'en'"),
    ({"lang": ["de", None], "source": ["s1", "s5"]}, "(lang = 'de' or lang is null) and source in ('s1', 's5')"),
    ({"kind": ["rare"]}, "kind = 'rare'"),
    ({"lang": ["xx"]}, "lang = 'xx'"),
    ({"lang": ["fr"], "source": ["none"]}, "false"),
    ({"lang": [None]}, "lang is null"),
])
def test_equal_to_the_search_of_what_passes(data, where, condition):
    index, built, queries = data
    want = search.topk(queries, index.filter(condition), 5)
    assert rows(built.search(queries, where, 5)) == rows(want)


def test_a_rare_value_reads_only_cells_that_hold_one(data):
    index, built, queries = data
    passing = built.passing({"kind": ["rare"]}).collect()
    blocks = built.blocks.count()
    assert sum(r["count"] for r in passing) == 2 and len(passing) == 2 < blocks / 10
    cells = {r["cell"] for r in built.blocks.join(built.passing({"kind": ["rare"]}), "block").collect()}
    assert len(cells) == 2
    read = built.blocks.filter(F.col("cell").isin(sorted(cells)))
    assert read.select(F.input_file_name()).distinct().count() < built.blocks.select(F.input_file_name()).distinct().count() / 2


def test_probing_goes_on_until_enough_rows_pass(data):
    index, built, queries = data
    # One cell holds enough rows of a frequent value: the nearest ones of the query's own cell.
    few = rows(built.search(queries, {"lang": ["en"]}, 5, at_least=5))
    exact = rows(built.search(queries, {"lang": ["en"]}, 5))
    assert len(few) == len(exact) and len(set(few) & set(exact)) > 0.8 * len(exact)
    # A rare value lies in two cells; both are reached from every query.
    assert rows(built.search(queries, {"kind": ["rare"]}, 5, at_least=5)) == rows(built.search(queries, {"kind": ["rare"]}, 5))
    assert {r[2] for r in rows(built.search(queries, {"kind": ["rare"]}, 2, at_least=2))} == {5, 1_999}


def test_names_of_its_own(data, spark):
    index, built, _ = data
    with pytest.raises(ValueError, match="of its own"):
        build_filter_index(index.withColumn("cell", F.lit(0)), built.centroids, ["cell"], new_dir(spark, "filter"))
