import os
import uuid

import pytest
from pyspark.sql import functions as F

from pagemill.operators.changes import (
    append_evolve, apply_diff, delete_by_key, delete_where, get_or_insert, latest_by_name,
    latest_per_key, snapshot_diff,
)
from pagemill.plans.flows import build_chunks
from pagemill.sources.pages import read_pages, rejected_pages, sample_pages, valid_pages
from pagemill.sources.sitemap import read_sitemap, write_sitemap
from pagemill.sources.tables import (
    append_batch, guarded_build, nonempty_gate, preview, publish, read_batches,
)
from pagemill.operators.vector_index import index_upsert
from pagemill.sources.layout import stored
from pagemill.streaming.incremental import current_chunks, incremental_pages


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def name():
    return "t_" + uuid.uuid4().hex


def test_publish_replaces_and_readers_keep_their_version(spark, name):
    old = publish(spark.range(3), name)
    publish(old.filter("id > 0"), name)          # reads the version it replaces
    assert values(spark.table(name)) == [(1,), (2,)]
    assert old.count() == 3


def test_guarded_build(spark, name):
    calls = []

    def build(n):
        calls.append(n)
        return spark.range(n)

    for n in (49, 50, 60):
        guarded_build(spark, name, lambda: build(n))
    assert calls == [49, 50] and spark.table(name).count() == 50


def test_append_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, n in ((0, 2), (1, 3), (1, 3)):
        append_batch(spark.range(n), path, batch)
    assert read_batches(spark, path).count() == 5


def test_append_with_more_columns(spark, tmp_path):
    a = spark.createDataFrame([("x", "2024")], "name string, date string")
    b = spark.createDataFrame([("y", "2025", "p")], "name string, date string, path string")
    expected = [("x", "2024", None), ("y", "2025", "p")]
    assert values(append_evolve(a, b)) == expected
    path = str(tmp_path / "t")
    append_batch(a, path, 0)
    append_batch(b, path, 1)
    assert values(read_batches(spark, path, evolve=True).select("name", "date", "path")) == expected


def test_gate(spark, name):
    publish(spark.range(0), name)
    rows = {r["table_name"]: tuple(r)[1:] for r in nonempty_gate(spark, {"a": name, "b": "/no/where", "c": "nope"}).collect()}
    assert rows == {"a": (True, False), "b": (False, False), "c": (False, False)}
    with pytest.raises(ValueError, match="a, b"):
        nonempty_gate(spark, {"a": name, "b": "/no/where"}, strict=True)


def test_preview_and_sample(spark):
    df = spark.range(200).select(F.col("id").alias("page_id")).repartition(5)
    assert values(preview(df, "page_id")) == [(0,), (1,)]
    assert sorted(r[0] for r in sample_pages(df).collect()) == list(range(100))


def test_pages_from_a_table(spark, name):
    publish(spark.createDataFrame([(1, "u", "<article>a</article>")], "page_id bigint, url string, html string"), name)
    assert valid_pages(read_pages(spark, name)).first()["article"] == "<article>a</article>"


def test_valid_and_rejected_are_complements(spark):
    rows = [(1, "u", "<article> x</article>"), (2, "u", None), (3, "u", ""), (4, "u", "<p>no</p>"),
            (5, "u", "<!-- <article>hidden</article> -->")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert [r["page_id"] for r in valid_pages(df).collect()] == [1]
    assert {r["page_id"]: r["reason"] for r in rejected_pages(df).collect()} == {
        2: "not fetched", 3: "empty", 4: "no article", 5: "no article"}


def test_sitemap_round_trip_and_foreign_file(spark, tmp_path):
    urls = ["https://e.org/a?x=1&y=<2>", "https://e.org/é", "https://e.org/a?x=1&y=<2>"]
    path = str(tmp_path / "map")
    write_sitemap(spark.createDataFrame([(u,) for u in urls], "url string"), path)
    assert sorted(r[0] for r in read_sitemap(spark, path).collect()) == sorted(urls)
    other = tmp_path / "index.xml"
    other.write_text('<?xml version="1.0"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
                     "<sitemap><loc>http://e.org/1.xml</loc><lastmod>2024</lastmod></sitemap></sitemapindex>")
    assert values(read_sitemap(spark, str(other), "sitemap")) == [("http://e.org/1.xml",)]


def test_diff_applied_to_old_is_new(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "x"), (4, "ab", "c")], "k bigint, u string, h string")
    new = spark.createDataFrame([(1, "a", ""), (2, "b", "x"), (4, "a", "bc"), (5, "e", "x")], "k bigint, u string, h string")
    diff = snapshot_diff(old, new, "k", ["u", "h"])
    assert {r["k"]: r["change"] for r in diff.collect()} == {1: "update", 3: "delete", 4: "update", 5: "insert"}
    assert values(apply_diff(old, diff, new, "k")) == values(new)
    assert snapshot_diff(new, new, "k", ["u", "h"]).count() == 0


def test_deletes_keep_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert values(delete_where(df, "k", "a")) == [("b", 2), (None, 3)]
    assert values(delete_by_key(df, df.filter("v <> 2"), "k")) == [("b", 2), (None, 3)]


def test_newest_rows(spark):
    df = spark.createDataFrame([("a", "2024", 1), ("a", "2025", 2), ("b", "2023", 3), ("a", "2025", 4)],
                               "name string, date string, id int")
    assert values(latest_by_name(df, "name", "a", "date", "id")) == [("a", "2025", 4)]
    assert values(latest_per_key(df, "name", "date", "id")) == [("a", "2025", 4), ("b", "2023", 3)]


def test_insert_only_absent_keys(spark):
    have = spark.createDataFrame([("a", 1), ("a", 2)], "k string, id int")
    more = spark.createDataFrame([("b", 9), ("a", 3), ("b", 5)], "k string, id int")
    once = get_or_insert(have, more, "k", "id")
    assert values(once) == [("a", 1), ("a", 2), ("b", 5)]
    assert values(get_or_insert(once, more, "k", "id")) == values(once)


def test_incremental_with_updates(spark, tmp_path):
    root = str(tmp_path)
    schema = "page_id bigint, url string, html string"
    page = lambda i, text: (i, f"u{i}", f"<article><h1>T</h1>{text}</article>")

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        return incremental_pages(spark, f"{root}/in", f"{root}/out", f"{root}/state", build_chunks, max_files=1)

    arrive([page(1, "one"), page(2, "two")])
    assert run() == 1
    assert run() == 0
    arrive([page(1, "changed"), page(3, "three"), (2, "u2", None)])
    assert run() == 1
    got = {r["page_id"]: r["content"].split()[-1] for r in current_chunks(spark, f"{root}/out").collect()}
    assert got == {1: "changed", 3: "three"}
    batch = build_chunks(spark.createDataFrame([page(1, "changed"), page(3, "three")], schema))
    assert values(current_chunks(spark, f"{root}/out").select(*batch.columns)) == values(batch)


@pytest.mark.parametrize("max_files", [1, 10])
def test_page_twice_in_any_batches(spark, tmp_path, max_files):
    root = str(tmp_path)
    schema = "page_id bigint, url string, html string"
    for n in range(3):
        rows = [(i, f"u{i}", f"<article>version{n} of {i}</article>") for i in range(n, 5)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        os.sync()
    for state in ("a", "b"):  # a second checkpoint adds the same again
        assert incremental_pages(spark, f"{root}/in", f"{root}/out", f"{root}/{state}", build_chunks, max_files) == (3 if max_files == 1 else 1)
    got = {r["page_id"]: r["content"] for r in current_chunks(spark, f"{root}/out").collect()}
    assert got == {0: "version0 of 0", 1: "version1 of 1", **{i: f"version2 of {i}" for i in (2, 3, 4)}}


def test_upsert_of_null_versions(spark):
    index = spark.createDataFrame([(1, "a")], "id bigint, v string")
    updates = spark.createDataFrame([(1, "b", None), (2, "c", 1), (2, "d", None), (3, "e", None)], "id bigint, v string, version int")
    assert values(index_upsert(index, updates, version="version")) == [(1, "b"), (2, "c"), (3, "e")]
    with pytest.raises(Exception, match="updated twice"):
        index_upsert(index, updates.drop("version")).collect()


def test_shared_dir_follows_the_session(spark):
    from pagemill.session import _own_dir, new_dir, shared_dir

    def session(folder=None, context=None, master="local[2]"):
        class Fake:
            class conf:
                get = staticmethod(lambda key, default: folder)

            class sparkContext:
                getCheckpointDir = staticmethod(lambda: context)
        Fake.sparkContext.master = master
        return Fake

    assert shared_dir(session()) == _own_dir() and os.path.isdir(_own_dir())
    assert shared_dir(session("/a/", "/b", "yarn")) == "/a" and shared_dir(session(None, "/b", "yarn")) == "/b"
    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_dir(session(master="spark://host:7077"))
    assert new_dir(spark, "x") != new_dir(spark, "x") and not os.path.exists(new_dir(spark, "x"))


def test_working_tables_are_deleted(spark, monkeypatch, tmp_path):
    from pagemill import session
    monkeypatch.setattr(session, "_RUN", "a-run-of-its-own")
    stored(spark.range(3), "x")
    assert os.path.isdir(session.run_dir(spark))
    session.clear_working_tables(spark)
    assert not os.path.exists(session.run_dir(spark))


def test_sample_and_preview_read_the_first_pages_only(spark):
    from pagemill.plans.flows import preview_chunks
    from pagemill.sources.pages import sample_pages

    rows = [(i, f"u{i}", "<article>" + "<h2>a b c d e</h2>" * (i % 3) + "</article>") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    assert [r["page_id"] for r in sample_pages(pages, 7).collect()] == list(range(7))
    odd = spark.createDataFrame([(None, "a", ""), (2, "b", ""), (1, "c", ""), (None, "d", "")], pages.schema)
    assert [r["page_id"] for r in sample_pages(odd, 3).collect()] == [None, None, 1]
    assert [r["page_id"] for r in sample_pages(odd, 1).collect()] == [None] and sample_pages(odd.limit(0), 3).collect() == []
    seen = []
    def build(df):
        seen.append(df.count())
        from pyspark.sql import functions as F
        return df.filter("page_id >= 10").select((F.col("page_id") * 100).alias("id"))
    assert [r["id"] for r in preview_chunks(pages, build, 4).collect()] == [1000, 1100, 1200, 1300]
    assert seen == [4, 16]
    assert preview_chunks(pages.limit(0), build, 4).collect() == []
