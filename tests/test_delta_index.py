"""The index of base buckets and deltas against a plain dictionary."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators.delta_index import HASH, DeltaIndex, content_hash
from pagemill.session import new_dir

SCHEMA = "id bigint, embedding array<float>, label string"


def rows(spark, given):
    return spark.createDataFrame([(i, [float(v)], str(v)) for i, v in given], SCHEMA)


def read(index):
    found = [(r["id"], int(r["label"])) for r in index.read().collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def files(index, kind):
    return {os.path.relpath(f, index.path): os.stat(f).st_mtime_ns for f in glob.glob(f"{index.path}/{kind}/**/part-*", recursive=True)}


def bucket_of(spark, ids, buckets):
    return {r["id"]: r["b"] for r in spark.createDataFrame([(i,) for i in ids], "id bigint").select(
        "id", F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("b")).collect()}


def test_commits_and_compaction_follow_a_dictionary(spark):
    rng = random.Random(3)
    known = {i: i for i in range(60)}
    index = DeltaIndex.create(rows(spark, known.items()).repartition(3), new_dir(spark, "delta"), buckets=8)
    assert read(index) == known
    for step in range(5):
        new = {rng.randrange(90): rng.randrange(1_000) for _ in range(12)}
        gone = [rng.randrange(90) for _ in range(8)]
        index.commit(rows(spark, new.items()), spark.createDataFrame([(i,) for i in gone], "id bigint"))
        for i in gone:
            known.pop(i, None)
        known |= new
        assert read(index) == known
        if step % 2:
            assert index.compact(share=0.2)
            assert read(index) == known
    index.clear_old()
    assert read(index) == known
    assert index.compact(share=0.0, least=1) is not None and read(index) == known


def test_a_one_row_change_rewrites_no_bucket_it_does_not_touch(spark):
    index = DeltaIndex.create(rows(spark, [(i, i) for i in range(400)]), new_dir(spark, "delta"), buckets=16)
    base = files(index, "base")
    assert len({f.split("bucket=")[1].split("/")[0] for f in base}) == 16
    index.commit(rows(spark, [(7, 70)]))
    assert files(index, "base") == base
    touched = {f.split("bucket=")[1].split("/")[0] for f in files(index, "delta")}
    own = bucket_of(spark, [7], 16)[7]
    assert touched == {str(own)}
    assert index.compact(share=0.0) == [own]
    after = files(index, "base")
    assert {f: t for f, t in after.items() if f in base} == base
    assert {f.split("bucket=")[1].split("/")[0] for f in after.keys() - base.keys()} == {str(own)}
    assert read(index) == {i: i for i in range(400)} | {7: 70}
    # Compaction again has nothing to do; deltas that are merged are not read.
    assert index.compact(share=0.0) == []
    assert index._pending(index._state()).count() == 0


def test_small_changes_wait(spark):
    index = DeltaIndex.create(rows(spark, [(i, i) for i in range(200)]), new_dir(spark, "delta"), buckets=4)
    index.commit(rows(spark, [(i, -i) for i in range(5)]))
    assert index.compact(share=0.5) == []
    index.commit(rows(spark, [(i, -i) for i in range(200)]))
    assert index.compact(share=0.5) == [0, 1, 2, 3]


def test_an_unfinished_commit_does_not_count(spark):
    index = DeltaIndex.create(rows(spark, [(1, 1), (2, 2)]), new_dir(spark, "delta"), buckets=2)
    index.commit(rows(spark, [(1, 10)]))
    os.remove(f"{index.path}/state/commit=1/_SUCCESS")  # as if the writer had died before the end
    assert read(index) == {1: 1, 2: 2}
    index.commit(rows(spark, [(2, 20)]))
    assert read(index) == {1: 1, 2: 20}


def test_readers_keep_their_state(spark):
    index = DeltaIndex.create(rows(spark, [(1, 1), (2, 2)]), new_dir(spark, "delta"), buckets=2)
    before = index.read()
    index.commit(rows(spark, [(1, 10)]), spark.createDataFrame([(2,)], "id bigint"))
    index.compact(share=0.0)
    assert sorted(r["id"] for r in before.collect()) == [1, 2] and read(index) == {1: 10}


def test_keys(spark):
    index = DeltaIndex.create(rows(spark, [(1, 1), (None, 5), (None, 6)]), new_dir(spark, "delta"), buckets=2)
    assert read(index) == {1: 1}
    with pytest.raises(ValueError, match="comes twice"):
        index.commit(rows(spark, [(3, 3), (3, 4)]))
    index.commit(rows(spark, [(None, 9), (2, 2)]), spark.createDataFrame([(None,), (2,), (77,)], "id bigint"))
    assert read(index) == {1: 1, 2: 2}
    empty = DeltaIndex.create(rows(spark, []), new_dir(spark, "delta"), buckets=2)
    assert read(empty) == {}
    empty.commit(rows(spark, [(4, 4)]))
    assert read(empty) == {4: 4}


def test_sync_embeds_only_what_changed(spark):
    def documents(given):
        return spark.createDataFrame(list(given.items()), "id bigint, text string")
    seen = []
    def embed(df):
        seen.extend(r["id"] for r in df.select("id").collect())
        return df.select("id", F.array(F.length("text").cast("float")).alias("embedding"), HASH)
    old = {1: "one", 2: "two", 3: None, 4: "", 5: "five"}
    first = embed(documents(old).withColumn(HASH, content_hash(F.col("text"))))
    index = DeltaIndex.create(first, new_dir(spark, "delta"), buckets=4)
    seen.clear()
    new = {1: "one", 2: "twice", 3: "", 4: "", 6: "six"}
    diff = index.sync(documents(new), "text", embed)
    assert {tuple(r) for r in diff.collect()} == {(2, "update"), (3, "update"), (5, "delete"), (6, "insert")}
    assert sorted(seen) == [2, 3, 6]
    assert {r["id"]: r["embedding"] for r in index.read().collect()} == {1: [3.0], 2: [5.0], 3: [0.0], 4: [0.0], 6: [3.0]}
    assert index.sync(documents(new), "text", embed).collect() == []
    assert index._latest() == 1
