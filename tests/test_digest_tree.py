"""Versions compared by digests against the diff of whole tables."""

import glob
import random
import re

import pytest
from pyspark.sql import functions as F

from pagemill.operators.changes import snapshot_diff
from pagemill.operators.digest_tree import differing_leaves, version_diff, write_version
from pagemill.session import new_dir

SCHEMA = "id bigint, a string, b string"


def table(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)


def stored(spark, rows, bits):
    path = new_dir(spark, "version")
    write_version(table(spark, rows), path, "id", ["a", "b"], bits)
    return path


def both(spark, old, new, bits=8):
    paths = [stored(spark, rows, bits) for rows in (old, new)]
    got = version_diff(spark, *paths, "id", ["a", "b"], table(spark, old), bits)
    want = snapshot_diff(table(spark, old), table(spark, new), "id", ["a", "b"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    return paths, got


@pytest.mark.parametrize("seed", range(3))
def test_random_changes(spark, seed):
    rng = random.Random(seed)
    old = {rng.randrange(10 ** 9): (str(rng.random()), rng.choice([None, "", "x"])) for _ in range(400)}
    new = dict(old)
    for key in rng.sample(sorted(old), 20):
        del new[key]
    for key in rng.sample(sorted(new), 20):
        new[key] = (new[key][0], "changed")
    new |= {rng.randrange(10 ** 9): ("new", None) for _ in range(20)}
    both(spark, old, new)


def test_a_one_row_change_reads_one_leaf_per_version(spark):
    old = {i: (f"a{i}", None) for i in range(3_000)}
    new = old | {77: ("other", None)}
    paths, got = both(spark, old, new)
    assert len(differing_leaves(spark, *paths, 8)) == 1
    for path in paths:
        assert len(glob.glob(f"{path}/rows/leaf=*")) > 200
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", got._jdf.queryExecution().executedPlan().toString())
    assert scans and all(re.fullmatch(r"(isnotnull\(leaf#\d+\), )?\(leaf#\d+ = \d+\)", s) for s in scans)


def test_at_the_borders_of_ranges(spark):
    """The first and the last key of a leaf, by hash, come and go."""
    keys = [r["id"] for r in spark.range(4_000).orderBy(F.expr("shiftrightunsigned(xxhash64(id), 0) >= 0"), F.xxhash64("id")).collect()]
    leaf = {r["id"]: r["l"] for r in spark.range(4_000).select("id", F.shiftrightunsigned(F.xxhash64("id"), 56).alias("l")).collect()}
    ends = [i for i in range(1, len(keys)) if leaf[keys[i]] != leaf[keys[i - 1]]][:6]
    old = {k: ("x", "y") for k in keys}
    for at in ends:
        new = {k: v for k, v in old.items() if k not in (keys[at - 1], keys[at])}
        paths, _ = both(spark, old, new)
        assert sorted(differing_leaves(spark, *paths, 8)) == sorted({leaf[keys[at - 1]], leaf[keys[at]]})
        break
    both(spark, {keys[ends[0]]: ("x", "y")}, {keys[ends[0] - 1]: ("x", "y")})


def test_equal_and_empty_versions(spark):
    rows = {i: ("a", None) for i in range(50)}
    for old, new in ((rows, rows), ({}, {}), ({}, rows), (rows, {}), (rows, {i: ("", "a") for i in range(50)})):
        both(spark, old, new, 4)
    # Values that only look alike when put together
    both(spark, {1: ("1:a|", "b"), 2: (None, "-")}, {1: ("1:a", "|b"), 2: ("-", None)}, 4)
    # Null keys are left out
    path = new_dir(spark, "version")
    write_version(spark.createDataFrame([(None, "x", "y"), (1, "a", "b")], SCHEMA), path, "id", ["a", "b"], 4)
    assert version_diff(spark, path, stored(spark, {1: ("a", "b")}, 4), "id", ["a", "b"], table(spark, rows), 4).collect() == []
