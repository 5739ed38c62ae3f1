import pytest

from pagemill.llm.common import running_sum
from pagemill.llm.mixing import mixed, mixture, source_shares
from pyspark.sql import functions as F


def water_filled(sizes):
    """Targets by repeated sharing of what is left."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, list(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if 3 * sizes[s] < level * weight[s]]
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 1, "c": 2, "d": 500, None: 3}, {"a": 0, "b": 0}, {"a": 5}, {"a": 0, "b": 7, "c": 10_000, "é": 40}])
def test_targets(spark, sizes):
    rows = source_shares(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()
    want = water_filled(sizes)
    assert {r["source"]: r["target"] for r in rows} == pytest.approx(want)


def test_every_source_comes_to_its_target(docs, plain):
    rows = mixed(docs).collect()
    assert len(rows) == len(plain)
    words = {}
    for id, text, source in plain:
        words[source] = words.get(source, 0) + len((text or "").split(None))
    want = water_filled({s: sum(r["size"] for r in rows if r["source"] == s) for s in words})
    longest = max(r["size"] for r in rows)
    for source in words:
        mine = [r for r in rows if r["source"] == source]
        assert [r["target"] for r in mine] == pytest.approx([want[source]] * len(mine))
        assert abs(sum(r["taken"] for r in mine) - want[source]) <= 2 * longest
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) == sum(r["size"] for r in rows)


def test_reruns_agree(docs):
    key = lambda df: sorted(map(str, df.collect()))
    assert key(mixed(docs)) == key(mixed(docs.repartition(7)))


def test_mixture_repeats_whole_rows(docs):
    out = mixture(docs)
    assert out.columns == docs.columns
    times = {}
    for r in mixed(docs).collect():
        times[r["id"]] = times.get(r["id"], 0) + (-(-r["taken"] // r["size"]) if r["size"] else 1)
    got = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {k: n for k, n in times.items() if n}


def test_empty(empty):
    assert mixed(empty).collect() == [] and mixture(empty).collect() == []


def test_running_sum(spark):
    for n in (0, 1, 2, 9, 10, 1000):
        got = spark.range(1).select(running_sum(F.lit(list(range(n))).cast("array<bigint>")).alias("s")).first()["s"]
        assert got == [i * (i + 1) // 2 for i in range(n)]
