"""The manifest against a plain loop over its rules."""

import hashlib
import zlib
from collections import Counter

import pytest

from pagemill.llm import merkle
from pagemill.llm.merkle_queries import manifest_of
from tests.llm.conftest import document_rows


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(id, source, lang, n_chars, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (id, source, lang, n_chars, text)))


def levels(nodes):
    """Runs of each level up to the root."""
    out = []
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        out.append(runs)
        nodes = [H(*run) for run in runs]
    return out, nodes[0]


def expected(rows):
    groups = {}
    for id, text, lang, source, n in rows:
        hit = id is not None and zlib.crc32(str(id).encode()) % 3 == 0 and text is not None
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if hit else text
        groups.setdefault(lang, []).append((id is None, id or 0, leaf_of(id, source, lang, n, text), leaf_of(id, source, lang, n, lower), id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: levels([r[2] for r in sorted(groups[g])]) for g in order}
    top, root = levels([built[g][1] for g in order])
    found = Counter()
    for at, g in enumerate(order):
        for i, (_, _, leaf, changed, id) in enumerate(sorted(groups[g])):
            sides, fold = "", changed
            for runs, k in [(runs, i // 8 ** l) for l, runs in enumerate(built[g][0])] + [(runs, at // 8 ** l) for l, runs in enumerate(top)]:
                run, p = runs[k // 8], k % 8
                sides += "".join(run[:p] + run[p + 1:])
                fold = H(*run[:p], fold, *run[p + 1:])
            found[id, leaf, built[g][1], root, H(sides), fold, fold == root] += 1
    return found


def got(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("inside, part_rows", [(4, 200_000), (1, 20), (2, 7)])
def test_manifest(docs, monkeypatch, inside, part_rows):
    monkeypatch.setattr(merkle, "LEVELS", inside)
    monkeypatch.setattr(merkle.ranked, "__defaults__", (part_rows,))
    rows = [(*r[:2], *r[2:4], len(r[1] or "")) for r in document_rows()]
    assert got(manifest_of(docs)) == expected(rows)


@pytest.mark.parametrize("n", [1, 8, 9, 65, 600])
def test_sizes_of_a_group(spark, n, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = [(i, f"Text {i}", "en", "s", 6) for i in range(n)] + [(5, "x", None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert got(manifest_of(df)) == expected(rows)


def test_many_groups_and_one_large_group(spark):
    rows = [(i, "A" if i % 7 else None, f"g{i % 70}" if i % 3 else "hot", "s", 1) for i in range(900)] + [(None, "N", "hot", "s", 1)] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert got(manifest_of(df)) == expected(rows)


def test_empty_table_and_one_row(spark, empty):
    assert manifest_of(empty).collect() == []
    rows = [(7, "Only", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert got(manifest_of(df)) == expected(rows)


def test_a_changed_text_breaks_its_proof_only(spark):
    rows = [(i, "Upper" if i % 2 else "lower", "en", "s", 5) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for r in manifest_of(df).collect():
        assert r["verified"] == (not (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["doc_id"] % 2 == 1))
