import random
import warnings

import numpy as np
import pytest

from pagemill.llm.hashing import counted, shingles, word_hashes
from pagemill.llm.near_duplicates import classes, components, kept_documents, prob_min_hash
from tests.llm.conftest import prose


def brute(rows):
    """Class of each row by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        w = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else {text} if text else set())
    root = list(range(len(rows)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if (rows[i][1] or "") == (rows[j][1] or "") or (both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both)):
                root[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(i)
    out = []
    for m in members.values():
        ids = [rows[i][0] for i in m if rows[i][0] is not None]
        out += [(str(rows[i][0]), min(ids, default=None), len(m)) for i in m]
    return sorted(out, key=str)


def _edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = "zz%d" % rng.randrange(10**6)
    return " ".join(w)


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    base = [prose(1000 + i, 150) for i in range(6)]
    texts = [_edited(rng, b, rng.randrange(9)) for b in base for _ in range(25)] + [base[0]] * 40
    texts += [t.upper() + "!" for t in texts[:3]] + ["a b", "a  b", "c", "!!!", "", None, "!!!"]
    # A chain whose ends are no longer alike.
    chain = [base[5]]
    for _ in range(6):
        chain.append(_edited(rng, chain[-1], 3))
    texts += chain
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((str(r["id"]), r["class_id"], r["class_size"]) for r in found), key=str) == brute(rows)


def test_lines_repeated_in_one_text_of_a_pair(spark):
    rng = random.Random(11)
    new = lambda n: " ".join("w%d" % rng.randrange(10**9) for _ in range(n))
    texts = []
    for _ in range(30):
        body, footer = new(204), new(30)
        texts += [body, body + (" " + footer) * 1000]
    rows = list(enumerate(texts))
    found = classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = sorted(((str(r["id"]), r["class_id"], r["class_size"]) for r in found), key=str)
    assert got == brute(rows) and {r["class_size"] for r in found} == {2}


def test_odd_rows(docs, empty, plain):
    found = classes(docs).collect()
    got = sorted(((str(r["id"]), r["class_id"], r["class_size"]) for r in found), key=str)
    assert got == brute([(i, t) for i, t, _ in plain])
    kept = kept_documents(docs)
    assert kept.columns == docs.columns
    groups = {(c, n if c is None else 0, i if c is None else "") for i, c, n in brute([(i, t) for i, t, _ in plain])}
    assert kept.count() == len(groups)
    assert classes(empty).collect() == [] and kept_documents(empty).collect() == []


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    names = rng.integers(1, 2**63, 400).astype(np.uint64)
    x, y = rng.integers(1, 6, 300).astype(float), rng.integers(1, 6, 300).astype(float)
    a, b = dict(zip(names[:300], x / x.sum())), dict(zip(names[100:], y / y.sum()))
    all_ = {*a, *b}
    true = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in all_) for d in a.keys() & b.keys())
    owner = np.repeat([0, 1], 300)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        s = prob_min_hash(owner, np.concatenate((names[:300], names[100:])), np.concatenate((x, 7 * y)), 2, 4096)
    assert (s[0] == s[1]).mean() == pytest.approx(true, abs=0.03)


def test_shingles_of_a_batch_are_those_of_each_text():
    texts = ["one two three four five six", "", "!?", "One, TWO", "x" * 3000 + " y", "a b c d e"]
    owner, hashes = shingles(texts, 5)
    for i, text in enumerate(texts):
        assert sorted(hashes[owner == i]) == sorted(shingles([text], 5)[1])
    assert np.bincount(owner, minlength=6).tolist() == [2, 0, 1, 1, 1, 1]
    assert word_hashes(["Ab ab"])[0].tolist() == word_hashes(["ab", "AB"])[0].tolist()
    o, h, n = counted(*shingles(["a b a b a b a b", "c"], 2))
    assert sorted(zip(o.tolist(), n.tolist())) == [(0, 3), (0, 4), (1, 1)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
