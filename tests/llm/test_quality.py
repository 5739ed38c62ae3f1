import re

from pyspark.sql import functions as F

from tests.llm.conftest import prose
from pagemill.llm.quality import frequent_lines, judged, measured, without_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [l for l in text.split("\n") if WORD.search(l)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark, docs, plain):
    more = ["a b c d e f g h " * 3, "x\nx\n\n x\nx", "# * $ < > | & %", "q " * 40, "one two three four five six seven eight nine one two three four five six seven eight"]
    rows = plain + [(1000 + i, t, "s1") for i, t in enumerate(more)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted((str(r["id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in measured(df).collect())
    assert got == sorted((str(i), *brute(t)) for i, t, _ in rows)


def _host(spark):
    own = lambda i: prose(500 + i, 30)
    rows = [(i, f"{own(i)}\nShared  FOOTER line {i % 10} of all pages", "a") for i in range(40)]
    rows += [(50 + i, "shared footer line 7 of all pages\nshort " + str(i), "a") for i in range(3)]
    rows += [(60 + i, own(60), "b") for i in range(30)] + [(99, "shared footer line 1 of all pages " * 4, "b")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_frequent_lines_and_depleted_documents(spark):
    df = _host(spark)
    found = frequent_lines(measured(df)).collect()
    # Digits are alike, copies of one text count once, another host has its own lines.
    assert [(r["host"], r["documents"]) for r in found] == [("=a", 43)]
    kept = {r["id"]: r["kept"] for r in judged(df).collect()}
    assert all(kept[i] for i in range(40)) and not any(kept[50 + i] for i in range(3)) and kept[60]
    clean = {r["doc"]["doc_id"]: r["clean"] for r in without_lines(df, frequent_lines(measured(df))).collect()}
    assert "FOOTER" not in clean[3] and clean[3] == prose(503, 30) and clean[50] == "short 0" and "footer" in clean[99]


def test_the_size_of_a_host_does_not_matter(spark):
    """One line in 15 documents, on a host of 100 documents and on one of 3,000."""
    line = "this line stands at the end of fifteen documents of either host whatever else the host may hold and it is long enough"
    rows = [(1_000_000 * n + i, prose(1_000_000 * n + i, 25) if i >= 15 else f"{prose(1_000_000 * n + i, 3)}\n{line}", f"h{n}")
            for n in (100, 3_000) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["id"]: r["kept"] for r in judged(df).collect()}
    assert all(kept[id] == (id % 1_000_000 >= 15) for id, _, _ in rows)
    # Of each host's share, only when it is asked for.
    found = frequent_lines(measured(df), share=0.01).collect()
    assert [(r["host"], r["documents"]) for r in found] == [("=h100", 15)]


def test_odd_rows(docs, empty, plain):
    rows = judged(docs).collect()
    assert len(rows) == len(plain)
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 20)
    assert judged(empty).collect() == []
    frequent = frequent_lines(measured(docs))
    assert without_lines(docs, frequent).count() == len(plain) and without_lines(empty, frequent).collect() == []
    assert without_lines(docs, frequent).filter(F.col("doc.text").isNull() != F.col("clean").isNull()).count() == 0
