import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pagemill.llm.secrets import RULES, candidates, postings, redact, scan, trigram_query


def brute(text):
    found = []
    for rank, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), rank, m.end(), rule.kind))
    return sorted(found)


PIECES = ["token", "=", ":", " ", "  ", "secret", "API_KEY", "apikey", "'", '"', "abc", "abcdef", "AKIA", "AKIA" + "Q7" * 9, "deadbeef" * 3,
          "0123456789abcdef", "é🤦", "\n", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1B2" * 9, "xoxb-1234567890-ab", "password", "p" * 30]


def test_spans_equal_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(400)] + [None, "", "token=token:abcdefgh"]
    texts.append(" ".join("f" * 24 for _ in range(3000)))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc"]["doc_id"]: [tuple(s) for s in r["spans"]] for r in scan(rows).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_odd_rows(docs, empty, plain):
    rows = scan(docs).collect()
    got = sorted((str(r["doc"]["doc_id"]), str(r["doc"]["text"]), str([tuple(s) for s in r["spans"]])) for r in rows)
    assert got == sorted((str(i), str(t), str(brute(t))) for i, t, _ in plain)
    assert scan(empty).collect() == []


def test_trigram_queries():
    assert trigram_query("[0-9a-f]{24,}") is None
    assert trigram_query("AKIA[A-Z]+") == (frozenset({"aki", "kia"}),)
    assert set(trigram_query("(?i)(Tokens?|key)=")) == {frozenset({"tok", "oke", "ken", "en="}), frozenset({"tok", "oke", "ken", "ens", "ns="}),
                                                      frozenset({"key", "ey="})}


def test_every_match_is_a_candidate(spark):
    texts = [(0, "my TOKEN: abcdef"), (1, "nothing here"), (2, "tok oke ken apart"), (3, "AKIAAKIA")]
    rows = spark.createDataFrame(texts, "key bigint, text string")
    kinds = {r["key"]: set(r["kinds"]) for r in candidates(spark, postings(rows, "key", "text")).collect()}
    assert "assign" in kinds[0] and 1 not in kinds and "access" in kinds[3]


def test_redacted_texts_have_no_secret(spark):
    texts = ["a token = 'abcdefgh' b", "k " + "ab12" * 8 + " z", "nothing", "token=abc", None, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r["t"] for r in rows.select(redact(F.col("text")).alias("t")).collect()]
    assert got == ["a [SECRET]' b", "k [SECRET] z", "nothing", "token=abc", None, ""]
    assert all(not brute(t) for t in got)


def test_digest_of_no_span(spark):
    from pagemill.llm.registry import QUERIES
    r = QUERIES["op3_secret_scan"](spark, "/root/testdata/sf0.001").filter("spans = ''").first()
    assert r["base_sha256"] == hashlib.sha256(b"").hexdigest()
