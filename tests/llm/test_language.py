import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm.language import letter_groups, predict, train
from pagemill.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.crc32(F.col("doc_id").cast("string")).alias("c"))
    rows = QUERIES["op2_language_id"](spark, SF).join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r["held_out"] == (r["c"] % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert sum(r["rejected"] for r in rows) <= 0.02 * len(rows)


def test_groups_of_a_batch_are_those_of_each_text():
    texts = ["Hello, wörld", "", "a", "123", "x y"]
    owner, bucket = letter_groups(texts)
    for i, text in enumerate(texts):
        assert sorted(bucket[owner == i]) == sorted(letter_groups([text])[1])
    assert len(letter_groups(["a"])[0]) == 3 and len(letter_groups(["123"])[0]) == 0


def _labelled(spark):
    rng = np.random.default_rng(0)
    words = {"aa": ["the", "and", "this", "with"], "bb": ["der", "und", "nicht", "mit"]}
    rows = [(i, " ".join(rng.choice(words[l], 20)), l) for i, l in enumerate(["aa", "bb"] * 60)]
    return spark.createDataFrame(rows + [(500, "zz", None), (501, None, "aa"), (502, "", "bb")], "doc_id bigint, text string, lang string")


def test_learned_and_unknown(spark, docs, plain):
    model = train(_labelled(spark))
    assert model.languages == ("aa", "bb")
    texts = [("and the this", "aa", False), ("UND NICHT mit", "bb", False), (None, "und", True), ("", "und", True), ("12 !", "und", True)]
    out = predict(spark.createDataFrame([(t,) for t, *_ in texts], "text string"), model).collect()
    assert [(r["lang_pred"], r["rejected"]) for r in out] == [(l, x) for _, l, x in texts]
    strange = predict(spark.createDataFrame([("qqqq xxxx кириллица",)], "text string"), model).first()
    assert strange["score"] < 0.9
    rows = predict(docs, model).collect()
    assert len(rows) == len(plain) and rows[0]["doc"].asDict().keys() == set(docs.columns)


def test_unlearned_is_rejected_and_two_languages_are_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(docs)
    def rejected(texts):
        rows = predict(spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1), model).collect()
        return [r["rejected"] for r in sorted(rows, key=lambda r: r["doc"]["i"])]
    rng = np.random.default_rng(2)
    junk = "".join(rng.choice(list("bcdfghjklmnpqrstvwxz "), 300))
    assert rejected(["кириллица и другие слова", "日本語のテキスト", "Ελληνικά κείμενο", junk]) == [True] * 4
    by = {l: [r["text"][:600] for r in docs.filter((F.col("lang") == l) & (F.length("text") > 600)).orderBy("doc_id").limit(10).collect()] for l in ("de", "en", "fr")}
    both = [f"{a} {b}" for x, y in (("de", "en"), ("fr", "de"), ("en", "fr")) for a, b in zip(by[x], by[y])]
    assert sum(rejected(both)) <= 1
    two = train(_labelled(spark))
    out = predict(spark.createDataFrame([("qqqq xxxx кириллица",), ("кириллица",)], "text string"), two).collect()
    assert all(r["rejected"] for r in out)


def test_same_model_again(spark):
    a, b = train(_labelled(spark)), train(_labelled(spark).repartition(5))
    assert np.array_equal(a.table, b.table) and a.least == b.least


def test_nothing_to_learn_from(spark, empty, docs, plain):
    assert train(empty) is None and predict(empty, None).collect() == []
    assert {r["lang_pred"] for r in predict(docs, None).collect()} == {"und"}
    one = train(spark.createDataFrame([(1, "only one", "aa")], "doc_id bigint, text string, lang string"))
    assert one.languages == ("aa",)


def test_driver_holds_the_sample_as_arrays(spark):
    """About 2,000 letter groups and counts in each of 200 rows: as Python numbers, and the rows
    they came in, these were more than the model and a few bytes each."""
    text = F.expr("concat_ws(' ', transform(sequence(1, 700), i -> translate(conv(substr(md5(concat(id, '-', i)), 1, 8), 16, 26), '0123456789', 'qrstuvwxyz')))")
    rows = spark.range(200).withColumn("text", text).select(F.col("id").alias("doc_id"), "text", F.lit("aa").alias("lang"))
    entries = sum(len(np.unique(letter_groups([r["text"]])[1])) for r in rows.collect())
    tracemalloc.start()
    model = train(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.languages == ("aa",) and entries > 300_000
    assert peak < 45 * entries + 16 * model.rarity.nbytes + 24 * len(model.rarity) * 8
