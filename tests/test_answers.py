import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagemill.functions.prompts import ChatWording, chat_prompt, prompt_hash
from pagemill.operators.answers import (
    answer_display, answer_records, local_questions, prompt_history, question_batch, rag_context,
)
from pagemill.operators.embedding import embed
from pagemill.operators.joins import in_ranges, preceding_rows
from pagemill.operators.training import (
    batch_page, qa_dataset, qa_join, question_rows, questions_parse, resume_pending,
)
from pagemill.operators import training
from pagemill.plans.flows import answer_prompts, build_prompts


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("given", [
    "one", ["one", "two"], pd.DataFrame({"q": ["one", "two"], "x": [1, 2]}),
    np.array([["one", "x"], ["two", "y"]]), np.array(["one", "two"]),
])
def test_local_questions(spark, given):
    expected = [(0, "one")] if isinstance(given, str) else [(0, "one"), (1, "two")]
    assert pairs(local_questions(spark, given)) == expected


def test_question_batch_takes_the_first_column(spark):
    df = spark.createDataFrame([(7, 12, "x")], "id long, n int, other string")
    assert pairs(question_batch(df, "id")) == [(7, "12")]
    with pytest.raises(ValueError):
        question_batch(df)


DOCS = [(1, "http://d/1", "billing usage of the workspace"), (2, "http://d/2", "cluster policies")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "id bigint, url string, content string")


def test_end_to_end(spark, docs):
    questions = local_questions(spark, ["How do I track billing usage?", "", "cluster policies\nplease"])
    index = embed(docs, "content")
    prompts = build_prompts(questions, index, docs, threshold=0.2)
    asked = {r["question_id"]: r for r in prompts.collect()}
    assert [asked[i]["document_id"] for i in range(3)] == [1, None, 2]
    w = ChatWording()
    assert asked[1]["prompt"] == w.open + w.system + w.close + w.instruction + w.question + w.end
    assert asked[0]["prompt"].count(DOCS[0][2]) == 1

    replies = {0: '{"candidates":[{"text":"Answer: see\\nthere"},{"text":"no"}]}', 2: '{"candidates":[{"te'}
    hashed = prompts.select("question_id", prompt_hash(F.col("prompt")).alias("prompt_hash"))
    stored = spark.createDataFrame(list(replies.items()), "question_id bigint, response string")
    answers = answer_prompts(prompts, hashed.join(stored, "question_id"))
    got = {r["question_id"]: r for r in answers.collect()}
    assert [got[i]["status"] for i in range(3)] == ["ok", "missing", "malformed"]
    assert got[0]["answer"] == ('Answer: see<br/>there<br/>For more details, '
                                '<a href="http://d/1">open the documentation</a>  ')
    assert got[1]["answer"] is None
    shown = {r["question_id"]: r for r in answer_display(answers).collect()}
    assert shown[0]["answer_html"].startswith("see<br/>there") and "\n" not in shown[0]["prompt_html"]
    records = answer_records(answers, 2).orderBy("batch_id").collect()
    assert [len(r["records"]) for r in records] == [2, 1]
    assert records[0]["records"][0]["answer"] == got[0]["answer"]


def test_no_match_means_no_context(spark, docs):
    questions = local_questions(spark, ["billing"])
    found = rag_context(questions, embed(docs, "content"), docs, threshold=0.99).first()
    assert found["document_id"] is None and found["content"] is None


def test_status_of_responses(spark):
    from pagemill.functions.responses import parse_completion
    cases = [('{"candidates":[{"text":"a"}]}', "ok"), ('{"candidates":[]}', "no candidates"), (None, "missing"),
             ('{"error":"x"}', "no candidates"), ("not json", "malformed"), ('{"candidates":[{}]}', "no candidates")]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)], "i int, r string").orderBy("i")
    assert [r[0]["status"] for r in df.select(parse_completion(F.col("r"))).collect()] == [s for _, s in cases]


@pytest.mark.parametrize("width", [1, 4, 4096])
def test_history_in_ranges(spark, width):
    rnd = random.Random(width)
    turns = [(c, t, f"{c}-{t}") for c in range(6) for t in rnd.sample(range(-20, 60), rnd.randrange(1, 40))]
    df = spark.createDataFrame(turns, "c bigint, t bigint, x string")
    got = {(r["c"], r["t"]): [h["x"] for h in r["h"]] for r in preceding_rows(df, "c", "t", ["x"], 3, "h", width).collect()}
    for c, t, _ in turns:
        before = sorted((u, x) for k, u, x in turns if k == c and u < t)
        assert got[(c, t)] == [x for _, x in before[-3:]]


def test_a_key_of_a_million_rows_with_orders_like_time_stamps(spark):
    """Ranges hold a bounded number of rows, whatever the key and however far apart the orders."""
    stamp = lambda c: F.lit(1_700_000_000_000_000) + c * 1_000_003 + F.pmod(F.xxhash64(c), F.lit(1_000))
    rows = spark.range(1_000_000).select(F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("c"), stamp(F.col("id")).alias("t"))
    sizes = [r["count"] for r in in_ranges(rows, "c", "t", 50_000).groupBy("_range").count().collect()]
    assert sum(sizes) == 1_000_000 and max(sizes) <= 150_000 and len(sizes) >= 8

    few = spark.range(20_000).select(F.lit(1).alias("c"), stamp(F.col("id")).alias("t"), F.col("id").alias("x"))
    got = preceding_rows(few, "c", "t", ["x"], 3, "h", 1_500).select("x", F.transform("h", lambda e: e["x"]).alias("h")).collect()
    assert len(got) == 20_000 and all(r["h"] == list(range(max(0, r["x"] - 3), r["x"])) for r in got)


def test_bucketed_join_moves_nothing(spark):
    from pagemill.registry.answer_queries import bucketed_pairs
    joined = bucketed_pairs(spark, "/root/testdata/sf0.001")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    spans = joined.groupBy("range").agg(F.min("question_id").alias("a"), F.max("question_id").alias("b")).orderBy("range").collect()
    assert len(spans) == 4 and all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_one_prompt_asked_very_often(spark):
    from pagemill.operators.answers import completion_join
    prompts = spark.range(300).select(F.col("id").alias("question_id"),
                                      F.when(F.col("id") < 100, "hi").otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("prompt"))
    done = spark.createDataFrame([("hi", "r"), ("p200", "s")], "p string, response string").select(
        prompt_hash(F.col("p")).alias("prompt_hash"), "response")
    got = completion_join(prompts, done).groupBy("response").count().collect()
    assert {r["response"]: r["count"] for r in got} == {"r": 100, "s": 1, None: 199}


def test_history_prompt(spark):
    turns = [(1, 0, "system", "rules"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 3, "user", "why")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    got = {r["turn"]: r for r in prompt_history(df, 2).collect()}
    assert got[3]["n_history"] == 2 and "\nuser: hi\nassistant: yes" in got[3]["prompt"] and "rules" not in got[3]["prompt"]


def test_question_lists(spark):
    rows = [(1, '["a","b"]'), (2, "plain"), (3, "[]"), (4, '["c"')]
    parsed = questions_parse(spark.createDataFrame(rows, "doc_id bigint, response string"))
    assert [r["doc_id"] for r in parsed.filter("reject").orderBy("doc_id").collect()] == [2, 4]
    first = "00000000000000000001-000000000"
    assert pairs(question_rows(parsed)) == [(first + "0", 1, 0, "a"), (first + "1", 1, 1, "b")]
    far = spark.createDataFrame([(2**62, '["x","y"]'), (2**40 * 2**20, '["z"]')], "doc_id bigint, response string")
    ids = [r["id"] for r in question_rows(questions_parse(far)).orderBy("id").collect()]
    assert len(set(ids)) == 3 and [int(i[:20]) for i in ids] == [2**60, 2**62, 2**62]


def test_training_set_with_one_large_document(spark, monkeypatch):
    monkeypatch.setattr(training.skew_join, "__defaults__", ("inner", 20, 4))
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("text"))
    questions = spark.range(90).select("id", F.when(F.col("id") < 40, 3).otherwise(F.col("id") % 6).alias("doc_id"),
                                       F.concat(F.lit("q"), F.col("id").cast("string")).alias("question"))
    joined = qa_join(questions, docs).collect()
    assert [r["question_id"] for r in joined] == [i for i in range(90) if i < 40 or i % 6 < 5]
    assert joined[0]["content"] == "d3"
    answers = spark.range(0, 90, 2).select(F.col("id").alias("question_id"), F.lit("a").alias("answer"))
    assert qa_dataset(questions, answers, docs).count() == len([i for i in range(0, 90, 2) if i < 40 or i % 6 < 5])


def test_training_set_writes_a_text_once(spark, tmp_path, monkeypatch):
    """60 texts of 40 kB with 20 questions each: the result holds 48 MB of texts, of 2.4 MB apart."""
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.expr(
        "concat_ws('', transform(sequence(1, 625), i -> sha2(concat(id, '-', i), 256)))").alias("text"))
    questions = spark.range(1200).select(F.format_string("q%05d", "id").alias("id"), (F.col("id") % 60).alias("doc_id"),
                                         F.lit("Why?").alias("question"))
    answers = questions.select(F.col("id").alias("question_id"), F.lit("So.").alias("answer"))
    qa_dataset(questions, answers, docs).write.parquet(f"{tmp_path}/set")
    assert sum(f.stat().st_size for f in (tmp_path / "set").glob("*.parquet")) < 5_000_000
    rows = spark.read.parquet(f"{tmp_path}/set")
    assert rows.count() == 1200 and rows.join(docs, "doc_id").filter("content <> text").count() == 0
    monkeypatch.setattr(training, "HOT_QUESTIONS", 10)
    assert pairs(qa_dataset(questions, answers, docs)) == pairs(rows)


@pytest.mark.parametrize("start,n", [(0, 1), (40, 25), (80, 10), (199, 5)])
def test_deep_pages_over_the_whole_key_range(spark, monkeypatch, start, n):
    top = 2**63 - 1
    width = -(-2**64 // 8)
    keys = sorted({-top - 1, top, *(-top - 1 + width * i + d for i in range(1, 8) for d in range(-14, 14))})[:200]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    monkeypatch.setattr(training, "NARROW_ROWS", 20)
    monkeypatch.setattr(training, "BINS", 8)
    assert [r["k"] for r in batch_page(df, "k", start, n).collect()] == keys[start:start + n]


@pytest.mark.parametrize("start,n", [(0, 10), (95, 10), (777, 25), (1990, 10), (1999, 10), (5000, 10)])
def test_deep_pages(spark, monkeypatch, start, n):
    keys = sorted(random.Random(1).sample(range(-10**15, 10**15), 1990) + list(range(10)))
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    monkeypatch.setattr(training, "NARROW_ROWS", 50)
    monkeypatch.setattr(training, "BINS", 8)
    assert [r["k"] for r in batch_page(df, "k", start, n).collect()] == keys[start:start + n]


@pytest.mark.parametrize("narrow", [10, 10_000])
def test_pages_with_null_keys(spark, monkeypatch, narrow):
    monkeypatch.setattr(training, "NARROW_ROWS", narrow)
    df = spark.createDataFrame([(None,)] * 3 + [(k,) for k in range(1000)], "k bigint")
    for start, n in ((0, 4), (600, 30), (997, 5), (999, 10), (1001, 5), (1003, 2)):
        want = ([*range(1000), None, None, None])[start:start + n]
        assert [r["k"] for r in batch_page(df, "k", start, n).collect()] == want


def test_several_documents_in_one_prompt(spark):
    from pagemill.plans.flows import build_prompts
    docs = spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(
        ["red apple", "red apple tree", "blue sea", "red"])], "id bigint, url string, content string")
    questions = spark.createDataFrame([(1, "red apple"), (2, "zzz qqq")], "question_id bigint, question string")
    rows = {r["question_id"]: r for r in build_prompts(questions, embed(docs, "content"), docs, k=2, threshold=0.3).collect()}
    assert "red apple\n\nred apple tree" in rows[1]["prompt"] and rows[1]["url"] == "u0"
    assert rows[2]["document_id"] is None and "apple" not in rows[2]["prompt"]


def test_resume_twice_is_once(spark):
    work = spark.range(100).withColumnRenamed("id", "k")
    done = spark.range(0, 100, 3).withColumnRenamed("id", "done_k")
    pending = resume_pending(work, done, "k", "done_k", 4)
    first = pending.filter("batch = 1")
    rest = resume_pending(work, done.union(first.select("k")), "k", "done_k", 4)
    assert pairs(rest) == pairs(pending.filter("batch <> 1")) and rest.filter("batch = 1").count() == 0
    everything = resume_pending(work, done.union(pending.select("k")), "k", "done_k", 4)
    assert everything.count() == 0


def test_sql_functions(spark):
    from pagemill.functions.sql_functions import register
    from pagemill.functions.prompts import TrainingWording
    register(spark, TrainingWording(page="It's a \\page:\n"))
    row = spark.sql("select question_request('D') q, parse_questions('[\"x\"]') p, parse_questions('x') n").first()
    assert json.loads(row["q"])["prompt"].startswith("It's a \\page:\nD")
    assert row["p"] == ["x"] and row["n"] is None
    plan = spark.sql("select question_prompt(cast(id as string)) from range(3)")._jdf.queryExecution().optimizedPlan().toString()
    assert "concat" in plan


def test_texts_are_joined_before_no_shuffle_of_every_question(spark, monkeypatch):
    """Ids that do not follow documents, ids and documents that come twice or are null."""
    from pagemill.operators import training
    monkeypatch.setattr(training, "RANGE_ROWS", 20)
    rows = [(f"{(i * 37) % 400:04}", i % 7 if i % 11 else None, 0, f"q{i}") for i in range(500)] + [(None, 1, 0, "none")]
    questions = spark.createDataFrame(rows, "id string, doc_id bigint, position int, question string")
    texts = [(0, "a"), (1, "b"), (2, "c"), (3, None), (4, "e"), (4, "f"), (None, "n")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    joined = training.qa_join(questions, docs)
    got = [tuple(r) for r in joined.collect()]
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda i: i or "")
    want = [(i, q, t) for i, d, _, q in rows for key, t in texts if d is not None and d == key]
    key = lambda r: tuple(str(c) for c in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    # Texts joined to each question would be sorted into ranges of their ids.
    assert "rangepartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
