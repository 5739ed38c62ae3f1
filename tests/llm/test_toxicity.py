import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm.registry import QUERIES
from pagemill.llm.toxicity import (
    KINDS, NEGATION_REACH, PRIOR, SYMBOLS, TARGET_REACH, Model, _clause, _fit, _reach, choose_terms, grammar, score, terms_of, train,
)

SF = "/root/testdata/sf0.1"
MODEL = Model((("idiot", "insult"), ("lowei*", "insult"), ("shab*", "doubtful")))


def test_held_out_rows(spark):
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op5_toxicity"](spark, SF).join(truth, "doc_id").filter("held_out").collect()
    hit = sum(r["toxic"] and r["predicted"] for r in rows)
    assert hit / sum(r["toxic"] for r in rows) > 0.85 and hit / sum(r["predicted"] for r in rows) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def _kinds(text):
    return {KINDS[i]: int(n) for i, n in enumerate(MODEL.counts(text)) if n}


def test_marks():
    kind = lambda aimed=0, negated=0, reported=0, symbol="insult": (symbol, aimed, negated, reported)
    assert _kinds("an idiot stood there") == {kind(): 1}
    assert _kinds("you are an idiot") == {kind(aimed=1): 1} == _kinds("What an IDIOT you are")
    assert _kinds("not an idiot") == {kind(negated=1): 1}
    assert _kinds("not here, and far away an idiot") == {kind(): 1}
    assert _kinds("she wrote that an idiot") == {kind(aimed=1, reported=1): 1}
    assert _kinds("you. Idiot!") == {kind(): 1}, "a border ends the clause"
    assert _kinds("loweischaft idiotic shabby") == {kind(): 1, kind(symbol="doubtful"): 1}
    assert _kinds("I will kill you") == {kind(aimed=1, symbol="threat"): 1}
    assert _kinds("") == _kinds("kind words") == {}


def test_weights_order_clauses():
    at = lambda text: MODEL.score(MODEL.counts(text))
    assert at("you idiot") > at("an idiot") > at("it said an idiot") > at("not an idiot") > at("nothing")


def test_composition_reads_as_its_parts():
    machine, parts = grammar(), (_reach("target", TARGET_REACH), _reach("negation", NEGATION_REACH), _clause("report"))
    rng = random.Random(0)
    for _ in range(200):
        state, alone = 0, [0, 0, 0]
        for symbol in rng.choices(SYMBOLS, k=30):
            state, marks = machine.steps[state, symbol]
            for k, part in enumerate(parts):
                alone[k], (mark,) = part.steps[alone[k], symbol]
                assert marks[k] == mark


def test_chosen_terms():
    candidates = ["rude", "vequ*", "veque*", "vequeu", "rare"]
    number = {t: i for i, t in enumerate(candidates)}
    texts = [{number[t] for t in terms} for terms in [["rude"]] * 20 + [["vequ*", "veque*", "vequeu"]] * 9 + [["vequ*"]] * 5 + [["rare", "rude"]] * 2]
    assert choose_terms(candidates, texts) == ("rude", "vequ*")
    nested = [{number["vequ*"], number["veque*"]}] * 10
    assert choose_terms(candidates, nested) == ("veque*",), "the longer one, where all texts have it"


def test_learned_from_labels(spark, docs, empty, plain):
    rows = [(i, f"clean words number{i} here", 0) for i in range(40)] + [(100 + i, f"some gruba{'abcdefghij'[i]} word{i}", 1) for i in range(10)]
    texts = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(900, 1), (None, 1), (901, None)], "doc_id bigint, toxic int")
    model = train(texts, labels, lambda df: df.cache())
    out = {r["doc"]["doc_id"]: r["predicted"] for r in score(texts, model).collect()}
    assert all(out[100 + i] for i in range(10)) and not any(out[i] for i in range(40)) and out[900] == 0
    assert score(docs, model).count() == len(plain) and score(empty, model).collect() == []
    none = train(empty, labels, lambda df: df.cache())
    assert none.terms == () and score(docs, none).agg(F.max("predicted")).first()[0] == 0


def test_terms():
    assert {"a", "don't", "grüße", "grüß*"} <= terms_of("A don't GRÜßE.")


@pytest.mark.parametrize("n", [300, 1_500, 10_000])
def test_any_number_of_insult_words(spark, n):
    """Each word in four toxic texts, as many clean texts: no term is out of reach."""
    rng = random.Random(n)
    letters = "abcdefghijklmnopqrstuvwxyz"
    some = lambda: "".join(rng.choices(letters, k=10))
    words, common = [some() for _ in range(n)], [some() for _ in range(400)]
    filler = lambda: " ".join(rng.choices(common, k=6))
    rows = [(4 * i + k, f"{filler()} {w} {filler()}", 1) for i, w in enumerate(words) for k in range(4)]
    rows += [(1_000_000 + i, filler(), 0) for i in range(4 * n)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(8)
    model = train(texts.drop("toxic"), texts.select("doc_id", "toxic"), lambda df: df.cache())
    found = score(texts, model).select("doc.toxic", "predicted").groupBy("toxic").agg(F.sum("predicted"), F.count("*"))
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == {1: (4 * n, 4 * n), 0: (0, 4 * n)}


def test_fit_converges_where_many_toxic_rows_have_no_match():
    kind = np.eye(len(KINDS))[0]
    rows = [{"toxic": 1, "counts": kind * 0, "count": 6_000}, {"toxic": 1, "counts": kind, "count": 3_000}, {"toxic": 0, "counts": kind * 0, "count": 6_000}]
    weights, bias = _fit(rows, 1.0)
    assert abs(bias) < 0.01 and weights[0] > 5  # half of the rows without a match are toxic
    for counts, clean in product((1e6, 1.0), (1.0, 1e4)):
        weights, bias = _fit([{"toxic": 1, "counts": kind * 8, "count": counts}, {"toxic": 0, "counts": kind * 0, "count": 1}], clean)
        assert np.isfinite(weights).all() and bias + 8 * weights[0] > 1 and bias < 0
    assert (_fit([{"toxic": 0, "counts": kind * 0, "count": 5}], 1.0)[0] == PRIOR).all()
