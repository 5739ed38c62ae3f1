import corpus_pipeline
from tests.llm.test_mixing import water_filled
from tests.llm.test_near_duplicates import brute as classes_of
from tests.llm.test_secrets import brute as secrets_in


def _written(df, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stage") / "out")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_stages_on_odd_rows(spark, docs, tmp_path_factory):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "secret_scans", "source_mix", "packing"]
    at = docs
    for name in list(stages)[:-1]:
        before, at = at.collect(), _written(stages[name](spark, at, ""), tmp_path_factory)
        assert at.columns == docs.columns
        after = at.collect()
        texts = [r["text"] for r in after]
        if name == "language_id":
            assert all(any(c.isalpha() for c in t) for t in texts) and len(after) >= 60
        elif name == "near_duplicates":
            groups = classes_of([(r["doc_id"], r["text"]) for r in before])
            assert len(after) == len({c for _, c, _ in groups if c is not None}) + sum(c is None for _, c, _ in groups)
        elif name == "secret_scans":
            assert len(after) == len(before) and not any(secrets_in(t) for t in texts)
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        else:
            size = lambda rows: {s: sum(len(r["text"].split()) for r in rows if r["source"] == s) for s in {r["source"] for r in rows}}
            want, got, longest = water_filled(size(before)), size(after), max(len(r["text"].split()) for r in before)
            assert all(abs(got.get(s, 0) - want[s]) <= 2 * longest for s in want)
    packed = stages["packing"](spark, at, "").collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in at.collect()}


def test_stages_on_an_empty_table(spark, empty, tmp_path_factory):
    at = empty
    for _, stage in corpus_pipeline.STAGES:
        at = _written(stage(spark, at, ""), tmp_path_factory)
        assert at.collect() == []


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    filled = {}
    for r in rows:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert rows and max(filled.values()) <= 1024
