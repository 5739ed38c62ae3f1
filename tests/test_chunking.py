import random

import pytest
from pyspark.sql import functions as F

from pagemill.functions.plugins import ModelTokens
from pagemill.operators.chunking import (
    chunk_rows, chunk_stats, heading_chunks, page_chunks, paragraph_chunks,
)
from pagemill.plans.flows import build_chunks

DOC = """<h1>This is a title</h1>
<h2>Subtitle 1</h2>
Some description 1
<h2>Subtitle 2</h2>
And description 2"""


def chunks(spark, pages, fn=heading_chunks, **options):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, article string")
    rows = chunk_rows(fn(df, **options)).orderBy("id").collect()
    return [[r for r in rows if r["page_id"] == i] for i in range(len(pages))]


def walk(sections, limit, smallest):
    """The rule, one section at a time."""
    out, pending = [], []
    size = lambda parts: sum(len(p.split()) for p in parts)
    for i, section in enumerate(sections):
        if i and size(pending) > limit / 2:
            out.append(pending)
            pending = []
        pending = pending + [section]
    return out + ([pending] if size(pending) > smallest else [])


def test_golden_document(spark):
    two, = chunks(spark, [DOC], max_tokens=16, min_tokens=3)
    assert [r["content"].split() for r in two] == [
        "This is a title Subtitle 1 Some description 1".split(), "Subtitle 2 And description 2".split()]
    one, = chunks(spark, [DOC], max_tokens=20, min_tokens=3)
    assert len(one) == 1


def test_repeated_and_attributed_headings(spark):
    page = "<h2>Same</h2>a b c<H2 id='x'>Same</H2>d e f<h2>Same</h2>g h i<h2x>no</h2x>"
    rows, = chunks(spark, [page], max_tokens=6, min_tokens=0)
    assert [r["content"].split() for r in rows] == [
        ["Same", "a", "b", "c"], ["Same", "d", "e", "f"], ["Same", "g", "h", "ino"]]


def test_comparisons_are_strict(spark):
    half = "a b<h2>c</h2>d"          # pending 2 is not more than 4 / 2
    least = "a b c<h2>d</h2>e"       # the rest, 2, is not more than 2
    first, second = chunks(spark, [half, least], max_tokens=4, min_tokens=2)
    assert [r["n_tokens"] for r in first] == [4]
    assert [r["n_tokens"] for r in second] == [3]


def test_small_page_is_one_chunk_even_if_empty(spark):
    empty, small, dropped = chunks(spark, ["<div></div>", "<h2>a</h2>b<h2>c</h2>d", "a b c d e f g h"],
                                   page_chunks, max_tokens=7, min_tokens=10)
    assert [r["content"] for r in empty] == [""]
    assert [r["n_tokens"] for r in small] == [4]
    assert dropped == []


def test_long_section_loses_its_tail(spark):
    page = "<h1>t</h1>" + "w " * 50 + "<h2>next</h2>" + "v " * 30
    rows, = chunks(spark, [page], page_chunks, max_tokens=20, min_tokens=5)
    assert [(r["n_tokens"], r["truncated"], len(r["content"].split())) for r in rows] == [
        (51, True, 20), (31, True, 20)]
    stats = chunk_stats(spark.createDataFrame(rows)).first()
    assert (stats["n_chunks"], stats["n_tokens"], stats["n_truncated"]) == (2, 82, 2)


@pytest.mark.parametrize("seed", range(2))
def test_against_the_plain_rule(spark, seed):
    rnd = random.Random(seed)
    pages, expected = [], []
    for _ in range(120):
        sections = [" ".join("w%d" % rnd.randrange(9) for _ in range(rnd.randrange(9))) for _ in range(rnd.randrange(1, 14))]
        heads = [f" h{i} " for i in range(1, len(sections))]
        pages.append(sections[0] + "".join(f"<h2>{h}</h2>{s}" for h, s in zip(heads, sections[1:])))
        texts = [sections[0]] + [h + " " + s for h, s in zip(heads, sections[1:])]
        expected.append([" ".join(parts).split()[:12] for parts in walk(texts, 12, 3)])
    got = chunks(spark, pages, max_tokens=12, min_tokens=3)
    assert [[r["content"].split() for r in rows] for rows in got] == expected


def test_paragraphs_join_to_the_text(spark):
    text = "\n\n".join(" ".join(f"p{i}w{j}" for j in range(i % 7 + 1)) for i in range(40))
    df = spark.createDataFrame([(1, text)], "page_id bigint, text string")
    rows = chunk_rows(paragraph_chunks(df, max_tokens=20, min_tokens=0)).orderBy("id").collect()
    assert len(rows) > 3 and " ".join(r["content"] for r in rows).split() == text.split()


def test_chunks_join_to_the_page(spark):
    from pagemill.functions.html import html_to_text
    from pagemill.sources.pages import valid_pages
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = build_chunks(pages, "p", 200, 0).orderBy("id").collect()
    text = {r[0]: r[1].split() for r in valid_pages(pages).select("page_id", html_to_text(F.col("article"))).collect()}
    for page, words in text.items():
        own = [r for r in rows if r["page_id"] == page]
        assert sum(r["n_tokens"] for r in own) == len(words)
        kept = [w for r in own for w in r["content"].split()]
        if any(r["truncated"] for r in own):
            assert len(kept) == sum(min(r["n_tokens"], 200) for r in own)
        else:
            assert kept == words


def test_ids_do_not_depend_on_partitions(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    build = lambda df: {tuple(r) for r in build_chunks(df, "p", 200, 10).collect()}
    one, many = build(pages), build(pages.repartition(7))
    assert one == many and len({r[0] for r in one}) == len(one)


def test_too_many_chunks_is_an_error(spark):
    df = spark.createDataFrame([(1, 1 << 20)], "page_id bigint, chunk_idx int")
    from pagemill.operators.chunking import with_chunk_id
    with pytest.raises(Exception, match="chunks"):
        with_chunk_id(df).collect()


def test_model_tokenizer(spark):
    def setup():
        import tiktoken
        by_byte = tiktoken.Encoding("bytes", pat_str=r"[\s\S]", special_tokens={},
                                    mergeable_ranks={bytes([i]): i for i in range(256)})
        return by_byte.encode_ordinary_batch, by_byte.decode_batch

    tokens = ModelTokens(setup)
    rows, = chunks(spark, ["abcd<h2>ef</h2>ijklmnopqrstu"], page_chunks, max_tokens=7, min_tokens=1,
                   tokenizer=tokens)
    # Each line break a heading leaves is a byte of the count.
    assert [(r["n_tokens"], r["truncated"], r["content"]) for r in rows] == [
        (4, False, "abcd"), (17, True, "ef\nijkl")]
    df = spark.createDataFrame([("hello",), (None,)], "x string")
    assert [r[0] for r in df.select(tokens.count(F.col("x"))).collect()] == [5, None]


def test_only_marked_texts_are_cut(spark):
    from pyspark.sql import functions as F
    tokens = ModelTokens(lambda: (lambda texts: [list(t) for t in texts], lambda lists: ["".join(l) for l in lists]))
    df = spark.createDataFrame([(["abcdef", "abcdef", None], [True, False, False]), (None, None), ([], [])], "t array<string>, a array<boolean>")
    assert [r[0] for r in df.select(tokens.truncate_each(F.col("t"), F.col("a"), 3)).collect()] == [["abc", "abcdef", None], None, []]
    assert [r[0] for r in df.select(tokens.count_each(F.col("t"))).collect()] == [[6, 6, None], None, []]
