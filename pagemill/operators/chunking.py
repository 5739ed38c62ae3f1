"""Split pages and texts into size-limited chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import MARK, html_to_text, mark_sections, page_title
from ..functions.text import bind, newline_cleanup, token_count, token_truncate
from ..sources.layout import pinned

CHUNK_BITS = 20


class WhitespaceTokens:
    """The default tokenizer: native expressions, no Python worker."""

    @staticmethod
    def count_each(texts: Column) -> Column:
        return F.transform(texts, token_count)

    @staticmethod
    def truncate_each(texts: Column, above: Column, n: int) -> Column:
        return F.zip_with(texts, above, lambda t, a: F.when(a, token_truncate(t, n)).otherwise(t))


def _cut_points(counts: Column, max_tokens: int) -> Column:
    """Walk the sections of one page: where chunks start, and the tokens left over.

    Only section numbers are carried, so the walk stays cheap on long pages.
    """

    def step(acc: Column, n: Column) -> Column:
        full = (acc["i"] > 0) & (acc["pending"] * 2 > max_tokens)
        return F.struct(
            F.when(full, F.concat(acc["cuts"], F.array(acc["i"]))).otherwise(acc["cuts"]).alias("cuts"),
            F.when(full, n).otherwise(acc["pending"] + n).alias("pending"),
            (acc["i"] + 1).alias("i"),
        )

    start = F.struct(
        F.array(F.lit(0)).alias("cuts"),
        F.lit(0).cast("bigint").alias("pending"),
        F.lit(0).alias("i"),
    )
    return F.aggregate(counts, start, step)


def _chunk_array(
    sections: Column, counts: Column, total: Column, max_tokens: int, min_tokens: int,
) -> Column:
    """``array<struct<content, n_tokens, truncated>>`` from sections and their counts."""

    def build(walk: Column) -> Column:
        n_sections = F.size(sections)
        starts = F.when(total > max_tokens, walk["cuts"]).otherwise(F.array(F.lit(0)))
        ends = lambda s: F.concat(F.slice(s, 2, F.size(s)), F.array(n_sections))
        spans = bind(starts, lambda s: F.arrays_zip(s.alias("lo"), ends(s).alias("hi")))
        keep_last = (total <= max_tokens) | (walk["pending"] > min_tokens)
        return F.transform(
            bind(spans, lambda s: F.when(keep_last, s).otherwise(F.slice(s, 1, F.size(s) - 1))),
            one,
        )

    def one(span: Column) -> Column:
        lo, width = span.getField("lo"), span.getField("hi") - span.getField("lo")
        text = newline_cleanup(F.array_join(F.slice(sections, lo + 1, width), ""))
        n = F.aggregate(F.slice(counts, lo + 1, width), F.lit(0).cast("bigint"), lambda a, c: a + c)
        return bind(n, lambda k: F.struct(
            text.alias("content"),
            k.alias("n_tokens"),
            (k > max_tokens).alias("truncated"),
        ))

    return bind(_cut_points(counts, max_tokens), build)


def _chunk(
    df: DataFrame, marked: Column, max_tokens: int, min_tokens: int, out: str,
    tokenizer, to_text: Callable[[Column], Column], always_fold: bool = False,
) -> DataFrame:
    total = F.aggregate("_counts", F.lit(0).cast("bigint"), lambda a, c: a + c)
    split = (
        df.withColumn("_sections", F.split(to_text(marked), MARK))
        .withColumn("_counts", tokenizer.count_each(F.col("_sections")))
        .withColumn("_total", total)
    )
    raw = _chunk_array(
        F.col("_sections"), F.col("_counts"),
        F.lit(max_tokens + 1) if always_fold else F.col("_total"),
        max_tokens, min_tokens,
    )
    # Tokens are counted before cleanup, the limit is applied after it.
    content = tokenizer.truncate_each(F.col("_raw.content"), F.col("_raw.truncated"), max_tokens)
    chunks = F.arrays_zip(content.alias("content"), F.col("_raw.n_tokens").alias("n_tokens"),
                          F.col("_raw.truncated").alias("truncated"))
    return (pinned(split.withColumn("_raw", raw), "_raw").withColumn(out, chunks)
            .drop("_sections", "_counts", "_total", "_raw"))


def _stripped_text(marked: Column) -> Column:
    """Text of markup whose invisible parts ``mark_sections`` has removed."""
    return html_to_text(marked, stripped=True)


def heading_chunks(
    df: DataFrame, html: str = "article", tag: str = "h2", max_tokens: int = 4000,
    min_tokens: int = 100, out: str = "chunks", tokenizer=WhitespaceTokens,
) -> DataFrame:
    """Greedy sections of every page, also of those within the limit."""
    return _chunk(df, mark_sections(F.col(html), tag), max_tokens, min_tokens, out,
                  tokenizer, _stripped_text, always_fold=True)


def page_chunks(
    df: DataFrame, html: str = "article", tag: str = "h2", max_tokens: int = 4000,
    min_tokens: int = 100, out: str = "chunks", tokenizer=WhitespaceTokens,
) -> DataFrame:
    """One chunk for a page within the limit, greedy sections above it.

    A section starts at each opening ``tag``. Before a heading the pending text is
    closed when it holds more than half the limit; the last part is kept only when
    it holds more than ``min_tokens``. A part above the limit loses its tail and is
    marked ``truncated``.
    """
    return _chunk(df, mark_sections(F.col(html), tag), max_tokens, min_tokens, out,
                  tokenizer, _stripped_text)


def paragraph_chunks(
    df: DataFrame, text: str = "text", separator: str = "\n\n", max_tokens: int = 4000,
    min_tokens: int = 100, out: str = "chunks", tokenizer=WhitespaceTokens,
) -> DataFrame:
    """The same walk over plain text, a section starting at each separator."""
    clean = F.translate(F.col(text), MARK, "")
    marked = F.replace(clean, F.lit(separator), F.lit(MARK + separator))
    return _chunk(df, marked, max_tokens, min_tokens, out, tokenizer, lambda t: t)


def with_chunk_id(df: DataFrame, page_id: str = "page_id", position: str = "chunk_idx") -> DataFrame:
    """Stable ``id`` from page and position: a rebuild gives the same numbers."""
    limit = 1 << CHUNK_BITS
    pos = F.col(position)
    checked = F.when(pos < limit, pos).otherwise(
        F.raise_error(F.lit(f"a page has more than {limit} chunks")).cast("int"))
    return df.withColumn("id", F.col(page_id) * limit + checked)


def chunk_rows(df: DataFrame, page_id: str = "page_id", chunks: str = "chunks") -> DataFrame:
    """One row per chunk with its id; a page without chunks gives no row."""
    others = [c for c in df.columns if c != chunks]
    # The plain explode lets the optimizer test the array below the projections that
    # build it, computing it twice; the outer form with a filter on top does not.
    rows = df.select(*others, F.posexplode_outer(chunks).alias("chunk_idx", "_chunk"))
    return with_chunk_id(rows.filter("_chunk is not null"), page_id).select(
        "id", *others, "chunk_idx", "_chunk.content", "_chunk.n_tokens", "_chunk.truncated")


def chunk_stats(rows: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Chunks, tokens and truncated chunks of each page."""
    return rows.groupBy(page_id).agg(
        F.count("*").alias("n_chunks"),
        F.sum("n_tokens").alias("n_tokens"),
        F.max("n_tokens").alias("max_tokens"),
        F.sum(F.col("truncated").cast("bigint")).alias("n_truncated"),
    )


def titled(df: DataFrame, html: str = "article") -> DataFrame:
    """Add the page title taken from the article markup."""
    return df.withColumn("title", page_title(F.col(html)))
