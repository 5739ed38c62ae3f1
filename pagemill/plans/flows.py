"""The flows a user runs: pages to chunks, questions to answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from ..operators.answers import (
    answer_format, completion_join, completion_parse, merged_context, rag_context, rag_prompt,
)
from ..operators.chunking import WhitespaceTokens, chunk_rows, page_chunks, titled
from ..sources.pages import sample_pages, valid_pages
from ..sources.tables import preview


def build_chunks(pages: DataFrame, tag: str = "h2", max_tokens: int = 4000, min_tokens: int = 100,
                 article: Column | None = None, tokenizer=WhitespaceTokens) -> DataFrame:
    """``id, page_id, url, title, chunk_idx, content, n_tokens, truncated``.

    Every step works on one page: a scan and projections, without a shuffle.
    """
    found = titled(valid_pages(pages, article))
    chunked = page_chunks(found, tag=tag, max_tokens=max_tokens, min_tokens=min_tokens,
                          tokenizer=tokenizer)
    return chunk_rows(chunked.drop("article"))


def preview_chunks(pages: DataFrame, build: Callable[[DataFrame], DataFrame], n: int = 2, key: str = "page_id") -> DataFrame:
    """The first ``n`` chunks in the order of their ids, which is that of pages.

    Only the first pages are chunked: as many as chunks are asked for, and four times as many
    while these have too few.
    """
    total, take = pages.count(), n
    while True:
        rows = preview(build(sample_pages(pages, take, key)), "id", n)
        if take >= total or rows.count() >= n:
            return rows
        take *= 4


def build_prompts(questions: DataFrame, index: DataFrame, documents: DataFrame, k: int = 1, **options) -> DataFrame:
    """Question, its best document and its prompt, which holds the ``k`` best ones; send
    the prompts to a model and store ``prompt_hash, response`` of what comes back."""
    context = rag_context(questions, index, documents, k=k, **options)
    return rag_prompt(context.drop("rank") if k == 1 else merged_context(context))


def answer_prompts(prompts: DataFrame, completions: DataFrame) -> DataFrame:
    """Answers of all prompts, with the status of each response."""
    return answer_format(completion_parse(completion_join(prompts, completions)))
