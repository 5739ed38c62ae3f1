"""Keyword search: BM25 over words, exact, for a batch of queries."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.layout import gathered, partitioned, stored
from .kernels import TILE_CELLS, BestMatches, pieces, word_codes, word_lists
from .search import MATCH_SCHEMA, _rank

K1 = 1.2
B = 0.75
BROADCAST_BYTES = 32 << 20
TERM_BLOCK = 1_000_000
DOC_BLOCK = 32_768
WORD_BLOCK = 4_000_000      # words of the documents of a block, about
FAN_OUT = 1_000_000         # pairs of a document's word and a query, at once


def query_terms(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    """``query_id, term, qtf``: how often each word occurs in each query.

    Queries and documents are cut into words by the same function.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(lo, n) for lo, n in pieces(whole.column(1))):
                lists = word_lists(batch.column(1))
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                each = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), lists.flatten()], names=["query_id", "term"])
                yield each.filter(pc.not_equal(each.column(1), ""))

    rows = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(text).alias("text"))
    each = rows.mapInArrow(task, "query_id bigint, term string")
    return each.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def word_frequencies(docs: DataFrame, terms: DataFrame, few: bool, text: str = "text") -> DataFrame:
    """``term, df, length``: documents that hold each query word, in one pass.

    The row of the empty word, which no text holds, counts all documents and sums
    their lengths. Each task counts its own texts first, so a word that every
    document holds is no large group. ``few`` query words are sent to all tasks, which
    then count only those; otherwise a task counts all words of a piece of its texts.
    """
    texts, spark = docs.select(text), docs.sparkSession
    vocabulary = terms.select("term").distinct()
    shared = spark.sparkContext.broadcast(
        vocabulary.toArrow().column("term").combine_chunks().cast(pa.string()) if few else None)

    def counted(known: pa.Array, df: np.ndarray, length: int, n_docs: int) -> pa.RecordBatch:
        held = np.nonzero(df)[0]
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([known.take(pa.array(held)), pa.array([""])]),
            pa.array(np.append(df[held], n_docs)),
            pa.array(np.append(np.zeros(len(held), np.int64), length)),
        ], names=["term", "df", "length"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        df, length, n_docs = np.zeros(len(known or ()), np.int64), 0, 0
        for texts in (batch.column(0).slice(lo, n) for batch in batches for lo, n in pieces(batch.column(0))):
            lists = word_lists(texts)
            words = lists.flatten().unique().cast(pa.string()) if known is None else known
            doc, code, lengths = word_codes(lists, words)
            pairs = np.unique(doc * (len(words) + 1) + code)
            found = np.bincount(pairs % (len(words) + 1), minlength=len(words))
            if known is None:
                yield counted(words, found, int(lengths.sum()), len(lists))
                continue
            df += found
            length += int(lengths.sum())
            n_docs += len(lists)
        if known is not None:
            yield counted(known, df, length, n_docs)

    counts = gathered(texts).mapInArrow(task, "term string, df bigint, length bigint")
    summed = counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("length").alias("length"))
    if few:
        return summed
    return summed.join(vocabulary.unionByName(spark.createDataFrame([("",)], "term string")), "term", "left_semi")


def term_weights(terms: DataFrame, frequencies: DataFrame, n_docs: int) -> DataFrame:
    """``query_id, term, weight``: idf times query frequency; only words that occur."""
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return terms.join(frequencies, "term").select(
        "query_id", "term", (idf * F.col("qtf")).alias("weight"))


def keyword_search(
    queries: DataFrame, docs: DataFrame, k: int = 10, query_id: str = "query_id",
    query_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` best documents by BM25 for each query: ``query_id, rank, id, score``.

    A document without a common word is no match. Tasks score whole documents against
    all queries at once and shuffle only the k best. Query words of up to
    ``broadcast_bytes`` are sent to all tasks; more are joined to the documents block by block.
    """
    terms = stored(query_terms(queries, query_id, query_text), "query-terms")
    d = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(doc_text, F.lit("")).alias("text"))
    n_terms, size = terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0))).first()
    few = size <= broadcast_bytes
    frequencies = stored(word_frequencies(d, terms, few), "word-frequencies")
    total = frequencies.filter("term = ''").first()
    n_docs, length = (total["df"], total["length"]) if total else (0, 0)
    mean = length / n_docs if n_docs else 0.0
    weighted = term_weights(terms, frequencies, n_docs)
    if few:
        return _rank(_scan(d, weighted.toArrow(), k, mean), k)
    return _rank(_block_join(d, weighted, k, mean, n_docs, n_terms, length), k)


class Postings(NamedTuple):
    """The queries of each word, as arrays."""

    query_ids: np.ndarray
    words: pa.Array
    starts: np.ndarray
    queries: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, weighted: pa.Table) -> Postings:
        query_ids, query = np.unique(weighted.column("query_id").to_numpy(), return_inverse=True)
        coded = weighted.column("term").combine_chunks().dictionary_encode()
        term = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        starts = np.searchsorted(term[order], np.arange(len(coded.dictionary) + 1))
        return cls(query_ids, coded.dictionary, starts, query[order],
                   weighted.column("weight").to_numpy()[order])

    def add_documents(self, best: BestMatches, ids: pa.Array, texts: pa.Array, mean: float) -> None:
        """Score the documents against all queries, a bounded tile at a time."""
        width = max(1, TILE_CELLS // max(1, len(self.query_ids)))
        for lo, n in pieces(texts, width):
            part = ids.slice(lo, n).to_numpy(zero_copy_only=False)
            best.add(self.scores(texts.slice(lo, n), mean), part)

    def scores(self, texts: pa.Array, mean: float) -> np.ndarray:
        """BM25 of shape (queries, texts); ``-inf`` where no word is shared."""
        lists = word_lists(texts)
        n, n_queries, n_words = len(lists), len(self.query_ids), max(1, len(self.words))
        row, code, length = word_codes(lists, self.words)
        pair, tf = np.unique(row * n_words + code, return_counts=True)
        doc, term = pair // n_words, pair % n_words
        part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / (mean or 1.0)))

        total = np.zeros(n_queries * n)
        # Each word of a document meets all its queries, a bounded number at a time.
        fan_out = self.starts[term + 1] - self.starts[term]
        ends = np.cumsum(fan_out)
        lo = 0
        while lo < len(term):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + FAN_OUT, side="right")))
            f = fan_out[lo:hi]
            before = np.concatenate([[0], np.cumsum(f)[:-1]])
            at = np.repeat(self.starts[term[lo:hi]] - before, f) + np.arange(f.sum())
            cell = self.queries[at] * n + np.repeat(doc[lo:hi], f)
            total += np.bincount(cell, weights=self.weights[at] * np.repeat(part[lo:hi], f),
                                 minlength=n_queries * n)
            lo = hi
        total[total == 0] = -np.inf   # every shared word adds more than nothing
        return total.reshape(n_queries, n)


def _scan(docs: DataFrame, weighted: pa.Table, k: int, mean: float) -> DataFrame:
    # A plain tuple: broadcast values are unpickled without this package.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(Postings.of(weighted)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = Postings(*shared.value)
        best = BestMatches(len(postings.query_ids), k)
        for batch in batches:
            postings.add_documents(best, batch.column(0), batch.column(1), mean)
        yield best.rows(postings.query_ids)

    return gathered(docs).mapInArrow(task, MATCH_SCHEMA)


def _block_join(docs: DataFrame, weighted: DataFrame, k: int, mean: float,
                n_docs: int, n_terms: int, n_words: int) -> DataFrame:
    """Blocks of queries against blocks of documents, each pair of blocks in a group
    of bounded size. A word in a third of all documents is spread over all blocks."""
    d_blocks, q_blocks = max(-(-n_docs // DOC_BLOCK), -(-n_words // WORD_BLOCK)) or 1, -(-n_terms // TERM_BLOCK) or 1
    own = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    d = docs.withColumn("db", own("id", d_blocks)).withColumn("qb", each(q_blocks))
    q = weighted.withColumn("qb", own("query_id", q_blocks)).withColumn("db", each(d_blocks))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        postings = Postings.of(left)
        best = BestMatches(len(postings.query_ids), k)
        ids, texts = (right.column(c).combine_chunks() for c in ("id", "text"))
        postings.add_documents(best, ids, texts, mean)
        return pa.Table.from_batches([best.rows(postings.query_ids)])

    keys = ("db", "qb")
    q, d = (partitioned(side, keys, d_blocks * q_blocks) for side in (q, d))
    return q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInArrow(block, MATCH_SCHEMA)
