"""A stored inverted index for BM25, read with block-max pruning.

Build: a task turns its texts into segments of a bounded number of documents and postings,
each inverted where it is made; texts are cut into words once and never moved. A row of the
index is a term of a segment, so a term that every document holds is one row per segment. Its
postings lie in slots of ``SLOT`` neighbouring documents. For each slot the row keeps the pairs
of frequency and length that no other posting of the slot beats in both: whatever the mean
length of the corpus becomes, the largest BM25 share of the slot follows from them. Rows are
written by range of terms; the first and last term of each range are kept, so a query opens
only folders that can hold its words.

Search: the rows of the queries' words meet by segment. In a segment a query visits slots in
the order of what they can score at most and stops where that is below its k-th best score. In
a slot, words that together cannot lift a document to that score are looked up only for
documents that the other words brought (MaxScore). What is not visited is not decoded. Scores
and ranks are those of ``keyword_search``.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layout import partitioned, stored
from ..sources.tables import append_batch
from .kernels import SCORE_DIGITS, BestMatches, pieces, word_codes, word_lists
from .keyword import BROADCAST_BYTES, K1, TERM_BLOCK, B, query_terms, term_weights
from .search import MATCH_SCHEMA, _rank

SLOT = 128
SEGMENT_LIMIT = 65_536          # what two bytes can number
SEGMENT_DOCS = 16_384           # a multiple of SLOT
SEGMENT_POSTINGS = 4_000_000    # a segment is closed from here on; a document stays whole
PIECE = 1_024                   # documents added at once
RANGE_ROWS = 500_000            # rows of the index per range of terms
KEPT = 20_000                   # decoded slots that a segment keeps
AT_ONCE = 8                     # slots visited, at most, before the k-th best score is looked at again
SLACK = 2 * 10.0 ** -SCORE_DIGITS

_LISTS = ("slots", "ends", "impact_ends", "impact_tf", "impact_len")
#: The row of the empty term, which no text holds, has the segment's ids and lengths.
INDEX = ("segment bigint, term string, n int, hits bigint, "
         + "".join(f"{c} array<int>, " for c in _LISTS) + "docs binary, tfs binary")


class Inverted:
    """Postings of the documents of one segment."""

    def __init__(self):
        self.ids, self.lengths, self.parts, self.docs, self.postings = [], [], [], 0, 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        lists = word_lists(texts)
        words = lists.flatten().unique().cast(pa.string())
        doc, code, length = word_codes(lists, words)
        pair, tf = np.unique(doc * max(1, len(words)) + code, return_counts=True)
        doc, code = pair // max(1, len(words)), pair % max(1, len(words))
        self.parts.append((words, code.astype(np.int32), (doc + self.docs).astype(np.int32), tf.astype(np.int32)))
        self.ids.append(ids.to_numpy(zero_copy_only=False))
        self.lengths.append(length)
        self.docs += len(ids)
        self.postings += len(pair)

    def closed(self, segment: int) -> pa.RecordBatch:
        coded = pa.concat_arrays([words for words, *_ in self.parts]).dictionary_encode()
        terms = coded.dictionary
        order = pc.sort_indices(terms).to_numpy()
        rank = np.empty(len(terms), np.int64)
        rank[order] = np.arange(len(terms))
        numbers, at = rank[coded.indices.to_numpy(zero_copy_only=False)].astype(np.int32), 0
        code = []
        for words, c, *_ in self.parts:
            code.append(numbers[at:at + len(words)][c])
            at += len(words)
        term, doc, tf = np.concatenate(code), *(np.concatenate([p[k] for p in self.parts]) for k in (2, 3))
        self.parts = code = None                    # a segment's postings are held once
        by = np.argsort(term * np.int64(SEGMENT_LIMIT) + doc, kind="stable")
        term, doc, tf = term[by], doc[by], tf[by]
        del by
        length = np.concatenate(self.lengths)
        total = len(term)
        known, term_start = np.unique(term, return_index=True)   # words without postings have no row
        slot = doc // SLOT
        begins = np.append(True, (term[1:] != term[:-1]) | (slot[1:] != slot[:-1]))[:total]
        block_start = np.flatnonzero(begins)
        block_of_term = np.searchsorted(block_start, term_start)
        # Impacts: by falling frequency, only what is shorter than all before it in the block.
        number = np.cumsum(begins, dtype=np.int32) - np.int32(1)
        del term, slot, begins
        falling = np.lexsort((length[doc], -tf, number))
        key = length[doc[falling]] - number[falling] * np.int64(int(length.max(initial=0)) + 1)
        least = np.minimum.accumulate(key)
        keep = falling[np.append(True, key[1:] < least[:-1])[:total]]
        del falling, key, least
        impact_end = np.searchsorted(number[keep], np.arange(len(block_start)), side="right")
        first_impact = np.append(0, impact_end)[block_of_term]
        counts = np.diff(np.append(term_start, total))
        per_term = np.diff(np.append(block_of_term, len(block_start)))
        ends = np.diff(np.append(block_start, total))
        def lists(offsets, values):
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
        def binary(data: np.ndarray, starts, width):
            offsets = np.append(starts, total).astype(np.int32) * width
            return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
        blocks, impacts = np.append(block_of_term, len(block_start)), np.append(first_impact, len(keep))
        of_term = np.repeat(np.arange(len(known)), per_term)
        rows = pa.RecordBatch.from_arrays([
            pa.array(np.full(len(known), segment)), terms.take(pa.array(order[known])), pa.array(counts, pa.int32()),
            pa.array(np.add.reduceat(tf, term_start, dtype=np.int64) if total else np.zeros(0, np.int64), pa.int64()),
            lists(blocks, doc[block_start] // SLOT),
            lists(blocks, (block_start + ends) - np.repeat(term_start, per_term)),
            lists(blocks, impact_end - first_impact[of_term]),
            lists(impacts, tf[keep]), lists(impacts, length[doc[keep]]),
            binary(doc.astype("<u2"), term_start, 2), binary(tf.astype("<u4"), term_start, 4)], _names())
        ids = np.concatenate(self.ids)
        own = pa.RecordBatch.from_arrays([
            pa.array([segment]), pa.array([""]), pa.array([len(ids)], pa.int32()), pa.array([int(length.sum())], pa.int64()),
            *(pa.array([[]], pa.list_(pa.int32())) for _ in _LISTS),
            pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([length.astype("<i4").tobytes()], pa.binary())], _names())
        return pa.Table.from_batches([own, rows]).combine_chunks().to_batches()[0]


def _names() -> list[str]:
    return ["segment", "term", "n", "hits", *_LISTS, "docs", "tfs"]


def _inverted(segment_docs: int, segment_postings: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 33, Inverted()
        for batch in batches:
            for lo, n in pieces(batch.column(1), min(PIECE, segment_docs)):
                piece = batch.slice(lo, n)
                if held.docs + piece.num_rows > segment_docs or held.postings >= segment_postings:
                    yield held.closed(number)
                    number, held = number + 1, Inverted()
                held.add(piece.column(0), piece.column(1))
        if held.docs:
            yield held.closed(number)
    return task


def append_keyword_index(docs: DataFrame, path: str, batch: int = 0, doc_id: str = "doc_id", doc_text: str = "text",
                         segment_docs: int = SEGMENT_DOCS, segment_postings: int = SEGMENT_POSTINGS, range_rows: int = RANGE_ROWS) -> None:
    """Index ``docs`` as one batch of the index at ``path``; the same batch replaces itself.

    Rows without an id cannot be found and are left out; a null text has no words. Rows with the
    same id are documents of their own. Batches must hold different documents.
    """
    d = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(doc_text, F.lit("")).alias("text"))
    rows = stored(d.mapInArrow(_inverted(segment_docs, segment_postings), INDEX), "segments")
    ranges = max(1, -(-rows.count() // range_rows))
    order = ["term", "segment"]
    ranged = (rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
              .sortWithinPartitions("range", *order))
    folder = f"{path}/postings/batch={batch}"
    ranged.write.mode("overwrite").partitionBy("range").parquet(folder)
    written = docs.sparkSession.read.schema(f"{INDEX}, `range` int").parquet(folder)
    append_batch(written.groupBy("range").agg(F.min("term").alias("first"), F.max("term").alias("last")), f"{path}/ranges", batch)


@dataclass(frozen=True)
class KeywordIndex:
    """The index at ``path`` as it is now."""

    spark: SparkSession
    path: str

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"{INDEX}, batch int, `range` int").parquet(f"{self.path}/postings").withColumn(
            "segment", F.struct("batch", "segment"))

    def with_terms(self, terms: list[str] | None) -> DataFrame:
        """Rows of these terms (of all by default) from the ranges that can hold them.

        The list of ranges has one row for some hundred thousand rows of the index.
        """
        if terms is None:
            return self.rows
        wanted, kept = sorted(terms, key=str.encode), {}
        spelled = [t.encode() for t in wanted]
        for r in self.spark.read.schema("`range` int, `first` string, `last` string, batch int").parquet(f"{self.path}/ranges").collect():
            at = bisect.bisect_left(spelled, r["first"].encode())
            if at < len(spelled) and spelled[at] <= r["last"].encode():
                kept.setdefault(r["batch"], []).append(r["range"])
        here = [(F.col("batch") == b) & F.col("range").isin(r) for b, r in kept.items()]
        found = F.lit(False)
        for condition in here:
            found = found | condition
        table = self.spark.createDataFrame([(t,) for t in wanted], "term string")
        return self.rows.filter(found).join(F.broadcast(table), "term", "left_semi")

    def totals(self) -> tuple[int, int]:
        """Documents, and words in all of them."""
        own = self.with_terms([""]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("hits"), F.lit(0)).alias("hits")).first()
        return own["n"], own["hits"]

    def statistics(self) -> DataFrame:
        """``term, df, hits, largest``: documents that hold a term, how often, and the largest share
        of a score (without idf) that the term gives any document."""
        n, hits = self.totals()
        mean = hits / n if n else 0.0
        share = F.aggregate(F.arrays_zip("impact_tf", "impact_len"), F.lit(0.0), lambda best, x: F.greatest(best, _share(
            x["impact_tf"], x["impact_len"], mean)))
        return self.rows.filter("term <> ''").groupBy("term").agg(
            F.sum("n").alias("df"), F.sum("hits").alias("hits"), F.max(share).alias("largest"))

    def search(self, queries: DataFrame, k: int = 10, query_id: str = "query_id", query_text: str = "text",
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """The ``k`` best documents by BM25 for each query: ``query_id, rank, id, score``.

        Query words of up to ``broadcast_bytes`` are sent to all tasks; more meet the segments
        in blocks of queries.
        """
        terms = stored(query_terms(queries, query_id, query_text), "query-terms")
        n_terms, size = terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0))).first()
        few = size <= broadcast_bytes
        wanted = [r["term"] for r in terms.select("term").distinct().collect()] if few else None
        n, hits = self.totals()
        mean = hits / n if n else 0.0
        rows = self.with_terms(wanted and [*wanted, ""] if few else None)
        if not few:
            held = terms.select("term").distinct().unionByName(self.spark.createDataFrame([("",)], "term string"))
            rows = rows.join(held, "term", "left_semi")
        rows = rows.select("segment", "term", "n", "hits", *_LISTS, "docs", "tfs")
        frequencies = rows.filter("term <> ''").groupBy("term").agg(F.sum("n").alias("df"))
        weighted = term_weights(terms, frequencies, n)
        found = (_by_segment(rows, weighted.toArrow(), k, mean) if few else
                 _by_block(rows, weighted, k, mean, -(-n_terms // TERM_BLOCK) or 1))
        return _rank(found, k)


def build_keyword_index(docs: DataFrame, path: str, **options) -> KeywordIndex:
    append_keyword_index(docs, path, **options)
    return KeywordIndex(docs.sparkSession, path)


def _share(tf, length, mean: float):
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / (mean or 1.0)))


class Segment:
    """The rows of one segment, decoded slot by slot when they are needed."""

    def __init__(self, rows: pa.Table, mean: float):
        own = rows.filter(pc.equal(rows.column("term"), "")).select(["docs", "tfs"]).to_pylist()
        self.ids = np.frombuffer(own[0]["docs"], "<i8") if own else np.zeros(0, np.int64)
        self.lengths = np.frombuffer(own[0]["tfs"], "<i4") if own else np.zeros(0, np.int32)
        self.mean, self.slots = mean, -(-len(self.ids) // SLOT)
        self.rows, self.bounds, self.kept = {}, {}, {}
        self.decoded = 0
        for batch in rows.filter(pc.not_equal(rows.column("term"), "")).to_batches():
            # Arrays beside each other, not a Python object for each number.
            lists = {c: (batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy(zero_copy_only=False)) for c in _LISTS}
            for i, term in enumerate(batch.column("term").to_pylist()):
                slots, ends, impact_ends, tf, length = (values[offsets[i]:offsets[i + 1]] for offsets, values in lists.values())
                share = _share(tf.astype(float), length.astype(float), mean)
                bound = np.zeros(self.slots)
                bound[slots] = np.maximum.reduceat(share, np.append(0, impact_ends[:-1]))
                self.bounds[term] = bound
                self.rows[term] = memoryview(slots), ends, batch.column("docs")[i], batch.column("tfs")[i]

    def block(self, term: str, slot: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (in the segment) of the term in the slot and their shares."""
        found = self.kept.get((term, slot))
        if found is None:
            slots, ends, docs, tfs = self.rows[term]
            at = int(np.searchsorted(np.asarray(slots), slot))
            a, b = int(ends[at - 1]) if at else 0, int(ends[at])
            doc = np.frombuffer(docs.as_buffer(), "<u2", b - a, 2 * a).astype(np.int64)
            tf = np.frombuffer(tfs.as_buffer(), "<u4", b - a, 4 * a).astype(float)
            if len(self.kept) >= KEPT:
                self.kept.clear()
            found = self.kept[term, slot] = doc, _share(tf, self.lengths[doc], self.mean)
            self.decoded += 1
        return found

    def search(self, words: list[tuple[str, float]], best: BestMatches, query: int) -> None:
        """Add the query's best documents of this segment to ``best``."""
        words = [(t, w) for t, w in words if t in self.rows]
        if not words:
            return
        each = np.array([self.bounds[t] * w for t, w in words])
        limit = each.sum(axis=0)
        order = np.argsort(-limit, kind="stable")
        number = np.array([query])
        lo, width = 0, 1
        while lo < len(order):
            floor = best.scores[query, -1] - SLACK
            slots = [s for s in order[lo:lo + width].tolist() if limit[s] > 0 and limit[s] >= floor]
            if not slots:
                return
            lo, width = lo + width, min(2 * width, AT_ONCE)
            docs, scores = zip(*(self._slot(s, words, each[:, s], floor) for s in slots))
            docs, scores = np.concatenate(docs), np.concatenate(scores)
            if len(docs):
                best.add(scores[None, :], self.ids[docs], number)

    def _slot(self, slot: int, words: list[tuple[str, float]], limits: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        by = np.argsort(-limits, kind="stable")
        by = by[limits[by] > 0]
        # What the words from here on can add at most.
        rest = np.append(np.cumsum(limits[by][::-1])[::-1], 0.0)
        total = np.zeros(SLOT)
        seen = np.zeros(SLOT, bool)
        first = slot * SLOT
        for i, w in enumerate(by.tolist()):
            term, weight = words[w]
            if rest[i] < floor and not (seen & (total + rest[i] >= floor)).any():
                break                   # no document here can come to the k-th best score
            doc, share = self.block(term, slot)
            total[doc - first] += weight * share
            if rest[i] >= floor:
                seen[doc - first] = True
        found = np.flatnonzero(seen)
        return found + first, total[found]


def _words(weighted: pa.Table) -> tuple[np.ndarray, list[list[tuple[str, float]]]]:
    """Query ids and the words of each with their weights."""
    ids, query = np.unique(weighted.column("query_id").to_numpy(), return_inverse=True)
    words = [[] for _ in ids]
    for q, t, w in zip(query.tolist(), weighted.column("term").to_pylist(), weighted.column("weight").to_pylist()):
        words[q].append((t, w))
    return ids, words


def _by_segment(rows: DataFrame, weighted: pa.Table, k: int, mean: float) -> DataFrame:
    """Segments one after the other, so that each begins with the scores of those before it."""
    shared = rows.sparkSession.sparkContext.broadcast(_words(weighted))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words = shared.value
        best, held = BestMatches(len(ids), k), []
        def searched():
            segment = Segment(pa.Table.from_batches(held), mean)
            for query, of in enumerate(words):
                segment.search(of, best, query)
        for batch in batches:
            key = batch.column(0)
            numbers = [(s["batch"], s["segment"]) for s in key.to_pylist()]
            lo = 0
            while lo < len(numbers):
                hi = lo
                while hi < len(numbers) and numbers[hi] == numbers[lo]:
                    hi += 1
                if held and _segment_of(held[0]) != numbers[lo]:
                    searched()
                    held = []
                held.append(batch.slice(lo, hi - lo))
                lo = hi
        if held:
            searched()
        yield best.rows(ids)

    return rows.repartition("segment").sortWithinPartitions("segment").mapInArrow(task, MATCH_SCHEMA)


def _segment_of(batch: pa.RecordBatch) -> tuple[int, int]:
    first = batch.column(0)[0].as_py()
    return first["batch"], first["segment"]


def _by_block(rows: DataFrame, weighted: DataFrame, k: int, mean: float, blocks: int) -> DataFrame:
    """Blocks of queries against segments, each pair in a group of bounded size."""
    own = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    segments = rows.filter("term = ''").select("segment")
    # A block of queries goes to every segment; neither side has a row per pair.
    q = weighted.withColumn("qb", own)
    of_block = q.groupBy("qb").agg(F.collect_list(F.struct("query_id", "term", "weight")).alias("words"))
    sent = of_block.join(segments.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), "qb")
    parts = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        words = left.column("words").combine_chunks().flatten() if len(left) else pa.array([], pa.struct([("query_id", pa.int64()), ("term", pa.string()), ("weight", pa.float64())]))
        ids, each = _words(pa.Table.from_batches([pa.RecordBatch.from_struct_array(words)]))
        best, segment = BestMatches(len(ids), k), Segment(right, mean)
        for query, of in enumerate(each):
            segment.search(of, best, query)
        return pa.Table.from_batches([best.rows(ids)])

    keys = ("segment", "qb")
    count = segments.count() * blocks
    sent, parts = (partitioned(side, keys, count) for side in (sent, parts))
    return sent.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInArrow(block, MATCH_SCHEMA)
