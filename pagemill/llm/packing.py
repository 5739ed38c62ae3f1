"""Best-fit packing of token pieces into sequences by exact complements.

A document becomes pieces of at most ``SIZE`` tokens, so piece lengths are a histogram of
at most ``SIZE`` counts, however large the corpus. ``plan`` packs that histogram on the
driver: for each length from the largest down it looks for one, two or three other
lengths that fill the gap exactly and uses such a combination as often as its counts
allow; what finds no exact filling is packed best-fit. A line of the plan says: the
pieces of this length with these ranks go to these sequences at this offset. Ranking the
pieces of a length and reading the plan is then work for all executors.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layout import stored
from .encoding import encoder, values_of

SIZE = 1024
END = 2
PART_ROWS = 4_000


class _Planner:
    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.left[0] = 0
        self.size = len(counts) - 1
        self.used = np.zeros_like(self.left)  # ranks given away, by length
        self.sequences = 0
        self.lines: list[tuple[int, int, int, int, int]] = []

    def use(self, lengths: list[int], times: int) -> None:
        """``times`` sequences, each with these lengths in a row."""
        offset = 0
        for length in lengths:
            rank = int(self.used[length])
            self.lines.append((length, rank, rank + times, self.sequences - rank, offset))
            self.used[length] += times
            self.left[length] -= times
            offset += length
        self.sequences += times

    def times(self, lengths: list[int]) -> int:
        return min(int(self.left[n]) // lengths.count(n) for n in lengths)

    def filling(self, gap: int, first: int) -> list[int] | None:
        """One, two or three available lengths that sum to ``gap``; the combination that can
        be used most often. ``first`` is set aside once."""
        left = self.left.copy()
        left[first] -= 1
        if left[gap] > 0:
            return [gap]
        if gap < 2:
            return None
        a = np.arange(1, gap // 2 + 1)
        b = gap - a
        uses = np.minimum(left[a], left[b])
        uses[a == b] = left[a[a == b]] // 2
        if uses.max() > 0:
            best = int(uses.argmax())
            return [int(b[best]), int(a[best])]
        have = np.flatnonzero(left[:gap] > 0)
        for c in have[::-1]:  # the largest of three
            rest = gap - int(c)
            if rest < 2 or 3 * int(c) < gap:
                continue
            a = np.arange(1, rest // 2 + 1)
            b = rest - a
            a, b = a[b <= c], b[b <= c]
            uses = np.minimum(left[a], left[b])
            uses[a == b] = left[a[a == b]] // 2
            uses = np.minimum(uses, np.where(b == c, left[c] - 1, left[c]))
            uses[(a == b) & (b == c)] = left[c] // 3
            if len(uses) and uses.max() > 0:
                best = int(uses.argmax())
                return [int(c), int(b[best]), int(a[best])]
        return None

    def run(self) -> None:
        self.use([self.size], int(self.left[self.size]))
        for length in range(self.size - 1, 0, -1):
            while self.left[length]:
                fill = self.filling(self.size - length, length)
                if fill is None:
                    break
                self.use([length, *fill], max(1, self.times([length, *fill])))
        for length in range(self.size - 1, 0, -1):  # best fit for the rest
            while self.left[length]:
                lengths, gap = [length], self.size - length
                left = self.left.copy()
                left[length] -= 1
                while gap and (fit := np.flatnonzero(left[:gap + 1])).size:
                    lengths.append(int(fit[-1]))
                    left[lengths[-1]] -= 1
                    gap -= lengths[-1]
                self.use(lengths, max(1, self.times(lengths)))


def plan(counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Lines ``length, first rank, end rank, sequence - rank, offset`` for a histogram
    (``counts[n]`` pieces of ``n`` tokens). Deterministic; its size depends on the number
    of lengths only."""
    planner = _Planner(counts)
    planner.run()
    return [line for line in planner.lines if line[2] > line[1]]


def _cut(tokenizer: str, end: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, closing = encoder(tokenizer).text_ids, np.array([end], "<u4").tobytes()
        for batch in batches:
            rows, places, pieces, starts, lengths, checks = [], [], [], [], [], []
            for row, text in enumerate(values_of(batch, "text")):
                data = encode(text) + closing
                n = len(data) // 4
                at = 0
                for piece in range(-(-n // size)):
                    to = n - size * (-(-n // size) - 1 - piece)  # the first one may be shorter
                    places.append(row)
                    pieces.append(piece)
                    starts.append(at)
                    lengths.append(to - at)
                    checks.append(zlib.crc32(memoryview(data)[4 * at:4 * to]))
                    at = to
            taken = pa.array(places, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(taken), batch.column("id").take(taken), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(checks, pa.int64())], ["row", "id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end: int = END, size: int = SIZE) -> DataFrame:
    """``row, id, piece, start, length, ids_crc32``: pieces of at most ``size`` tokens."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("bigint").alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_cut(tokenizer, end, size),
                           "row bigint, id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def _placed(lines: list[tuple[int, int, int, int, int]]):
    """Looks each ``length, rank`` up in the plan."""
    table = np.array(sorted(lines), np.int64).reshape(-1, 5)
    first = np.searchsorted(table[:, 0], np.arange(int(table[:, 0].max(initial=0)) + 2))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            line = np.empty(len(length), np.int64)
            for n in np.unique(length):
                mine = length == n
                lo, hi = first[n], first[n + 1]
                line[mine] = lo + np.searchsorted(table[lo:hi, 1], rank[mine], side="right") - 1
            names = ["id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(rank + table[line, 3]), pa.array(table[line, 4])],
                [*names, "sequence_id", "offset"])
    return run


def packed(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end: int = END, size: int = SIZE) -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece.

    A null or empty text is its end id alone. Pieces of one length are ranked part by
    part: parts of some thousand rows are counted, their counts summed up in order, and
    only ranks inside a part need a window, so a length that a third of all pieces share
    is no single group. Repeated rows are packed each.
    """
    cut = stored(pieces(docs, tokenizer, id, text, end, size), "pieces")
    parts = -(-cut.count() // PART_ROWS) or 1
    cut = cut.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    histogram = np.zeros(size + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most ``size`` rows
        histogram[length] = n
    within = Window.partitionBy("length", "part").orderBy("row", "piece")
    ranked = (cut.withColumn("within", F.row_number().over(within) - 1).join(ahead, ["length", "part"])
              .withColumn("rank", F.col("ahead") + F.col("within")))
    return ranked.mapInArrow(_placed(plan(histogram)), (
        "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"))
