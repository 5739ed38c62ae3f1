"""Token counts by chunk maps that compose.

``compile_model`` reads the model's pieces and keeps which characters ever stand next to each
other inside one. Two neighbours that never do are a certain token border, whatever stands
around them; the text between two such borders is a unit, and tokens of units add up. A unit is
counted by the model itself when it is first met, and its count is kept in a table: no
transducer is compiled from the merges, so counts are the model's by construction.

A chunk of text maps what precedes it to a count and what it leaves: what stands before its
first border is added to the unit that it meets, what follows its last border is the unit it
leaves. Such maps compose, in any grouping (``ChunkMap.then``). Long texts are therefore cut
anywhere and their chunks are mapped on many tasks; one task composes the maps of a text, one
after the other. A very long text without a border is one unit, which is cut again at each step.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 18         # characters; longer texts are cut
KNOWN_UNITS = 300_000   # counts kept by a task; all are dropped when it has more
LONGEST_KEPT = 64       # longer units are counted anew each time
LIMIT = 4096

MARK = "▁"  # what a piece has for a space


@dataclass(frozen=True)
class ChunkMap:
    """Effect of a chunk: ``count`` is None where the chunk has no border."""

    head: str
    count: int | None
    tail: str

    def then(self, other: "ChunkMap", counter: "Counter") -> "ChunkMap":
        if self.count is None and other.count is None:
            return counter.chunk(self.head + other.head)
        if self.count is None:
            return counter.chunk(self.head + other.head).closed(other, counter)
        joined = counter.chunk(self.tail + other.head)
        if joined.count is None:
            return (ChunkMap(self.head, self.count, joined.head) if other.count is None else
                    ChunkMap(self.head, self.count + counter.unit(joined.head) + other.count, other.tail))
        inner = self.count + counter.unit(joined.head) + joined.count
        return (ChunkMap(self.head, inner, joined.tail) if other.count is None else
                ChunkMap(self.head, inner + counter.unit(joined.tail) + other.count, other.tail))

    def closed(self, other: "ChunkMap", counter: "Counter") -> "ChunkMap":
        """This map, of a text that ends at a border, followed by the rest of ``other``."""
        if self.count is None:
            return ChunkMap(self.head, other.count, other.tail)
        return ChunkMap(self.head, self.count + counter.unit(self.tail) + other.count, other.tail)

    def total(self, counter: "Counter") -> int:
        return counter.unit(self.head) + (0 if self.count is None else self.count + counter.unit(self.tail))


class Counter:
    """Counts of units, and the borders between them. Texts come with ``MARK`` for each space."""

    def __init__(self, model_file: str, known: int = KNOWN_UNITS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = [i for i in range(self.model.vocab_size()) if self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i)]
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        for i in special:
            pieces[i] = ""
        self.pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        self.border = _border(self.pairs)
        self.known, self.table = known, {"": 0}
        self._check()

    def _check(self) -> None:
        """The model must not rewrite texts, else its pieces say nothing about them."""
        probe = "  a  ﬁ²​ é "
        if self.model.decode(self.model.encode(probe)) != probe:
            raise ValueError("the model normalises its input; this counter needs one that does not")

    def _by_model(self, units: list[str]) -> list[int]:
        """Tokens of units inside a text: the model puts a mark before its input, so each
        is given behind a character that no piece joins with it."""
        lead = [u[1:] if u[0] == MARK else None for u in units]
        inside = iter(self.model.encode(["\n" + u for u, l in zip(units, lead) if l is None], num_threads=1))
        first = iter(self.model.encode([l for l in lead if l], num_threads=1))
        return [len(next(inside)) - self.before if l is None else len(next(first)) if l else 1 for l in lead]

    @property
    def before(self) -> int:
        if not hasattr(self, "_before"):
            self._before = len(self.model.encode("\n"))
        return self._before

    def learn(self, units: set[str]) -> None:
        new = [u for u in units if u not in self.table]
        if len(self.table) + len(new) > self.known:
            self.table = {"": 0}
            new = list(units - {""})
        self.table.update(zip(new, self._by_model(new)))

    def unit(self, text: str) -> int:
        found = self.table.get(text)
        return self._by_model([text])[0] if found is None else found

    def chunk(self, text: str) -> ChunkMap:
        units = self.border(text)
        if len(units) < 2:
            return ChunkMap(text, None, "")
        inner = units[1:-1]
        return ChunkMap(units[0], self.count(inner), units[-1])

    def count(self, units: list[str]) -> int:
        try:
            return sum(map(self.table.__getitem__, units))
        except KeyError:
            pass
        short = [u for u in units if len(u) <= LONGEST_KEPT]
        rest = [u for u in units if len(u) > LONGEST_KEPT]
        step = self.known // 2
        total = sum(self._by_model(rest)) if rest else 0
        for i in range(0, len(short), step):
            part = short[i:i + step]
            self.learn(set(part))
            total += sum(map(self.table.__getitem__, part))
        return total


@functools.cache
def compile_model(model_file: str) -> Counter:
    """One counter for all tasks that a Python worker runs."""
    return Counter(model_file)


def _border(pairs: set[str]):
    """Cuts a text into units at certain borders.

    A mark follows no other character inside a piece, so a unit begins at each run of
    marks; and a character in no pair is a unit of its own. Both hold for these pieces
    or are refused here.
    """
    if any(b == MARK and a != MARK for a, b in pairs):
        raise ValueError("a piece has a space inside; its borders are not these")
    lone = "".join(c for c in map(chr, range(0x21)) if not any(c in p for p in pairs))
    alone = re.escape(lone)
    return re.compile(f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+").findall


def mapped(model_file: str):
    """Maps Arrow batches of ``row, place, last, text`` to their chunk maps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compile_model(model_file)
        for batch in batches:
            maps = []
            for place, whole, text in zip(*(batch.column(c).to_pylist() for c in ("place", "whole", "text"))):
                text = text.replace(" ", MARK)
                # The model puts one mark before the text.
                made = counter.chunk(MARK + text if place == 0 and text else text)
                maps.append(ChunkMap("", made.total(counter), "") if whole else made)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("row", "place", "id", "n_bytes")), pa.array([m.head for m in maps], pa.string()),
                pa.array([m.count for m in maps], pa.int64()), pa.array([m.tail for m in maps], pa.string())], MAPS)
    return run


MAPS = ["row", "place", "id", "n_bytes", "head", "count", "tail"]
COUNTS = ["id", "n_bytes", "n_tokens"]


def composed(model_file: str):
    """Composes the maps of each text, which come as one sorted list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compile_model(model_file)
        for batch in batches:
            totals = []
            for maps in batch.column("maps").to_pylist():
                made = ChunkMap(maps[0]["head"], maps[0]["count"], maps[0]["tail"])
                for m in maps[1:]:
                    made = made.then(ChunkMap(m["head"], m["count"], m["tail"]), counter)
                totals.append(made.total(counter))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(totals, pa.int64())], COUNTS)
    return run


def token_counts(docs: DataFrame, model_file: str, id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every text, as the model counts it.

    A null or empty text has no tokens; repeated rows are counted each. Texts of up to
    ``chunk`` characters are finished where they are read; only the maps of longer ones
    are shuffled, by row. An empty table has no rows.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("bigint").alias("id"),
                       F.octet_length(t).cast("bigint").alias("n_bytes"), t.alias("text"))
    pieces = F.greatest(F.ceil(F.length("text") / chunk), F.lit(1)).cast("int")
    cut = rows.select("row", "id", "n_bytes", (pieces == 1).alias("whole"), "text", F.explode(
        F.sequence(F.lit(0), pieces - 1)).alias("place"))
    cut = cut.withColumn("text", F.when(F.col("whole"), F.col("text")).otherwise(
        F.substring(F.col("text"), F.col("place") * chunk + 1, F.lit(chunk))))
    maps = cut.mapInArrow(mapped(model_file), "row bigint, place int, id bigint, n_bytes bigint, head string, count bigint, tail string")
    listed = maps.groupBy("row", "id", "n_bytes").agg(F.sort_array(F.collect_list(F.struct("place", "head", "count", "tail"))).alias("maps"))
    counted = listed.mapInArrow(composed(model_file), "id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
