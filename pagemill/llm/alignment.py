"""Alignment of two tokenizers over the same texts.

Both read a text behind one space: a byte-level file gets the space, a piece model adds it.
Tokens of either are byte ranges. Every token points to the token of the other side that
overlaps it and ends farthest to the right, a token of the second side to itself where both
end together. The pointers are doubled (each is replaced by what its target points to) for all
tokens of a batch of documents at once, until none moves: then every token points to the
last token of its group, and groups are runs of equal pointers.

A link is a pair of tokens that overlap. How many documents hold a pair of ids linked is
counted over the whole corpus. Documents are gathered in blocks of a bounded number of links;
a block keeps its distinct pairs once and, for each, the documents that hold it. So a pair that
every document holds is one row of each block, counts are summed from blocks, and what goes
back is one number per pair and block, not one per link.

A text that is null or empty, or that either side does not give back byte for byte, has no
tokens: its numbers are 0 and its groups none. Equal rows are documents of their own. Long
texts are encoded in sections that end before a space where both sides are known to end a
token; a document stays whole. An empty table has no rows, other columns do not matter.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.layout import stored
from .encoding import Encoder, _byte_of, values_of
from .hashing import groups as text_groups
from .token_counts import compile_model

BATCH_CHARACTERS = 1 << 19   # texts worked on together
SECTION = 1 << 16            # characters encoded at once, at least
BLOCK_LINKS = 2_000_000      # a block is closed from here on; a document stays whole
SLICE = 1 << 16              # tokens written out at once

_edge = re.compile(r"(?<=\S) (?=\S)").search


def sections(text: str, size: int = SECTION) -> Iterator[str]:
    """The text without the spaces at which it is cut; neither side has a token across one."""
    at = 0
    while len(text) - at > size and (cut := _edge(text, at + size)):
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


class Pair:
    """A byte-level file (first) and a piece model (second): ids and token bytes."""

    def __init__(self, byte_file: str, piece_file: str):
        self.first = Encoder(byte_file)
        self.first.library.encode_special_tokens = True
        self.second = compile_model(piece_file).model
        byte = _byte_of()
        vocabulary = {i: piece for piece, i in self.first.library.get_vocab(with_added_tokens=False).items()}
        self.first_bytes = [bytes(byte.get(c, 0) for c in vocabulary.get(i, "")) for i in range(max(vocabulary) + 1)]
        self.second_bytes = [
            bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.second.id_to_piece(i)) for i in range(self.second.vocab_size()))]
        self.sizes = [np.array([len(b) for b in table], np.int64) for table in (self.first_bytes, self.second_bytes)]
        # Ids as they are written, with what may follow them.
        self.first_written = [b"%d%s" % (i, s) for s in (b",", b"|") for i in range(len(self.first_bytes))]
        self.second_written = [b"%d%s" % (i, s) for s in (b",", b";", b"") for i in range(len(self.second_bytes))]

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; None where their bytes are not the text's."""
        made = []
        for section in sections(text) if text else ():
            a = np.frombuffer(self.first.text_ids(" " + section), "<u4").astype(np.int64)
            b = np.array(self.second.encode(section, num_threads=1), np.int64)
            told = (" " + section).encode()
            if b"".join(map(self.first_bytes.__getitem__, a.tolist())) != told or b"".join(map(self.second_bytes.__getitem__, b.tolist())) != told:
                return None
            made.append((a, b))
        return tuple(np.concatenate(side) for side in zip(*made)) if made else None


@functools.cache
def tokenizer_pair(byte_file: str, piece_file: str) -> Pair:
    """One pair for all tasks that a Python worker runs."""
    return Pair(byte_file, piece_file)


def jumped(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The last token of each token's group: tokens of the first side, then of the second,
    numbered in this order. Both sides cover the same bytes."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)           # the token of b that holds the last byte
    over_b = np.searchsorted(ends_a, ends_b)
    itself = ends_a[over_b] == ends_b
    to = np.concatenate((over_a + n, np.where(itself, np.arange(len(ends_b)) + n, over_b)))
    while True:
        farther = to[to]
        if np.array_equal(farther, to):
            return to
        to = farther


@dataclass
class Aligned:
    """Tokens, groups and links of some documents, side by side."""

    documents: int
    ids: tuple[np.ndarray, np.ndarray]
    ends: tuple[np.ndarray, np.ndarray]        # in bytes, over all documents
    upto: tuple[np.ndarray, np.ndarray]        # tokens up to the end of each document
    group: tuple[np.ndarray, np.ndarray]       # number of each token's group
    groups_upto: np.ndarray
    links: tuple[np.ndarray, np.ndarray]       # numbers of the two tokens
    links_upto: np.ndarray


def align(pair: Pair, texts: list[str]) -> Aligned:
    none = (np.zeros(0, np.int64),) * 2
    encoded = [pair.encoded(t) or none for t in texts]
    ids = tuple(np.concatenate([e[side] for e in encoded]) for side in (0, 1))
    upto = tuple(np.cumsum([len(e[side]) for e in encoded]) for side in (0, 1))
    ends = tuple(np.cumsum(pair.sizes[side][ids[side]]) for side in (0, 1))
    n = len(ids[0])
    if n:
        last = jumped(*ends)
        terminal = np.zeros(len(ids[1]), bool)
        terminal[last[n:] - n] = True
        number = np.cumsum(terminal) - 1
        group = tuple(number[part - n] for part in (last[:n], last[n:]))
        marks = np.concatenate(ends)
        marks.sort(kind="stable")
        marks = marks[np.append(True, marks[1:] != marks[:-1])]   # each ends one link
        links = tuple(np.searchsorted(e, marks) for e in ends)
        byte_upto = np.concatenate(([0], ends[0]))[upto[0]]
        links_upto = np.searchsorted(marks, byte_upto, side="right")
        groups_upto = np.concatenate(([0], number + 1))[upto[1]]
    else:
        group, links = none, none
        links_upto = groups_upto = np.zeros(len(texts), np.int64)
    return Aligned(len(texts), ids, ends, upto, group, groups_upto, links, links_upto)


def written(pair: Pair, found: Aligned) -> list[str]:
    """Digest of each document's groups, written as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    (a, b), (ga, gb) = found.ids, found.group
    total = int(found.groups_upto[-1]) if found.documents else 0
    in_a, in_b = np.bincount(ga, minlength=total), np.bincount(gb, minlength=total)
    before_b = np.cumsum(in_b) - in_b
    upto_a = np.cumsum(in_a)
    place_a, place_b = np.arange(len(a)) + before_b[ga], np.arange(len(b)) + upto_a[gb]
    closes_a, closes_b = np.append(ga[1:] != ga[:-1], True)[:len(a)], np.append(gb[1:] != gb[:-1], True)[:len(b)]
    ends_text = np.zeros(len(b), bool)
    ends_text[found.upto[1][np.diff(found.upto[1], prepend=0) > 0] - 1] = True
    codes = np.empty(len(a) + len(b), np.int64)
    codes[place_a] = a + closes_a * len(pair.first_bytes)
    codes[place_b] = len(pair.first_written) + b + np.where(ends_text, 2, closes_b) * len(pair.second_bytes)
    table = pair.first_written + pair.second_written
    out, start = [], 0
    for end in (found.upto[0] + found.upto[1]).tolist():
        digest = hashlib.sha256()
        for at in range(start, end, SLICE):
            digest.update(b"".join(map(table.__getitem__, codes[at:min(end, at + SLICE)].tolist())))
        out.append(digest.hexdigest() if end > start else "")
        start = end
    return out


_GROUPS = "array<struct<start:bigint,end:bigint,a:array<int>,b:array<int>>>"


def groups_of(docs: DataFrame, byte_file: str, piece_file: str, keep: list[str], text: str = "text") -> DataFrame:
    """``doc`` (the columns ``keep``) and ``groups``: of each group its bytes (in space and text)
    and the ids of both sides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(byte_file, piece_file)
        for batch in batches:
            made = []
            for t in values_of(batch, "text"):
                f = align(pair, [t])
                each, total = [], int(f.groups_upto[0])
                cuts = [np.searchsorted(g, np.arange(total + 1)).tolist() for g in f.group]
                for k in range(total):
                    (a, a2), (b, b2) = (c[k:k + 2] for c in cuts)
                    each.append({"start": int(f.ends[0][a - 1]) if a else 0, "end": int(f.ends[0][a2 - 1]),
                                 "a": f.ids[0][a:a2].tolist(), "b": f.ids[1][b:b2].tolist()})
                made.append(each)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(made, kind)], ["doc", "groups"])
    rows = docs.select(F.struct(*keep).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, groups {_GROUPS}")


def _packed(values: np.ndarray) -> bytes:
    """Small numbers by byte planes, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64)


class Block:
    """Documents of one task until their links are enough: rows, and links as one key each."""

    def __init__(self, second_ids: int):
        self.second_ids, self.rows, self.keys, self.links = second_ids, [], [], 0

    def add(self, found: Aligned, ids: list[int | None], digests: list[str]) -> None:
        sizes = [np.diff(u, prepend=0).tolist() for u in (*found.upto, found.groups_upto, found.links_upto)]
        owner = np.repeat(np.arange(found.documents) + len(self.rows), sizes[3])
        pairs = found.ids[0][found.links[0]] * self.second_ids + found.ids[1][found.links[1]]
        self.keys.append((pairs, owner))
        self.links += len(pairs)
        self.rows += zip(ids, *sizes, digests)

    def closed(self, number: int) -> pa.RecordBatch:
        bits = max(1, len(self.rows).bit_length())
        keys = np.concatenate([p << bits | d for p, d in self.keys])
        keys.sort()
        new = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(keys)))
        pairs, owner = keys[at] >> bits, keys[at] & ((1 << bits) - 1)
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)])
        held = np.diff(np.append(first, len(pairs)))
        docs = [dict(zip(("id", "n_a", "n_b", "n_groups", "n_links", "digest"), row)) for row in self.rows]
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([docs], _DOCS_TYPE), one(pairs[first], pa.int64()), one(held, pa.int32()),
            pa.array([len(pairs)], pa.int64()), pa.array([_packed(owner)], pa.binary()), pa.array([_packed(times)], pa.binary())],
            ["block", "docs", "pairs", "held", "n", "owner", "times"])


_DOCS = "array<struct<id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,digest:string>>"
_DOCS_TYPE = pa.list_(pa.struct([*((c, pa.int64()) for c in ("id", "n_a", "n_b", "n_groups", "n_links")), ("digest", pa.string())]))
BLOCKS = f"block bigint, docs {_DOCS}, pairs array<bigint>, held array<int>, n bigint, owner binary, times binary"


def _blocks(byte_file: str, piece_file: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(byte_file, piece_file)
        number = TaskContext.get().partitionId() << 33
        block = Block(len(pair.second_bytes))
        for batch in batches:
            ids = batch.column("id").to_pylist()
            at = 0
            for texts in text_groups(values_of(batch, "text"), BATCH_CHARACTERS):
                found = align(pair, texts)
                block.add(found, ids[at:at + len(texts)], written(pair, found))
                at += len(texts)
                if block.links >= limit:
                    yield block.closed(number)
                    number, block = number + 1, Block(len(pair.second_bytes))
        if block.rows:
            yield block.closed(number)
    return run


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            docs, held, known, n, owner, times = (batch.column(c)[k] for c in ("docs", "held", "known", "n", "owner", "times"))
            held = held.values.to_numpy()
            place, count, best = (known.values.field(c).to_numpy(zero_copy_only=False) for c in ("place", "count", "best"))
            order = np.argsort(place)
            rows = len(docs.values)
            owner, times = (_unpacked(x.as_py(), n.as_py()) for x in (owner, times))
            count_sum, n_best = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(count_sum, owner, times * np.repeat(count[order], held))
            np.add.at(n_best, owner, times * np.repeat(best[order], held))
            table = pa.Table.from_arrays([*docs.values.flatten(), pa.array(n_best), pa.array(count_sum)], _ROW)
            yield from table.to_batches()


_ROW = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def alignments(docs: DataFrame, byte_file: str, piece_file: str, id: str = "doc_id", text: str = "text",
               links: int = BLOCK_LINKS) -> tuple[DataFrame, DataFrame]:
    """Rows of documents and the table of linked ids.

    Documents: ``id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum``. A link's
    count is the number of documents that hold its ids linked; ``n_best`` links have the highest
    count of their first id (ties included).
    Pairs: ``a, b, count, best``, the dictionary between both vocabularies.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocks = stored(rows.mapInArrow(_blocks(byte_file, piece_file, links), BLOCKS), "alignment-blocks")
    second = len(tokenizer_pair(byte_file, piece_file).second_bytes)
    each = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "x")).select(
        "block", "place", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    first_id = F.floor(F.col("pair") / second).cast("int")
    counts = stored(each.groupBy("pair").agg(F.sum("held").alias("count")), "alignment-counts")
    most = counts.groupBy(first_id.alias("a")).agg(F.max("count").alias("most"))
    # One row per id of the first vocabulary, so its size bounds what is broadcast.
    known = counts.withColumn("a", first_id).join(F.broadcast(most), "a").select(
        "pair", "a", (F.col("pair") % second).cast("int").alias("b"), "count", (F.col("count") == F.col("most")).alias("best"))
    answers = (each.select("block", "place", "pair").join(known.select("pair", "count", "best"), "pair")
               .groupBy("block").agg(F.collect_list(F.struct("place", "count", F.col("best").cast("bigint").alias("best"))).alias("known")))
    # A block whose documents have no token has no pair to ask for.
    met = blocks.select("block", "docs", "held", "n", "owner", "times").join(answers, "block", "left").withColumn(
        "known", F.coalesce("known", F.array().cast(answers.schema["known"].dataType)))
    measured = met.select("docs", "held", "known", "n", "owner", "times").mapInArrow(
        _measured, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in _ROW))
    return measured, known.select("a", "b", "count", "best")
