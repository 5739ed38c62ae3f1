"""Chat formatting: conversations that share initial turns as one prefix tree.

A node is a turn with all turns before it, so conversations that begin alike share nodes. Each
node's tokens are emitted once, depth first in its tree (a tree is a training sequence of its
own); a token's position id is its place in the conversation, and it may attend to the
intervals of the tree's tokens that hold its ancestors, and to what precedes it in its node.

How it is made, with no tree in one task:

* Turns are sorted into parts of bounded size. A node is known by a hash of all turns up to it:
  a polynomial over two primes' fields, whose parts add up, so a conversation may span any
  number of parts.
* Turns with one hash become one node, which is formatted and encoded once.
* A run of nodes in which no conversation parts or ends is a segment. Its name is the names of
  the nodes at which segments begin, from the root on. Depth-first order is the order of these
  names; sorting and running sums give the place of each segment.
* The ancestors of a segment are the beginnings of its name.

Template: ``### role: text</turn>`` and a line break. In texts and roles a backslash precedes every
backslash, each ``#`` of three or more in a row and the ``/`` of ``</turn>`` (in roles every ``:``, too),
so no control string occurs inside, and a reader who drops each escaping backslash has the text
again.
Only texts of the role ``assistant`` are under the loss mask.

Turns go by ``turn`` (null last), then role and text. A null role or text is empty, a null
conversation id is a conversation; equal rows are turns of their own. Header, text and end are
encoded apart. A long text is one node, held by one task. An empty table has no rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import skew_join
from ..sources.layout import checked_broadcast, stored
from .encoding import Encoder, _byte_of, values_of
from .ordered import PART_ROWS, in_order, part, running

PRIME = (1 << 61) - 1
BASES = (0x1B7D_3C45_9A2E_6F13 % PRIME, 0x0F4A_91D2_77C3_5B29 % PRIME)
NAME = 40               # characters of a node's name
ASSISTANT = "assistant"
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
_each = lambda found: "".join("\\" + c for c in found[0])
_in_text = functools.partial(re.compile(r"\\|#{3,}|(?<=<)/(?=turn>)").sub, _each)
_in_role = functools.partial(re.compile(r"\\|:|#{3,}|(?<=<)/(?=turn>)").sub, _each)
_plain = functools.partial(re.compile(r"\\(.)", re.S).sub, r"\1")
_header = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S).match


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """Header, text and end of a turn."""
    return OPEN + _in_role(role) + BETWEEN, _in_text(text), CLOSE


def parsed(turn: str) -> tuple[str, str, int, int]:
    """Role and text of a formatted turn, and where its (escaped) text lies."""
    header = _header(turn)
    if not header or not turn.endswith(CLOSE):
        raise ValueError("not a formatted turn")
    start, end = header.end(), len(turn) - len(CLOSE)
    return _plain(header[1]), _plain(turn[start:end]), start, end


class Chat:
    """Ids of formatted turns by a byte-level file; special tokens inside texts are plain text."""

    def __init__(self, file: str):
        self.encoder = Encoder(file)
        self.encoder.library.encode_special_tokens = True
        byte = _byte_of()
        pieces = {i: p for p, i in self.encoder.library.get_vocab(with_added_tokens=False).items()}
        self.bytes = [bytes(byte.get(c, 0) for c in pieces.get(i, "")) for i in range(max(pieces) + 1)]

    def encode(self, role: str, text: str) -> tuple[list[int], int, int]:
        parts = [np.frombuffer(self.encoder.text_ids(p), "<u4") for p in formatted(role, text)]
        start = len(parts[0])
        return np.concatenate(parts), start, start + len(parts[1])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode()


@functools.cache
def chat(file: str) -> Chat:
    return Chat(file)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of a part in order -> ``idx`` in the part, sums up to the turn and before it."""
    now, idx, sums, powers = object(), 0, [0, 0], [1, 1]
    for batch in batches:
        out = {c: [] for c in ("idx", "s1", "s2", "b1", "b2")}
        for conv, role, text in zip(*(values_of(batch, c) for c in ("conv", "role", "text"))):
            if conv != now:
                now, idx, sums, powers = conv, 0, [0, 0], [1, 1]
            told = role.encode()
            h = hashlib.blake2b(b"%d:" % len(told) + told + text.encode(), digest_size=16).digest()
            out["idx"].append(idx)
            out["b1"].append(sums[0])
            out["b2"].append(sums[1])
            for k in (0, 1):
                value = int.from_bytes(h[8 * k:8 * k + 8], "little") % (PRIME - 1) + 1
                sums[k] = (sums[k] + value * powers[k]) % PRIME
                powers[k] = powers[k] * BASES[k] % PRIME
            out["s1"].append(sums[0])
            out["s2"].append(sums[1])
            idx += 1
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "mid", "role", "text")),
                                          *(pa.array(v, pa.int64()) for v in out.values())], _PREFIXES)


_PREFIXES = ["conv", "mid", "role", "text", "idx", "s1", "s2", "b1", "b2"]


def _carried(table: pa.Table) -> pa.Table:
    """The parts of one conversation that spans several -> what comes before each: turns, the
    sums so far, and the factors of the sums that follow."""
    rows = table.sort_by("part").to_pylist()
    n, sums, out = 0, [0, 0], []
    for r in rows:
        factors = [pow(BASES[k], n, PRIME) for k in (0, 1)]
        out.append({"part": r["part"], "conv": r["conv"], "n": n, "c1": sums[0], "c2": sums[1], "f1": factors[0], "f2": factors[1]})
        sums = [(sums[k] + factors[k] * r[f"s{k + 1}"]) % PRIME for k in (0, 1)]
        n += r["rows"]
    return pa.Table.from_pylist(out, pa.schema([(c, pa.int64()) for c in ("part", "conv", "n", "c1", "c2", "f1", "f2")]))


def _name(depth: Column, a: Column, b: Column) -> Column:
    return F.concat(*(F.lpad(F.lower(F.hex(x)), w, "0") for x, w in ((a, 16), (b, 16), (depth, 8))))


def named_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str, part_rows: int) -> DataFrame:
    """Stored rows ``conv, part, mid, idx, node, parent, role, text``; the roots' parent is ''."""
    rows = conversations.select(F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                                F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = stored(rows.withColumn("copy_no", F.monotonically_increasing_id()), "chat-turns")
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"), F.col("copy_no")]
    placed = in_order(rows, order, rows.count(), part_rows).select("conv", "mid", "role", "text")
    summed = stored(placed.mapInArrow(_prefixes, "conv bigint, mid bigint, role string, text string, "
                                                 "idx bigint, s1 bigint, s2 bigint, b1 bigint, b2 bigint"), "chat-sums").withColumn("part", part())
    runs = summed.groupBy("part", "conv").agg(F.count("*").alias("rows"), F.max_by(F.struct("s1", "s2"), "mid").alias("last"))
    runs = runs.withColumn("parts", F.count("*").over(Window.partitionBy("conv"))).filter("parts > 1")
    # At most two runs of a part belong to conversations that span parts.
    carry = runs.select("part", "conv", "rows", "last.s1", "last.s2").groupBy("conv").applyInArrow(
        _carried, "part bigint, conv bigint, n bigint, c1 bigint, c2 bigint, f1 bigint, f2 bigint").filter("n > 0")
    carry = checked_broadcast(carry.select(F.col("part").alias("_part"), F.col("conv").alias("_conv"), "n", "c1", "c2", "f1", "f2"))
    joined = summed.join(carry, (F.col("part") == F.col("_part")) & F.col("conv").eqNullSafe(F.col("_conv")), "left")
    def whole(local: str, k: int) -> Column:
        wide = lambda c: F.col(c).cast("decimal(19,0)")
        total = (wide(f"c{k}").cast("decimal(38,0)") + wide(f"f{k}") * wide(local)) % F.lit(PRIME).cast("decimal(19,0)")
        return F.when(F.col("n").isNull(), F.col(local)).otherwise(total.cast("bigint"))
    depth = F.col("idx") + F.coalesce("n", F.lit(0))
    named = joined.select("conv", "part", "mid", depth.alias("idx"), _name(depth, whole("s1", 1), whole("s2", 2)).alias("node"),
                          F.when(depth > 0, _name(depth - 1, whole("b1", 1), whole("b2", 2))).otherwise(F.lit("")).alias("parent"), "role", "text")
    return stored(named, "chat-named")


def _encoded(file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = chat(file)
        for batch in batches:
            ids, starts, ends = [], [], []
            for role, text in zip(values_of(batch, "role"), values_of(batch, "text")):
                i, a, b = made.encode(role, text)
                ids.append(i)
                starts.append(a if role == ASSISTANT else None)
                ends.append(b if role == ASSISTANT else None)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("node", "parent", "depth", "conversations", "role")), pa.array(ids, pa.list_(pa.int32())),
                pa.array([len(i) for i in ids], pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], _NODES)
    return run


_NODES = ["node", "parent", "depth", "conversations", "role", "ids", "n", "loss_start", "loss_end"]


def prefix_tree(conversations: DataFrame, file: str, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """Emitted nodes and the nodes of each conversation.

    Nodes: ``tree, start`` (the place of the first token in the tree's tokens), ``node, parent,
    depth, conversations`` (how many hold it), ``role, ids, positions``, ``loss_start, loss_end``
    (tokens of ``ids`` under the mask; null without), ``attends`` (intervals of the tree's tokens
    before the node, end exclusive, that hold its conversation so far).
    Conversations: ``conv, idx, node``.
    """
    turns = named_turns(conversations, conv, turn, role, text, part_rows)
    once = turns.groupBy("node").agg(F.any_value("parent").alias("parent"), F.any_value("idx").alias("depth"),
                                     F.count("*").alias("conversations"), F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    nodes = stored(once.mapInArrow(_encoded(file), "node string, parent string, depth bigint, conversations bigint, role string, "
                                                   "ids array<int>, n bigint, loss_start int, loss_end int"), "chat-nodes")
    # A segment begins at a root and wherever fewer conversations go on than came.
    came = nodes.select(F.col("node").alias("parent"), F.col("conversations").alias("came"))
    begins = skew_join(nodes.select("node", "parent", "conversations", "n"), came, "parent", "node", "left").select(
        "node", "n", (~F.col("conversations").eqNullSafe(F.col("came"))).alias("begins"))
    ways = stored(skew_join(turns.select("conv", "part", "mid", "node"), begins, "node", "mid"), "chat-ways")
    named = _segments(running(ways, "conv", "n", "position"))
    known = named.groupBy("node").agg(F.any_value("segment").alias("segment"), F.any_value("position").alias("position"))
    whole = stored(nodes.join(known, "node"), "chat-whole")
    segments = stored(_placed(whole, part_rows), "chat-segments")
    at = skew_join(whole, segments.select("segment", "tree", "from", F.col("position").alias("first"), "attends"), "segment", "node")
    start = F.col("from") + F.col("position") - F.col("first")
    own = F.struct(F.col("from").alias("start"), start.alias("end"))
    attends = F.when(start == F.col("from"), F.col("attends")).otherwise(_merged(F.concat("attends", F.array(own))))
    emitted = at.select("tree", start.alias("start"), "node", "parent", "depth", "conversations", "role", "ids",
                        F.sequence(F.col("position"), F.col("position") + F.col("n") - 1).alias("positions"), "loss_start", "loss_end",
                        attends.alias("attends"))
    return emitted, turns.select("conv", "idx", "node")


def _segments(ways: DataFrame) -> DataFrame:
    """``node, position, segment``: the names of the nodes at which segments begin on the way to
    each node. As in ``running``, only the conversation that enters a part has a carry."""
    local = Window.partitionBy("part", "conv").orderBy("mid")
    begun = F.when(F.col("begins"), F.col("node"))
    runs = ways.groupBy("part", "conv").agg(F.min("mid").alias("at"), F.transform(F.array_sort(F.collect_list(
        F.when(F.col("begins"), F.struct("mid", "node")))), lambda x: x["node"]).alias("names"))
    every = Window.partitionBy("conv")
    ahead = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (runs.withColumn("parts", F.count("*").over(every)).filter("parts > 1")
             .select(F.col("part").alias("_part"), F.col("conv").alias("_conv"),
                     F.array_join(F.flatten(F.collect_list("names").over(ahead)), "").alias("_before")).filter("_before <> ''"))
    rows = ways.withColumn("names", F.collect_list(begun).over(local.rowsBetween(Window.unboundedPreceding, 0)))
    met = (F.col("part") == F.col("_part")) & F.col("conv").eqNullSafe(F.col("_conv"))
    return rows.join(checked_broadcast(carry), met, "left").select(
        "node", "position", F.concat(F.coalesce("_before", F.lit("")), F.array_join("names", "")).alias("segment"))


def _merged(intervals: Column) -> Column:
    """Ascending intervals with those that touch made one."""
    kind = "array<struct<start:bigint,end:bigint>>"
    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), x["end"].alias("end"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] == x["start"]), longer).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(intervals, F.array().cast(kind), add)


def _placed(nodes: DataFrame, part_rows: int) -> DataFrame:
    """``segment, tree, from, n, position, attends``: depth-first places and ancestors' intervals."""
    sums = stored(nodes.groupBy("segment").agg(F.sum("n").alias("n"), F.min("position").alias("position"))
                  .withColumn("tree", F.substring("segment", 1, NAME)), "chat-sums")
    placed = stored(in_order(sums, [F.col("segment")], sums.count(), part_rows), "chat-order").withColumn("part", part())
    placed = stored(running(placed, "tree", "n", "from").drop("part", "mid"), "chat-from")
    depth = (F.length("segment") / NAME).cast("int")
    above = placed.filter(F.length("segment") > NAME).select("segment", F.explode(F.transform(
        F.sequence(F.lit(1), depth - 1), lambda k: F.substring(F.col("segment"), F.lit(1), k * NAME))).alias("above"))
    spans = placed.select(F.col("segment").alias("above"), F.struct(F.col("from").alias("start"), (F.col("from") + F.col("n")).alias("end")).alias("span"))
    listed = skew_join(above, spans, "above", "segment").groupBy("segment").agg(_merged(F.array_sort(F.collect_list("span"))).alias("attends"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return placed.join(listed, "segment", "left").withColumn("attends", F.coalesce("attends", none))


def _digests(file: str):
    """Nodes of conversations in order -> one row per conversation, read from the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, now, state = chat(file), object(), None
        def row():
            conv, n, turns, loss_chars, loss, chars = state
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                (conv, pa.int64()), (n, pa.int64()), (turns.hexdigest(), pa.string()), (loss_chars, pa.int64()),
                (loss.hexdigest(), pa.string()), (chars, pa.int64()))], _READ)
        for batch in batches:
            done = []
            for conv, ids, start, end in zip(*(values_of(batch, c) for c in ("conv", "ids", "loss_start", "loss_end"))):
                if conv != now:
                    if state:
                        done.append(row())
                    now, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turn = made.decode(ids)
                role, text, *_ = parsed(turn)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    under = _plain(made.decode(ids[start:end]))
                    state[3] += len(under)
                    state[4].update(under.encode())
                state[5] += len(turn)
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if state:
            yield row()
    return run


_READ = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def read_back(nodes: DataFrame, turns: DataFrame, file: str) -> DataFrame:
    """``conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from the emitted
    ids. One digest needs the turns of a conversation one after the other, so they are sorted
    (with spilling) into one task, which holds one turn at a time."""
    rows = skew_join(stored(turns, "chat-paths"), nodes.select("node", "ids", "loss_start", "loss_end"), "node", "idx")
    ordered = rows.select("conv", "idx", "ids", "loss_start", "loss_end").repartition("conv").sortWithinPartitions("conv", "idx")
    return ordered.mapInArrow(_digests(file), "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                              "loss_sha256 string, formatted_chars bigint")
