"""Near-duplicates by ProbMinHash: signatures, bands, exact verification, classes.

Each shingle of five words arrives at random times, the sooner the heavier it is, and each
arrival falls on one component of the signature; a component keeps the shingle that came
first. Arrivals later than the slowest component change nothing, so each text stops
early. Two signatures agree in a component with the probability Jaccard of their weighted
shingles. A link is a Jaccard similarity of the shingle sets of ``SIMILAR`` or more, so
each distinct shingle weighs 1, however often it occurs: the probability is then that very
similarity. Texts that agree in a whole band of components are candidates; a class is what
links connect.

Exact copies are one node. A band does not pair all its texts: each is compared with the
band's first text and its most typical one, then what is still apart is compared across
classes only, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layout import stored
from .encoding import values_of
from .hashing import constants, counted, groups, mix, shingles

WIDTH = 5
SIMILAR = 0.8
BLOCK = 256  # texts of a band that are compared together
BANDS = 24
ROWS = 5   # a pair of similarity 0.8 shares none of the bands once in fourteen thousand times


def prob_min_hash(owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray, texts: int, size: int) -> np.ndarray:
    """Signatures of ``texts`` texts, ``size`` shingle hashes each; 0 where a text has none."""
    first = np.full(texts * size, np.inf)
    kept = np.zeros(texts * size, np.uint64)
    slowest = np.full(texts, np.inf)
    time, turn = np.zeros(len(hashes)), 0
    while len(hashes):
        turn += 1
        draw = mix(hashes + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0 ** -53) / weight
        soon = time < slowest[owner]
        owner, hashes, weight, time = owner[soon], hashes[soon], weight[soon], time[soon]
        spot = owner * size + (mix(draw[soon] + np.uint64(0xD1B54A32D192ED03)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, spot, time)
        won = first[spot] == time
        kept[spot[won]] = hashes[won]
        changed = np.unique(owner)
        slowest[changed] = first.reshape(texts, size)[changed].max(axis=1)
        soon = time < slowest[owner]
        owner, hashes, weight, time = owner[soon], hashes[soon], weight[soon], time[soon]
    return kept.reshape(texts, size)


def _bands(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows) * constants(rows, 3)
    return mix(parts.sum(axis=2, dtype=np.uint64) + constants(bands, 4)).view(np.int64)


def _signed(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, sizes = [], []
            for texts in groups(values_of(batch, "text")):
                owner, hashes, _ = counted(*shingles(texts, width))
                made.append(_bands(prob_min_hash(owner, hashes, np.ones(len(hashes)), len(texts), bands * rows), bands, rows))
                sizes.append(np.bincount(owner, minlength=len(texts)))
            flat = np.concatenate(made).ravel() if made else np.zeros(0, np.int64)
            offsets = np.arange(0, len(flat) + 1, bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("copy"), pa.array(np.concatenate(sizes) if sizes else [], pa.int32()),
                 pa.ListArray.from_arrays(offsets, pa.array(flat))], ["id", "copy", "n", "bands"])
    return run


def signatures(docs: DataFrame, id: str, text: str, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id, copy, n, bands``: hash of the text, number of shingles, one hash per band."""
    rows_ = docs.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows_.withColumn("copy", F.md5("text")).mapInArrow(
        _signed(width, bands, rows), "id bigint, copy string, n int, bands array<bigint>")


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, sizes = [], []
            for texts in groups(values_of(batch, "text")):
                owner, hashes, _ = counted(*shingles(texts, width))
                lists.append(hashes.view(np.int64))
                sizes.append(np.bincount(owner, minlength=len(texts)))
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))) if sizes else [0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))], ["node", "shingles"])
    return run


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of all nodes of ``edges`` (``a, b``); the root is the least node.

    Large-star and small-star steps alternate until nothing moves: each step aggregates
    per node and joins the result back, so no component is ever one group, and the
    number of rounds grows with the logarithm of its size.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("least"))
        large = both.filter("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _similar(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs ``a, b`` whose sets have that Jaccard similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    nx, ny = F.size("x"), F.size("y")
    possible = joined.filter((F.least(nx, ny) >= similar * F.greatest(nx, ny)) & (nx > 0) & (ny > 0))
    both = F.size(F.array_intersect("x", "y"))
    return possible.select("a", "b", (nx + ny).alias("sum"), both.alias("both")).filter(
        F.col("both") >= similar * (F.col("sum") - F.col("both"))).select("a", "b")


def _rooted(rows: DataFrame, roots: DataFrame | None, column: str, name: str) -> DataFrame:
    if roots is None:
        return rows.withColumn(name, F.col(column))
    found = roots.select(F.col("node").alias(column), F.col("root").alias("__found"))
    return rows.join(found, column, "left").withColumn(name, F.coalesce("__found", column)).drop("__found")


def _grown(roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Roots after ``links`` between nodes have been added."""
    moved = _rooted(_rooted(links, roots, "a", "ra"), roots, "b", "rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    if moved.isEmpty():
        return roots
    new = stored(components(moved), "roots")
    if roots is None:
        return new
    far = new.select(F.col("node").alias("root"), F.col("root").alias("far"))
    old = roots.join(far, "root", "left").select("node", F.coalesce("far", "root").alias("root"))
    return stored(old.unionByName(new).distinct(), "roots")


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``id, copy, class_id, class_size``, one row per row of ``docs``; options as for ``_classes``.

    ``class_id`` is the least id of the class (null if all its ids are null) and ``copy``
    the MD5 of the text. A null text counts as empty, and all empty texts are copies of
    each other. Repeated rows belong to one class. Tables between the steps lie in the
    shared folder, so a lost executor repeats a step at most.
    """
    placed = _classes(docs, id, text, **options)
    named = placed.groupBy("root").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return placed.join(named, "root").select("id", "copy", "class_id", "class_size")


def _classes(docs: DataFrame, id: str, text: str, similar: float = SIMILAR, width: int = WIDTH,
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id, copy, root``: rows with the same root are one class."""
    signed = stored(signatures(docs, id, text, width, bands, rows), "signatures")
    nodes = stored(signed.groupBy("copy").agg(F.any_value("n").alias("n"), F.any_value("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()), "nodes")
    banded = nodes.filter("n > 0").select("node", F.posexplode("bands").alias("band", "hash"))
    shared = (banded.groupBy("band", "hash").agg(F.min("node").alias("b"), F.max("node").alias("last"))
              .filter("b < last").select("band", "hash", "b"))
    members = stored(banded.join(shared, ["band", "hash"]), "members")
    stars = stored(members.filter("node <> b").groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("shared")), "stars")
    wanted = members.select("node").distinct().join(nodes.select("node", "copy"), "node")
    texts = (docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("copy", F.md5("text"))
             .join(wanted, "copy").groupBy("node").agg(F.any_value("text").alias("text")))
    sets = stored(texts.mapInArrow(_sets(width), "node bigint, shingles array<bigint>"), "shingles")

    best = stars.groupBy("a").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b"))
    roots = _grown(None, stored(_similar(best, sets, similar), "links"))
    apart = lambda pairs: _rooted(_rooted(pairs, roots, "a", "ra"), roots, "b", "rb").filter("ra <> rb").select("a", "b")
    more = apart(stars.join(best, ["a", "b"], "left_anti"))
    roots = _grown(roots, stored(_similar(more, sets, similar), "links"))
    left = stored(_open_bands(members, roots, sets, similar), "open")
    roots = _grown(roots, stored(_similar(_central(_moved(left, roots)), sets, similar), "links"))
    roots = _grown(roots, stored(_linked_across(_moved(left, roots), sets, similar), "links"))

    rooted = _rooted(nodes.select("node", "copy"), roots, "node", "root").select("copy", "root")
    return stored(signed.select("id", "copy").join(rooted, "copy"), "classes")


def _open_bands(members: DataFrame, roots: DataFrame | None, sets: DataFrame, similar: float) -> DataFrame:
    """``band, hash, node, root, n, m`` of the texts that may still be linked across classes.

    In a band whose texts are one class by now, nothing is left to compare. Of two texts
    of ``n`` and ``n'`` shingles, the first having ``m`` that any other candidate has at
    all, at most ``m`` are common, so their similarity is at most m / (n + n' - m). A
    text with too many shingles of its own is thereby left out, and no link is lost.
    """
    rooted = _rooted(members.select("band", "hash", "node"), roots, "node", "root")
    open_ = stored(_mixed(rooted), "apart")
    shared = sets.select(F.explode("shingles").alias("s")).groupBy("s").count().filter("count > 1").select("s")
    own = sets.join(open_.select("node").distinct(), "node").select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    sized = own.join(shared, "s").groupBy("node", "n").agg(F.count("*").alias("m"))
    known = open_.join(sized, "node")
    least = known.groupBy("band", "hash").agg(F.min("n").alias("least"))
    near = F.greatest(F.col("least"), similar * F.col("n"))
    return known.join(least, ["band", "hash"]).filter(_able("m", "n", near, similar)).drop("least")


def _able(m: str, n: str, other: Column, similar: float) -> Column:
    return F.col(m) >= similar * (F.col(n) + other - F.col(m)) - 1e-6


def _central(left: DataFrame) -> DataFrame:
    """Pairs of each text with the text of its band that has most in common with others."""
    center = left.groupBy("band", "hash").agg(F.max_by("node", F.struct("m", -F.col("node"))).alias("b"), F.max_by(
        "root", F.struct("m", -F.col("node"))).alias("rb"))
    return left.join(center, ["band", "hash"]).filter("root <> rb").select(F.col("node").alias("a"), "b").distinct()


def _linked_across(left: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Links ``a, b`` of texts of one band in different classes.

    The texts outside the band's largest class meet all its texts, in blocks of bounded
    size: a task holds two blocks of sets, no row is made for a pair, and a text gives at
    most one link for each class in a block.
    """
    sizes = left.groupBy("band", "hash", "root").count()
    blocks = lambda rows: F.ceil(rows / BLOCK).cast("int")
    bands = sizes.groupBy("band", "hash").agg(F.max_by("root", F.struct("count", -F.col("root"))).alias("largest"), blocks(
        F.sum("count")).alias("all"), blocks(F.sum("count") - F.max("count")).alias("outer"))
    rows = left.join(bands, ["band", "hash"]).join(sets, "node")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["band", "hash", "node", "root", "shingles"]
    outer = rows.filter("root <> largest").select(*columns, "all", F.lit(True).alias("out"), own("outer").alias("i")).select(
        *columns, "out", "i", each("all").alias("j"))
    inner = rows.select(*columns, "outer", F.lit(False).alias("out"), own("all").alias("j")).select(
        *columns, "out", each("outer").alias("i"), "j")
    return (outer.unionByName(inner).groupBy("band", "hash", "i", "j")
            .applyInArrow(_block_links(similar), "a bigint, b bigint").distinct())


def _block_links(similar: float):
    def run(table: pa.Table) -> pa.Table:
        out, node, root = (np.asarray(table.column(c)) for c in ("out", "node", "root"))
        lists = table.column("shingles").combine_chunks()
        size = np.asarray(lists.value_lengths()).astype(np.int64)
        known, code = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        starts = np.cumsum(size) - size
        inner = np.flatnonzero(~out)
        held = np.zeros(len(known), bool)
        a, b = [], []
        if len(inner):
            taken = np.concatenate([code[starts[k]:starts[k] + size[k]] for k in inner])
            at = np.cumsum(size[inner]) - size[inner]
        for k in np.flatnonzero(out) if len(inner) else ():
            mine = code[starts[k]:starts[k] + size[k]]
            held[mine] = True
            both = np.add.reduceat(held[taken], at, dtype=np.int64)
            held[mine] = False
            like = np.flatnonzero((both >= similar * (size[inner] + size[k] - both)) & (root[inner] != root[k]))
            _, first = np.unique(root[inner[like]], return_index=True)
            b += node[inner[like[first]]].tolist()
            a += [int(node[k])] * len(first)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _moved(left: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The open bands after their texts have found more links."""
    return stored(_mixed(_rooted(left.drop("root"), roots, "node", "root")), "moved")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of bands that hold more than one class."""
    several = rows.groupBy("band", "hash").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    return rows.join(several.select("band", "hash"), ["band", "hash"])


def kept_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, one row of each class: the one with the
    least id (null last), then the least text hash. Of equal rows any one stays."""
    found = _classes(docs, id, text, **options)
    none, known = F.isnull("id"), F.coalesce("id", F.lit(0))
    first = found.groupBy("root").agg(F.min(F.struct(none.alias("none"), known.alias("known"), "copy")).alias("k"))
    key = ["none", "known", "copy"]
    rows = docs.select(F.struct("*").alias("doc"), F.col(id).cast("bigint").alias("id"), F.md5(
        F.coalesce(F.col(text), F.lit(""))).alias("copy")).select("doc", none.alias("none"), known.alias("known"), "copy")
    again = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    return rows.join(first.select("k.*"), key).withColumn("again", again).filter("again = 1").select("doc.*")
