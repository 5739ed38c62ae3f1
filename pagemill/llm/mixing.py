"""Mixing sources to target weights by weighted fair queueing.

Each source serves its documents in shuffled order, up to ``REPEATS`` times over. A
document's virtual finish time is the number of its source's words served up to and with
it, divided by the source's weight. Served in the order of finish times, all sources
advance in proportion to their weights, and one that has no more words leaves its share
to the others. The mix is the beginning of that order, as long as the budget: the words
of all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layout import stored
from .common import WORD

REPEATS = 3
PART_ROWS = 256      # documents of one source that are summed up in order together
RANGES = 4_096       # ranges of virtual time; only the one that holds the end is sorted

#: Place in the order of a source: a hash of id and text, so it follows neither.
SHUFFLE_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def shuffle_place(id: Column, text: Column) -> Column:
    digest = F.md5(F.concat_ws("|", id.cast("string"), text))
    return F.conv(F.substring(digest, 1, SHUFFLE_BITS // 4), 16, 10).cast("bigint")


def source_shares(sizes: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``source, weight, source_size, target`` from one row per source (``source,
    source_size``): weights 1, 2, 3, repeating, by code point with null last.

    Targets share the total by weight; one above ``repeats`` times its source stops
    there and the rest shares the excess. In the order of size over weight, exactly a
    first part of the sources stops: the level is the largest that its own source could
    still serve. The table has one row per source.
    """
    one = Window.partitionBy(F.lit(0))
    upto = one.orderBy("full", "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("rank", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last()))).select(
        "*", ((F.col("rank") - 1) % 3 + 1).alias("weight"))
    cap = F.lit(repeats) * F.col("source_size")
    ranked = ranked.withColumn("full", cap / F.col("weight"))
    summed = ranked.select(
        "*", (F.sum("source_size").over(one) - F.coalesce(F.sum(cap).over(upto), F.lit(0))).alias("left"),
        (F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(upto), F.lit(0))).alias("weights"))
    level = F.max(F.when(F.col("left") <= F.col("full") * F.col("weights"), F.col("left") / F.col("weights"))).over(one)
    return summed.select("source", "weight", "source_size", F.least(
        cap.cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"))


def queued(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", repeats: int = REPEATS) -> DataFrame:
    """``id, source, size, place, served, weight, source_size, target``, one row per document.

    ``served`` counts the source's words up to and with the document, in shuffled order.
    A source is cut into parts by place: sums within parts and sums over parts make the
    whole, so a source with a third of all rows is no single group. A null text has no
    words; null is a source of its own. Rows that agree in id and text are
    interchangeable. An empty table has no rows; a long text is counted where it lies.
    """
    sized = stored(docs.select(
        F.col(id).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        shuffle_place(F.col(id), F.col(text)).alias("place")), "sizes")
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    parts = -(-sized.count() // PART_ROWS) or 1
    width = -(-(1 << SHUFFLE_BITS) // parts)
    sized = sized.select("*", key.alias("key"), F.floor(F.col("place") / F.lit(width)).alias("part"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sized.groupBy("key", "source", "part").agg(F.sum("size").alias("words"))
    ahead = totals.select("key", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("ahead"))
    shares = source_shares(totals.groupBy("key", "source").agg(F.sum("words").alias("source_size")), repeats).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"), "weight", "source_size", "target")
    parted = ahead.join(shares, "key")
    within = Window.partitionBy("key", "part").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return (sized.withColumn("within", F.sum("size").over(within)).join(parted, ["key", "part"])
            .select("id", "source", "size", "place", (F.col("ahead") + F.col("within")).alias("served"),
                    "weight", "source_size", "target"))


def turns(queue: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Each document of ``queue`` once for each ``turn``, with its virtual ``finish``."""
    turn = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn")
    return queue.select("*", turn).withColumn("finish", (
        F.col("turn") * F.col("source_size") + F.col("served")) / F.col("weight"))


ORDER = ("finish", "weight", "source", "turn", "place", "id")


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", repeats: int = REPEATS) -> DataFrame:
    """``queued`` with ``taken``: the words of each document in the mix, repeats counted.

    The order of all turns is cut by range of finish time. Words are counted for each
    range; the range in which the budget ends is sorted and summed up, which gives the
    last turn and how much of it fits. All turns before it are taken whole. An empty table
    has no rows; where no text has a word, nothing is taken.
    """
    queue = stored(queued(docs, id, text, source, repeats), "queue")
    every = turns(queue, repeats).filter("size > 0")
    budget, last = queue.select(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(
        F.max(repeats * F.col("source_size") / F.col("weight")), F.lit(0.0))).first()
    if not budget:
        return queue.withColumn("taken", F.lit(0).cast("bigint"))
    lower, upper, before = 0.0, last, 0
    while True:
        step = (upper - lower) / RANGES
        place = F.least(F.floor((F.col("finish") - lower) / step), F.lit(RANGES - 1))
        inside = every.filter((F.col("finish") >= lower) & (F.col("finish") <= upper))
        ranges = inside.groupBy(place.alias("range")).agg(
            F.sum("size").alias("words"), F.count("*").alias("rows"), F.min("finish").alias("low"), F.max("finish").alias("high"))
        for found in sorted(ranges.collect()):  # at most RANGES rows
            if before + found.words >= budget:
                break
            before += found.words
        lower, upper = found.low, found.high
        if found.rows <= 100_000 or lower == upper:
            break
    upto = Window.orderBy(*[F.col(c).asc_nulls_last() for c in ORDER]).rowsBetween(Window.unboundedPreceding, 0)
    sorted_range = (every.filter((F.col("finish") >= lower) & (F.col("finish") <= upper))
                    .withColumn("end", F.sum("size").over(upto) + before))
    end = sorted_range.filter(F.col("end") >= budget).orderBy("end").limit(1).first()
    # Place of a turn against the last one, null after every value as in the sort.
    rank = lambda value, kind: F.struct(value.isNull(), F.coalesce(value, F.lit("" if kind == "string" else 0)).cast(kind))
    kinds = {c: dict(every.dtypes)[c] for c in ORDER}
    mine = lambda turn: F.struct(*[rank(v, kinds[c]).alias(c) for c, v in (
        (c, (turn * F.col("source_size") + F.col("served")) / F.col("weight") if c == "finish" else
         turn if c == "turn" else F.col(c)) for c in ORDER)])
    bound = F.struct(*[rank(F.lit(end[c]).cast(kinds[c]), kinds[c]).alias(c) for c in ORDER])
    words = lambda turn: (F.when(mine(turn) < bound, F.col("size"))
                          .when(mine(turn) == bound, F.col("size") - (end.end - budget)).otherwise(0))
    return queue.withColumn("taken", sum((words(F.lit(t)) for t in range(1, repeats)), words(F.lit(0))).cast("bigint"))


def mixture(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", repeats: int = REPEATS) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it.

    The document at which the budget ends stays whole. A document without words takes
    nothing from the budget and stays once. Equal rows are paired off by number.
    """
    key = ["none", "known", "place", "again"]
    def keyed(rows: DataFrame) -> DataFrame:
        again = Window.partitionBy("none", "known", "place").orderBy(F.lit(0))
        none, known = F.isnull("id").alias("none"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("known")
        return rows.select("*", none, known).withColumn("again", F.row_number().over(again))
    taken = mixed(docs, id, text, source, repeats)
    times = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id).alias("id"), shuffle_place(F.col(id), F.col(text)).alias("place"))
    counts = keyed(taken.select("id", "place", times.alias("times"))).filter("times > 0").select(*key, "times")
    return keyed(rows).join(counts, key).select(F.explode(F.array_repeat("doc", F.col("times"))).alias("doc")).select("doc.*")
