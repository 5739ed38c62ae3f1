"""Quality rules: counts within a document, and lines that a host repeats everywhere.

``measured`` counts words, symbols and repeats of each text. ``frequent_lines`` hashes
normalised lines and counts, for each host, the different documents that hold a line.
``judged`` takes lines above the limits away and rejects documents with too little left;
``without_lines`` returns the texts without them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind
from ..sources.layout import stored
from .common import SPACE, WORD, positions, word_list

WINDOW = 8
LINE_DOCUMENTS = 10     # a line is frequent from so many documents of its host on
LEAST_WORDS = 20        # words that a document must keep
LEAST_SHARE = 0.3       # and the share of its words


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that stand in a window of ``width`` words found at least twice."""
    hashes = F.transform(positions(F.size(words) - (width - 1)), lambda i: F.xxhash64(
        *[F.get(words, i + k) for k in range(width)]))
    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        same = lambda x, other: x["h"].eqNullSafe(other["h"])
        twice = lambda o: F.sort_array(F.transform(F.filter(
            o, lambda x, i: same(x, F.get(o, i - 1)) | same(x, F.get(o, i + 1))), lambda x: x["at"]))
        # Each such window adds what the next one does not start with.
        total = lambda at: F.aggregate(F.transform(at, lambda x, i: F.least(
            F.coalesce(F.get(at, i + 1) - x, F.lit(width)), F.lit(width))), F.lit(0), lambda s, x: s + x)
        return bind(ordered, lambda o: bind(twice(o), total))
    return bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)).cast("bigint")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(f"[^{SPACE}]")))


def normal_line(line: Column) -> Column:
    """Lower case, digits as 0, single spaces, none at the ends."""
    digits = F.regexp_replace(F.lower(line), "[0-9]", "0")
    return F.btrim(F.regexp_replace(digits, f"[{SPACE}]+", " "))


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: ``row`` (a number of its own), ``id``, ``host``, the counts,
    ``copy`` (hash of the text) and ``lines`` (hash and words of each line with a word).

    A null text counts as empty, a null host is a host of its own.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = F.col("text")
    counted = rows.select(
        "id", F.coalesce(F.concat(F.lit("="), F.col("host")), F.lit("")).alias("host"), F.xxhash64(t, F.length(t)).alias("copy"),
        F.length(F.regexp_replace(t, f"[{SPACE}]+", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        bind(lines_with_words(t), lambda l: F.struct(
            (F.size(l) - F.size(F.array_distinct(l))).cast("bigint").alias("repeats"),
            F.transform(l, lambda x: F.struct(
                F.xxhash64(normal_line(x)).alias("line"),
                F.regexp_count(x, F.lit(WORD)).cast("bigint").alias("words"))).alias("each"))).alias("lines"),
        bind(word_list(t), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("repeated"))).alias("words"))
    return counted.select(
        F.monotonically_increasing_id().alias("row"), "id", "host", "copy", F.col("words.n").alias("n_words"), "word_chars",
        "n_symbols", F.col("lines.repeats").alias("n_dup_lines"), F.col("words.repeated").alias("n_repeat_words"),
        F.col("lines.each").alias("lines"))


def frequent_lines(measures: DataFrame, documents: int = LINE_DOCUMENTS, share: float = 0.0) -> DataFrame:
    """``host, line, documents`` of lines in so many documents. Copies of one text count once.

    Whether a line is frequent does not depend on what else its host holds. With ``share``, it
    must also stand in that share of the host's documents.

    Counting combines before the shuffle, so a line of every document is no large group.
    """
    texts = measures.groupBy("host", "copy").agg(F.any_value(F.array_distinct("lines.line")).alias("lines"))
    # One more entry for each text counts the texts of the host in the same pass.
    entries = F.concat(F.array(F.struct(F.lit(True).alias("all"), F.lit(0).cast("bigint").alias("line"))),
                       F.transform("lines", lambda x: F.struct(F.lit(False).alias("all"), x.alias("line"))))
    counted = texts.select("host", F.explode(entries).alias("e")).groupBy("host", "e").agg(F.count("*").alias("documents"))
    many = counted.filter((F.col("documents") >= documents) & ~F.col("e.all")).select("host", F.col("e.line").alias("line"), "documents")
    hosts = counted.filter("e.all").select("host", F.col("documents").alias("texts"))
    return many.join(hosts, "host").filter(F.col("documents") >= share * F.col("texts")).select("host", "line", "documents")


def judged(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source",
           documents: int = LINE_DOCUMENTS, share: float = 0.0) -> DataFrame:
    """``id``, the counts, ``n_line_words`` (words in frequent lines), ``base_failed`` and ``kept``.

    Every row is judged, equal ones each for itself. A null or empty text has no words and
    fails; a null host is a host of its own. An empty table has no rows.
    """
    rows = stored(measured(docs, id, text, host), "quality")
    lines = rows.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    taken = (lines.join(frequent_lines(rows, documents, share).select("host", "line"), ["host", "line"])
             .groupBy("row").agg(F.sum("words").alias("n_line_words")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_line_words")
    return (rows.join(taken, "row", "left").withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (left >= LEAST_WORDS) & (left >= LEAST_SHARE * F.col("n_words")))
            .drop("row", "host", "copy", "lines"))


def without_lines(docs: DataFrame, frequent: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``doc`` (all columns of a row) and ``clean``: its text without the frequent lines of
    its host; the other lines keep their order. A null text stays null."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("text"), F.coalesce(
        F.concat(F.lit("="), F.col(host)), F.lit("")).alias("host"), F.md5(F.concat_ws("\n", F.struct("*").cast("string"))).alias("key"))
    split = rows.select("key", "host", F.explode(F.array_distinct(F.transform(
        lines_with_words(F.col("text")), lambda x: F.xxhash64(normal_line(x))))).alias("line"))
    gone = (split.distinct().join(frequent.select("host", "line"), ["host", "line"], "left_semi")
            .groupBy("key").agg(F.collect_set("line").alias("gone")))
    keep = lambda x: ~F.coalesce(F.array_contains("gone", F.xxhash64(normal_line(x))) & F.rlike(x, F.lit(f"[^{SPACE}]")), F.lit(False))
    return rows.join(gone, "key", "left").select("doc", F.array_join(F.filter(F.split("text", "\n", -1), keep), "\n").alias("clean"))
