"""Question/answer training set: prompts, parsed questions, joins, batches, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import TrainingWording, answer_prompt, question_prompt
from ..functions.responses import parse_questions
from ..functions.text import whole_part
from ..sources.bucketed import in_key_order
from ..sources.layout import MAX_PARTITIONS, checked_broadcast, stored
from .joins import skew_join

BINS = 1024
NARROW_ROWS = 10_000
RANGE_ROWS = 5_000      # questions that are sorted with their texts at once
TEXT_BYTES = 512 << 10  # texts that a part of the training set holds, about
HOT_QUESTIONS = 100_000


def question_prompts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     wording: TrainingWording = TrainingWording()) -> DataFrame:
    return docs.select(doc_id, question_prompt(F.col(text), wording).alias("prompt"))


def questions_parse(responses: DataFrame) -> DataFrame:
    """Add ``questions``, and ``reject`` where the response is no JSON array."""
    parsed = responses.withColumn("questions", parse_questions(F.col("response")))
    return parsed.withColumn("reject", F.col("questions").isNull())


def question_id(doc_id: str, position: str = "position") -> Column:
    """Document and position as text of fixed width: any two numbers fit, and the order of
    the texts is that of document (from 0 on) and position."""
    digits = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    return F.concat(digits(doc_id, 20), F.lit("-"), digits(position, 10))


def question_rows(parsed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``id, doc_id, position, question``; the id follows from document and position."""
    rows = parsed.select(doc_id, F.posexplode_outer("questions").alias("position", "question"))
    return rows.filter("position is not null").select(question_id(doc_id).alias("id"), doc_id, "position", "question")


def qa_join(questions: DataFrame, docs: DataFrame, doc_id: str = "doc_id",
            text: str = "text", ordered: bool = True) -> DataFrame:
    """``question_id, question, content``, in question order if ``ordered``; no matter
    how many questions one document has.

    For the order, questions are cut into ranges of ids before texts are joined. A text is moved
    once for each range that asks it, not once for each question, and rows are sorted where the
    range lies.
    """
    # Stored, since frequent documents are counted before the join.
    asked, texts = stored(questions.select("id", doc_id, "question"), "questions"), docs.select(doc_id, F.col(text).alias("content"))
    if not ordered:
        return skew_join(asked, texts, doc_id, "id").select(F.col("id").alias("question_id"), "question", "content")
    ranges = max(asked.sparkSession.sparkContext.defaultParallelism, min(MAX_PARTITIONS, -(-asked.count() // RANGE_ROWS)))
    ranged = stored(asked.repartitionByRange(ranges, "id").withColumn("_range", F.spark_partition_id()), "ranges")
    of_text = ranged.groupBy("_range", doc_id).agg(F.collect_list(F.struct("id", "question")).alias("_asked"))
    joined = skew_join(of_text, texts, doc_id, "_range").repartitionById(ranges, F.col("_range"))
    pairs = joined.select(F.explode("_asked").alias("_a"), "content")
    return pairs.select(F.col("_a.id").alias("question_id"), F.col("_a.question").alias("question"), "content").sortWithinPartitions("question_id")


def qa_join_bucketed(questions: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranges: int = 1) -> DataFrame:
    """``qa_join`` of two tables in the same buckets of ``doc_id`` (``sources.bucketed``), with
    ``range``: written by it, folders are in the order of documents and so of question ids.
    Neither questions nor texts are shuffled."""
    ranged = in_key_order(questions, doc_id, ranges)
    joined = ranged.join(docs.select(doc_id, text).hint("merge"), doc_id)
    return joined.select(F.col("id").alias("question_id"), "question", F.col(text).alias("content"), "range")


def answer_prompts(pairs: DataFrame, wording: TrainingWording = TrainingWording()) -> DataFrame:
    return pairs.select("question_id", answer_prompt(F.col("content"), F.col("question"), wording).alias("prompt"))


def batch_page(df: DataFrame, key: str, start: int, n: int = 10) -> DataFrame:
    """Rows ``[start, start + n)`` in the order of the unique bigint ``key``, null last.

    The range of keys that holds the page is narrowed first: each step counts the rows of
    ``BINS`` parts of the range and keeps those the page lies in. Whole rows are read from
    that range only; it has at most ``n`` and ``NARROW_ROWS`` more, or keys that are equal.
    Null keys have no order among themselves.
    """
    k, skipped = F.col(key), 0
    lo, hi, rows = df.agg(F.min(key), F.max(key), F.count(key)).first()
    stop = min(start + n, rows)
    known = df.limit(0)
    if start < rows:
        inside = rows
        while lo < hi and inside > n + NARROW_ROWS:
            width = -(-(hi - lo + 1) // BINS)
            # Decimals, since the distance of two bigints may not be one.
            part = whole_part(k.cast("decimal(20,0)") - F.lit(lo).cast("decimal(20,0)"), width,
                              "decimal(21,0)").alias("part")
            counts = df.filter(k.between(lo, hi)).groupBy(part).agg(F.count("*").alias("rows")).collect()
            before, kept = skipped, []
            for row in sorted(counts):
                if before < stop and before + row["rows"] > start:
                    kept.append(row)
                elif not kept:
                    skipped += row["rows"]
                before += row["rows"]
            lo, hi = lo + int(kept[0]["part"]) * width, min(hi, lo + (int(kept[-1]["part"]) + 1) * width - 1)
            if inside == (inside := sum(row["rows"] for row in kept)) and len(kept) > 1:
                break
        known = df.filter(k.between(lo, hi)).orderBy(key).offset(start - skipped).limit(n)
    if start + n <= rows:
        return known
    unknown = df.filter(k.isNull()).offset(max(0, start - rows)).limit(start + n - max(start, rows))
    return known.unionByName(unknown)


def resume_pending(df: DataFrame, done: DataFrame, key: str, done_key: str | None = None,
                   n_batches: int = 10) -> DataFrame:
    """Rows whose key is not in ``done``, each with a batch number that never changes."""
    # A digest, since keys may be multiples of something.
    spread = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10)
    finished = checked_broadcast(done.select(F.col(done_key or key).alias(key)))
    return (df.join(finished, key, "left_anti")
            .withColumn("batch", F.pmod(spread.cast("bigint"), F.lit(n_batches)).cast("bigint")))


def qa_dataset(questions: DataFrame, answers: DataFrame, docs: DataFrame, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Question, answer and source text of every answered question.

    A text is in the result once for each of its questions. Parts are so small that Parquet's
    dictionary (1 MB) holds their texts: rows of a part then refer to a text that is written once.
    """
    given = answers.select("question_id", "answer")
    answered = questions.join(given, questions["id"] == given["question_id"]).drop("id")
    texts = docs.select(doc_id, text)
    size = texts.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, min(MAX_PARTITIONS, -(-size // TEXT_BYTES)))
    joined = skew_join(stored(answered, "answered"), texts, doc_id, "question_id", hot_rows=HOT_QUESTIONS, partitions=parts)
    return joined.select("question_id", doc_id, "question", "answer", F.col(text).alias("content"))
