"""Batch question answering over stored completions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prompts import (
    LINK, ChatWording, answer_html, chat_prompt, prompt_hash, shown_answer, shown_prompt,
)
from ..functions.responses import parse_completion
from ..functions.text import whole_part
from .embedding import embed
from .joins import preceding_rows
from .search import topk, with_metadata


def question_batch(df: DataFrame, id_column: str | None = None) -> DataFrame:
    """``question_id, question`` from the first column of any input.

    ``id_column`` must be given: it names a unique bigint column, by which answers find their
    question again. When it comes first the next column is the question.
    """
    columns = [c for c in df.columns if c != id_column]
    if id_column is None:
        raise ValueError("name the column that identifies a question")
    return df.select(F.col(id_column).cast("bigint").alias("question_id"),
                     F.col(columns[0]).cast("string").alias("question"))


def local_questions(spark: SparkSession, questions) -> DataFrame:
    """The same from a string, a list, a pandas DataFrame or a numpy array."""
    if isinstance(questions, str):
        questions = [questions]
    elif hasattr(questions, "iloc"):
        questions = questions.iloc[:, 0].tolist()
    elif hasattr(questions, "ndim"):
        questions = (questions[:, 0] if questions.ndim > 1 else questions).tolist()
    rows = [(i, None if q is None else str(q)) for i, q in enumerate(questions)]
    return spark.createDataFrame(rows, "question_id bigint, question string")


def rag_context(questions: DataFrame, index: DataFrame, documents: DataFrame,
                threshold: float | None = None, model=None, k: int = 1, document_id: str = "id",
                columns: tuple[str, ...] = ("url", "content")) -> DataFrame:
    """Add the ``k`` best documents of each question, one row each with its ``rank``; a
    question without a match has one row without them."""
    asked = embed(questions, "question", model=model)
    found = with_metadata(topk(asked, index, k, threshold, query_id="question_id"), documents, document_id, columns)
    details = found.select(F.col("query_id").alias("question_id"), "rank", F.col("id").alias("document_id"),
                           "score", *columns)
    return questions.join(details, "question_id", "left")


def merged_context(context: DataFrame, columns: tuple[str, ...] = ("question",), gap: str = "\n\n") -> DataFrame:
    """One row per question: the contents of its documents in order of rank, one after the
    other, and the fields of the best one. A question has at most ``k`` rows."""
    parts = F.array_sort(F.collect_list(F.struct("rank", "document_id", "score", "url", "content")))
    grouped = context.groupBy("question_id", *columns).agg(parts.alias("parts"))
    contents = F.array_compact(F.transform("parts", lambda p: p["content"]))
    best = F.get("parts", F.lit(0))
    return grouped.select("question_id", *columns, *[best[c].alias(c) for c in ("document_id", "score", "url")],
                          F.when(F.size(contents) > 0, F.array_join(contents, gap)).alias("content"))


def rag_prompt(context: DataFrame, wording: ChatWording = ChatWording()) -> DataFrame:
    return context.withColumn("prompt", chat_prompt(F.col("question"), F.col("content"), wording=wording))


def prompt_history(turns: DataFrame, n: int = 4, wording: ChatWording = ChatWording()) -> DataFrame:
    """Prompt of each user turn with the last ``n`` turns of its conversation."""
    past = preceding_rows(turns, "conv_id", "turn", ["role", "text"], n)
    prompt = chat_prompt(F.col("text"), history=F.col("history"), wording=wording)
    return past.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.size("history").cast("bigint").alias("n_history"), prompt.alias("prompt"))


def completion_join(prompts: DataFrame, completions: DataFrame) -> DataFrame:
    """Add the stored ``response`` of each prompt by its hash, null when there is none.

    ``completions`` is unique on ``prompt_hash``. One very frequent prompt makes a
    large partition on the left only, which adaptive execution splits.
    """
    keyed = prompts.withColumn("prompt_hash", prompt_hash(F.col("prompt")))
    return keyed.join(completions.select("prompt_hash", "response"), "prompt_hash", "left")


def completion_parse(joined: DataFrame) -> DataFrame:
    """Add ``status`` and ``text`` of the first candidate."""
    parsed = parse_completion(F.col("response"))
    return joined.withColumn("_parsed", parsed).select(
        *joined.columns, F.col("_parsed.status").alias("status"), F.col("_parsed.text").alias("text"))


def answer_format(parsed: DataFrame, url: str = "url", link: str = LINK) -> DataFrame:
    return parsed.withColumn("answer", answer_html(F.col("text"), F.col(url), link))


def answer_display(answers: DataFrame) -> DataFrame:
    return answers.select("question_id", shown_prompt(F.col("prompt")).alias("prompt_html"),
                          shown_answer(F.col("answer")).alias("answer_html"))


def answer_records(answers: DataFrame, batch_size: int = 100) -> DataFrame:
    """``batch_id, records``: the answers of ``batch_size`` consecutive question ids.

    Ids are unique, so an array holds at most ``batch_size`` records.
    """
    record = F.struct("question_id", "answer", "prompt")
    batch = whole_part(F.col("question_id"), batch_size).alias("batch_id")
    grouped = answers.groupBy(batch).agg(F.array_sort(F.collect_list(record)).alias("_r"))
    return grouped.select("batch_id", F.transform(
        "_r", lambda r: F.struct(r["answer"].alias("answer"), r["prompt"].alias("prompt"))).alias("records"))
