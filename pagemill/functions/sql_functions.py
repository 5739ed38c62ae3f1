"""The prompt and parse steps as named SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .prompts import MAX_ANSWER_TOKENS, TrainingWording


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def register(spark: SparkSession, wording: TrainingWording = TrainingWording()) -> None:
    """Create the functions in the session; Catalyst inlines them into the plan."""
    w = wording
    definitions = {
        "question_prompt(doc STRING) RETURNS STRING":
            f"concat({_text(w.page)}, doc, {_text(w.ask)})",
        "answer_prompt(doc STRING, question STRING) RETURNS STRING":
            f"concat({_text(w.context)}, doc, {_text(w.question)}, question)",
        "model_request(prompt STRING) RETURNS STRING":
            f"to_json(named_struct('prompt', prompt, 'max_tokens', {MAX_ANSWER_TOKENS}))",
        "parse_questions(response STRING) RETURNS ARRAY<STRING>":
            "from_json(response, 'array<string>')",
        "question_request(doc STRING) RETURNS STRING":
            "model_request(question_prompt(doc))",
        "answer_request(doc STRING, question STRING) RETURNS STRING":
            "model_request(answer_prompt(doc, question))",
    }
    for head, body in definitions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
