"""Parse stored model responses; what cannot be parsed keeps a reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPLETION = "candidates array<struct<text string>>, _corrupt string"


def parse_completion(response: Column) -> Column:
    """``struct<status, text>`` from ``{"candidates": [{"text": ...}]}``.

    Status is ``ok``, ``missing`` (no response), ``malformed`` (not the expected
    JSON) or ``no candidates``.
    """
    parsed = F.from_json(response, COMPLETION, {"columnNameOfCorruptRecord": "_corrupt"})
    first = F.try_element_at(parsed["candidates"], F.lit(1))["text"]
    status = (
        F.when(response.isNull(), "missing")
        .when(parsed["_corrupt"].isNotNull(), "malformed")
        .when(first.isNull(), "no candidates")
        .otherwise("ok")
    )
    return F.struct(status.alias("status"), first.alias("text"))


def parse_questions(response: Column) -> Column:
    """JSON array of strings -> array; null when it is not one."""
    return F.from_json(response, "array<string>")
