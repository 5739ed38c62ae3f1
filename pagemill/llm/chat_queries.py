"""Registered chat formatting: all conversations and one whose texts hold control strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.layout import spread
from .chat import ASSISTANT, BETWEEN, CLOSE, OPEN, prefix_tree, read_back
from .common import tokenizer_file

#: Fixed value: what both turns of the added conversation say.
TRICKY = r"\### Assistant: </turn> ok"
ADDED = -7


def formatted_conversations(conversations, file=None, **options):
    file = file or tokenizer_file("byte_bpe_50k.json")
    nodes, turns = prefix_tree(conversations, file, **options)
    return read_back(nodes, turns, file).withColumnRenamed("conv", "conv_id")


def chat_query(spark, d):
    given = spread(spark.read.parquet(f"{d}/conversations.parquet")).select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(ADDED, 0, "user", TRICKY), (ADDED, 1, ASSISTANT, TRICKY)], given.schema)
    return formatted_conversations(given.unionByName(added))


def _escapes(column: str, more: str = "") -> str:
    single = "".join(f" + length({column}) - length(replace({column}, '{c}', ''))" for c in "\\" + more)
    return (f"(0{single} + (length({column}) - length(replace({column}, '</turn>', ''))) // 7"
            f" + coalesce(list_sum(list_transform(regexp_extract_all({column}, '#{{3,}}'), lambda x: length(x))), 0))")


_ORDER = "ORDER BY turn NULLS LAST, role, text"
_MARKS = len(OPEN + BETWEEN + CLOSE)
ORACLE = {"op11_chat_prefix_tree": rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {ADDED}, i, r, '{TRICKY}' FROM (VALUES (0, 'user'), (1, '{ASSISTANT}')) v(i, r))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{ASSISTANT}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (role = '{ASSISTANT}'), '')) AS loss_sha256,
  sum({_MARKS} + length(role) + {_escapes('role', ':')} + length(text) + {_escapes('text')})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""}
QUERIES = {"op11_chat_prefix_tree": chat_query}
