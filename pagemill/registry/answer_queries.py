"""Batch answering and the training set."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.prompts import LINK, ChatWording, TrainingWording, prompt_hash
from ..functions.sql_functions import register
from ..operators.answers import (
    answer_display, answer_records, completion_join, completion_parse, prompt_history, question_batch,
    rag_context,
)
from ..operators.training import (
    answer_prompts, batch_page, qa_dataset, qa_join, qa_join_bucketed, question_id, question_prompts, question_rows,
    questions_parse, resume_pending,
)
from ..plans.flows import answer_prompts as answer_all
from ..plans.flows import build_prompts
from ..session import new_dir
from ..sources.bucketed import write_bucketed
from ..sources.tables import append_batch, read_batches
from .common import (
    CONTEXT_SQL, QUESTIONS_SQL, questions, site, sql_text, table, text_index,
)

BATCH = 100
LONG_REPLY = 800


def batch_query(spark, d):
    turns = table(spark, d, "conversations").filter("role = 'user'")
    return question_batch(turns.select("text", (F.col("conv_id") * 100 + F.col("turn")).alias("question_id")),
                          "question_id")


def context(spark, d, k=1):
    return rag_context(questions(spark, d), text_index(spark, d), site(spark, d), k=k)


def prompts(spark, d):
    """The prompt table, written once: the model answers what was stored."""
    path = new_dir(spark, "prompts")
    build_prompts(questions(spark, d), text_index(spark, d), site(spark, d)).write.parquet(path)
    return spark.read.parquet(path)


def completions(spark, d, asked):
    """What a model sent back, from the next turn of each conversation.

    Conversations with a system turn got an error, long replies broke off in transit,
    and a question without a reply has no completion.
    """
    turns = table(spark, d, "conversations")
    reply = turns.filter("role = 'assistant'").select(
        (F.col("conv_id") * 100 + F.col("turn") - 1).alias("question_id"), "conv_id", F.col("text").alias("reply"))
    ruled = turns.filter("role = 'system'").select("conv_id", F.lit(True).alias("ruled")).distinct()
    full = F.to_json(F.struct(F.array(F.struct(F.col("reply").alias("text"))).alias("candidates")))
    response = (F.when(F.col("ruled"), '{"error":"refused"}')
                .when(F.length("reply") > LONG_REPLY, F.regexp_replace(full, r"\]\}$", ""))
                .otherwise(full))
    keyed = asked.select("question_id", prompt_hash(F.col("prompt")).alias("prompt_hash"))
    return (keyed.join(reply, "question_id").join(ruled, "conv_id", "left")
            .groupBy("prompt_hash").agg(F.min(response).alias("response")))


def joined(spark, d):
    asked = prompts(spark, d)
    return completion_join(asked, completions(spark, d, asked))


def answers(spark, d):
    asked = prompts(spark, d)
    return answer_all(asked, completions(spark, d, asked))


def records_query(spark, d):
    rows = answer_records(answers(spark, d), BATCH)
    return rows.select("batch_id", F.posexplode("records").alias("position", "_r")).select(
        "batch_id", F.col("position").cast("bigint").alias("position"), "_r.answer", "_r.prompt")


def generated(spark, d, *more):
    """Question lists as a model returns them: the lines of each document as a JSON
    array; one source ignored the instruction and returned plain text."""
    lines = F.to_json(F.split("text", "\n"))
    return table(spark, d, "documents").select(
        "doc_id", *more, F.when(F.col("source") == "src7", F.col("text")).otherwise(lines).alias("response"))


def asked_rows(spark, d):
    return question_rows(questions_parse(generated(spark, d)))


def given_answers(spark, d):
    """The line after a question answers it; the last line has no answer."""
    before = asked_rows(spark, d).filter("position > 0").withColumn("position", F.col("position") - 1)
    return before.select(question_id("doc_id").alias("question_id"), F.col("question").alias("answer"))


def append_query(spark, d):
    """Questions arrive in two batches; the second is delivered twice."""
    path = new_dir(spark, "questions")
    docs = generated(spark, d, "lang")
    parts = [docs.filter("lang = 'en'"), docs.filter("not lang <=> 'en'")]
    for batch in (0, 1, 1):
        append_batch(question_rows(questions_parse(parts[batch])), path, batch)
    return read_batches(spark, path).drop("batch")


def parse_query(spark, d):
    parsed = questions_parse(generated(spark, d))
    return parsed.select("doc_id", "reject", F.array_size("questions").cast("bigint").alias("n_questions"),
                         F.array_join("questions", "|").alias("questions"))


def functions_query(spark, d):
    register(spark)
    generated(spark, d, "text").createOrReplaceTempView("pagemill_generated")
    return spark.sql("""
        SELECT doc_id, question_request(text) AS request, answer_request(text, 'Why?') AS answer,
          cast(array_size(parse_questions(response)) AS bigint) AS n_questions
        FROM pagemill_generated""")


def pending_query(spark, d):
    docs = table(spark, d, "documents")
    return resume_pending(docs, table(spark, d, "labels"), "doc_id")


def pairs(spark, d, **options):
    return qa_join(asked_rows(spark, d), table(spark, d, "documents"), **options)


def bucketed_pairs(spark, d):
    """Questions and documents as tables in buckets of the document."""
    name = lambda label: f"{label}_{uuid.uuid4().hex}"
    asked = write_bucketed(asked_rows(spark, d), name("questions"), "doc_id", 8)
    docs = write_bucketed(table(spark, d, "documents").select("doc_id", "text"), name("documents"), "doc_id", 8)
    return qa_join_bucketed(asked, docs, ranges=4)


QUERIES = {
    "question_batch": batch_query,
    "rag_context": lambda s, d: context(s, d).select("question_id", "document_id", "score", "url"),
    "rag_prompt": lambda s, d: build_prompts(
        questions(s, d), text_index(s, d), site(s, d)).select("question_id", "prompt"),
    "rag_context_k3": lambda s, d: context(s, d, 3).select("question_id", "rank", "document_id", "score", "url"),
    "rag_prompt_k3": lambda s, d: build_prompts(
        questions(s, d), text_index(s, d), site(s, d), 3).select("question_id", "document_id", "prompt"),
    "prompt_history": lambda s, d: prompt_history(table(s, d, "conversations"), 2),
    "completion_join": lambda s, d: joined(s, d).select("question_id", "prompt_hash", "response"),
    "completion_parse": lambda s, d: completion_parse(joined(s, d)).select("question_id", "status", "text"),
    "answer_format": lambda s, d: answers(s, d).select("question_id", "status", "answer"),
    "answer_display": lambda s, d: answer_display(answers(s, d)),
    "answer_records": records_query,
    "question_prompt": lambda s, d: question_prompts(table(s, d, "documents")),
    "questions_parse": parse_query,
    "question_rows": asked_rows,
    "append_rows": append_query,
    "qa_join": pairs,
    "qa_join_bucketed": lambda s, d: bucketed_pairs(s, d).drop("range"),
    "batch_page": lambda s, d: batch_page(table(s, d, "documents"), "doc_id", 30, 10),
    "resume_pending": pending_query,
    "answer_prompt": lambda s, d: answer_prompts(pairs(s, d, ordered=False)),
    "qa_dataset": lambda s, d: qa_dataset(asked_rows(s, d), given_answers(s, d), table(s, d, "documents")),
    "sql_functions": functions_query,
}

_C, _T = ChatWording(), TrainingWording()
_PROMPT = (f"{sql_text(_C.open + _C.system)} || CASE WHEN content IS NULL THEN '' ELSE {sql_text(_C.context)} || content END"
           f" || {sql_text(_C.close + _C.instruction + _C.question)} || question || {sql_text(_C.end)}")
_PROMPTS = CONTEXT_SQL + f", prompts AS (SELECT *, {_PROMPT} AS prompt FROM context)"
_COMPLETIONS = _PROMPTS + f""",
replies AS (
  SELECT r.conv_id * 100 + r.turn - 1 AS question_id, r.text AS reply,
    EXISTS (SELECT 1 FROM conversations s WHERE s.conv_id = r.conv_id AND s.role = 'system') AS ruled
  FROM conversations r WHERE r.role = 'assistant'),
responses AS (
  SELECT sha256(prompt) AS prompt_hash, min(CASE WHEN ruled THEN '{{"error":"refused"}}'
    WHEN length(reply) > {LONG_REPLY} THEN '{{"candidates":[{{"text":' || to_json(reply)::VARCHAR || '}}'
    ELSE '{{"candidates":[{{"text":' || to_json(reply)::VARCHAR || '}}]}}' END) AS response
  FROM prompts JOIN replies USING (question_id) GROUP BY 1),
joined AS (SELECT p.*, sha256(prompt) AS hash, response FROM prompts p LEFT JOIN responses ON prompt_hash = sha256(prompt)),
parsed AS (
  SELECT *, CASE WHEN response IS NULL THEN 'missing' WHEN NOT json_valid(response) THEN 'malformed'
    WHEN json_extract_string(response, '$.candidates[0].text') IS NULL THEN 'no candidates' ELSE 'ok' END AS status,
    CASE WHEN json_valid(response) THEN json_extract_string(response, '$.candidates[0].text') END AS text FROM joined),
answers AS (
  SELECT *, replace(CASE WHEN url IS NULL THEN text ELSE text || {sql_text(LINK.split('{url}')[0])} || url
    || {sql_text(LINK.split('{url}')[1])} END, chr(10), '<br/>') AS answer FROM parsed)"""
_ROWS = """WITH generated AS (SELECT doc_id, text, CASE WHEN source = 'src7' THEN NULL ELSE string_split(text, chr(10)) END AS q
  FROM documents),
question_rows AS (
  SELECT lpad(doc_id::VARCHAR, 20, '0') || '-' || lpad((pos - 1)::VARCHAR, 10, '0') AS id, doc_id, (pos - 1)::INT AS position, q[pos] AS question
  FROM (SELECT doc_id, q, unnest(generate_series(1, len(q))) AS pos FROM generated WHERE q IS NOT NULL)),
pairs AS (SELECT id AS question_id, question, text AS content, doc_id, position FROM question_rows JOIN documents USING (doc_id))"""

ORACLE = {
    "question_batch": f"WITH {QUESTIONS_SQL} SELECT * FROM questions",
    "rag_context": CONTEXT_SQL + " SELECT question_id, document_id, score, url FROM context",
    "rag_prompt": _PROMPTS + " SELECT question_id, prompt FROM prompts",
    "rag_context_k3": CONTEXT_SQL + " SELECT question_id, rank, document_id, score, url FROM context3",
    "rag_prompt_k3": CONTEXT_SQL + f""", merged AS (SELECT question_id, question, arg_min(document_id, rank) AS document_id,
  string_agg(content, chr(10) || chr(10) ORDER BY rank) AS content FROM context3 GROUP BY ALL)
SELECT question_id, document_id, {_PROMPT} AS prompt FROM merged""",
    "prompt_history": f"""WITH past AS (
  SELECT conv_id, turn, role, text, coalesce(list(chr(10) || role || ': ' || text) OVER w, []) AS h
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING))
SELECT conv_id, turn, len(h) AS n_history,
  {sql_text(_C.open + _C.system + _C.close + _C.instruction)}
  || CASE WHEN len(h) > 0 THEN {sql_text(_C.history)} || array_to_string(h, '') ELSE '' END
  || {sql_text(_C.question)} || text || {sql_text(_C.end)} AS prompt FROM past WHERE role = 'user'""",
    "completion_join": _COMPLETIONS + " SELECT question_id, hash AS prompt_hash, response FROM joined",
    "completion_parse": _COMPLETIONS + " SELECT question_id, status, text FROM parsed",
    "answer_format": _COMPLETIONS + " SELECT question_id, status, answer FROM answers",
    "answer_display": _COMPLETIONS + """ SELECT question_id, replace(prompt, chr(10), '<br/>') AS prompt_html,
  replace(replace(answer, chr(10), '<br/>'), 'Answer: ', '') AS answer_html FROM answers""",
    "answer_records": _COMPLETIONS + f""" SELECT question_id // {BATCH} AS batch_id,
  row_number() OVER (PARTITION BY question_id // {BATCH} ORDER BY question_id) - 1 AS position, answer, prompt FROM answers""",
    "question_prompt": f"SELECT doc_id, {sql_text(_T.page)} || text || {sql_text(_T.ask)} AS prompt FROM documents",
    "questions_parse": _ROWS + """ SELECT doc_id, q IS NULL AS reject, len(q) AS n_questions,
  array_to_string(q, '|') AS questions FROM generated""",
    "question_rows": _ROWS + " SELECT * FROM question_rows",
    "append_rows": _ROWS + " SELECT * FROM question_rows",
    "qa_join": _ROWS + " SELECT question_id, question, content FROM pairs",
    "qa_join_bucketed": _ROWS + " SELECT question_id, question, content FROM pairs",
    "batch_page": "SELECT * FROM documents ORDER BY doc_id LIMIT 10 OFFSET 30",
    "resume_pending": """SELECT *, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT % 10 AS batch FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "answer_prompt": _ROWS + f""" SELECT question_id,
  {sql_text(_T.context)} || content || {sql_text(_T.question)} || question AS prompt FROM pairs""",
    "qa_dataset": _ROWS + """ SELECT p.question_id, p.doc_id, p.question, a.question AS answer, p.content
FROM pairs p JOIN pairs a ON a.position = p.position + 1 AND a.doc_id = p.doc_id""",
    "sql_functions": _ROWS + f""" SELECT doc_id,
  '{{"prompt":' || to_json({sql_text(_T.page)} || text || {sql_text(_T.ask)})::VARCHAR || ',"max_tokens":500}}' AS request,
  '{{"prompt":' || to_json({sql_text(_T.context)} || text || {sql_text(_T.question)} || 'Why?')::VARCHAR
    || ',"max_tokens":500}}' AS answer,
  len(q) AS n_questions FROM generated""",
}
