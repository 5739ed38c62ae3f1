"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and
read again as the next one's ``docs``. All but the last keep the columns of ``docs``.

1. language id: documents whose language is not recognised go;
2. near-duplicates: one document of each class stays;
3. secrets: found spans are replaced in the text (``n_chars`` follows);
4. mix: documents stay, go or repeat so that sources come to their target weights;
5. packing: the pieces of all documents with their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import documents
from pagemill.llm.language import predict
from pagemill.llm.language_queries import train_on
from pagemill.llm.mixing import mixture
from pagemill.llm.near_duplicates import kept_documents
from pagemill.llm.packing_queries import pack_documents
from pagemill.llm.secrets import redact, scan
from pagemill.session import new_dir


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return predict(docs, train_on(docs)).filter("not rejected").select("doc.*")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.col("doc.text")
    clean = F.when(F.size("spans") > 0, redact(text)).otherwise(text)
    found = scan(docs).select("doc", F.explode_outer(F.array(clean)).alias("clean"))
    doc = F.col("doc").withField("text", F.col("clean"))
    if "n_chars" in docs.columns:
        changed = ~F.col("clean").eqNullSafe(text)
        doc = doc.withField("n_chars", F.when(changed, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars")))
    return found.select(doc.alias("doc")).select("doc.*")


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language_id", recognised),
    ("near_duplicates", distinct_texts),
    ("secret_scans", without_secrets),
    ("source_mix", to_target_weights),
    ("packing", packed_sequences),
]

#: A fitted model and a tokenizer have no twin in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
