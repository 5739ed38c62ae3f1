"""Chunk only the page files that are new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layout import checked_broadcast
from ..sources.pages import PAGE_SCHEMA
from ..sources.tables import append_batch, read_batches


VERSION = ("_time", "_file")


def incremental_pages(
    spark: SparkSession, source: str, target: str, checkpoint: str,
    build: Callable[[DataFrame], DataFrame], max_files: int = 1000,
) -> int:
    """Run ``build`` on the page files added since the last run; number of batches.

    Of a page that comes several times the newest file counts (by time, then by name; in
    one file by a hash of the page), whatever batch each came in. A micro-batch is written
    under the id of its stream and its number: replayed after a failure it replaces what
    it wrote, and another checkpoint does not overwrite it.
    """
    batches = []

    def write(pages: DataFrame, batch: int) -> None:
        session = pages.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        cores = session.sparkContext.defaultParallelism
        few = pages.rdd.getNumPartitions() < cores
        # Only ids and file names are grouped. Pages that come once stay where they lie.
        keys = pages.groupBy("page_id").agg(F.max(F.struct(*VERSION)).alias("newest"), F.count("*").alias("n"))
        again = checked_broadcast(keys.filter("n > 1").select("page_id", "newest"))
        once = pages
        if not again.isEmpty():
            order = F.struct(*VERSION, F.xxhash64("url", "html"))
            twice = pages.join(again, "page_id").filter(F.struct(*VERSION) == F.col("newest"))
            picked = twice.groupBy("page_id").agg(F.max_by(F.struct(*pages.columns), order).alias("row")).select("row.*")
            once = pages.join(again.select("page_id"), "page_id", "left_anti").select(*pages.columns).unionByName(picked)
        # A few files are dealt out before the chunking, which costs more than the move.
        rows = once.drop(*VERSION)
        append_batch(build(rows.repartition(cores) if few else rows), f"{target}/chunks", f"{run}-{batch}")
        append_batch(once.select("page_id", *VERSION), f"{target}/pages", f"{run}-{batch}")
        batches.append(batch)

    read = (spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source)
            .select("*", F.col("_metadata.file_modification_time").alias("_time"), F.col("_metadata.file_path").alias("_file")))
    query = (read.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(batches)


def current_chunks(spark: SparkSession, target: str) -> DataFrame:
    """The chunks of each page from its newest file.

    Only the page ids are grouped; chunks move if the pages delivered again are too
    many to broadcast.
    """
    pages = read_batches(spark, f"{target}/pages")
    newest = F.max_by("batch", F.struct(*VERSION, "batch")).alias("newest")
    again = pages.groupBy("page_id").agg(newest, F.count("*").alias("n")).filter("n > 1").drop("n")
    stale = pages.join(again, "page_id").filter("batch <> newest").select("page_id", "batch")
    chunks = read_batches(spark, f"{target}/chunks")
    return chunks.join(checked_broadcast(stale), ["page_id", "batch"], "left_anti").drop("batch")
