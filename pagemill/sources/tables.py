"""Stored tables: publish a version, append, guard, preview.

Plain parquet folders have no update in place. A new version is written to a folder
of its own and a view is switched to it, so running readers keep the version they
started with and a failed write leaves the table as it was.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_dir

MIN_ROWS = 50


def publish(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as the new version of table ``name`` and return it."""
    spark = df.sparkSession
    path = path or new_dir(spark, name)
    df.write.parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)


def needs_build(spark: SparkSession, name: str, min_rows: int = MIN_ROWS) -> bool:
    """True when the table is missing or has fewer than ``min_rows`` rows."""
    if not spark.catalog.tableExists(name):
        return True
    # take() reads only as many partitions as it needs.
    return len(spark.table(name).select(F.lit(1)).take(min_rows)) < min_rows


def guarded_build(spark: SparkSession, name: str, build: Callable[[], DataFrame],
                  min_rows: int = MIN_ROWS) -> DataFrame:
    """The table, built only when it needs to be."""
    return publish(build(), name) if needs_build(spark, name, min_rows) else spark.table(name)


def append_batch(df: DataFrame, path: str, batch: int | str) -> None:
    """Append one batch; writing the same batch again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str, evolve: bool = False) -> DataFrame:
    """All batches; ``evolve`` merges their columns."""
    return spark.read.option("mergeSchema", str(evolve).lower()).parquet(path)


def preview(df: DataFrame, key: str, n: int = 2) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(key).limit(n)


def nonempty_gate(spark: SparkSession, tables: dict[str, str], strict: bool = False) -> DataFrame:
    """One row per table: does it exist, does it hold a row.

    ``tables`` maps names to parquet paths or catalog names. Each is read up to its first
    row, in one plan for all. With ``strict`` a table that fails raises an error.
    """
    def checked(name: str, source: str) -> DataFrame:
        df = _open(spark, source)
        rows = spark.range(0) if df is None else df.limit(1)
        return rows.agg((F.count("*") > 0).alias("has_rows")).select(
            F.lit(name).alias("table_name"), F.lit(df is not None).alias("found"), "has_rows")

    gate = functools.reduce(DataFrame.unionByName, [checked(*t) for t in tables.items()])
    failed = [r["table_name"] for r in gate.filter("not has_rows").collect()] if strict else []
    if failed:
        raise ValueError(f"missing or empty: {', '.join(failed)}")
    return gate


def _open(spark: SparkSession, source: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.parquet(source) if "/" in source else spark.table(source)
        return df.select(*[F.col(f"`{c}`") for c in df.columns[:1]])
    except AnalysisException:
        return None
