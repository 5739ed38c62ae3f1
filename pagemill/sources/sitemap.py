"""Sitemap XML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the public name of the format.
NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"


def read_sitemap(spark: SparkSession, path: str, entry: str = "url") -> DataFrame:
    """URL rows; ``entry='sitemap'`` reads an index of sitemaps."""
    return (spark.read.format("xml").option("rowTag", entry).schema("loc string")
            .load(path).filter("loc is not null")
            .select(F.col("loc").alias("url")))


def write_sitemap(df: DataFrame, path: str, url: str = "url") -> None:
    """One sitemap part per partition."""
    (df.select(F.col(url).alias("loc")).write.mode("overwrite").format("xml")
     .option("rootTag", f'urlset xmlns="{NAMESPACE}"').option("rowTag", "url").save(path))
