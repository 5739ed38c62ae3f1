"""Stored pages: reading, validity, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import element
from .layout import pinned

PAGE_SCHEMA = "page_id bigint, url string, html string"


def read_pages(spark: SparkSession, source: str) -> DataFrame:
    """Pages from a parquet path, or from a catalog table when it has no slash."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return df.select("page_id", "url", "html")


def sample_pages(df: DataFrame, n: int = 100, key: str = "page_id") -> DataFrame:
    """The first ``n`` pages in key order, null keys first.

    Keys alone are sorted first; whole pages are read up to the last of these keys.
    """
    first = [r[0] for r in df.select(key).orderBy(key).limit(n).collect()]
    known = [k for k in first if k is not None]
    wanted = F.col(key).isNull() if len(known) < len(first) else F.lit(False)
    if known:
        wanted = wanted | (F.col(key) <= F.lit(known[-1]))
    return df.filter(wanted).orderBy(key).limit(n)


def with_article(df: DataFrame, article: Column) -> DataFrame:
    """Add the trimmed article markup, null when the page has none."""
    return df.withColumn("article", F.trim(article))


def default_article(tag: str = "article", attribute: str | None = None,
                    value: str | None = None) -> Column:
    return element(F.col("html"), tag, attribute, value)


def valid_pages(df: DataFrame, article: Column | None = None) -> DataFrame:
    """Pages that were fetched and have an article element."""
    present = df.filter("html is not null and html <> ''")
    found = with_article(present, default_article() if article is None else article)
    return pinned(found.drop("html"), "article").filter("article is not null")


def rejected_pages(df: DataFrame, article: Column | None = None) -> DataFrame:
    """The other pages, each with the reason it was left out."""
    found = pinned(with_article(df, default_article() if article is None else article), "article")
    reason = (
        F.when(F.col("html").isNull(), "not fetched")
        .when(F.col("html") == "", "empty")
        .when(F.col("article").isNull(), "no article")
    )
    return (found.withColumn("reason", reason)
            .filter(F.col("reason").isNotNull())
            .select("page_id", "url", "reason"))
