"""What several of these operators share: the input table, words, prefix sums, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bind
from ..sources.layout import spread

#: What separates words, the same for every operator here.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies on this machine; every machine has them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_list(text: Column) -> Column:
    """The words of a text in order; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def positions(n: Column) -> Column:
    """``[0, 1, ... n - 1]``; empty for ``n < 1``."""
    return F.when(n < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), (n - 1).cast("int")))


def running_sum(values: Column) -> Column:
    """Inclusive prefix sums of an array of numbers, as long.

    Blocks of about sqrt(n) elements keep the work at n * sqrt(n) additions, so an
    array of a hundred thousand elements is no trap.
    """
    add = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    def two_level(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))), F.lit(1)).cast("int")
        blocks = F.transform(positions(F.ceil(F.size(v) / width)), lambda b: F.slice(v, b * width + 1, width))
        def spelled(blocks: Column) -> Column:
            sums = F.transform(blocks, add)
            return bind(sums, lambda sums: F.flatten(F.transform(blocks, lambda block, b: bind(
                add(F.slice(sums, F.lit(1), b)),
                lambda before: F.transform(block, lambda _, i: before + add(F.slice(block, F.lit(1), i + 1)))))))
        return bind(blocks, spelled)
    return bind(values, two_level)
