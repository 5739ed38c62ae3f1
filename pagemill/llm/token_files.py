"""Token files: the ids of a corpus in ascending document order, as wavelet matrices.

A shard holds some hundred whole documents. Its file is a table of documents (id and
number of ids) and the wavelet matrix of their ids in a row; one file answers which id
stands at a place, how often an id occurs and where. Files are rows of a Parquet table,
so any store that Spark writes to will do, and a lost task writes its files again.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ascending import with_part
from .encoding import encoder, values_of
from .wavelet import WaveletMatrix, pack

END = 2
PART_ROWS = 256
SHARD_IDS = 1 << 20      # a shard is closed from here on; a document stays whole
_HEAD = "<4sQQ"
_MAGIC = b"TOK1"
FILES = "part bigint, shard int, start bigint, n_ids bigint, file binary"


def shard_file(ids: list[int | None], texts: list[bytes]) -> bytes:
    """One file: head (magic, documents, bytes of their table), table, wavelet matrix."""
    known = np.array([i is not None for i in ids], bool)
    names = np.array([0 if i is None else i for i in ids], "<i8")
    sizes = np.array([len(t) // 4 for t in texts], "<i8")
    table = zlib.compress(known.tobytes() + names.tobytes() + sizes.tobytes(), 1)
    return struct.pack(_HEAD, _MAGIC, len(ids), len(table)) + table + pack(np.frombuffer(b"".join(texts), "<u4"))


class Shard:
    """Reads one file: ``ids`` (None for a null id), ``sizes`` and ``matrix``."""

    def __init__(self, file: bytes):
        magic, n, size = struct.unpack_from(_HEAD, file)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        table = zlib.decompress(file[struct.calcsize(_HEAD):struct.calcsize(_HEAD) + size])
        known = np.frombuffer(table, bool, n)
        names, self.sizes = (np.frombuffer(table, "<i8", n, n + 8 * n * k) for k in (0, 1))
        self.ids = [int(i) if k else None for k, i in zip(known, names)]
        self.matrix = WaveletMatrix(file[struct.calcsize(_HEAD) + size:])


def _encoded(tokenizer: str, end: int, limit: int):
    """Batches of ``part, id, text`` in order -> shard files. A shard ends with its part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, closing = encoder(tokenizer).text_ids, np.array([end], "<u4").tobytes()
        part, shard, start, held, ids, texts = None, 0, 0, 0, [], []
        def closed():
            nonlocal shard, start, held, ids, texts
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int64()), pa.array([shard], pa.int32()), pa.array([start], pa.int64()),
                pa.array([held], pa.int64()), pa.array([shard_file(ids, texts)], pa.binary())],
                ["part", "shard", "start", "n_ids", "file"])
            shard, start, held, ids, texts = shard + 1, start + held, 0, [], []
            return row
        for batch in batches:
            for here, id, text in zip(*(values_of(batch, c) for c in ("part", "id", "text"))):
                if ids and (here != part or held >= limit):
                    yield closed()
                if here != part:
                    part, shard, start = here, 0, 0
                ids.append(id)
                texts.append(encode(text) + closing)
                held += len(texts[-1]) // 4
        if ids:
            yield closed()
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text",
                      end: int = END, limit: int = SHARD_IDS) -> None:
    """Writes the files of all rows to ``path``, in ascending id (null last; equal ids in the
    order of a hash of the text). A null text is empty: only its end id is written."""
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parted = with_part(rows, "id", F.xxhash64("text"), PART_ROWS)
    count = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = parted.repartition(count, "part").sortWithinPartitions("part", F.col("id").asc_nulls_last(), "tie")
    ordered.select("part", "id", "text").mapInArrow(_encoded(tokenizer, end, limit), FILES).write.parquet(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    """All shard files with ``before``, the ids of the whole corpus in front of each.

    Parts are at most some hundred thousand, so their offsets are broadcast.
    """
    table = spark.read.schema(FILES).parquet(path)
    ahead = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (table.groupBy("part").agg(F.sum("n_ids").alias("ids"))
               .select("part", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).alias("offset")))
    return table.join(F.broadcast(offsets), "part").select("part", "shard", (F.col("offset") + F.col("start")).alias("before"), "file")


def _each(names: list[str], rows):
    """A mapInArrow function that reads one file at a time; ``rows(before, shard)`` gives columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, file in zip(*(values_of(batch, c) for c in ("before", "file"))):
                yield pa.RecordBatch.from_arrays(rows(before, Shard(file)), names)
    return run


def _documents(before: int, shard: Shard) -> list[pa.Array]:
    data = memoryview(shard.matrix.unpack().astype("<u4", copy=False).tobytes())
    ends = np.cumsum(shard.sizes)
    starts = ends - shard.sizes
    checks = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts, ends)]
    return [pa.array(shard.ids, pa.int64()), pa.array(before + starts), pa.array(shard.sizes), pa.array(checks, pa.int64())]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of each document, from its ids in the files."""
    return files(spark, path).mapInArrow(
        _each(["id", "start", "n_tokens", "ids_crc32"], _documents),
        "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _counts(before: int, shard: Shard, token: int) -> list[pa.Array]:
    return [pa.array([before]), pa.array([shard.matrix.count(token)])]


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``before, n``: occurrences of an id in each shard, without unpacking it."""
    return files(spark, path).mapInArrow(_each(["before", "n"], functools.partial(_counts, token=token)), "before bigint, n bigint")


def _places(before: int, shard: Shard, token: int) -> list[pa.Array]:
    return [pa.array(before + shard.matrix.find(token), pa.int64())]


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``position``: every place of an id in the corpus."""
    return files(spark, path).mapInArrow(_each(["position"], functools.partial(_places, token=token)), "position bigint")
