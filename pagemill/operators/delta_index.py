"""A vector index as base buckets and deltas, so that a small change is a small write.

Rows lie in buckets by a hash of their key. A commit writes the changed rows, and a tombstone
for each deleted key, into a delta folder by bucket; the base stays. Reading merges both: the
newest delta row of a key hides what is older. Buckets whose deltas have grown are compacted:
base and deltas of these buckets alone are written as a new generation.

    base/gen=G/bucket=B      whole buckets
    delta/commit=C/bucket=B  changed rows; ``_deleted`` marks a tombstone
    state/commit=C           one row per bucket: its generation, and the last commit merged in it

A commit counts once its state is complete, which is written last; what a failed commit has left
is overwritten by the next one, which takes the same number. Readers keep the state they began
with, and old generations and deltas stay until ``clear_old`` is called. There is one writer at
a time. Rows with a null key cannot be addressed and are left out. Keys must be unique in a
commit, which is checked.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.layout import checked_broadcast, stored
from .changes import snapshot_diff

BUCKETS = 64
STATE = "bucket int, gen bigint, merged bigint"
HASH = "content_hash"


@dataclass(frozen=True)
class DeltaIndex:
    """The index at ``path``; ``schema`` has the columns of its rows."""

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType

    # ------------------------------------------------------------------ writing

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: str = "id", buckets: int = BUCKETS) -> DeltaIndex:
        """A new index of ``rows``, unique by ``key``."""
        index = cls(rows.sparkSession, path, key, rows.schema)
        index._write_base(index._bucketed(_unique(rows, key), buckets), 0)
        index._write_state(index.spark.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("gen"),
                                                             F.lit(0).cast("bigint").alias("merged")), 0)
        return index

    def commit(self, upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> int:
        """Add or replace ``upserts`` and delete the keys of ``deletes``; the number of the commit.

        A key in both is replaced.
        """
        number, state = self._next(), self._state()
        parts = []
        if upserts is not None:
            parts.append(_unique(upserts.select(*self.schema.names), self.key).withColumn("_deleted", F.lit(False)))
        if deletes is not None:
            gone = deletes.select(self.key).distinct()
            if upserts is not None:
                gone = gone.join(upserts.select(self.key), self.key, "left_anti")
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name != self.key]
            parts.append(gone.select(F.col(self.key).cast(self.schema[self.key].dataType), *none).withColumn("_deleted", F.lit(True)))
        for i, part in enumerate(parts):
            mode = "overwrite" if i == 0 else "append"
            self._bucketed(part, state.count()).repartition("bucket").write.mode(mode).partitionBy("bucket").parquet(f"{self.path}/delta/commit={number}")
        self._write_state(state, number)
        return number

    def compact(self, share: float = 0.25, least: int = 1) -> list[int]:
        """Write the buckets anew whose deltas have at least ``share`` of the rows of their base;
        their numbers. Other buckets are not touched."""
        state = stored(self._state(), "state")
        pending = self._pending(state).groupBy("bucket").agg(F.count("*").alias("changed"))
        base = self._base(state).groupBy("bucket").agg(F.count("*").alias("rows"))
        full = pending.join(base, "bucket", "left").filter(
            (F.col("changed") >= least) & (F.col("changed") >= share * F.coalesce("rows", F.lit(0))))
        chosen = sorted(r["bucket"] for r in full.select("bucket").collect())  # one row per bucket
        if not chosen:
            return []
        number, upto = self._next(), self._latest()
        mine = F.col("bucket").isin(chosen)
        self._write_base(self._merged(state.filter(mine)), number)
        self._write_state(state.withColumn("gen", F.when(mine, F.lit(number)).otherwise(F.col("gen")))
                          .withColumn("merged", F.when(mine, F.lit(upto)).otherwise(F.col("merged"))), number)
        return chosen

    def sync(self, documents: DataFrame, content: str, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Bring the index up to ``documents``; ``key, change`` of what was changed.

        The index has a column ``content_hash``. Only keys and hashes are compared; only documents
        that are new or have another hash go through ``embed``, which adds the other columns.
        """
        given = documents.filter(F.col(self.key).isNotNull()).withColumn(HASH, content_hash(F.col(content)))
        diff = stored(snapshot_diff(self.read().select(self.key, HASH), given.select(self.key, HASH), self.key, [HASH])
                      .select(self.key, "change"), "index-changes")
        if diff.isEmpty():
            return diff
        wanted = checked_broadcast(diff.filter("change <> 'delete'").select(self.key))
        self.commit(embed(given.join(wanted, self.key, "left_semi")).select(*self.schema.names),
                    diff.filter("change = 'delete'").select(self.key))
        return diff

    def clear_old(self) -> None:
        """Delete generations and deltas that the present state does not need; no reader may
        still use an older state."""
        state = self._state().collect()  # one row per bucket
        live, merged = {r["gen"] for r in state}, min(r["merged"] for r in state)
        for kind, name, needed in (("base", "gen", lambda n: n in live), ("delta", "commit", lambda n: n > merged)):
            for number in self._numbers(f"{kind}/{name}=*", name):
                if not needed(number):
                    self._delete(f"{kind}/{name}={number}")

    # ------------------------------------------------------------------ reading

    def read(self) -> DataFrame:
        """The rows as the last commit left them."""
        return self._merged(self._state()).select(*self.schema.names)

    def _merged(self, state: DataFrame) -> DataFrame:
        state = stored(state, "state")
        rows = F.struct(*self.schema.names, "_deleted", "bucket")
        newest = (self._pending(state).groupBy(self.key).agg(F.max_by(rows, "commit").alias("_row")).select("_row.*"))
        names = [*self.schema.names, "bucket"]
        newest = stored(newest, "newest")
        # Deltas are few beside the base; if not, the join shuffles both sides by key.
        kept = self._base(state).join(checked_broadcast(newest.select(self.key)), self.key, "left_anti")
        return kept.select(*names).unionByName(newest.filter("not _deleted").select(*names))

    def _base(self, state: DataFrame) -> DataFrame:
        """Folders of the live generation of each bucket."""
        groups = {}
        for r in state.collect():  # one row per bucket
            groups.setdefault(r["gen"], []).append(r["bucket"])
        live = [(F.col("gen") == g) & F.col("bucket").isin(b) for g, b in groups.items()]
        return self._read("base", "gen bigint", live)

    def _pending(self, state: DataFrame) -> DataFrame:
        """Deltas that are not yet in the base of their bucket."""
        upto, groups = self._latest(), {}
        for r in state.collect():
            groups.setdefault(r["merged"], []).append(r["bucket"])
        after = [(F.col("commit") > m) & (F.col("commit") <= upto) & F.col("bucket").isin(b) for m, b in groups.items()]
        return self._read("delta", "_deleted boolean, commit bigint", after)

    def _read(self, kind: str, more: str, conditions: list[Column]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *T.StructType.fromDDL(more).fields, T.StructField("bucket", T.IntegerType())])
        if not self._exists(kind):
            return self.spark.createDataFrame([], schema)
        found = F.lit(False)
        for c in conditions:
            found = found | c
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}").filter(found)

    # ------------------------------------------------------------------ files

    def _bucketed(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.filter(F.col(self.key).isNotNull()).withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int"))

    def _write_base(self, rows: DataFrame, gen: int) -> None:
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/gen={gen}")

    def _write_state(self, state: DataFrame, number: int) -> None:
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/commit={number}")

    def _state(self) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(f"{self.path}/state/commit={self._latest()}")

    def _latest(self) -> int:
        return max(self._numbers("state/commit=*/_SUCCESS", "commit"))

    def _next(self) -> int:
        return self._latest() + 1

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _numbers(self, pattern: str, name: str) -> list[int]:
        found = self._files().globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")) or []
        parts = (str(f.getPath()).split(f"{name}=") for f in found)
        return [int(p[1].split("/")[0]) for p in parts if len(p) > 1]

    def _exists(self, name: str) -> bool:
        return self._files().exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"))

    def _delete(self, name: str) -> None:
        self._files().delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)


def _unique(rows: DataFrame, key: str) -> DataFrame:
    """``rows``; fails when a key comes twice. Only keys are counted before rows move."""
    twice = rows.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").select(key).limit(1)
    if not twice.isEmpty():
        raise ValueError(f"a key comes twice: {twice.first()[0]}")
    return rows


def content_hash(content: Column) -> Column:
    """Digest of a document's content; a null is not an empty one."""
    return F.md5(F.coalesce(F.concat(F.lit(":"), content), F.lit("-")))
