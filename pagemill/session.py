"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pagemill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session, or the
    checkpoint folder of its context.

    A local session without either (a test) gets a folder of its own. On a cluster such a
    folder would be another one on each machine, so there a folder must be named.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return (named or _own_dir()).rstrip("/")


@functools.cache
def _own_dir() -> str:
    path = tempfile.mkdtemp(prefix="pagemill-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


_RUN = uuid.uuid4().hex


def run_dir(spark: SparkSession) -> str:
    """Where this process keeps all its working tables."""
    return f"{shared_dir(spark)}/pagemill/{_RUN}"


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_working_tables(spark: SparkSession) -> None:
    """Delete what this process has stored; results not yet written are lost with it."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
