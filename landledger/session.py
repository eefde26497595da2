"""Session settings, and intermediate tables that survive the loss of executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Engine settings every job wants, whatever its size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Spark's setting that a query's shuffle files go when it has ended, not when the driver happens to collect its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What ``materialize`` has written since the innermost ``passing`` began.
MADE: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("made", default=None)


def local_session(app: str = "landledger", cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    """A session of one machine for tests and benchmarks; on a cluster, use the one the cluster gives."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": cores,
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A session of one process (``local[n]``) that names none gets a new one; any other must name it, since a temporary folder
    exists on one machine alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="landledger-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, grouped by application so it can be dropped at the end."""
    return f"{shared_dir(spark)}/landledger-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def write(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet; the shuffle files that this took go with its end, and no longer add up over the steps of a job."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANED, None)
    conf.set(CLEANED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(CLEANED) if before is None else conf.set(CLEANED, before)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage durably, freezes row placement, and gives the planner true sizes, so a later
    join broadcasts the result only when its files are below Spark's own threshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if MADE.get() is not None:
        MADE.get().append((spark, path))
    write(df, path)
    read = spark.read.schema(df.schema).parquet(path)
    read.scratch = path
    return read


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` or ``settled`` has written for these frames; nothing may read them, or what is made from them, any more."""
    for frame in frames:
        _delete(frame.sparkSession, frame.scratch)


@contextmanager
def passing(keep: bool = False) -> Iterator[list[tuple[SparkSession, str]]]:
    """Tables that ``materialize`` writes meanwhile are deleted at the end, so nothing may read them later; with ``keep``, all but the last."""
    outer, made = MADE.get(), []
    token = MADE.set(made)
    try:
        yield made
    finally:
        MADE.reset(token)
        if keep and made and outer is not None:
            outer.append(made[-1])
        for spark, path in made[:-1] if keep else made:
            _delete(spark, path)


def settled(make: Callable[[], DataFrame], label: str = "step") -> DataFrame:
    """``materialize(make())``, less the tables that ``make`` itself has written: only its result stays."""
    with passing(keep=True):
        return materialize(make(), label)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables this application wrote."""
    _delete(spark, f"{shared_dir(spark)}/landledger-{spark.sparkContext.applicationId}")
