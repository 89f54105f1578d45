"""Session set-up and the few run-time facts operators need to ask for."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

INPUT_PARTITIONS = "spark.glosa.inputPartitions"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders written in the innermost ``stages_removed``.
PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def build_session(app: str = "glosa", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` entries override the defaults."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the session.

    Only a local-mode session may fall back to a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        # local[8] is one machine, local-cluster[...] is not.
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="glosa-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind: what they wrote is read from then on."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stage_dir(spark: SparkSession, name: str) -> str:
    """A scratch folder that goes with the ``stages_removed`` around it, if there is one."""
    path = scratch_dir(spark, name)
    if (passing := PASSING.get()) is not None:
        passing.append(path)
    return path


@contextmanager
def stages_removed(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Stages written inside are deleted at the end, but for those written by the function it gives.

    What that function wrote belongs to the next ``stages_removed`` outside, or stays.
    """
    outer, own = PASSING.get(), []
    token = PASSING.set(own)

    def keep(df: DataFrame) -> DataFrame:
        inside = PASSING.set(outer)
        try:
            return cut_lineage(df)
        finally:
            PASSING.reset(inside)

    try:
        yield keep
    finally:
        PASSING.reset(token)
        for path in own:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so a lost executor costs no recompute."""
    spark = df.sparkSession
    path = stage_dir(spark, "stage")
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan over the number of partitions that the session names, if it names one.

    ``INPUT_PARTITIONS`` is for inputs of one file and one row group; the plan depends on the
    setting alone, never on the size of the input.
    """
    parts = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df
