"""Spark session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARK_BATCH = "67108864b"  # what Spark answers if nothing is set
TEXT_BATCH = 4 << 20  # bytes of texts that go to a Python worker at once

_written: list[str] = []          # folders of this driver's stages
_recorders: list[list[str]] = []  # lists that are told of every new one


def build_session(app: str = "stockcast", master: str | None = None, **conf: object) -> SparkSession:
    """Session with UTC dates, ANSI casts and adaptive execution (skew joins included).

    Partition counts and memory stay with the cluster's own settings unless given in ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def send_texts_in_small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by ``TEXT_BATCH`` bytes, from Spark's own bound of 64 MiB.

    A batch of long texts stands in the executor (in buffers that double) and in its Python worker, once per task.
    Results do not depend on it. A session that has set a bound of its own keeps it.
    """
    if spark.conf.get(ARROW_BYTES) == SPARK_BATCH:
        spark.conf.set(ARROW_BYTES, str(TEXT_BATCH))


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors are one process, so a temporary folder is seen by all of them."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local master may go without one (tests): it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="stockcast-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _note(path: str) -> None:
    _written.append(path)
    for own in _recorders:
        own.append(path)


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Used where several jobs read one result. Unlike a checkpointed RDD the table keeps
    column pruning, filter pushdown and a size Spark can plan with, and it outlives executors.
    ``remove_stages`` deletes what this session has written.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    _note(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def note_stage(path: str) -> None:
    """Let ``remove_stages`` delete a folder that was written in another way."""
    _note(path)


def remove_stages(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Delete the given stages, or all that this driver has written; call it once their results are saved."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in list(_written if paths is None else paths):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
        if path in _written:
            _written.remove(path)


@contextmanager
def recorded_stages() -> Iterator[list[str]]:
    """Paths of the stages written inside, also of those that fail half way; nothing is removed."""
    own: list[str] = []
    _recorders.append(own)
    try:
        yield own
    finally:
        _recorders[:] = [other for other in _recorders if other is not own]


@contextmanager
def own_stages(spark: SparkSession) -> Iterator[None]:
    """Stages written inside are removed at the end; results must be saved or collected before."""
    with recorded_stages() as own:
        try:
            yield
        finally:
            remove_stages(spark, own)
