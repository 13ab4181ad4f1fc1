"""Sessions for local runs, and the shared folder in which stages are written."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Where sessions of this one machine write stages if nothing else is set.
LOCAL_SHARED_DIR = "file:///tmp/checkpoints"
# For stages of texts or vectors: a quarter less of texts and a tenth less of vectors than the usual codec.
SMALLEST = "zstd"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, name: str = "searchloom") -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores if str(cores).isdigit() else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", LOCAL_SHARED_DIR)
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A ``local`` session has one machine, whose folder all its tasks share, so it
    may go without the setting; a cluster without it is refused, since a
    machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.conf.get("spark.master", "") or ""
    if master == "local" or master.startswith("local["):
        return LOCAL_SHARED_DIR
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/searchloom/{name}-{uuid.uuid4().hex}"


# The stages written by the innermost run of each thread.
_runs: dict[int, list[str]] = {}


@contextmanager
def stages_of_a_run(spark: SparkSession) -> Iterator[list[str]]:
    """Remove, at the end, all stages written inside; results that read them must be used inside too.

    If the run fails its stages are left for a look and for age to clear.  Runs may be nested.
    """
    paths: list[str] = []
    thread = threading.get_ident()
    outer = _runs.get(thread)
    _runs[thread] = paths
    try:
        yield paths
    finally:
        if outer is None:
            del _runs[thread]
        else:
            _runs[thread] = outer
    for path in paths:
        remove_path(spark, path)


@contextmanager
def passing_stages(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Stages written inside last until the end of the block, but for those written by the function it gives.

    For results that are made of several stages and need none of them afterwards.
    """
    kept: list[str] = []
    with stages_of_a_run(spark) as own:

        def keep(df: DataFrame, name: str) -> DataFrame:
            written = stage(df, name, SMALLEST)
            kept.append(own.pop())
            return written

        yield keep
    if (run := _runs.get(threading.get_ident())) is not None:
        run.extend(kept)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What queries shuffle inside the block goes as soon as they end, not when the driver collects garbage."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever Spark can reach it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage for good: the files outlive any executor, later readers
    still prune columns, and the sizes are known to the optimizer.  What was shuffled
    for it goes once it is written, as nothing reads that again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if (run := _runs.get(threading.get_ident())) is not None:
        run.append(path)
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
