"""Where shared intermediate data goes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())

# Input behind one shuffle partition before adaptive execution merges small ones, and shuffled bytes that it merges up to.
INPUT_PER_PARTITION = 2 << 20
MERGED_PARTITION = 8 << 20
MOST_PARTITIONS = 20_000


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder of the one machine there is.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="arrearium-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_dir(spark)}/arrearium/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def size_shuffles(spark: SparkSession, paths: Sequence[str]) -> None:
    """Let the number of shuffle partitions grow with the input, so that what one task sorts does not.

    Several sorts of a chain of joins are held by one task at a time, many times the compressed size of its partition. What a session
    was started with stays: a number of first partitions as it is, a number of partitions as the least.
    """
    given, first, merged = spark.sparkContext.getConf(), "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if not given.contains(first):
        places = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths if exists(spark, p)]
        size = sum(at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength() for at in places)
        spark.conf.set(first, max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(size // INPUT_PER_PARTITION, MOST_PARTITIONS)))
    if not given.contains(merged):
        spark.conf.set(merged, MERGED_PARTITION)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed at the end, but for those stored with keep=True: these go with the scope around it, if any.

    What outlives the scope may read only kept tables. Nothing else is removed: the paths are the scope's own, each new.
    """
    mine: list[str] = []
    outer = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(outer)
        for path in mine:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a table that several passes will read to the shared folder, and read it from there.

    Unlike a cache it survives lost executors, and each pass reads only the columns it needs. In a scratch_scope the
    table goes at its end unless keep is set.
    """
    path = scratch_path(df.sparkSession, name)
    scopes = _scopes.get()[:-1] if keep else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def side_by_side(spark: SparkSession, jobs: Sequence[Callable], parallelism: int = 4) -> list:
    """Submit independent Spark jobs from a few threads; results in the order of jobs."""
    pool = ThreadPool(max(1, min(parallelism, len(jobs))))
    try:
        return pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs, chunksize=1)
    finally:
        pool.close()
