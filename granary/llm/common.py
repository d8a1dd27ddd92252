"""Shared helpers: the shared folder, written intermediate tables, words."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word, for Spark's regular expressions.
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Only where the session names none and runs in one process (tests) a local
    temporary folder is chosen, once per session; on a cluster it must be named.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all of {master} sees")
        path = tempfile.mkdtemp(prefix="granary-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Folders written so far, by the scratch they are of; the first is the session's.
_made: list[list[tuple[SparkSession, str]]] = [[]]


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and computes a branch that several readers need once;
    the files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/granary-{name}-{uuid.uuid4().hex}"
    _made[-1].append((spark, path))
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def dropped(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`written`."""
    _delete(df.sparkSession, df._written)
    for made in _made:
        made[:] = [x for x in made if x[1] != df._written]


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside are deleted at the end, but for those given to the
    function that this yields, which a lazy result still reads."""
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._written)
        return df

    _made.append([])
    try:
        yield keep
    finally:
        for spark, path in _made.pop():
            if path in kept:
                _made[-1].append((spark, path))
            else:
                _delete(spark, path)


@atexit.register
def _clean() -> None:
    """What lazy results may have read goes when Python ends."""
    for made in _made:
        for spark, path in made:
            try:
                _delete(spark, path)
            except Exception:  # the JVM is gone
                return


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words, by one pass of the regular expression."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tidy(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are written."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def _release() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 20)  # arrays of a megabyte or more are mapped, so they go when they are freed
        libc.malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run):
    """A function of an iterator of batches that leaves no freed memory with the
    Python worker, which outlives the task."""

    def leanly(batches: Iterator) -> Iterator:
        _release()
        yield from run(batches)
        _release()

    return leanly
