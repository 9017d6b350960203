"""Helpers shared by the corpus operators: input, shared scratch tables, shingles."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` names it on a cluster. In local mode alone, where the driver is the
    executor, a temporary folder is made if that is unset; elsewhere an unset folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    set_before = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_before.isDefined():
        return set_before.get().rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="skein-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    What :func:`discard` has not removed goes when the driver's Python process ends.
    """
    path = f"{shared_dir(df.sparkSession)}/skein/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._skein_path = path
    if not _left:
        atexit.register(_clear)
    _left[path] = df.sparkSession
    return back


#: Stored tables not yet removed.
_left: dict[str, SparkSession] = {}


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Remove a table made by :func:`stored` once nothing reads it any more."""
    path = getattr(df, "_skein_path", None)
    if path:
        _remove(df.sparkSession, path)
        _left.pop(path, None)


def _clear() -> None:
    for path, spark in list(_left.items()):
        try:
            _remove(spark, path)
        except Exception:  # the session has ended: its files go with the shared folder's own clean-up
            return
    _left.clear()


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column (in any case) has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words (xor-shift-multiply rounds)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, ascending; a sort and a comparison, several times faster on integers than a hash table."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def trim() -> None:
    """Give this process's free memory back to the system (where the C library is glibc)."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give is not None:
        give(0)


#: What Python workers keep between tasks, by operator.
CACHES: dict[str, dict] = {}


def drop_caches(own: str | None = None) -> None:
    """Empty what other operators than ``own`` keep in this worker."""
    for name, cache in CACHES.items():
        if name != own:
            cache.clear()


def trimmed(run, own: str | None = None):
    """``run`` (of an Arrow map), after which the worker gives free memory back to the system.

    Python workers live on between tasks and stages; without this each keeps the most that any stage
    needed. Before, what other operators than ``own`` keep in :data:`CACHES` is dropped.
    """

    def all_of(batches):
        drop_caches(own)
        yield from run(batches)
        trim()

    return all_of
