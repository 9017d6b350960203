"""Sinks: ordered text, keyed upserts, incremental copies, guards against empty results."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.text import hms
from skein.operators.sequences import first_wins, ranked
from skein.sources.readers import exists


def write_transcript_lines(segments: DataFrame, path: str) -> None:
    """``[MM:SS] text`` lines in segment order; files are sorted by range, so their concatenation is in order."""
    line = F.concat(F.lit("["), hms(F.col("start")), F.lit("] "), F.trim("text"))
    segments.repartitionByRange("seg_idx").sortWithinPartitions("seg_idx").select(line.alias("value")).write.mode("overwrite").text(path)


def write_if_any(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write unless there are no rows: an empty result is a failure and never replaces data."""
    if not df.limit(1).count():
        raise ValueError("no rows to write; the earlier output stays")
    df.write.mode(mode).parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both, one per key: the latest by ``order``, the new one of equals."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return first_wins(both, keys, [F.desc(order), F.desc("_new")]).drop("_new")


def needs_refresh(source: DataFrame, target: DataFrame) -> DataFrame:
    """Files (name, size, mtime) that are absent from the target or differ in size or time."""
    return source.join(target, ["name", "size", "mtime"], "left_anti")


def append_events(rows: DataFrame, path: str, ambient: dict[str, str] | None = None) -> None:
    """Add events as JSON lines; ``ambient`` fields (run, host) stand in every row where the row's own field is null or absent.

    Files are only ever added, so writers need no lock.
    """
    fields = ambient or {}
    filled = rows.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in rows.columns else F.lit(v) for k, v in fields.items()})
    filled.write.mode("append").json(path)


def append_run_summary(spark: SparkSession, path: str, summary: dict, run_id: str, host: str = "") -> None:
    """One line per run; run, time and host are filled in where the summary has none."""
    line = {"run_id": run_id, "ts": time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime()), "host": host} | summary
    append_events(spark.range(1).select(*[F.lit(v).alias(k) for k, v in line.items()]), path)


def write_once(df: DataFrame, path: str, force: bool = False) -> bool:
    """Write unless the path is there already (or ``force``); whether it was written."""
    if not force and exists(df.sparkSession, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_new(df: DataFrame, path: str) -> None:
    """Write to a path that must not exist; a collision is an error before anything is written."""
    df.write.mode("errorifexists").parquet(path)


def rewrite(df: DataFrame, path: str) -> str | None:
    """Write ``df`` beside ``path``, keep what stood there as a snapshot, and put the new rows in its place.

    The first snapshot is ``path.bak``; later ones carry the time. Returns the snapshot's path, None when there was nothing. ``df``
    may read from ``path``. A failed write leaves everything as it was.
    """
    spark, fresh = df.sparkSession, f"{path}.new-{time.time_ns()}"
    df.write.parquet(fresh)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    store = path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    kept = None
    if exists(spark, path):
        kept = f"{path}.bak" if not exists(spark, f"{path}.bak") else f"{path}.bak-{time.time_ns()}"
        store.rename(path_of(path), path_of(kept))
    store.rename(path_of(fresh), path_of(path))
    return kept


def reorder_by_time(manifest: DataFrame, path: str) -> str | None:
    """Rewrite a manifest (idx, src, start) in the order of ``start``, with a snapshot; refused while any clip has no time."""
    untimed = manifest.where("start IS NULL").count()
    if untimed:
        raise ValueError(f"{untimed} clips have no time: their order would be made up")
    return rewrite(ranked(manifest, ["start", "idx"], "_place").withColumn("idx", F.col("_place") - 1).drop("_place"), path)
