"""Structured Streaming over stage event logs: filters, windows, sessions, lifecycle, staleness.

Every function takes and returns streaming DataFrames; :func:`drain` runs one to the end of
what has arrived (``availableNow``) into a table, with its checkpoint in the shared folder, from which a named run resumes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from skein.operators.sequences import first_wins
from skein.sources.shared import shared_dir

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Stage events as a stream: run (user), stage (type) and event time. ``path`` is a folder or a pattern of files."""
    events = spark.readStream.schema(SCHEMA).parquet(path)
    return events.withColumn("at", F.col("ts").cast("timestamp"))


def status_filter(events: DataFrame, status: str) -> DataFrame:
    return events.where(F.col("event_type") == status).select("event_id", "user_id", "value")


def tumbling(events: DataFrame, width: str, lateness: str) -> DataFrame:
    """Counts per window and stage; windows wholly behind the watermark, ``lateness`` behind the latest event, are closed and forgotten."""
    counted = events.withWatermark("at", lateness).groupBy(F.window("at", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.unix_seconds("window.start").alias("start_s"), "event_type", "n")


def sessions(events: DataFrame, gap: str, lateness: str) -> DataFrame:
    """Sessions of a run: events less than ``gap`` apart. A session is a row once the watermark has passed its end (append mode)."""
    grouped = events.withWatermark("at", lateness).groupBy("user_id", F.session_window("at", gap)).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select("user_id", F.unix_micros("session_window.start").alias("start_us"), "n")


def lifecycle(events: DataFrame) -> DataFrame:
    """The latest stage of each run and how many events led to it: state per run, updated as events come."""
    last = F.max(F.struct("at", "event_id", "event_type"))
    return events.groupBy("user_id").agg(last.alias("x"), F.count(F.lit(1)).alias("n")).select("user_id", F.col("x.event_type").alias("stage"), "n")


def first_seen(events: DataFrame, lateness: str) -> DataFrame:
    """One row per run and stage while the watermark remembers it."""
    return events.withWatermark("at", lateness).dropDuplicatesWithinWatermark(["user_id", "event_type"])


def stale_gaps(events: DataFrame, seconds: int) -> DataFrame:
    """Heartbeats that come more than ``seconds`` after the run's one before; the last beat of each run is the state."""

    def beat(key, batches, state: GroupState):
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["us", "event_id"])
        found = []
        for us, ident in zip(rows["us"].tolist(), rows["event_id"].tolist(), strict=True):
            if last is not None and us - last > seconds * 1_000_000:
                found.append((key[0], ident, (us - last) / 1e6))
            last = us if last is None else max(last, us)
        state.update((last,))
        if found:
            yield pd.DataFrame(found, columns=["user_id", "event_id", "gap_s"])

    keyed = events.select("user_id", "event_id", F.unix_micros("at").alias("us"))
    return keyed.groupBy("user_id").applyInPandasWithState(beat, "user_id long, event_id long, gap_s double", "last long", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, mode: str, keys: list[str] | None = None, name: str | None = None) -> DataFrame:
    """Run the stream over all that has arrived; the table it leaves.

    Rows are only ever added. In append mode they are final. In update mode each batch adds the
    rows that changed, under its number (written over when a batch is repeated after a failure), and the
    table is the last row of every key in ``keys``. With a ``name`` the checkpoint and the
    table are kept under it in the shared folder: the next run resumes and reads only what is new.
    """
    spark, path = stream.sparkSession, shared_dir(stream.sparkSession, name and f"streams/{name}")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", f"{path}/table").start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{path}/table")

    def changed(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/table/batch={batch}")

    writer.foreachBatch(changed).start().awaitTermination()
    rows = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).option("basePath", f"{path}/table").parquet(f"{path}/table/batch=*")
    return first_wins(rows, keys or stream.columns, [F.desc("batch")]).drop("batch")
