"""Window operators: islands, range merging, forward fill, spans, firsts and running structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from skein.sources.shared import shared_dir


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def islands(df: DataFrame, by: list, order: list, key: Column, name: str = "island") -> DataFrame:
    """Number the maximal runs of consecutive rows with an equal ``key`` (nulls are equal)."""
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    marked = df.withColumn("_k", key)
    marked = marked.withColumn("_new", F.when(F.row_number().over(w) == 1, 1).when(F.lag("_k").over(w).eqNullSafe(F.col("_k")), 0).otherwise(1))
    return marked.withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_k", "_new")


def runs(df: DataFrame, by: list, order: list, key: Column, keep: Column, at_least: int, start: str, end: str) -> DataFrame:
    """(by.., first, last, run_start, run_end, n) of runs of equal ``key`` on rows where ``keep`` holds."""
    numbered = islands(df.withColumn("_keep", keep), by, order, F.struct(F.col("_keep"), key.alias("k")))
    grouped = numbered.where("_keep").groupBy(*_cols(by), "island")
    pos = order[0]
    return grouped.agg(F.min(pos).alias("first_pos"), F.max(pos).alias("last_pos"), F.min_by(start, pos).alias("run_start"), F.max_by(end, pos).alias("run_end"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least).drop("island")


def merge_ranges(df: DataFrame, by: list, start: str, end: str, tolerance=0, ties: list | None = None) -> DataFrame:
    """Union of ranges per group: a range joins the one before when it starts by its running end plus ``tolerance``."""
    w = Window.partitionBy(*_cols(by)).orderBy(start, *(ties or [end]))
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(F.col(start) <= reach + tolerance, 0).otherwise(1))
    marked = marked.withColumn("_range", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*_cols(by), "_range").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n_merged")).drop("_range")


def forward_fill(df: DataFrame, by: list, order: list, value: str, filled: str) -> DataFrame:
    """The latest non-null ``value`` up to each row; rows before the first one are dropped."""
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(filled, F.last(value, ignorenulls=True).over(w)).where(F.col(filled).isNotNull())


def until_next(df: DataFrame, by: list, order: list, start: str, name: str, default: Column) -> DataFrame:
    """The next row's ``start`` within the group, or ``default`` on the last one."""
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    return df.withColumn(name, F.coalesce(F.lead(start).over(w), default))


def first_wins(df: DataFrame, key: list, order: list) -> DataFrame:
    """One row per key, the first in ``order``."""
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_k(df: DataFrame, by: list, order: list, k: int, name: str = "rank") -> DataFrame:
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def drop_repeats(df: DataFrame, by: list, order: list, value: str) -> DataFrame:
    """Without rows whose ``value`` equals that of the row before."""
    w = Window.partitionBy(*_cols(by)).orderBy(*_cols(order))
    return df.withColumn("_was", F.lag(value).over(w)).where(~F.col(value).eqNullSafe(F.col("_was")) | F.col("_was").isNull()).drop("_was")


def upper_median(values: Column) -> Column:
    """The middle element of the sorted array, the upper one of two."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def ranked(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``df`` with ``name``: every row's place, from 1, in the order of all rows (``order`` must tell rows apart).

    A window over the whole table would be one task. Rows are sorted by range instead, written, numbered
    within their partition, and moved by the rows of the partitions before: one number per partition.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    df.repartitionByRange(*_cols(order)).withColumn("_p", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.schema(StructType([*df.schema.fields, StructField("_p", IntegerType())])).parquet(path)
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = rows.groupBy(F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("n")).select("_q", ahead.alias("_before"))
    local = rows.withColumn("_local", F.row_number().over(Window.partitionBy("_p").orderBy(*_cols(order))))
    out = local.join(F.broadcast(before), F.col("_p") == F.col("_q"))  # a row per partition
    return out.withColumn(name, (F.col("_local") + F.col("_before")).cast("long")).drop("_p", "_q", "_local", "_before")
