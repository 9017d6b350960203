"""Interval joins as equi-joins on time cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cells(df: DataFrame, start: Column, end: Column, width: float, tag: str) -> DataFrame:
    first, last = F.floor(start / width), F.floor(end / width)
    return df.withColumn(f"_{tag}_first", first).withColumn("_cell", F.explode(F.sequence(first, F.greatest(first, last))))


def interval_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], left_span: tuple, right_span: tuple, width: float, closed: bool = True, left_key: list[str] | None = None) -> DataFrame:
    """Pairs whose spans overlap: with ``closed`` ends touching counts, otherwise not.

    Both sides are laid on cells of ``width`` and joined on (``on``, cell); the overlap is
    tested exactly and a pair counts in the first cell that both share, so none repeats. Choose
    a width near the usual span: a row is copied once per cell it covers. With ``left_key``
    (columns that identify a left row) left rows without a match come back once, the right side null. Rows with a null span match nothing.
    Column names of the two sides must differ.
    """
    ls, le = (F.col(c) for c in left_span)
    rs, re_ = (F.col(c) for c in right_span)
    key = [F.col(a) == F.col(b) for a, b in on]
    a = _cells(left.where(ls.isNotNull() & le.isNotNull()), ls, le, width, "l")
    b = _cells(right.where(rs.isNotNull() & re_.isNotNull()), rs, re_, width, "r").withColumnRenamed("_cell", "_rcell")
    meets = (ls <= re_) & (rs <= le) if closed else (ls < re_) & (rs < le)
    cond = (F.col("_cell") == F.col("_rcell")) & meets & (F.col("_cell") == F.greatest("_l_first", "_r_first"))
    for k in key:
        cond = cond & k
    pairs = a.join(b, cond, "inner").drop("_cell", "_rcell", "_l_first", "_r_first")
    if left_key is None:
        return pairs
    rights = pairs.select(*[F.col(c).alias(f"_k_{c}") for c in left_key], *right.columns)
    same = [left[c].eqNullSafe(F.col(f"_k_{c}")) for c in left_key]
    return left.join(rights, same, "left").drop(*[f"_k_{c}" for c in left_key])


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Seconds that two spans share; negative when they are apart."""
    return F.least(a_end, b_end) - F.greatest(a_start, b_start)
