"""Exact deduplication by a 128-bit content hash with a byte comparison inside each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import stored, text_or_empty


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes (MD5 as a binary value)."""
    return F.unhex(F.md5(text))


def text_groups(docs: DataFrame, id_col: str, text_col: str, keep: str, hasher) -> DataFrame:
    """One row per distinct text: ``_h, _sha, keep_id, group_size``.

    The grouping key is (128-bit hash, text): rows whose hashes collide meet in the same
    partition and are told apart there because the text's bytes are part of the key. Copies
    collapse on the map side, so a text crosses the network at most once per map task.
    """
    pick = {"max": F.max, "min": F.min}[keep]
    text = text_or_empty(text_col)
    return (
        docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
        .groupBy(hasher(F.col("_text")).alias("_h"), "_text")
        .agg(pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_h", F.unhex(F.sha2("_text", 256)).alias("_sha"), "keep_id", "group_size")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", hasher=content_hash) -> DataFrame:
    """Per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are; null counts as the empty text. Of a group the row with
    the largest (``keep='max'``) or smallest id stays. Rows that repeat an id and a text share
    one decision. A null id never wins over another; a group of null ids only has a null
    ``keep_id`` and its rows stay. No rows in, no rows out. Other columns are ignored, whatever their names.

    Plan: one exchange of the texts (collapsed per map task) to form groups, then one exchange
    of digests (16 + 32 bytes a row) to tell every row its group. A hot group is one row on the
    groups' side; its rows of digests are split by the skew-join rule of adaptive execution
    (which must be on, as it is by default), so no task holds it whole.
    """
    groups = text_groups(docs, id_col, text_col, keep, hasher)
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), hasher(text).alias("_h"), F.unhex(F.sha2(text, 256)).alias("_sha"))
    joined = rows.join(groups.hint("merge"), ["_h", "_sha"])
    return joined.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """``docs`` with its own columns, whatever their names: of each group of equal texts one row stays.

    It is a row of the group's ``keep_id``; null text counts as empty. Of rows that repeat both id
    and text one stays, the first by its columns written as text; so does one row of a group
    without any id. An empty table stays empty.

    Plan: one exchange of the texts (collapsed per map task) finds each group's ``keep_id``, digests
    carry it back to the rows (a semi-join, whose hot keys the skew-join rule splits). A count of
    ids alone tells whether any repeats; only then are the kept rows written and those of
    repeated ids numbered.
    """
    groups = text_groups(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")), "_id", "_text", keep, content_hash)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    text = text_or_empty(f"d.`{text_col}`")
    rows = rows.select("d", F.col(f"d.`{id_col}`").alias("_id"), content_hash(text).alias("_gh"), F.unhex(F.sha2(text, 256)).alias("_gsha"))
    same = (F.col("_gh") == F.col("_h")) & (F.col("_gsha") == F.col("_sha")) & F.col("_id").eqNullSafe(F.col("keep_id"))
    kept = rows.join(groups.hint("merge"), same, "left_semi")
    repeats = stored(docs.groupBy(F.col(f"`{id_col}`").alias("_again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_again"), "repeated-ids")
    if repeats.limit(1).count():
        kept = stored(kept, "kept-copies")
        again = F.col("_id").eqNullSafe(F.col("_again"))
        first = F.row_number().over(Window.partitionBy("_gh", "_gsha", "_id").orderBy(F.col("d").cast("string")))
        numbered = kept.join(repeats, again, "left_semi").withColumn("_n", first).where("_n = 1").drop("_n")
        kept = kept.join(repeats, again, "left_anti").unionByName(numbered)
    return kept.select("d.*")


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
