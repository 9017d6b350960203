"""Sharding by histogram sort: exact byte counts below probes, splitters refined, one exchange.

The sort key is (64-bit hash of the text, id), so equal texts are neighbours. A boundary is
first sought between hashes, which keeps equal texts in one shard; only where one hash's rows
are too many bytes for the tolerance does the search go on among that hash's ids.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from skein.llm.common import discard, fresh, stored, text_or_empty

_HALF = 1 << 63
_LOW = (1 << 64) - 1
_TOP = 1 << 128


def _key(hashed: int, ident: int) -> int:
    return (hashed + _HALF) << 64 | (ident + _HALF)


def _parts(key: int) -> tuple[int, int]:
    return (key >> 64) - _HALF, (key & _LOW) - _HALF


def _below(hashes: np.ndarray, ids: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """For each row the number of bounds at or below its key; ``bounds`` ascend."""
    edge = np.array([b[0] for b in bounds], dtype=np.int64)
    out = np.searchsorted(edge, hashes, side="left")
    tied = np.flatnonzero(np.searchsorted(edge, hashes, side="right") > out)
    for value in np.unique(hashes[tied]):  # only rows whose hash is itself a bound's
        rows = tied[hashes[tied] == value]
        lo, hi = np.searchsorted(edge, value, side="left"), np.searchsorted(edge, value, side="right")
        inner = np.array([b[1] for b in bounds[lo:hi]], dtype=np.int64)
        out[rows] = lo + np.searchsorted(inner, ids[rows], side="right")
    return out


def _histogram(index: DataFrame, bounds: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows below each bound. Each task sends at most one row per interval."""

    def count(batches):
        size, rows = np.zeros(len(bounds) + 1, dtype=np.int64), np.zeros(len(bounds) + 1, dtype=np.int64)
        for batch in batches:
            place = _below(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bounds)
            np.add.at(size, place, batch.column(2).to_numpy())
            rows += np.bincount(place, minlength=len(bounds) + 1)
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(size[full]), pa.array(rows[full])], names=["place", "size", "n"])

    found = index.select("_h", "_k", "size").mapInArrow(count, "place long, size long, n long").groupBy("place").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    size, rows = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for r in found:
        size[r.place], rows[r.place] = r.size, r.n
    return np.cumsum(size).tolist()[:-1], np.cumsum(rows).tolist()[:-1]


def find_splitters(index: DataFrame, total: int, n_rows: int, parts: int, shards: int, tolerance: float, loose: float, probes: int = 7) -> list[tuple[int, int, int]]:
    """(key, bytes below, rows below) of the ``parts - 1`` inner splitters, ascending.

    Every ``parts / shards``-th splitter is a shard's boundary and must come within
    ``tolerance`` of its goal, as a share of a shard; the others within ``loose`` of a part.
    A splitter whose bracket holds one row or one key only is as exact as it can be.
    """
    goals = [total * k // parts for k in range(1, parts)]
    slack = [total / shards * tolerance if k % (parts // shards) == 0 else total / parts * loose for k in range(1, parts)]
    known: dict[int, tuple[int, int]] = {0: (0, 0), _TOP: (total, n_rows)}
    done: dict[int, int] = {}
    while len(done) < len(goals):
        keys = sorted(known)
        sizes = [known[k][0] for k in keys]
        wanted: set[int] = set()
        for g, goal in enumerate(goals):
            if g in done:
                continue
            at = bisect_left(sizes, goal)
            lo, hi = keys[max(at - 1, 0)], keys[at]
            near = min((lo, hi), key=lambda k: abs(known[k][0] - goal))
            # bounds with an id of the lowest value lie between hashes
            if abs(known[near][0] - goal) <= slack[g] or known[hi][1] - known[lo][1] <= 1 or hi - lo <= 1:
                done[g] = near
                continue
            step = 1 << 64 if (hi >> 64) - (lo >> 64) > 1 else 1
            first, last = -(-(lo + 1) // step), (hi - 1) // step
            if first > last:
                step, first, last = 1, lo + 1, hi - 1
            wanted |= {(first + (last - first) * (j + 1) // (probes + 1)) * step for j in range(probes)}
        wanted -= known.keys()
        if wanted:
            asked = sorted(wanted)
            size, rows = _histogram(index, [_parts(k) for k in asked])
            known |= {k: (s, r) for k, s, r in zip(asked, size, rows, strict=True)}
    chosen = sorted(done[g] for g in range(len(goals)))
    return [(k, *known[k]) for k in chosen]


def shard_documents(docs: DataFrame, shards: int = 16, tolerance: float = 0.005, id_col: str = "doc_id", text_col: str = "text", per_part: int = 1_000_000) -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``law`` ('bytes'), ``shard``, ``slot``, ``grown_shard`` (null).

    Size is the text's UTF-8 bytes plus 1; a null text has none and hashes as the empty text,
    a null id sorts first; ids that are not integers sort by their 64-bit hash, then by themselves.
    Shards follow the sort key, slots count from 0 along it in every shard. A shard's bytes differ
    from the mean by at most ``tolerance`` of it or the largest group of equal texts that the tolerance
    can hold, or one row. Equal texts share a shard unless a boundary must cut
    their group (where it is more than the tolerance) for sizes to be near equal. Repeated rows have
    one key and stay together; an empty table gives an empty one; other columns are ignored, whatever their names.

    The text is read once into an index of about 40 bytes a row in the shared folder; every
    refinement is a scan of that index that returns one number per interval; then one exchange
    deals the index by part (some million rows each), and a window sorts and numbers a part.
    """
    text = text_or_empty(f"`{text_col}`")
    whole_ids = isinstance(docs.schema[id_col].dataType, IntegralType)
    number = F.col(f"`{id_col}`").cast("long") if whole_ids else F.when(F.col(f"`{id_col}`").isNotNull(), F.xxhash64(f"`{id_col}`"))
    ident = F.coalesce(number, F.lit(-(1 << 63)).cast("long"))
    index = stored(docs.select(F.xxhash64(text).alias("_h"), ident.alias("_k"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.col(f"`{id_col}`").alias("_id")), "shard-index")
    whole = index.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    total, n_rows = whole.size or 0, whole.n
    fine = max(8, -(-n_rows // (shards * per_part)))
    cuts = find_splitters(index, total, n_rows, shards * fine, shards, tolerance, 0.25) if n_rows else []
    bounds = [_parts(k) for k, _, _ in cuts]
    before = [0] + [rows for _, _, rows in cuts]

    def deal(batches):
        starts = np.array(before, dtype=np.int64)
        for batch in batches:
            part = _below(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bounds) if bounds else np.zeros(batch.num_rows, dtype=np.int64)
            shard = part // fine
            skip = starts[part] - starts[shard * fine] if bounds else part
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int64)), pa.array(shard.astype(np.int32)), pa.array(skip)], names=[*batch.schema.names, "part", "shard", "_skip"])

    dealt = index.mapInArrow(deal, f"_h long, _k long, size long, text_crc32 long, _id {docs.schema[id_col].dataType.simpleString()}, part long, shard int, _skip long")
    order = Window.partitionBy("part").orderBy("_h", "_k", "_id")
    return dealt.select(
        F.col("_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_skip") + F.row_number().over(order) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", **options) -> None:
    """Write ``docs`` under ``path`` as ``shard=K`` folders of Parquet files in slot order.

    A column of the table's own called ``shard`` stays; the folders' column is then ``shard_``. Ids must
    be unique (a null id is one id): repeated ones raise ValueError, as a row could not tell its slot. An
    empty table writes no folder.
    """
    names = docs.columns
    shard, slot, ident = (fresh(n, names) for n in ("shard", "_slot", "_id"))
    placed = stored(shard_documents(docs, shards, id_col=id_col, **options).select(F.col(id_col).alias(ident), F.col("shard").alias(shard), F.col("slot").alias(slot)), "shard-places")
    if placed.groupBy(ident).count().where("count > 1").limit(1).count():
        discard(placed)
        raise ValueError(f"{id_col} repeats: shards are written by unique ids")
    rows = docs.join(placed, docs[f"`{id_col}`"].eqNullSafe(placed[ident])).drop(ident)
    rows.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).drop(slot).write.partitionBy(shard).parquet(path)
    discard(placed)
