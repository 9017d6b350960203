"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams it holds, each scaled by the log-count ratio
of its bucket, the whole vector scaled to the same length for every text (each n-gram counts
1 / sqrt(number of n-grams)). So one rule scores texts of every length, and evidence for
either label counts. An n-gram counts once however often a text repeats it: a few insults
in a very long text weigh little.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skein.llm.common import discard, distinct, fresh, mix64, stored, trim, trimmed

ORDERS = (4, 5, 6)
BITS = 22
#: Bounds of the sample that a fit learns from: labelled rows of either class, characters in all, characters of one text
#: (a longer one is passed over, those after it are not).
MAX_TOXIC, MAX_CLEAN, MAX_CHARS, MAX_TEXT = 1200, 1800, 12_000_000, 400_000
#: Texts of the sample that must hold a bucket before it is a feature.
LEAST = 3
#: Texts of the overall share of label 1 that are added to a bucket's counts, so that a rare bucket's ratio is near 0.
SMOOTH = 20.0
THRESHOLD = 0.3


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _chunks(texts, limit: int = 100_000):
    """Lists of (position, code points) of up to about ``limit`` characters; a longer text is alone."""
    out, size = [], 0
    for k, text in enumerate(texts):
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        if out and size + len(points) > limit:
            yield out
            out, size = [], 0
        out.append((k, points))
        size += len(points)
    if out:
        yield out


def _grams(chunk):
    """Yields (owner, bucket) arrays, one per n-gram order, for a chunk of texts."""
    gap = np.zeros(max(ORDERS), dtype=np.uint64)
    points = np.concatenate([x for _, p in chunk for x in (p.astype(np.uint64), gap)])
    owner = np.repeat(np.array([k for k, _ in chunk]), [len(p) + len(gap) for _, p in chunk])
    for n in ORDERS:
        m = len(points) - n + 1
        word = np.full(m, n, dtype=np.uint64)
        whole = points[n - 1 :] != 0  # n-grams that reach into a gap belong to no text
        for j in range(n):
            word *= np.uint64(0x100000001B3)
            word += points[j : j + m]
        whole &= points[:m] != 0
        yield owner[:m][whole], (mix64(word[whole]) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """``weight[bucket]`` is ratio times coefficient; ``known`` marks the buckets that are features."""

    weight: np.ndarray
    known: np.ndarray
    bias: float

    def __getstate__(self):
        """Features alone travel to the executors (8 bytes each), not the tables they are looked up in."""
        pick = np.flatnonzero(self.known).astype(np.int32)
        return pick, self.weight[pick], self.bias

    def __setstate__(self, state):
        pick, weights, self.bias = state
        self.weight, self.known = np.zeros(1 << BITS, dtype=np.float32), np.zeros(1 << BITS, dtype=bool)
        self.weight[pick], self.known[pick] = weights, True

    def logits(self, texts) -> np.ndarray:
        """Bias plus the mean weight of a text's features times the root of their number."""
        sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
        for chunk in _chunks(texts):
            pairs = []
            for owner, bucket in _grams(chunk):
                used = self.known[bucket]
                pairs.append(owner[used] << BITS | bucket[used])
            seen = distinct(np.concatenate(pairs))
            owner = seen >> BITS
            sums += np.bincount(owner, self.weight[seen & (1 << BITS) - 1], minlength=len(texts))
            counts += np.bincount(owner, minlength=len(texts))
        return self.bias + sums / np.sqrt(np.maximum(counts, 1))

    def scores(self, texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -40, 40)))


def features(texts) -> list[np.ndarray]:
    """The distinct buckets of each text, ascending."""
    out = [np.zeros(0, dtype=np.int32)] * len(texts)
    for chunk in _chunks(texts):
        pairs = distinct(np.concatenate([owner << BITS | bucket for owner, bucket in _grams(chunk)]))
        cuts = np.searchsorted(pairs >> BITS, [k for k, _ in chunk] + [chunk[-1][0] + 1])
        for (k, _), a, b in zip(chunk, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            out[k] = (pairs[a:b] & (1 << BITS) - 1).astype(np.int32)
    return out


def log_count_ratios(held: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Per bucket, log of the share of label-1 texts that hold it over that of label-0 texts, both smoothed by
    ``SMOOTH`` texts of the overall share; 0 for buckets that fewer than ``LEAST`` texts hold."""
    seen = np.zeros((2, 1 << BITS), dtype=np.int32 if len(held) >= 1 << 14 else np.int16)
    for buckets, label in zip(held, y, strict=True):
        seen[int(label), buckets] += 1
    often = np.flatnonzero(seen.sum(0, dtype=seen.dtype) >= LEAST)
    n = np.array([len(y) - y.sum(), y.sum()])
    shares = [(seen[k, often] + SMOOTH * n[k] / n.sum()) / n[k] for k in (0, 1)]
    ratios = np.zeros(1 << BITS, dtype=np.float32)
    ratios[often] = np.log(shares[1]) - np.log(shares[0])
    return ratios


def fit_features(held: list[np.ndarray], labels: list[int], prior: float | None = None, rounds: int = 100) -> Model:
    """Logistic loss over the scaled features, by ``rounds`` accelerated gradient steps from 0; few steps keep coefficients small.

    ``held`` are the buckets of each text, and is emptied; ``prior`` is the share of label 1 among all labelled
    rows when the sample is stratified. Without both labels every score is the prior.
    """
    y = np.array(labels, dtype=np.float64)
    n1, n0 = y.sum(), (1 - y).sum()
    prior = n1 / max(1, len(y)) if prior is None else prior
    bias = float(np.log((prior + 1e-4) / (1 - prior + 1e-4)))
    weight, known = np.zeros(1 << BITS, dtype=np.float32), np.zeros(1 << BITS, dtype=bool)
    ratios = log_count_ratios(held, y) if n1 and n0 else weight
    pick = np.flatnonzero(ratios)
    if not len(pick):
        return Model(weight, known, bias)
    known[pick] = True
    column = np.cumsum(known, dtype=np.int32) - 1
    scale = ratios[pick].astype(np.float64)
    blocks, rows, size = [], [], 0  # blocks of texts bound what one step holds in memory
    del ratios
    for k in range(len(held)):
        buckets, held[k] = held[k], None  # what a block holds is not kept twice
        mine = column[buckets[known[buckets]]]
        if len(mine):
            rows.append((k, mine))
            size += len(mine)
        if rows and (size > 2_000_000 or k == len(held) - 1):
            lengths = np.array([len(x) for _, x in rows])
            blocks.append((np.array([i for i, _ in rows]), lengths, np.cumsum(lengths) - lengths, np.concatenate([x for _, x in rows])))
            rows, size = [], 0
    share = np.where(y == 1, prior / n1, (1 - prior) / n0)
    bound = 1e-12  # of the loss's curvature, from which the step follows
    for own, lengths, starts, cols in blocks:
        bound += 0.25 * (share[own] * np.add.reduceat((scale * scale)[cols], starts) / lengths).sum()
    coef, ahead, bias_ahead, speed = np.zeros(len(pick)), np.zeros(len(pick)), bias, 1.0
    for _ in range(rounds):
        z, gradient, now = np.full(len(y), bias_ahead), np.zeros(len(pick)), (ahead * scale).astype(np.float32)
        for own, lengths, starts, cols in blocks:
            z[own] += np.add.reduceat(now[cols], starts, dtype=np.float64) / np.sqrt(lengths)
            miss = share[own] * (1 / (1 + np.exp(-np.clip(z[own], -40, 40))) - y[own])
            gradient += np.bincount(cols, np.repeat(miss / np.sqrt(lengths), lengths), minlength=len(pick))
        rest = (share * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)).sum()
        last, speed = speed, (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        drift = (last - 1) / speed
        stepped, bias_stepped = ahead - gradient * scale / bound, bias_ahead - 2 * rest
        ahead, bias_ahead = stepped + drift * (stepped - coef), bias_stepped + drift * (bias_stepped - bias)
        coef, bias = stepped, bias_stepped
    weight[pick] = coef * scale
    return Model(weight, known, float(bias))


def fit_model(texts: list, labels: list[int], prior: float | None = None, **options) -> Model:
    """Fit on texts in memory."""
    return fit_features(features(texts), labels, prior, **options)


def _extract(batches):
    for batch in batches:
        for part in range(0, batch.num_rows, 500):
            cut = batch.slice(part, 500)
            held = features(cut.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([cut.column(0), cut.column(1), pa.array([x.astype("<i4").tobytes() for x in held], pa.binary())], names=["place", "y", "buckets"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on a bounded, stratified sample of the labelled rows outside the held-out fold.

    The sample is the first ``MAX_TOXIC`` and ``MAX_CLEAN`` ids by hash, without texts over
    ``MAX_TEXT`` characters or that would take the sample past ``MAX_CHARS``; its ids (a few
    thousand at most, whatever the input) are broadcast and its n-grams are extracted by the
    executors. A document that several label rows contradict counts as toxic; of rows that
    repeat an id the least text counts; null texts count as empty. No labels give the prior 0.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    totals = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = known.where("_y = 1").orderBy(*order).limit(MAX_TOXIC).unionByName(known.where("_y = 0").orderBy(*order).limit(MAX_CLEAN))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(picked), "_id")
    sample = stored(rows.groupBy("_id", "_y").agg(F.min("_text").alias("_text")).select(F.xxhash64("_id").alias("place"), F.col("_id").cast("string").alias("name"), "_y", "_text"), "toxicity-sample")
    kept, chars = [], 0
    for r in sorted(sample.select("place", "name", F.length("_text").alias("n")).collect()):
        if r.n <= MAX_TEXT and chars + r.n <= MAX_CHARS:
            kept.append((r.place, r.name))
            chars += r.n
    wanted = F.broadcast(spark.createDataFrame(kept, "place long, name string"))
    got = sample.join(wanted, ["place", "name"], "left_semi").select(F.struct("place", "name").cast("string").alias("place"), F.col("_y").alias("y"), F.col("_text").alias("text"))
    found = sorted((r.place, r.y, bytes(r.buckets)) for r in got.mapInArrow(trimmed(_extract), "place string, y int, buckets binary").toLocalIterator())
    discard(sample)
    n = sum(totals.values())
    y = [y for _, y, _ in found]
    held = [np.frombuffer(x, dtype="<i4") for _, _, x in found]
    del found
    model = fit_features(held, y, totals.get(1, 0) / n if n else 0.0)
    trim()
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "_score") -> DataFrame:
    """Per row: all columns of ``docs`` and ``score_col`` (0 to 1). Null and empty texts score by the bias; no exchange."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some MB (32 at most), whatever the input
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                cut = batch.slice(part, 1000)
                yield pa.RecordBatch.from_arrays([*cut.columns, pa.array(shared.value.scores(cut.column(at).to_pylist()))], names=[*names, score_col])

    return docs.mapInArrow(trimmed(run), StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per row: id, ``held_out``, ``score``, ``predicted`` (score at least 0.3).

    Whole texts are scored by one rule, lower-cased; labels, language, source and id never enter
    a score. Rows are independent: repeated rows score alike, a null id is never held out, null
    and empty texts score by the bias alone, no labels give the prior 0, an empty table an
    empty one, other columns are ignored.
    """
    scored = score(docs.select(id_col, text_col), fit(docs, labels, id_col, text_col, label_col), text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, whatever their names, without the rows predicted toxic.

    Rows are judged one by one: repeated rows stay or go together, rows of null ids or texts are
    judged as by :func:`toxicity`, an empty table stays empty, and without labels every row stays.
    """
    name = fresh("_score", docs.columns)
    return score(docs, fit(docs, labels, id_col, text_col), text_col, name).where(F.col(name) < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
