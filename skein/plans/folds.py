"""Ordered folds, fuzzy ratios and citations (where no SQL stands beside a query, tests compare with plain loops)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import text as T
from skein.functions.citations import Citations, has_candidate
from skein.functions.fuzzy import partial_ratio
from skein.operators import folds as O
from skein.operators.match import hash_words
from skein.plans.base import query, table
from skein.sources import entities as E


def _segments(spark, folder):
    return E.segments(table(spark, folder, "conversations"))


_BITS = lambda a: f"list_reduce(list_prepend(0::BIGINT, list_transform(embedding[{a + 1}:{a + 32}], lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END::BIGINT)), lambda s, x: s * 2 + x)"


@query(
    "drift_group",
    f"""WITH RECURSIVE h AS (SELECT vec_id // 40 AS clip, vec_id AS pos, {_BITS(0)} AS hi, {_BITS(32)} AS lo, row_number() OVER (PARTITION BY vec_id // 40 ORDER BY vec_id) AS k FROM embeddings),
f AS (SELECT clip, pos, k, hi, lo, hi AS hi0, lo AS lo0, 0::BIGINT AS grp FROM h WHERE k = 1 UNION ALL
  SELECT clip, pos, k, hi, lo, CASE WHEN far THEN hi ELSE hi0 END, CASE WHEN far THEN lo ELSE lo0 END, grp + CASE WHEN far THEN 1 ELSE 0 END FROM (
    SELECT h.*, f.hi0, f.lo0, f.grp, bit_count(xor(h.hi, f.hi)) + bit_count(xor(h.lo, f.lo)) >= {O.STEP // 2} OR bit_count(xor(h.hi, f.hi0)) + bit_count(xor(h.lo, f.lo0)) >= {O.DRIFT // 2} AS far FROM f JOIN h ON h.clip = f.clip AND h.k = f.k + 1))
SELECT clip, pos, grp FROM f""",
)
def drift_group(spark, folder):
    """Forty vectors in turn stand for a clip's frames."""
    hi, lo = hash_words(F.col("embedding"), 0.0)
    frames = table(spark, folder, "embeddings").select(F.expr("vec_id div 40").alias("clip"), F.col("vec_id").alias("pos"), hi.alias("hi"), lo.alias("lo"))
    return O.fold_by(frames, "clip", O.drift_groups, "clip long, pos long, grp long")


@query(
    "semantic_group_span",
    f"""WITH RECURSIVE {E.SEGMENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY seg_idx) AS k FROM segments),
f AS (SELECT clip, seg_idx, k, start_ms AS s0, end_ms, 0::BIGINT AS grp FROM n WHERE k = 1 UNION ALL
  SELECT n.clip, n.seg_idx, n.k, CASE WHEN n.start_ms - f.end_ms >= 60000 OR n.end_ms - f.s0 > 90000 THEN n.start_ms ELSE f.s0 END, n.end_ms, f.grp + CASE WHEN n.start_ms - f.end_ms >= 60000 OR n.end_ms - f.s0 > 90000 THEN 1 ELSE 0 END FROM f JOIN n ON n.clip = f.clip AND n.k = f.k + 1)
SELECT clip, seg_idx, grp FROM f""",
)
def semantic_group_span(spark, folder):
    return O.fold_by(_segments(spark, folder).select("clip", "seg_idx", "start_ms", "end_ms"), "clip", O.span_groups(60_000, 90_000), "clip long, seg_idx long, grp long")


@query(
    "rate_windows",
    f"""WITH RECURSIVE {E.SEGMENTS}, r AS (SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY seg_idx) AS k, start_ms / 250.0::DOUBLE AS s, start_ms / 250.0::DOUBLE + (dur_ms / 1000.0::DOUBLE) * CASE role WHEN 'assistant' THEN 4.0 ELSE 1.0 END AS e, length(trim(text)) AS n FROM segments),
m AS (SELECT clip, list_sort(list(n / (e - s)) FILTER (e - s > 0.5 AND n > 0)) AS l FROM r GROUP BY 1),
w AS (SELECT a.clip, a.k, a.s, a.e, coalesce((SELECT min(b.k) FROM r b WHERE b.clip = a.clip AND b.k >= a.k AND b.e - a.s >= 30), (SELECT max(b.k) + 1 FROM r b WHERE b.clip = a.clip)) AS j FROM r a),
t AS MATERIALIZED (SELECT w.*, x.s1, x.n, x.s1 - w.s AS span, coalesce(l[len(l) // 2 + 1], 0.0) AS median FROM w JOIN m USING (clip), LATERAL (SELECT max_by(e, k) AS s1, sum(n) AS n FROM r WHERE r.clip = w.clip AND r.k >= w.k AND r.k < w.j) x),
hit AS MATERIALIZED (SELECT *, j > k AND e - s >= 0.5 AND span >= 24 AND n / span < 0.6 * median AS ok FROM t),
walk AS (SELECT clip, k, ok, j FROM hit WHERE k = 1 UNION ALL SELECT h.clip, h.k, h.ok, h.j FROM walk JOIN hit h ON h.clip = walk.clip AND h.k = CASE WHEN walk.ok THEN walk.j ELSE walk.k + 1 END)
SELECT clip, s AS start, s1 AS "end", round(n / span, 6) AS rate FROM walk JOIN hit USING (clip, k) WHERE hit.ok""",
)
def rate_windows(spark, folder):
    """Segments last as long as their length says, so the rate is varied by role: answers are spoken four times slower here."""
    slow = F.when(F.col("role") == "assistant", 4.0).otherwise(1.0)
    rows = _segments(spark, folder).select("clip", "seg_idx", (F.col("start_ms") / 250.0).alias("start"), (F.col("start_ms") / 250.0 + (F.col("dur_ms") / 1000.0) * slow).alias("end"), "text")
    return O.fold_by(rows, "clip", O.rate_windows(0.6, 30.0), "clip long, start double, end double, rate double")


@query("resegment")
def resegment(spark, folder):
    words = _segments(spark, folder).select("clip", "seg_idx", "start_ms", "end_ms", T.words(F.col("text"), r"\S+").alias("w")).select("clip", "seg_idx", "start_ms", ((F.col("end_ms") - F.col("start_ms")) / F.size("w") / 1000.0).alias("each"), F.posexplode("w").alias("pos", "word"))
    timed = words.select("clip", "seg_idx", "pos", "word", (F.col("start_ms") / 1000.0 + F.col("pos") * F.col("each")).alias("start"), (F.col("start_ms") / 1000.0 + (F.col("pos") + 1) * F.col("each")).alias("end"))
    return O.resegment(timed)


@query("partial_ratio")
def partial_ratio_query(spark, folder):
    """Each slide title (a part's name) against its type and brand line."""
    part = table(spark, folder, "part").select("p_partkey", F.lower("p_name").alias("a"), F.lower(F.concat_ws(" ", "p_type", "p_name", "p_brand")).alias("b"), F.lower("p_type").alias("c"))
    return part.select("p_partkey", F.round(partial_ratio("a", "b"), 6).alias("inside"), F.round(partial_ratio("a", "c"), 6).alias("other"))


#: How notes cite a segment's start, by its number modulo 9: the note, and the rows that it means (label, start, end, approximate).
_CITED = [
    ("said (V1 {s})", [("'V1'", "a", "NULL", "false")]),
    ("from ({s}-{e})", [("'a.mp4'", "a", "b", "false")]),
    ("(V2 {s}, 00:05)", [("'V2'", "a", "NULL", "false"), ("'V2'", "5", "NULL", "false")]),
    ("see (at V1 {s} he says)", []),
    ("(seg06 A1 {s})", [("'A1'", "a", "NULL", "false")]),
    ("`(clip.m2ts {s}–x.MP4 00:09)`", [("'clip.m2ts'", "a", "NULL", "false"), ("'x.MP4'", "9", "NULL", "false")]),
    ("(V1 ⚠️approx {s})", [("'V1'", "a", "NULL", "true")]),
    ("(V2 {s}-59) and (120:80)", [("'V2'", "a", "a - a % 60 + 59", "false")]),
    ("(c00 {s}; V3 0:01:02)", [("'c00'", "a", "NULL", "false"), ("'V3'", "62", "NULL", "false")]),
]


@query(
    "citation_udtf",
    f"WITH {E.SEGMENTS}, t AS (SELECT clip, seg_idx, start_ms // 1000 AS a, end_ms // 1000 AS b FROM segments) "
    + " UNION ALL ".join(f"SELECT clip, seg_idx, {label} AS label, ({start})::INT AS start_s, ({end})::INT AS end_s, {rough} AS approx FROM t WHERE seg_idx % {len(_CITED)} = {k}" for k, (_, rows) in enumerate(_CITED) for label, start, end, rough in rows),
)
def citation_udtf(spark, folder):
    """Citations of every segment's start, in the forms that notes use; only notes with a clock in parentheses reach Python."""
    rows = _segments(spark, folder)
    clocks = {"s": T.minute_clock(F.col("start_ms") / 1000), "e": T.minute_clock(F.col("end_ms") / 1000)}
    note = F.lit(None).cast("string")
    for k, (form, _) in enumerate(_CITED):
        text = F.lit(form)
        for name, clock in clocks.items():
            text = F.replace(text, F.lit("{" + name + "}"), clock)
        note = F.when(F.col("seg_idx") % len(_CITED) == k, text).otherwise(note)
    spark.udtf.register("skein_citations", Citations)
    notes = rows.select("clip", "seg_idx", note.alias("note")).where(has_candidate(F.col("note")))
    return spark.sql("SELECT clip, seg_idx, label, start_s, end_s, approx FROM {notes}, LATERAL skein_citations(note, 'a.mp4')", notes=notes)
