"""Roll-ups, consensus, repetition, votes, audits and bands."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators import sequences as S
from skein.plans.base import query, table
from skein.sources import entities as E


@query(
    "canonical_pick",
    f"""WITH {E.SLIDES}, c AS (SELECT *, length(array_to_string(list_filter(string_split(quick_text, chr(10)), lambda x: NOT contains(x, 'token')), chr(10))) AS n FROM slides)
SELECT clip, arg_max(slide_id, (n, pos)) AS slide_id, min(start_s) AS start_s, max(end_s) AS end_s, count(*) AS n_slides FROM c GROUP BY 1""",
)
def canonical_pick(spark, folder):
    """Of a group the slide with the longest cleaned text, the latest of equals, and the group's span."""
    rows = E.slides(table(spark, folder, "documents")).withColumn("n", F.length(T.strip_chrome_lines(F.col("quick_text"), ["token"])))
    best = F.max(F.struct("n", "pos", "slide_id"))
    return rows.groupBy("clip").agg(best.alias("x"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.count(F.lit(1)).alias("n_slides")).select("clip", F.col("x.slide_id").alias("slide_id"), "start_s", "end_s", "n_slides")


@query(
    "two_level_kpi_cv",
    """WITH f AS (SELECT l_suppkey, l_returnflag, l_partkey, avg(l_quantity) AS m, max(l_quantity) AS mx, CASE WHEN avg(l_quantity) > 0 THEN stddev_pop(l_quantity) / avg(l_quantity) ELSE 0 END AS cv FROM lineitem GROUP BY 1, 2, 3)
SELECT l_suppkey, l_returnflag, count(*) AS n_fixtures, round(avg(m) + 1e-9, 6) AS mean_quantity, round(avg(cv), 6) AS mean_cv, max(mx) AS max_quantity FROM f GROUP BY 1, 2""",
)
def two_level_kpi_cv(spark, folder):
    """Per fixture (part) first, then the mean of means per engine (supplier) and category; variation is over the population.

    A billionth is added before rounding: means over powers of two end in exact halves, which engines round differently.
    """
    q = "l_quantity"
    fixture = table(spark, folder, "lineitem").groupBy("l_suppkey", "l_returnflag", "l_partkey").agg(F.avg(q).alias("m"), F.max(q).alias("mx"), F.stddev_pop(q).alias("sd"))
    cv = F.when(F.col("m") > 0, F.col("sd") / F.col("m")).otherwise(0.0)
    return fixture.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n_fixtures"), F.round(F.avg("m") + 1e-9, 6).alias("mean_quantity"), F.round(F.avg(cv), 6).alias("mean_cv"), F.max("mx").alias("max_quantity"))


@query(
    "trigram_repetition",
    """WITH w AS (SELECT doc_id, regexp_extract_all(text, '[\\pL\\pN_]+') AS w FROM documents), g AS (SELECT doc_id, lower(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g, count(*) AS c FROM w, unnest(range(1, len(w) - 1)) AS u(i) WHERE len(w) >= 6 GROUP BY ALL)
SELECT w.doc_id, round(coalesce(max(c) / count(g)::DOUBLE, 0.0), 3) AS score FROM w LEFT JOIN g USING (doc_id) GROUP BY 1""",
)
def trigram_repetition(spark, folder):
    """Highest count of a word trigram over the number of distinct ones; 0 for fewer than six words."""
    docs = table(spark, folder, "documents").select("doc_id", T.words(F.lower("text"), r"[\p{L}\p{N}_]+").alias("w"))
    grams = F.transform("w", lambda a, i: F.concat_ws(" ", a, F.get("w", i + 1), F.get("w", i + 2)))  # strings alone are exploded, never the array beside them
    whole = F.when(F.size("w") >= 6, F.slice(grams, F.lit(1), F.size("w") - 2))
    counted = docs.select("doc_id", F.explode(whole).alias("g")).groupBy("doc_id", "g").agg(F.count(F.lit(1)).alias("c")).groupBy("doc_id").agg((F.max("c") / F.count(F.lit(1))).alias("s"))
    return docs.select("doc_id").join(counted, "doc_id", "left").select("doc_id", F.round(F.coalesce("s", F.lit(0.0)), 3).alias("score"))


FLAT = "regexp_replace(regexp_replace(text, 'https?://\\S+', '', 'g'), '\\s+', '', 'g')"


@query(
    "line_dup_and_diversity",
    f"""WITH l AS (SELECT doc_id, regexp_replace(replace(regexp_replace(trim(x), '^[\\s>*#\\d.-]+', ''), '`', ''), '\\s+', '', 'g') AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) WHERE NOT contains(x, '|')),
c AS (SELECT doc_id, max(n) AS worst FROM (SELECT doc_id, s, count(*) AS n FROM l WHERE length(s) >= 12 GROUP BY 1, 2) GROUP BY 1),
f AS (SELECT doc_id, {FLAT} AS f FROM documents), d AS (SELECT doc_id, count(DISTINCT substr(f, i, 8)) / count(*)::DOUBLE AS diversity FROM f, unnest(range(1, length(f) - 6)) AS u(i) GROUP BY 1)
SELECT f.doc_id, coalesce(worst, 0) AS worst, round(coalesce(diversity, 1.0), 6) AS diversity, length(f) >= 500 AND (coalesce(worst, 0) >= 4 OR coalesce(diversity, 1.0) < 0.7) AS warn FROM f LEFT JOIN c USING (doc_id) LEFT JOIN d USING (doc_id)""",
)
def line_dup_and_diversity(spark, folder):
    """The most repeated content line and the share of distinct 8-grams of characters: signs of a looping text."""
    docs = table(spark, folder, "documents")
    clean = F.regexp_replace(F.replace(F.regexp_replace(F.trim("x"), r"^[\s>*#\d.-]+", ""), F.lit("`"), F.lit("")), r"\s+", "")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("x")).where(~F.contains("x", F.lit("|"))).select("doc_id", clean.alias("s")).where(F.length("s") >= 12)
    worst = lines.groupBy("doc_id", "s").agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id").agg(F.max("n").alias("worst"))
    flat = F.regexp_replace(F.regexp_replace("text", r"https?://\S+", ""), r"\s+", "")
    grams = docs.select("doc_id", F.length(flat).alias("n"), T.char_ngrams(F.regexp_replace("text", r"https?://\S+", ""), 8).alias("g"))
    both = grams.select("doc_id", "n", F.when(F.size("g") > 0, F.size(F.array_distinct("g")) / F.size("g")).otherwise(1.0).alias("diversity")).join(worst, "doc_id", "left")
    bad = (F.coalesce("worst", F.lit(0)) >= 4) | (F.col("diversity") < 0.7)
    return both.select("doc_id", F.coalesce("worst", F.lit(0)).alias("worst"), F.round("diversity", 6).alias("diversity"), ((F.col("n") >= 500) & bad).alias("warn"))


@query(
    "coverage_ratio",
    """WITH d AS (SELECT source, sum(length(regexp_replace(regexp_replace(text, '`?\\([^()]{0,30}\\d{1,2}:\\d{2}\\)`?', '', 'g'), '\\s+', '', 'g'))) AS n FROM documents GROUP BY 1), t AS (SELECT sum(length(regexp_replace(text, '\\s+', '', 'g'))) AS n FROM conversations)
SELECT source, d.n::BIGINT AS note_chars, t.n::BIGINT AS transcript_chars, round(d.n / t.n::DOUBLE, 6) AS ratio, d.n / t.n::DOUBLE < 0.10 AS thin FROM d, t""",
)
def coverage_ratio(spark, folder):
    """Visible characters of a source's notes over those of the transcripts, without clocks in brackets."""
    note = T.squeeze(F.regexp_replace("text", r"`?\([^()]{0,30}\d{1,2}:\d{2}\)`?", ""))
    notes = table(spark, folder, "documents").groupBy("source").agg(F.sum(F.length(note)).alias("note_chars"))
    said = table(spark, folder, "conversations").agg(F.sum(F.length(T.squeeze(F.col("text")))).alias("transcript_chars"))
    ratio = F.col("note_chars") / F.col("transcript_chars")
    return notes.crossJoin(F.broadcast(said)).select("source", "note_chars", "transcript_chars", F.round(ratio, 6).alias("ratio"), (ratio < 0.10).alias("thin"))  # one row


def discordant(order: np.ndarray) -> int:
    """Inversions of a sequence of ranks, by merging sorted halves."""
    if len(order) < 2:
        return 0
    half = len(order) // 2
    a, b = order[:half], order[half:]
    return discordant(a) + discordant(b) + int((half - np.searchsorted(np.sort(a), b, side="right")).sum())


@query(
    "kendall_discordance",
    """SELECT a.o_custkey, count(*) AS n_pairs, round(avg(CASE WHEN (a.o_totalprice, a.o_orderkey) > (b.o_totalprice, b.o_orderkey) THEN 1.0 ELSE 0.0 END), 9) AS discordant FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND (a.o_orderdate, a.o_orderkey) < (b.o_orderdate, b.o_orderkey) GROUP BY 1""",
)
def kendall_discordance(spark, folder):
    """Share of a customer's order pairs that date and price rank differently; inversions are counted in n log n, no pairs are made."""
    by = Window.partitionBy("o_custkey")
    ranks = table(spark, folder, "orders").select("o_custkey", F.row_number().over(by.orderBy("o_orderdate", "o_orderkey")).alias("i"), F.row_number().over(by.orderBy("o_totalprice", "o_orderkey")).alias("r"))

    def count(group: pd.DataFrame) -> pd.DataFrame:
        n = len(group)
        pairs = n * (n - 1) // 2
        found = discordant(group.sort_values("i")["r"].to_numpy())
        return pd.DataFrame({"o_custkey": [group["o_custkey"].iloc[0]], "n_pairs": [pairs], "discordant": [round(found / pairs, 9) if pairs else None]})

    return ranks.groupBy("o_custkey").applyInPandas(count, "o_custkey long, n_pairs long, discordant double").where("n_pairs > 0")


@query(
    "weighted_vote",
    """WITH v AS (SELECT source, lang, sum(w) AS w FROM (SELECT d.source, d.lang, 1 + l.quality * 2 AS w FROM documents d JOIN labels l USING (doc_id)) GROUP BY 1, 2)
SELECT source, lang, round(w / t::DOUBLE, 6) AS share FROM (SELECT *, sum(w) OVER (PARTITION BY source) AS t, row_number() OVER (PARTITION BY source ORDER BY w DESC, lang) AS r FROM v) WHERE r = 1""",
)
def weighted_vote(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang")
    votes = docs.join(table(spark, folder, "labels"), "doc_id").groupBy("source", "lang").agg(F.sum(1 + F.col("quality") * 2).alias("w"))
    rated = votes.withColumn("t", F.sum("w").over(Window.partitionBy("source")))
    return S.first_wins(rated, ["source"], [F.desc("w"), "lang"]).select("source", "lang", F.round(F.col("w") / F.col("t"), 6).alias("share"))


@query(
    "mode_and_median_consensus",
    """WITH m AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2), x AS (SELECT l_suppkey, arg_max(l_linenumber, (n, -l_linenumber)) AS layout FROM m GROUP BY 1)
SELECT l_suppkey, layout, median(l_quantity) AS edge, round(stddev_samp(l_discount), 6) AS spread, stddev_samp(l_discount) > 0.03 AS warn FROM lineitem JOIN x USING (l_suppkey) GROUP BY 1, 2""",
)
def mode_and_median_consensus(spark, folder):
    """The most frequent layout (the smallest of equals), the median edge and a warning on spread."""
    lines = table(spark, folder, "lineitem")
    mode = lines.groupBy("l_suppkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).groupBy("l_suppkey").agg(F.max(F.struct("n", (-F.col("l_linenumber")).alias("m"))).alias("x"))
    sd = F.stddev_samp("l_discount")
    stats = lines.groupBy("l_suppkey").agg(F.median("l_quantity").alias("edge"), F.round(sd, 6).alias("spread"), (sd > 0.03).alias("warn"))
    return stats.join(mode, "l_suppkey").select("l_suppkey", (-F.col("x.m")).alias("layout"), "edge", "spread", "warn")


@query(
    "upper_median_by_class",
    """WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents), g AS (SELECT n_chars AS m FROM (SELECT n_chars, row_number() OVER (ORDER BY n_chars) - 1 AS i, count(*) OVER () AS n FROM documents) WHERE i = n // 2)
SELECT lang, n, CASE WHEN n >= 130 THEN n_chars ELSE (SELECT m FROM g) END AS median FROM r WHERE i = n // 2""",
)
def upper_median_by_class(spark, folder):
    """The upper median of a class from counts per distinct value; a class with few samples (under 130 here) borrows the overall one."""
    counts = table(spark, folder, "documents").groupBy("lang", "n_chars").agg(F.count(F.lit(1)).alias("c"))

    def median(df, by):
        w = Window.partitionBy(*by).orderBy("n_chars")
        run = df.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy(*by)))
        mid = F.floor(F.col("n") / 2)
        return run.where((F.col("upto") > mid) & (F.col("upto") - F.col("c") <= mid))

    overall = median(counts.groupBy("n_chars").agg(F.sum("c").alias("c")).withColumn("all", F.lit(1)), ["all"]).select(F.col("n_chars").alias("m"))
    own = median(counts, ["lang"]).crossJoin(F.broadcast(overall))  # one row
    return own.select("lang", "n", F.when(F.col("n") >= 130, F.col("n_chars")).otherwise(F.col("m")).alias("median"))


@query(
    "severity_rollup",
    f"""WITH {E.NOTE_LINES}, f AS (
 SELECT note, 'long_line' AS code, 1 AS sev, count(*) AS n FROM note_lines WHERE length(line) > 400 GROUP BY 1 UNION ALL
 SELECT note, 'forbidden_term', 2, count(*) FROM note_lines WHERE contains(line, 'idiot') OR contains(line, 'moron') GROUP BY 1 UNION ALL
 SELECT note, 'unescaped_pipe', 1, count(*) FROM note_lines WHERE regexp_matches(line, '\\S\\|\\S') GROUP BY 1 UNION ALL
 SELECT note, 'space_indent', 0, count(*) FROM note_lines WHERE regexp_matches(line, '^ {{2,}}\\S') GROUP BY 1 UNION ALL
 SELECT note, 'leftover_todo', 1, count(*) FROM note_lines WHERE regexp_matches(line, '(?i)\\btodo\\b|lorem ipsum') GROUP BY 1 UNION ALL
 SELECT note, 'credential', 2, count(*) FROM note_lines WHERE regexp_matches(line, 'token = "|AKIA[A-Z0-9]+') GROUP BY 1),
s AS (SELECT note, max(sev) AS sev, count(*) FILTER (sev = 2) AS n_fail, count(*) FILTER (sev = 1) AS n_warn, string_agg(code || ':' || n, ',' ORDER BY code) AS findings FROM f GROUP BY 1), l AS (SELECT note, count(*) AS n_lines FROM note_lines GROUP BY 1)
SELECT l.note, n_lines, CASE coalesce(sev, 0) WHEN 2 THEN 'REGENERATE' WHEN 1 THEN 'REVIEW' ELSE 'OK' END AS verdict, coalesce(n_fail, 0) AS n_fail, coalesce(n_warn, 0) AS n_warn, coalesce(findings, '') AS findings FROM l LEFT JOIN s USING (note)""",
)
def severity_rollup(spark, folder):
    """Line rules of the note audit in one pass over the lines, then the worst severity; information never raises it."""
    line = F.col("line")
    rules = {
        "credential": (2, line.rlike('token = "|AKIA[A-Z0-9]+')),
        "forbidden_term": (2, T.any_contains(line, ["idiot", "moron"])),
        "leftover_todo": (1, line.rlike(r"(?i)\btodo\b|lorem ipsum")),
        "long_line": (1, F.length(line) > 400),
        "space_indent": (0, line.rlike(r"^ {2,}\S")),
        "unescaped_pipe": (1, line.rlike(r"\S\|\S")),
    }
    counts = E.note_lines(table(spark, folder, "documents")).groupBy("note").agg(F.count(F.lit(1)).alias("n_lines"), *[F.sum(test.cast("long")).alias(code) for code, (_, test) in rules.items()])
    level = lambda s: sum(((F.col(c) > 0).cast("long") for c, (v, _) in rules.items() if v == s), F.lit(0).cast("long"))
    found = F.concat_ws(",", *[F.when(F.col(c) > 0, F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))) for c in rules])
    verdict = F.when(level(2) > 0, "REGENERATE").when(level(1) > 0, "REVIEW").otherwise("OK")
    return counts.select("note", "n_lines", verdict.alias("verdict"), level(2).alias("n_fail"), level(1).alias("n_warn"), found.alias("findings"))


@query(
    "band_detection",
    """WITH p AS (SELECT vec_id, i, embedding[i] > t AS above, t FROM embeddings, unnest(range(1, 65)) AS u(i), (VALUES (0.0::DOUBLE), (0.05), (0.1)) AS s(t)),
a AS (SELECT *, lag(i) OVER (PARTITION BY vec_id, t ORDER BY i) AS was FROM p WHERE above), b AS (SELECT *, sum(CASE WHEN i - was <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY vec_id, t ORDER BY i) AS band FROM a),
r AS (SELECT vec_id, t, band, max(i) - min(i) + 1 AS w FROM b GROUP BY ALL), s AS (SELECT vec_id, t, count(*) AS n_bands, max(w) AS widest FROM r GROUP BY 1, 2)
SELECT vec_id, t AS threshold, n_bands, widest FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(n_bands - 12), t) AS k FROM s) WHERE k = 1""",
)
def band_detection(spark, folder):
    """Content bands of a profile, closed by a gap of two; of three thresholds the one nearest to twelve bands."""
    sweep = F.explode(F.array(F.lit(0.0), F.lit(0.05), F.lit(0.1)))
    cells = table(spark, folder, "embeddings").select("vec_id", sweep.alias("t"), "embedding").select("vec_id", "t", F.posexplode("embedding").alias("i", "x")).where(F.col("x") > F.col("t"))
    w = Window.partitionBy("vec_id", "t").orderBy("i")
    marked = cells.withColumn("new", F.when(F.col("i") - F.lag("i").over(w) <= 2, 0).otherwise(1)).withColumn("band", F.sum("new").over(w))
    bands = marked.groupBy("vec_id", "t", "band").agg((F.max("i") - F.min("i") + 1).alias("w"))
    rated = bands.groupBy("vec_id", "t").agg(F.count(F.lit(1)).alias("n_bands"), F.max("w").alias("widest"))
    return S.first_wins(rated, ["vec_id"], [F.abs(F.col("n_bands") - 12), "t"]).select("vec_id", F.col("t").alias("threshold"), "n_bands", "widest")


@query(
    "semantic_group_nospan",
    f"""WITH {E.SEGMENTS}, g AS (SELECT *, lag(end_ms) OVER w AS pe, lag(role) OVER w AS pr, lag(length(text)) OVER w AS pl FROM segments WINDOW w AS (PARTITION BY clip ORDER BY seg_idx)),
b AS (SELECT *, CASE WHEN start_ms - pe < 60000 AND least(length(text), pl) * 2 >= greatest(length(text), pl) THEN 0 ELSE 1 END AS nw FROM g), s AS (SELECT *, sum(nw) OVER (PARTITION BY clip ORDER BY seg_idx)::BIGINT AS grp FROM b)
SELECT clip, grp, min(seg_idx) AS first_seg, max(seg_idx) AS last_seg, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM s GROUP BY 1, 2""",
)
def semantic_group_nospan(spark, folder):
    """Neighbours group while the gap is under a minute and their lengths are within a factor of two (the stand-in's likeness)."""
    w = Window.partitionBy("clip").orderBy("seg_idx")
    rows = E.segments(table(spark, folder, "conversations")).withColumn("n", F.length("text"))
    near = (F.col("start_ms") - F.lag("end_ms").over(w) < 60000) & (F.least("n", F.lag("n").over(w)) * 2 >= F.greatest("n", F.lag("n").over(w)))
    grouped = rows.withColumn("nw", F.when(near, 0).otherwise(1)).withColumn("grp", F.sum("nw").over(w))
    return grouped.groupBy("clip", "grp").agg(F.min("seg_idx").alias("first_seg"), F.max("seg_idx").alias("last_seg"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))


@query(
    "benchmark_report_pivot",
    "SELECT engine, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM (SELECT *, l_suppkey % 10 AS engine FROM lineitem) GROUP BY 1",
)
def benchmark_report_pivot(spark, folder):
    """Engines against categories, counts as a pivot."""
    rows = table(spark, folder, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("engine")).pivot("l_returnflag", ["A", "N", "R"]).count()
    return rows.select("engine", *[F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("A", "N", "R")])
