"""Segments, recordings and blocks in time: runs, ranges, fills, spans, roll-ups, order checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators import sequences as S
from skein.operators.intervals import interval_join, overlap
from skein.plans.base import query, table
from skein.sources import entities as E


def _segments(spark, folder):
    return E.segments(table(spark, folder, "conversations"))


def _spans(spark, folder):
    return E.spans(table(spark, folder, "events"))


@query(
    "segments_clock_text",
    f"""WITH {E.SEGMENTS} SELECT clip, seg_idx, '[' || CASE WHEN s < 3600 THEN printf('%02d:%02d', s // 60, s % 60) ELSE printf('%d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) END || '] ' || trim(text) AS line
FROM (SELECT *, start_ms // 1000 AS s FROM segments)""",
)
def segments_clock_text(spark, folder):
    line = F.concat(F.lit("["), T.hms(F.col("start_ms") / 1000), F.lit("] "), F.trim("text"))
    return _segments(spark, folder).select("clip", "seg_idx", line.alias("line"))


@query(
    "transcript_bucket_30s",
    f"WITH {E.SEGMENTS} SELECT clip, start_ms // 30000 * 30 AS bucket_s, count(*) AS n, string_agg(text, ' ' ORDER BY seg_idx) AS text FROM segments GROUP BY 1, 2",
)
def transcript_bucket_30s(spark, folder):
    rows = _segments(spark, folder).withColumn("bucket_s", F.expr("start_ms div 30000 * 30"))
    texts = F.array_sort(F.collect_list(F.struct("seg_idx", "text")))  # a bucket is 30 seconds of one clip
    return rows.groupBy("clip", "bucket_s").agg(F.count(F.lit(1)).alias("n"), texts.alias("x")).select("clip", "bucket_s", "n", F.array_join("x.text", " ").alias("text"))


@query(
    "gaps_islands_runs",
    f"""WITH {E.SPANS}, m AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS nw FROM spans WINDOW w AS (PARTITION BY user_id ORDER BY start_s, event_id)),
i AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY start_s, event_id) AS island FROM m)
SELECT user_id, event_type, min(start_s) AS run_start, max(start_s) AS run_last, count(*) AS n FROM i GROUP BY user_id, island, event_type HAVING count(*) >= 3""",
)
def gaps_islands_runs(spark, folder):
    numbered = S.islands(_spans(spark, folder), ["user_id"], ["start_s", "event_id"], F.col("event_type"))
    runs = numbered.groupBy("user_id", "island", "event_type").agg(F.min("start_s").alias("run_start"), F.max("start_s").alias("run_last"), F.count(F.lit(1)).alias("n"))
    return runs.where("n >= 3").drop("island")


COLLAPSE = """f AS (SELECT *, end_ms - start_ms < 12000 AND length(trim(text)) < 180 AS short FROM segments),
k AS (SELECT *, CASE WHEN lag(short) OVER w = short THEN 0 ELSE 1 END AS nw FROM f WINDOW w AS (PARTITION BY clip ORDER BY seg_idx)),
g AS (SELECT *, sum(nw) OVER (PARTITION BY clip ORDER BY seg_idx) AS island FROM k)"""


@query(
    "collapse_signals",
    f"""WITH {E.SEGMENTS}, {COLLAPSE}, r AS (SELECT clip, island, short, count(*) AS n FROM g GROUP BY ALL)
SELECT clip, sum(n)::BIGINT AS n_segs, coalesce(sum(n) FILTER (short), 0)::BIGINT AS n_short, coalesce(max(n) FILTER (short), 0) AS longest_run,
  coalesce(max(n) FILTER (short), 0) >= 2 OR (sum(n) >= 4 AND coalesce(sum(n) FILTER (short), 0) / sum(n) >= 0.5) AS suspect FROM r GROUP BY 1""",
)
def collapse_signals(spark, folder):
    """Share and longest run of short segments; thresholds are scaled to the stand-in's longer turns."""
    short = (F.col("end_ms") - F.col("start_ms") < 12000) & (F.length(F.trim("text")) < 180)
    numbered = S.islands(_segments(spark, folder).withColumn("short", short), ["clip"], ["seg_idx"], F.col("short"))
    runs = numbered.groupBy("clip", "island", "short").agg(F.count(F.lit(1)).alias("n"))
    few, longest = F.coalesce(F.sum(F.when(F.col("short"), F.col("n"))), F.lit(0)), F.coalesce(F.max(F.when(F.col("short"), F.col("n"))), F.lit(0))
    return runs.groupBy("clip").agg(F.sum("n").alias("n_segs"), few.alias("n_short"), longest.alias("longest_run"), ((longest >= 2) | ((F.sum("n") >= 4) & (few / F.sum("n") >= 0.5))).alias("suspect"))


@query(
    "merge_ranges_tolerance",
    f"""WITH {E.SPANS}, m AS (SELECT *, max(end_s) OVER (PARTITION BY user_id, event_type ORDER BY start_s, end_s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
g AS (SELECT *, sum(CASE WHEN start_s <= reach + 5 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY start_s, end_s, event_id) AS r FROM m)
SELECT user_id, event_type, min(start_s) AS start_s, max(end_s) AS end_s, count(*) AS n_merged FROM g GROUP BY user_id, event_type, r""",
)
def merge_ranges_tolerance(spark, folder):
    return S.merge_ranges(_spans(spark, folder), ["user_id", "event_type"], "start_s", "end_s", 5, ["end_s", "event_id"])


@query(
    "forward_fill",
    f"""WITH {E.SPANS} SELECT * FROM (SELECT event_id, user_id, start_s, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY start_s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM spans) WHERE last_purchase IS NOT NULL""",
)
def forward_fill(spark, folder):
    rows = _spans(spark, folder).withColumn("stamp", F.when(F.col("event_type") == "purchase", F.col("value")))
    return S.forward_fill(rows, ["user_id"], ["start_s", "event_id"], "stamp", "last_purchase").select("event_id", "user_id", "start_s", "last_purchase")


@query(
    "consecutive_dedup",
    f"WITH {E.SPANS} SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY start_s, event_id) AS was FROM spans) WHERE was IS NULL OR was <> event_type",
)
def consecutive_dedup(spark, folder):
    return S.drop_repeats(_spans(spark, folder), ["user_id"], ["start_s", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query(
    "chain_break_gaps",
    f"""WITH {E.SPANS}, g AS (SELECT *, lead(start_s) OVER (PARTITION BY user_id ORDER BY start_s, event_id) - end_s AS gap FROM spans)
SELECT user_id, CASE WHEN gap < 0 THEN 'overlap' WHEN gap <= 5 THEN 'chain' WHEN gap >= 480 THEN 'break' ELSE 'pause' END AS kind, count(*) AS n, sum(gap)::BIGINT AS total_gap FROM g WHERE gap IS NOT NULL GROUP BY 1, 2""",
)
def chain_break_gaps(spark, folder):
    w = Window.partitionBy("user_id").orderBy("start_s", "event_id")
    gaps = _spans(spark, folder).withColumn("gap", F.lead("start_s").over(w) - F.col("end_s")).where("gap IS NOT NULL")
    kind = F.when(F.col("gap") < 0, "overlap").when(F.col("gap") <= 5, "chain").when(F.col("gap") >= 480, "break").otherwise("pause")
    return gaps.groupBy("user_id", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum("gap").alias("total_gap"))


@query(
    "chapter_rollup",
    f"""WITH {E.SEGMENTS}, b AS (SELECT *, seg_idx // 4 AS section, coalesce(lead(start_ms) OVER (PARTITION BY clip, seg_idx // 4 ORDER BY start_ms, seg_idx), start_ms + 45000) AS block_end FROM segments)
SELECT clip, section, min(start_ms) AS start_ms, max(block_end) AS end_ms, min(seg_idx) AS first_block, count(*) AS n_blocks, (max(block_end) - min(start_ms)) AS duration_ms FROM b GROUP BY 1, 2""",
)
def chapter_rollup(spark, folder):
    rows = _segments(spark, folder).withColumn("section", F.expr("seg_idx div 4"))
    blocks = S.until_next(rows, ["clip", "section"], ["start_ms", "seg_idx"], "start_ms", "block_end", F.col("start_ms") + 45000)
    out = blocks.groupBy("clip", "section").agg(F.min("start_ms").alias("start_ms"), F.max("block_end").alias("end_ms"), F.min("seg_idx").alias("first_block"), F.count(F.lit(1)).alias("n_blocks"))
    return out.withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))


@query(
    "keyword_in_context",
    f"WITH {E.SEGMENTS} SELECT h.clip, h.seg_idx AS hit, r.seg_idx, r.text FROM segments h JOIN segments r ON r.clip = h.clip AND abs(r.seg_idx - h.seg_idx) <= 1 WHERE contains(lower(h.text), 'thing')",
)
def keyword_in_context(spark, folder):
    rows = _segments(spark, folder)
    hits = rows.where(F.contains(F.lower("text"), F.lit("thing"))).select("clip", F.col("seg_idx").alias("hit")).withColumn("seg_idx", F.explode(F.sequence(F.col("hit") - 1, F.col("hit") + 1)))
    return hits.join(rows.select("clip", "seg_idx", "text"), ["clip", "seg_idx"])


@query(
    "order_drift",
    """SELECT o_custkey, count(*) AS n, sum((a <> b)::INT)::BIGINT AS n_drifted, max(o_orderkey) - min(o_orderkey) + 1 = count(DISTINCT o_orderkey) AS contiguous FROM
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS a, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) GROUP BY 1""",
)
def order_drift(spark, folder):
    """Places by time against places by id, and whether ids are a dense range."""
    by = Window.partitionBy("o_custkey")
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderkey", F.row_number().over(by.orderBy("o_orderdate", "o_orderkey")).alias("a"), F.row_number().over(by.orderBy("o_orderkey")).alias("b"))
    dense = F.max("o_orderkey") - F.min("o_orderkey") + 1 == F.count_distinct("o_orderkey")
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("a") != F.col("b")).cast("long")).alias("n_drifted"), dense.alias("contiguous"))


@query(
    "contiguity",
    "SELECT l_orderkey, count(DISTINCT l_linenumber) AS n_lines, max(l_linenumber) - min(l_linenumber) + 1 = count(DISTINCT l_linenumber) AS contiguous FROM lineitem GROUP BY 1",
)
def contiguity(spark, folder):
    n = F.count_distinct("l_linenumber")
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(n.alias("n_lines"), (F.max("l_linenumber") - F.min("l_linenumber") + 1 == n).alias("contiguous"))


@query(
    "play_order",
    f"""WITH {E.SPANS}, s AS (SELECT user_id, event_type, min(start_s) AS t, max(event_id) AS shown FROM spans GROUP BY 1, 2)
SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY shown) AS display_rank, row_number() OVER (PARTITION BY user_id ORDER BY t, event_type) AS clip_rank FROM s""",
)
def play_order(spark, folder):
    groups = _spans(spark, folder).groupBy("user_id", "event_type").agg(F.min("start_s").alias("t"), F.max("event_id").alias("shown"))
    by = Window.partitionBy("user_id")
    return groups.select("user_id", "event_type", F.row_number().over(by.orderBy("shown")).alias("display_rank"), F.row_number().over(by.orderBy("t", "event_type")).alias("clip_rank"))


@query(
    "even_spread",
    f"""WITH {E.SPANS}, p AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n, min(start_s) OVER (PARTITION BY user_id) AS t0, max(end_s) OVER (PARTITION BY user_id) AS t1, lead(start_s) OVER w AS nxt FROM spans WINDOW w AS (PARTITION BY user_id ORDER BY start_s, event_id))
SELECT event_id, floor(i * ((t1 - t0) / n::DOUBLE))::BIGINT AS even_start, start_s - t0 AS clock_start, coalesce(nxt, t1) - t0 AS clock_end FROM p""",
)
def even_spread(spark, folder):
    """Two placements of images on a talk's clock: evenly, and by their own capture time until the next one's."""
    by = Window.partitionBy("user_id")
    w = by.orderBy("start_s", "event_id")
    rows = _spans(spark, folder).select("event_id", "start_s", (F.row_number().over(w) - 1).alias("i"), F.count(F.lit(1)).over(by).alias("n"), F.min("start_s").over(by).alias("t0"), F.max("end_s").over(by).alias("t1"), F.lead("start_s").over(w).alias("nxt"))
    return rows.select("event_id", F.floor(F.col("i") * ((F.col("t1") - F.col("t0")) / F.col("n"))).cast("long").alias("even_start"), (F.col("start_s") - F.col("t0")).alias("clock_start"), (F.coalesce("nxt", "t1") - F.col("t0")).alias("clock_end"))


@query(
    "first_owner_naming",
    """WITH o AS (SELECT l_partkey, min((l_orderkey, l_linenumber)) AS f FROM lineitem GROUP BY 1)
SELECT l_partkey, f[1] AS owner, row_number() OVER (PARTITION BY f[1] ORDER BY f[2], l_partkey) AS seq FROM o""",
)
def first_owner_naming(spark, folder):
    """Each part belongs to the first order that lists it and is numbered within that order."""
    first = table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.min(F.struct("l_orderkey", "l_linenumber")).alias("f"))
    seq = F.row_number().over(Window.partitionBy("f.l_orderkey").orderBy("f.l_linenumber", "l_partkey"))
    return first.select("l_partkey", F.col("f.l_orderkey").alias("owner"), seq.alias("seq"))


@query(
    "heading_audit",
    f"""WITH {E.NOTE_LINES}, h AS (SELECT *, length(line) BETWEEN 1 AND 40 AS head FROM note_lines),
g AS (SELECT *, sum(head::INT) OVER (PARTITION BY note ORDER BY line_no) AS sec FROM h)
SELECT note, min(line_no) AS heading_line, count(*) - 1 AS n_lines, sum(CASE WHEN head OR trim(line) = '' THEN 0 ELSE 1 END)::BIGINT AS n_body FROM g WHERE sec > 0 GROUP BY note, sec""",
)
def heading_audit(spark, folder):
    """Short lines as headings; lines and non-blank lines of each until the next one (0: an empty heading)."""
    head = F.length("line").between(1, 40)
    w = Window.partitionBy("note").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = E.note_lines(table(spark, folder, "documents")).withColumn("head", head).withColumn("sec", F.sum(F.col("head").cast("int")).over(w)).where("sec > 0")
    body = F.sum(F.when(F.col("head") | (F.trim("line") == ""), 0).otherwise(1))
    return rows.groupBy("note", "sec").agg(F.min("line_no").alias("heading_line"), (F.count(F.lit(1)) - 1).alias("n_lines"), body.alias("n_body")).drop("sec")


@query(
    "gallery_runs",
    f"""WITH {E.NOTE_LINES}, t AS (SELECT *, contains(line, ' | ') AS is_row FROM note_lines WHERE trim(line) <> ''),
k AS (SELECT *, CASE WHEN lag(is_row) OVER (PARTITION BY note ORDER BY line_no) = is_row THEN 0 ELSE 1 END AS nw FROM t),
g AS (SELECT *, sum(nw) OVER (PARTITION BY note ORDER BY line_no) AS island FROM k)
SELECT note, min(line_no) AS first_line, max(line_no) AS last_line, count(*) AS n FROM g WHERE is_row GROUP BY note, island HAVING count(*) >= 3""",
)
def gallery_runs(spark, folder):
    """Runs of three or more table lines, blank lines ignored."""
    rows = E.note_lines(table(spark, folder, "documents")).where(F.trim("line") != "").withColumn("is_row", F.contains("line", F.lit(" | ")))
    blocks = S.islands(rows, ["note"], ["line_no"], F.col("is_row")).where("is_row").groupBy("note", "island")
    return blocks.agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count(F.lit(1)).alias("n")).where("n >= 3").drop("island")


@query(
    "chunk_coverage",
    f"""WITH {E.SEGMENTS}, c AS (SELECT *, lead(start_ms) OVER (PARTITION BY clip ORDER BY seg_idx) AS nxt FROM segments)
SELECT clip, count(*) AS n_chunks, (max(end_ms) + 29999) // 30000 AS expected, bool_and(nxt IS NULL OR nxt = end_ms) AS contiguous FROM c GROUP BY 1""",
)
def chunk_coverage(spark, folder):
    w = Window.partitionBy("clip").orderBy("seg_idx")
    rows = _segments(spark, folder).withColumn("nxt", F.lead("start_ms").over(w))
    return rows.groupBy("clip").agg(F.count(F.lit(1)).alias("n_chunks"), F.expr("(max(end_ms) + 29999) div 30000").alias("expected"), F.bool_and(F.col("nxt").isNull() | (F.col("nxt") == F.col("end_ms"))).alias("contiguous"))


#: White space around a text, and ends of lines, as Python's strip() and splitlines() know them.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
OUTER_SPACE = rf"\A{_SPACE}|{_SPACE}\z"
LINE_END = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


@query(
    "time_interleave",
    f"""WITH {E.SEGMENTS}, {E.SLIDES}, u AS (SELECT clip, start_s * 1000 AS t, 0 AS kind, pos, array_to_string(string_split_regex(regexp_replace(quick_text, '{OUTER_SPACE}', '', 'g'), '{LINE_END}')[1:6], ' / ') AS text FROM slides UNION ALL SELECT clip, start_ms, 1, seg_idx, text FROM segments)
SELECT *, row_number() OVER (PARTITION BY clip ORDER BY t, kind, pos) AS place FROM u""",
)
def time_interleave(spark, folder):
    """Slides and speech of a clip in one order of time, slides first at equal times; whole speech, the first six lines of a slide (the reference's feature)."""
    lines = F.split(F.regexp_replace("quick_text", OUTER_SPACE, ""), LINE_END, -1)
    slides = E.slides(table(spark, folder, "documents")).select("clip", (F.col("start_s") * 1000).alias("t"), F.lit(0).alias("kind"), "pos", F.array_join(F.slice(lines, 1, 6), " / ").alias("text"))
    speech = _segments(spark, folder).select("clip", F.col("start_ms").alias("t"), F.lit(1).alias("kind"), F.col("seg_idx").alias("pos"), "text")
    return slides.unionByName(speech).withColumn("place", F.row_number().over(Window.partitionBy("clip").orderBy("t", "kind", "pos")))


@query(
    "playback_lookup",
    f"""WITH {E.SEGMENTS}, {E.SLIDES}, t AS (SELECT slide_id, clip, start_s * 1000 AS t FROM slides),
m AS (SELECT t.slide_id, g.seg_idx, row_number() OVER (PARTITION BY t.slide_id ORDER BY CASE WHEN role = 'assistant' THEN 0 ELSE 1 END, g.seg_idx) AS r, count(*) OVER (PARTITION BY t.slide_id) AS n FROM t JOIN segments g ON g.clip = t.clip AND g.start_ms - 150 <= t.t AND t.t < g.end_ms + 150)
SELECT slide_id, seg_idx, n AS n_blocks FROM m WHERE r = 1""",
)
def playback_lookup(spark, folder):
    """The block playing at a slide's time: within 0.15 s, assistant's blocks first, then the earliest."""
    slides = E.slides(table(spark, folder, "documents")).select("slide_id", F.col("clip").alias("s_clip"), (F.col("start_s") * 1000).alias("t"))
    blocks = _segments(spark, folder).select("clip", "seg_idx", "role", (F.col("start_ms") - 150).alias("a"), (F.col("end_ms") + 149).alias("b"))
    met = interval_join(slides, blocks, [("s_clip", "clip")], ("t", "t"), ("a", "b"), 60_000)
    w = Window.partitionBy("slide_id")
    ranked = met.withColumn("r", F.row_number().over(w.orderBy(F.when(F.col("role") == "assistant", 0).otherwise(1), "seg_idx"))).withColumn("n_blocks", F.count(F.lit(1)).over(w))
    return ranked.where("r = 1").select("slide_id", "seg_idx", "n_blocks")


RIGS = """days AS (SELECT user_id, user_id // 10 AS rig, start_s // 86400 AS day, min(start_s) AS a, max(end_s) AS b FROM spans GROUP BY ALL)"""


def rigs(spans):
    """A recording per user and day: from the first event to the last end; ten users share a rig."""
    return spans.groupBy("user_id", F.expr("user_id div 10").alias("rig"), F.expr("start_s div 86400").alias("day")).agg(F.min("start_s").alias("a"), F.max("end_s").alias("b"))


def _pairs(spark, folder):
    one = rigs(_spans(spark, folder))
    two = one.select(*[F.col(c).alias(f"{c}2") for c in one.columns])
    return interval_join(one, two, [("rig", "rig2")], ("a", "b"), ("a2", "b2"), 86400, closed=False).where(F.struct("user_id", "day") < F.struct(F.col("user_id2").alias("user_id"), F.col("day2").alias("day")))


@query(
    "interval_self_overlap",
    f"""WITH {E.SPANS}, {RIGS} SELECT x.user_id, x.day, y.user_id AS user_id2, y.day AS day2, least(x.b, y.b) - greatest(x.a, y.a) AS seconds FROM days x JOIN days y ON x.rig = y.rig AND (x.user_id, x.day) < (y.user_id, y.day) AND x.a < y.b AND y.a < x.b""",
)
def interval_self_overlap(spark, folder):
    return _pairs(spark, folder).select("user_id", "day", "user_id2", "day2", overlap(F.col("a"), F.col("b"), F.col("a2"), F.col("b2")).alias("seconds"))


@query(
    "parallel_tracks_unpaired",
    f"""WITH {E.SPANS}, {RIGS}, p AS (SELECT x.user_id, x.day, y.user_id AS user_id2, y.day AS day2 FROM days x JOIN days y ON x.rig = y.rig AND (x.user_id, x.day) < (y.user_id, y.day) AND least(x.b, y.b) - greatest(x.a, y.a) > 60),
k AS (SELECT DISTINCT user_id, start_s // 86400 AS day, event_type FROM spans WHERE value > 100)
SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM k JOIN k AS k2 ON k.event_type = k2.event_type WHERE k.user_id = p.user_id AND k.day = p.day AND k2.user_id = p.user_id2 AND k2.day = p.day2)""",
)
def parallel_tracks_unpaired(spark, folder):
    """Recordings over a minute in parallel whose segments (large event types of a day) have none in common."""
    long = _pairs(spark, folder).where(overlap(F.col("a"), F.col("b"), F.col("a2"), F.col("b2")) > 60).select("user_id", "day", "user_id2", "day2")
    seg = _spans(spark, folder).where("value > 100").select("user_id", F.expr("start_s div 86400").alias("day"), "event_type").distinct()
    kinds = seg.groupBy("user_id", "day").agg(F.collect_set("event_type").alias("kinds"))
    two = kinds.select(F.col("user_id").alias("user_id2"), F.col("day").alias("day2"), F.col("kinds").alias("kinds2"))
    both = long.join(kinds, ["user_id", "day"], "left").join(two, ["user_id2", "day2"], "left")
    return both.where(~F.coalesce(F.arrays_overlap("kinds", "kinds2"), F.lit(False))).select("user_id", "day", "user_id2", "day2")


@query(
    "photo_during",
    f"""WITH {E.SPANS}, photos AS (SELECT event_id AS photo, user_id // 10 AS rig, user_id, start_s AS t FROM spans WHERE event_type = 'view'),
rec AS (SELECT event_id, user_id, user_id // 10 AS rig, start_s, end_s FROM spans WHERE event_type = 'purchase')
SELECT p.photo, count(r.event_id) AS n_running, coalesce(string_agg(r.event_id::VARCHAR, ',' ORDER BY r.event_id), '') AS during FROM photos p LEFT JOIN rec r ON r.rig = p.rig AND p.t BETWEEN r.start_s AND r.end_s GROUP BY 1""",
)
def photo_during(spark, folder):
    """The recordings of a rig that run while a photo is taken; photos outside all keep their row."""
    spans = _spans(spark, folder)
    photos = spans.where("event_type = 'view'").select(F.col("event_id").alias("photo"), F.expr("user_id div 10").alias("p_rig"), F.col("start_s").alias("t"))
    rec = spans.where("event_type = 'purchase'").select("event_id", F.expr("user_id div 10").alias("rig"), "start_s", "end_s")
    met = interval_join(photos, rec, [("p_rig", "rig")], ("t", "t"), ("start_s", "end_s"), 14_400, left_key=["photo"])
    ids = F.array_sort(F.collect_list("event_id"))
    return met.groupBy("photo").agg(F.count("event_id").alias("n_running"), F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("during"))


@query(
    "claim_vs_measured_conflict",
    f"""WITH {E.SPANS}, claim AS (SELECT user_id, start_s // 86400 AS day, min(start_s) AS claimed, count(*) AS n FROM spans GROUP BY 1, 2),
meas AS (SELECT user_id, start_s // 86400 AS day, min(start_s) AS measured FROM spans WHERE event_type <> 'error' GROUP BY 1, 2)
SELECT user_id, day, claimed, measured, n >= 2 AS reliable, coalesce(n >= 2 AND abs(claimed - measured) > 5, false) AS conflict FROM claim LEFT JOIN meas USING (user_id, day)""",
)
def claim_vs_measured_conflict(spark, folder):
    """Claimed starts against measured ones: over 5 s apart is a conflict unless the source is unreliable."""
    spans = _spans(spark, folder).withColumn("day", F.expr("start_s div 86400"))
    both = spans.groupBy("user_id", "day").agg(F.min("start_s").alias("claimed"), F.min(F.when(F.col("event_type") != "error", F.col("start_s"))).alias("measured"), F.count(F.lit(1)).alias("n"))
    far = F.coalesce((F.col("n") >= 2) & (F.abs(F.col("claimed") - F.col("measured")) > 5), F.lit(False))
    return both.select("user_id", "day", "claimed", "measured", (F.col("n") >= 2).alias("reliable"), far.alias("conflict"))


@query(
    "replacement_merge",
    f"""WITH {E.SEGMENTS}, rep AS (SELECT clip, seg_idx, start_ms AS a, end_ms AS b FROM segments WHERE seg_idx % 3 = 0 AND length(text) > 100),
r AS (SELECT clip, seg_idx, a + (b - a) // 4 AS a, b + (b - a) // 4 AS b FROM rep),
kept AS (SELECT g.* FROM segments g WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.clip = g.clip AND least(r.b, g.end_ms) - greatest(r.a, g.start_ms) > 0 AND 2 * (least(r.b, g.end_ms) - greatest(r.a, g.start_ms)) >= g.end_ms - g.start_ms))
SELECT clip, start_ms, end_ms, 'master' AS origin, row_number() OVER () * 0 AS z FROM kept UNION ALL SELECT clip, a, b, 'replacement', 0 FROM r""".replace(", row_number() OVER () * 0 AS z", "").replace("'replacement', 0", "'replacement'"),
)
def replacement_merge(spark, folder):
    """Master segments at least half covered by a replacement go; every replacement is inserted once."""
    rows = _segments(spark, folder)
    span = F.expr("(end_ms - start_ms) div 4")
    rep = rows.where("seg_idx % 3 = 0 AND length(text) > 100").select(F.col("clip").alias("r_clip"), (F.col("start_ms") + span).alias("ra"), (F.col("end_ms") + span).alias("rb"))
    return replace_segments(rows.select("clip", "seg_idx", "start_ms", "end_ms"), rep)


def replace_segments(master, rep):
    """``master`` (clip, seg_idx, start_ms, end_ms) with ``rep`` (r_clip, ra, rb) merged in; an empty ``rep`` changes nothing."""
    met = interval_join(master, rep, [("clip", "r_clip")], ("start_ms", "end_ms"), ("ra", "rb"), 60_000, closed=False)
    shared = overlap(F.col("start_ms"), F.col("end_ms"), F.col("ra"), F.col("rb"))
    gone = met.where((shared > 0) & (2 * shared >= F.col("end_ms") - F.col("start_ms"))).select("clip", "seg_idx").distinct()
    kept = master.join(gone, ["clip", "seg_idx"], "left_anti").select("clip", "start_ms", "end_ms", F.lit("master").alias("origin"))
    return kept.unionByName(rep.select(F.col("r_clip").alias("clip"), F.col("ra").alias("start_ms"), F.col("rb").alias("end_ms"), F.lit("replacement").alias("origin")))


@query(
    "interval_coverage_ratio",
    f"""WITH {E.SPANS}, m AS (SELECT *, max(end_s) OVER (PARTITION BY user_id ORDER BY start_s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans WHERE event_type <> 'click'),
g AS (SELECT *, sum(CASE WHEN start_s <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY start_s, event_id) AS r FROM m),
own AS (SELECT user_id, min(start_s) AS a, max(end_s) AS b FROM g GROUP BY user_id, r),
c AS (SELECT s.event_id, s.end_s - s.start_s AS dur, coalesce(sum(greatest(least(o.b, s.end_s) - greatest(o.a, s.start_s), 0)), 0)::BIGINT AS covered FROM spans s LEFT JOIN own o ON o.user_id = s.user_id + 1 AND o.a < s.end_s AND s.start_s < o.b WHERE s.event_type = 'click' GROUP BY 1, 2)
SELECT event_id, covered, dur > 0 AND covered * 10 >= dur * 7 AS duplicate FROM c""",
)
def interval_coverage_ratio(spark, folder):
    """Clips at least 70 % covered by the neighbouring source's merged recordings count as duplicates."""
    spans = _spans(spark, folder)
    own = S.merge_ranges(spans.where("event_type <> 'click'"), ["user_id"], "start_s", "end_s", 0, ["event_id"]).select((F.col("user_id") - 1).alias("near"), F.col("start_s").alias("a"), F.col("end_s").alias("b"))
    clips = spans.where("event_type = 'click'").select("event_id", "user_id", "start_s", "end_s")
    met = interval_join(clips, own, [("user_id", "near")], ("start_s", "end_s"), ("a", "b"), 14_400, closed=False, left_key=["event_id"])
    shared = F.sum(F.greatest(overlap(F.col("start_s"), F.col("end_s"), F.col("a"), F.col("b")), F.lit(0)))
    out = met.groupBy("event_id", (F.col("end_s") - F.col("start_s")).alias("dur")).agg(F.coalesce(shared, F.lit(0)).alias("covered"))
    return out.select("event_id", "covered", ((F.col("dur") > 0) & (F.col("covered") * 10 >= F.col("dur") * 7)).alias("duplicate"))


@query(
    "wall_clock_range",
    f"WITH {E.SPANS} SELECT event_id, user_id, start_s, end_s, strftime(make_timestamp(start_s * 1000000), '%Y-%m-%d %H:%M:%S') AS wall FROM spans WHERE start_s BETWEEN epoch(TIMESTAMP '2024-01-10 08:00:00') AND epoch(TIMESTAMP '2024-01-12 17:30:59')",
)
def wall_clock_range(spark, folder):
    """Closed range of wall-clock times; on the scan the bounds reach the timestamp column itself."""
    events = table(spark, folder, "events")
    seconds = lambda t: F.expr(f"cast(floor(unix_micros(cast(timestamp_ntz'{t}' as timestamp)) / 1000000) as bigint)")
    rows = E.spans(events).where(F.col("start_s").between(seconds("2024-01-10 08:00:00"), seconds("2024-01-12 17:30:59")))
    wall = F.date_format(F.timestamp_seconds("start_s"), "yyyy-MM-dd HH:mm:ss")
    return rows.select("event_id", "user_id", "start_s", "end_s", wall.alias("wall"))


@query(
    "plan_validate",
    f"""WITH {E.SPANS}, o AS (SELECT user_id, event_id, start_s, lag(end_s) OVER (PARTITION BY user_id ORDER BY start_s, event_id) AS was FROM (SELECT * REPLACE (CASE WHEN event_type = 'error' THEN end_s + 60 ELSE end_s END AS end_s) FROM spans))
SELECT user_id, count(*) AS n_rows, coalesce(sum((was > start_s)::INT), 0)::BIGINT AS n_overlaps FROM o GROUP BY 1""",
)
def plan_validate(spark, folder):
    """Rows of a plan that start before the row ahead of them ends."""
    rows = _spans(spark, folder).withColumn("end_s", F.when(F.col("event_type") == "error", F.col("end_s") + 60).otherwise(F.col("end_s")))
    was = F.lag("end_s").over(Window.partitionBy("user_id").orderBy("start_s", "event_id"))
    return rows.withColumn("was", was).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum((F.col("was") > F.col("start_s")).cast("long")), F.lit(0)).alias("n_overlaps"))
