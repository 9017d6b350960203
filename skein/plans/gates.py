"""Gates, file order, roll-ups of runs and the readers' shapes, on stand-ins made of the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skein.operators import gates as G
from skein.operators.folds import semantic_groups
from skein.operators.sequences import first_wins, ranked
from skein.plans.base import query, table
from skein.plans.rules import SIGNALS, signals
from skein.sources import entities as E
from skein.sources import readers as R

_GUARD = "[A-Za-z][A-Za-z0-9\\-]{2,}|[\\x{4e00}-\\x{9fff}]{2,}"


def _sql_names(text: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({text}, '{_GUARD}'), lambda w: lower(w)))"


@query(
    "slide_gates",
    f"""WITH {SIGNALS}, s AS (SELECT *, doc_id % 5 <> 0 AND doc_id % 3 = 0 AS skipped, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id % 2 = 0 END AS canonical, CASE WHEN doc_id % 4 = 0 THEN [] ELSE types END AS done, doc_id % 4 + 1 AS tier, CASE WHEN doc_id % 6 = 1 THEN 'dup' WHEN doc_id % 6 = 2 THEN '' END AS suppressed FROM signals)
SELECT doc_id, coalesce(canonical, false) AS canonical, tier <= 2 AND coalesce(suppressed, '') = '' AS embeddable, skipped OR len(done) > 0 AS complete FROM s""",
)
def slide_gates(spark, folder):
    """Which slides are canonical, may be embedded, and are done by an earlier run."""
    i, rows = F.col("doc_id"), signals(table(spark, folder, "documents"))
    flag = F.when(i % 7 == 0, None).otherwise(i % 2 == 0)
    done = F.when(i % 4 == 0, F.array().cast("array<string>")).otherwise(F.col("types"))
    yes, no = G.canonical_split(rows, flag)
    both = yes.withColumn("canonical", F.lit(True)).unionByName(no.withColumn("canonical", F.lit(False)))
    suppressed = F.when(i % 6 == 1, "dup").when(i % 6 == 2, "")
    return both.select("doc_id", "canonical", G.embeddable(i % 4 + 1, suppressed).alias("embeddable"), G.complete((i % 5 != 0) & (i % 3 == 0), done).alias("complete"))


@query(
    "cache_paste_guard",
    f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN left(d.text, 40) ELSE d.text END AS ocr, CASE WHEN doc_id % 4 = 0 THEN [] ELSE regexp_extract_all(coalesce(CASE WHEN doc_id % 4 = 1 THEN b.text ELSE d.text END, ''), '[^ \\n]+')[1:5] END AS labels, CASE doc_id % 6 WHEN 0 THEN ['flowchart'] ELSE ['title'] END AS types, b.text AS other FROM documents d LEFT JOIN benchmark b ON b.item_id = doc_id % 50),
n AS (SELECT *, {_sql_names("array_to_string(labels, ' ')")} AS own, {_sql_names("ocr")} AS seen, {_sql_names("left(coalesce(other, ''), 200) || ' ' || left(ocr, doc_id % 400)")} AS written FROM d)
SELECT doc_id, len(own) = 0 OR length(ocr) < 60 OR len(list_intersect(own, seen)) / len(own) >= 0.2 AS allowed,
  coalesce(len(list_intersect(seen, written)) / nullif(len(seen), 0), 0) > 0.7 AND types <> ['flowchart'] AS suppressed FROM n""",
)
def cache_paste_guard(spark, folder):
    """Labels of the slide's own text or of another's; and whether what is written makes the picture superfluous."""
    i = F.col("doc_id")
    other = table(spark, folder, "benchmark").select(F.col("item_id").alias("_i"), F.col("text").alias("other"))
    rows = table(spark, folder, "documents").join(other, i % 50 == F.col("_i"), "left")
    ocr = F.when(i % 5 == 0, F.left("text", F.lit(40))).otherwise(F.col("text"))
    labels = F.when(i % 4 == 0, F.array().cast("array<string>")).otherwise(F.slice(F.regexp_extract_all(F.coalesce(F.when(i % 4 == 1, F.col("other")).otherwise(F.col("text")), F.lit("")), F.lit("[^ \\n]+"), F.lit(0)), 1, 5))
    written = F.concat(F.left(F.coalesce("other", F.lit("")), F.lit(200)), F.lit(" "), F.left(ocr, (i % 400).cast("int")))
    types = F.when(i % 6 == 0, F.array(F.lit("flowchart"))).otherwise(F.array(F.lit("title")))
    return rows.select("doc_id", G.paste_allowed(labels, ocr).alias("allowed"), G.overlap_suppressed(ocr, written, types).alias("suppressed"))


_STAGE = "SELECT event_type AS stage, value, event_id % 3 <> 0 AND event_type <> 'view' AS called, event_id % 7 = 0 OR (event_type = 'error' AND event_id % 2 = 0) AS failed FROM events"


@query(
    "stage_gates",
    f"""WITH s AS ({_STAGE}), c AS (SELECT stage, count(*) AS n_input, count(*) FILTER (called) AS n_called, count(*) FILTER (called AND failed) AS n_failed, avg(value) FILTER (called) AS mean_s FROM s GROUP BY 1)
SELECT stage, n_input, n_called, n_failed, round(mean_s, 6) AS mean_s, round(n_failed / nullif(n_called, 0)::DOUBLE, 6) AS fail_ratio, round((n_input - n_called) * mean_s, 1) AS eta_s,
  CASE WHEN n_called = 0 THEN 'nothing_attempted' WHEN n_failed / nullif(n_called, 0)::DOUBLE > 0.2 THEN 'failed' ELSE 'ok' END AS verdict FROM c""",
)
def stage_gates(spark, folder):
    """Counters, running estimate and verdict of every stage of the event log."""
    i, kind = F.col("event_id"), F.col("event_type")
    rows = table(spark, folder, "events").select(kind.alias("stage"), "value", ((i % 3 != 0) & (kind != "view")).alias("called"), ((i % 7 == 0) | ((kind == "error") & (i % 2 == 0))).alias("failed"))
    counted = G.counters(rows, "stage", F.col("called"), F.col("failed"), F.col("value"))
    return counted.select("stage", "n_input", "n_called", "n_failed", F.round("mean_s", 6).alias("mean_s"), F.round("fail_ratio", 6).alias("fail_ratio"), "eta_s", G.verdict(F.col("n_called"), F.col("fail_ratio")).alias("verdict"))


@query(
    "tail_coverage",
    f"WITH {E.SEGMENTS}, p AS (SELECT clip, max(end_ms) / 1000.0::DOUBLE AS said, max(end_ms) FILTER (seg_idx % 3 <> 2) / 1000.0::DOUBLE AS planned FROM segments GROUP BY 1) SELECT clip, said, planned, coalesce(said - planned > 60, true) AS uncovered FROM p",
)
def tail_coverage(spark, folder):
    """Clips whose plan (every row but each third) ends more than a minute before their speech."""
    rows = E.segments(table(spark, folder, "conversations"))
    ends = rows.groupBy("clip").agg((F.max("end_ms") / 1000).alias("said"), (F.max(F.when(F.col("seg_idx") % 3 != 2, F.col("end_ms"))) / 1000).alias("planned"))
    return ends.select("clip", "said", "planned", F.coalesce(F.col("said") - F.col("planned") > 60, F.lit(True)).alias("uncovered"))


_EXT = ["mp4", "MTS", "jpg", "mp3", "mov", "wav"]
MEDIA = f"""media AS (SELECT event_id, user_id % 7 AS source, lpad(event_id::VARCHAR, 7, '0') || '.' || {_EXT}[event_id % 6 + 1] AS file, CASE event_id % 6 WHEN 2 THEN 'photo' WHEN 3 THEN 'audio' WHEN 5 THEN 'audio' ELSE 'video' END AS kind,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE epoch_us(ts) END AS start_us, CASE WHEN event_id % 6 = 2 THEN 0 ELSE event_id % 900 END AS duration_s, ['aac', 'ac3', NULL, 'Opus', 'pcm_s16le'][event_id % 5 + 1] AS codec FROM events)"""


def media(events):
    """Media files of a course, one per event: source, file, kind, start (some have none), seconds, sound codec."""
    i = F.col("event_id")
    kind = F.when(i % 6 == 2, "photo").when((i % 6).isin(3, 5), "audio").otherwise("video")
    ext = F.element_at(F.array(*map(F.lit, _EXT)), (i % 6).cast("int") + 1)
    codec = F.element_at(F.array(*[F.lit(x) for x in ("aac", "ac3", None, "Opus", "pcm_s16le")]), (i % 5).cast("int") + 1)
    start = F.when(i % 9 != 0, F.expr("unix_micros(cast(ts as timestamp))"))
    return events.select("event_id", (F.col("user_id") % 7).alias("source"), F.concat(F.lpad(i.cast("string"), 7, "0"), F.lit("."), ext).alias("file"), kind.alias("kind"), start.alias("start_us"), F.when(i % 6 == 2, 0).otherwise(i % 900).alias("duration_s"), codec.alias("codec"))


@query(
    "chronological_index",
    f"WITH {MEDIA} SELECT source, file, kind, start_us, row_number() OVER (ORDER BY start_us IS NULL, start_us, file) AS place FROM media WHERE kind <> 'audio'",
)
def chronological_index(spark, folder):
    """Videos and photos in order of time, those without one last by name."""
    rows = media(table(spark, folder, "events")).where("kind <> 'audio'").select("source", "file", "kind", "start_us")
    return ranked(rows, [F.col("start_us").asc_nulls_last(), "file"], "place")


@query(
    "chronological_totals",
    f"""WITH {MEDIA}, a AS (SELECT * FROM media WHERE kind <> 'audio' UNION ALL SELECT * FROM media WHERE kind = 'audio'),
l AS (SELECT source, file, row_number() OVER (PARTITION BY source ORDER BY duration_s DESC, file) AS r FROM a WHERE kind <> 'photo')
SELECT a.source, count(*) AS n_files, count(start_us) AS n_timed, count(*) - count(start_us) AS n_untimed, count(DISTINCT start_us // 86400000000) AS n_days, round(sum(duration_s) / 3600.0::DOUBLE, 6) AS hours, max(l.file) AS longest FROM a JOIN l ON l.source = a.source AND r = 1 GROUP BY 1""",
)
def chronological_totals(spark, folder):
    """Per source, over the index and the sound files: files with and without a time, days, hours, the longest source."""
    every = media(table(spark, folder, "events"))
    rows = every.where("kind <> 'audio'").unionByName(every.where("kind = 'audio'"))
    longest = first_wins(rows.where("kind <> 'photo'"), ["source"], [F.desc("duration_s"), "file"]).select(F.col("source").alias("_s"), F.col("file").alias("longest"))
    days = F.count_distinct(F.floor(F.col("start_us") / 86400000000))
    sums = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_files"), F.count("start_us").alias("n_timed"), (F.count(F.lit(1)) - F.count("start_us")).alias("n_untimed"), days.alias("n_days"), F.round(F.sum("duration_s") / 3600, 6).alias("hours"))
    return sums.join(longest, F.col("source") == F.col("_s")).drop("_s")


@query(
    "reencode_plan",
    f"""WITH {MEDIA} SELECT file, left(file, length(file) - length(regexp_extract(file, '([.][^.]*)$', 1))) AS stem, lower(regexp_extract(file, '([.][^.]*)$', 1)) = '.mts' OR coalesce(lower(codec), '?') NOT IN ('aac', 'mp3', 'opus', 'vorbis') AS encode, regexp_extract(file, '([.][^.]*)$', 1) AS ext FROM media WHERE kind = 'video'""",
)
def reencode_plan(spark, folder):
    name = F.col("file")
    return media(table(spark, folder, "events")).where("kind = 'video'").select("file", G.stem(name).alias("stem"), G.needs_encoding(name, F.col("codec")).alias("encode"), F.regexp_extract(name, r"(\.[^.]*)$", 1).alias("ext"))


@query(
    "ordering_source",
    """WITH f AS (SELECT event_id // 6 AS course, 'img' || (event_id % 6 * 7 % 13) || '.jpg' AS name, CASE WHEN event_id // 6 % 5 = 0 THEN NULL WHEN event_id // 6 % 5 = 1 THEN 1000 WHEN event_id % 4 = 0 THEN NULL ELSE epoch_us(ts) END AS taken, event_id % 2 = 0 AS exif, event_id % 6 * 7 % 13 AS num FROM events),
u AS (SELECT *, count(taken) OVER (PARTITION BY course) = 0 OR (count(*) OVER (PARTITION BY course) > 1 AND count(DISTINCT taken) OVER (PARTITION BY course) < 2) AS useless FROM f)
SELECT course, name, CASE WHEN useless OR taken IS NULL THEN 'filename' WHEN exif THEN 'exif' ELSE 'mtime' END AS order_source, row_number() OVER (PARTITION BY course ORDER BY CASE WHEN useless THEN 0 ELSE (taken IS NULL)::INT END, CASE WHEN useless THEN NULL ELSE taken END, num, name) AS position FROM u""",
)
def ordering_source(spark, folder):
    """Six pictures in turn are a course; some courses have no times, or one for all."""
    i, course = F.col("event_id"), F.expr("event_id div 6")
    at = F.when(course % 5 == 0, None).when(course % 5 == 1, 1000).when(i % 4 == 0, None).otherwise(F.expr("unix_micros(cast(ts as timestamp))"))
    files = table(spark, folder, "events").select(course.alias("course"), F.concat(F.lit("img"), (i % 6 * 7 % 13).cast("string"), F.lit(".jpg")).alias("name"), at.alias("at"), (i % 2 == 0).alias("exif"))
    return G.ordering(files, "course").select("course", "name", "order_source", "position")


@query(
    "serial_bracketing",
    f"WITH {MEDIA}, b AS (SELECT source, event_id, start_us, last(start_us IGNORE NULLS) OVER (PARTITION BY source ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a, first(start_us IGNORE NULLS) OVER (PARTITION BY source ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS z FROM media) SELECT source, event_id, a AS after, z AS before FROM b WHERE start_us IS NULL",
)
def serial_bracketing(spark, folder):
    rows = G.bracketed(media(table(spark, folder, "events")), "source", "event_id", "start_us")
    return rows.where("start_us IS NULL").select("source", "event_id", "after", "before")


@query(
    "clock_meaning",
    """WITH c AS (SELECT event_id // 8 AS rec, event_id % 8 * 60 AS off, event_id % 5 * 30 AS dur, event_id // 8 % 2 AS kind, event_id % 3 AS noise FROM events), t AS (SELECT *, 10000 + off + kind * dur + noise AS taken FROM c),
s AS (SELECT rec, max(taken - off) - min(taken - off) AS s, max(taken - off - dur) - min(taken - off - dur) AS e FROM t GROUP BY 1) SELECT rec, CASE WHEN e < s THEN 'end' ELSE 'start' END AS meaning, least(s, e) AS spread FROM s""",
)
def clock_meaning(spark, folder):
    """Eight clips in turn are a recording; in every second one, clips carry the time of their end."""
    i, rec = F.col("event_id"), F.expr("event_id div 8")
    rows = table(spark, folder, "events").select(rec.alias("rec"), (i % 8 * 60).alias("off"), (i % 5 * 30).alias("dur"), (10000 + i % 8 * 60 + rec % 2 * (i % 5 * 30) + i % 3).alias("at"))
    return G.clock_meaning(rows, "rec", "at", "off", "dur")


@query(
    "manifest_files",
    """WITH m AS (SELECT event_id AS idx, CASE event_id % 4 WHEN 0 THEN 'a/' WHEN 1 THEN 'b/' WHEN 2 THEN '' ELSE 'lost/' END || 'f' || (event_id % 400) || '.mp4' AS src FROM events), f AS (SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN 'a/' ELSE 'b/' END || 'f' || (event_id % 300) || '.mp4' AS path FROM events),
n AS (SELECT regexp_extract(path, '([^/]*)$', 1) AS base, min(path) AS path FROM f GROUP BY 1)
SELECT idx, src, coalesce(f.path, n.path) AS file, CASE WHEN coalesce(f.path, n.path) IS NULL THEN 'source file not found' END AS error FROM m LEFT JOIN f ON f.path = src LEFT JOIN n ON n.base = regexp_extract(src, '([^/]*)$', 1)""",
)
def manifest_files(spark, folder):
    i, events = F.col("event_id"), table(spark, folder, "events")
    folder_ = F.when(i % 4 == 0, "a/").when(i % 4 == 1, "b/").when(i % 4 == 2, "").otherwise("lost/")
    manifest = events.select(i.alias("idx"), F.concat(folder_, F.lit("f"), (i % 400).cast("string"), F.lit(".mp4")).alias("src"))
    files = events.select(F.concat(F.when(i % 3 == 0, "a/").otherwise("b/"), F.lit("f"), (i % 300).cast("string"), F.lit(".mp4")).alias("path")).distinct()
    return G.manifest_files(manifest, files)


@query(
    "resegment_stats",
    f"""WITH {E.SEGMENTS}, b AS (SELECT clip, dur_ms / 1000.0::DOUBLE AS s, greatest(1, (dur_ms + 7999) // 8000) AS k FROM segments), a AS (SELECT clip, s / k AS s FROM (SELECT *, unnest(range(k)) AS u FROM b)),
x AS (SELECT clip, count(*) AS n, round(avg(s) + 1e-9, 3) AS m, max(s) AS l, count(*) FILTER (s > 15) AS c FROM b GROUP BY 1), y AS (SELECT clip, count(*) AS n, round(avg(s) + 1e-9, 3) AS m, max(s) AS l, count(*) FILTER (s > 15) AS c FROM a GROUP BY 1)
SELECT x.clip, x.n, x.m AS mean_s, x.l AS max_s, x.c AS n_long, y.n AS n_after, y.m AS mean_after, y.l AS max_after, y.c AS long_after FROM x JOIN y USING (clip)""",
)
def resegment_stats(spark, folder):
    """Lengths of a clip's segments before and after cutting them into equal pieces of eight seconds at most."""
    rows = E.segments(table(spark, folder, "conversations")).select("clip", (F.col("dur_ms") / 1000).alias("s"), F.greatest(F.lit(1), F.ceil(F.col("dur_ms") / 8000)).cast("int").alias("k"))
    pieces = rows.select("clip", (F.col("s") / F.col("k")).alias("s"), F.explode(F.sequence(F.lit(1), F.col("k"))))
    after = G.durations(pieces, "clip", F.col("s")).select(F.col("clip").alias("_c"), F.col("n").alias("n_after"), F.col("mean_s").alias("mean_after"), F.col("max_s").alias("max_after"), F.col("n_long").alias("long_after"))
    return G.durations(rows, "clip", F.col("s")).join(after, F.col("clip") == F.col("_c")).drop("_c")


@query("grid_size_drift", "SELECT p_partkey % 12 // 4 AS \"row\", p_partkey % 4 AS col, count(*) AS n, count(DISTINCT (p_size // 30, p_partkey % 2)) AS n_sizes, count(DISTINCT (p_size // 30, p_partkey % 2)) > 1 AS drift FROM part GROUP BY 1, 2")
def grid_size_drift(spark, folder):
    cells = table(spark, folder, "part").select(F.expr("p_partkey % 12 div 4").alias("row"), (F.col("p_partkey") % 4).alias("col"), F.expr("p_size div 30").alias("w"), (F.col("p_partkey") % 2).alias("h"))
    return G.size_drift(cells, ["row", "col"], ["w", "h"])


_FAULTS = ["ok", "not an object", "missing engine", "blocks wrong type", "block 1 malformed", "reading_order not all ints", "page_confidence wrong type"]


@query("ocr_schema_check", f"SELECT p_partkey, {_FAULTS}[p_partkey % 7 + 1] AS fault FROM part")
def ocr_schema_check(spark, folder):
    """Results of an engine as JSON, six of seven with a fault."""
    k, name = F.col("p_partkey") % 7, F.to_json(F.struct(F.col("p_name").alias("text")))
    blocks = F.when(k == 3, F.lit('"none"')).when(k == 4, F.concat(F.lit("["), name, F.lit(', {"box": []}]'))).otherwise(F.concat(F.lit("["), name, F.lit("]")))
    order = F.when(k == 5, F.lit("[0, 1.5]")).otherwise(F.lit("[0]"))
    engine = F.when(k == 2, F.lit("")).otherwise(F.lit('"engine": "s", '))
    body = F.concat(F.lit('{"fixture": "f.jpg", '), engine, F.lit('"blocks": '), blocks, F.lit(', "reading_order": '), order, F.lit(', "labels": [], "page_confidence": '), F.when(k == 6, F.lit('"high"')).otherwise(F.lit("0.5")), F.lit(', "latency_s": 1}'))
    return table(spark, folder, "part").select("p_partkey", G.schema_fault(F.when(k == 1, F.lit("[1]")).otherwise(body)).alias("fault"))


@query(
    "ocr_normalize",
    "SELECT p_partkey, p_name AS text, CASE WHEN p_partkey % 4 = 2 THEN 0.0 ELSE p_size / 100.0 END::DOUBLE AS confidence FROM part WHERE p_partkey % 4 <> 3 UNION ALL SELECT p_partkey, p_brand, 0.25 FROM part WHERE p_partkey % 4 IN (0, 1)",
)
def ocr_normalize(spark, folder):
    """Two shapes of an engine's result, one without confidences, and empty ones."""
    q = lambda c: F.get_json_object(F.to_json(F.struct(F.col(c).alias("x"))), "$.x")
    text, brand, score, k = q("p_name"), q("p_brand"), (F.col("p_size") / 100).cast("string"), F.col("p_partkey") % 4
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    listed = F.concat(F.lit("[[[[0,0]], "), quoted(text), F.lit(", "), score, F.lit("], [[], "), quoted(brand), F.lit(", 0.25]]"))
    named = F.concat(F.lit('{"txts": ['), quoted(text), F.lit(", "), quoted(brand), F.lit('], "scores": ['), score, F.lit(', 0.25], "boxes": []}'))
    value = F.when(k == 0, F.concat(F.lit("["), listed, F.lit(", [0.1]]"))).when(k == 1, named).when(k == 2, F.concat(F.lit("[[[], "), quoted(text), F.lit("]]"))).otherwise(F.lit("null"))
    return table(spark, folder, "part").select("p_partkey", F.explode(G.ocr_items(value)).alias("x")).select("p_partkey", "x.text", "x.confidence")


@query(
    "term_pull",
    "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\\b[A-Z][A-Za-z0-9₂₃]+(?:[-_/][A-Za-z0-9]+)*\\b')))[1:50], ',') AS terms, CASE lang WHEN 'en' THEN NULL WHEN 'fr' THEN 'zh' ELSE lang END AS code FROM (SELECT doc_id, lang, regexp_replace(text, '[^\\x00-\\x7f]', ' ', 'g') AS text FROM documents)",
)
def term_pull(spark, folder):
    """Terms of the ASCII part of a text; languages renamed so that automatic and bilingual ones occur."""
    named = F.when(F.col("lang") == "en", "auto").when(F.col("lang") == "fr", "bilingual").otherwise(F.col("lang"))
    plain = F.regexp_replace("text", r"[^\x00-\x7f]", " ")
    return table(spark, folder, "documents").select("doc_id", F.array_join(G.terms(plain), ",").alias("terms"), G.language_code(named).alias("code"))


@query(
    "deck_pages",
    """WITH p AS (SELECT doc_id // 10 AS deck, doc_id, doc_id % 10 AS pos, length(text) AS n FROM documents) SELECT deck, CASE WHEN doc_id % 10 < 2 THEN 'intro' ELSE 'pages' END AS part, CASE WHEN pos < 2 THEN pos ELSE pos - 2 END AS page, n FROM p WHERE pos < 2 OR pos - 2 BETWEEN 1 AND 5""",
)
def deck_pages(spark, folder):
    """Decks as JSON (bare lists, wrapped ones, under any name): intro pages first, then pages 1 to 5."""
    i, deck = F.col("doc_id"), F.expr("doc_id div 10")
    item = lambda page: F.struct(page.cast("int").alias("page"), F.struct(F.length("text").alias("n")).alias("ocr"))
    docs = table(spark, folder, "documents")
    packed = lambda rows, page: rows.groupBy(deck.alias("deck")).agg(F.to_json(F.array_sort(F.collect_list(item(page)))).alias("value"))
    intro, pages = packed(docs.where(i % 10 < 2), i % 10), packed(docs.where(i % 10 >= 2), i % 10 - 2)
    shaped = F.when(F.col("deck") % 3 == 0, F.col("value")).when(F.col("deck") % 3 == 1, F.concat(F.lit('{"slides": '), F.col("value"), F.lit("}"))).otherwise(F.concat(F.lit('{"title": "x", "cards": '), F.col("value"), F.lit("}")))
    read = lambda rows: R.slide_rows(rows.withColumn("value", shaped), "struct<page:int,ocr:struct<n:int>>").select("deck", "x.page", "x.ocr.n")
    return R.deck(read(intro), R.page_range(read(pages), 1, 5)).select("deck", "part", "page", "n")


@query(
    "load_gate_polls",
    """WITH v AS (SELECT event_id // 3 AS host, CASE WHEN event_id * 37 % 9000 < 4000 OR (user_id % 3 = 0 AND event_id % 100 > 80) THEN 'blocked' WHEN user_id % 3 = 0 THEN 'warning' ELSE 'ok' END AS v FROM events)
SELECT host, count(*) AS n_polls, CASE WHEN bool_and(v = 'blocked') THEN 'blocked' WHEN bool_or(v = 'warning') THEN 'warning' ELSE 'ok' END AS verdict FROM v GROUP BY 1""",
)
def load_gate_polls(spark, folder):
    """Three events in turn are polls of one accelerator."""
    i = F.col("event_id")
    rows = table(spark, folder, "events").select(F.expr("event_id div 3").alias("host"), (i * 37 % 9000).alias("free"), (i % 100).alias("util"), F.when(F.col("user_id") % 3 == 0, 2000).alias("heavy"))
    return G.polled(rows, "host", G.load_verdict(F.col("free"), F.col("util"), F.col("heavy")))


_COERCED = [  # the report, and what its nine columns are
    ('{"content_type": ["a", "b"], "contains_measurement": true, "text_redundancy": 0.5}', "'a|b', '', '', true, false, false, 0.5, 0.0, 0.0"),
    ('{"content_type": "chart", "visible_labels": 7, "contains_algorithm": "false", "visual_complexity": "0.25"}', "'chart', '', '7', false, true, false, 0.0, 0.25, 0.0"),
    ('{"contains_measurement": 0, "contains_algorithm": "", "contains_clinical_imaging": [1], "text_redundancy": "high", "visual_complexity": true}', "'', '', '', false, false, true, 0.0, 1.0, 0.0"),
    ('{"contains_measurement": null, "contains_algorithm": {}, "contains_clinical_imaging": [], "non_textual_information_density": 3}', "'', '', '', false, false, false, 0.0, 0.0, 3.0"),
    ("not json", "'', '', '', false, false, false, 0.0, 0.0, 0.0"),
]
_NAMES = [n for names in G.SIGNALS.values() for n in names]


@query(
    "signal_coercion",
    f"SELECT p.p_partkey, v.* EXCLUDE (k) FROM part p JOIN (VALUES {', '.join(f'({k}, {values})' for k, (_, values) in enumerate(_COERCED))}) AS v(k, {', '.join(_NAMES)}) ON p.p_partkey % {len(_COERCED)} = v.k",
)
def signal_coercion(spark, folder):
    text = F.element_at(F.array(*[F.lit(t) for t, _ in _COERCED]), (F.col("p_partkey") % len(_COERCED)).cast("int") + 1)
    rows = table(spark, folder, "part").select("p_partkey", *G.coerced(text))
    return rows.withColumns({n: F.array_join(n, "|") for n in G.SIGNALS["list"]})


@query(
    "plan_faults",
    """WITH r AS (SELECT event_id // 7 AS plan, event_id % 7 AS seg, CASE WHEN event_id % 53 = 0 THEN NULL ELSE 's' || CASE WHEN event_id % 31 = 0 THEN 1 ELSE event_id % 7 END END AS slug, CASE WHEN event_id % 97 = 0 THEN NULL ELSE 't' END AS title, event_id % 7 * 100 - CASE WHEN event_id % 11 = 0 THEN 60 ELSE 0 END AS s, event_id % 7 * 100 + 90 AS e FROM events),
m AS (SELECT *, slug IS NULL OR title IS NULL AS missing, slug IS NOT NULL AND count(slug) OVER (PARTITION BY plan, slug) > 1 AS again, coalesce(s < lag(e) OVER (PARTITION BY plan ORDER BY seg), false) AS early FROM r),
f AS (SELECT plan, count(*) AS n_rows, count(*) FILTER (missing) AS n_missing, count(*) FILTER (again) AS n_repeated, count(*) FILTER (early) AS n_overlaps FROM m GROUP BY 1)
SELECT *, CASE WHEN n_missing > 0 THEN 'missing' WHEN n_repeated > 0 THEN 'duplicate' WHEN n_overlaps > 0 THEN 'overlap' ELSE 'ok' END AS verdict FROM f""",
)
def plan_faults(spark, folder):
    """Seven events in turn are the rows of a plan."""
    i, seg = F.col("event_id"), F.col("event_id") % 7
    slug = F.when(i % 53 != 0, F.concat(F.lit("s"), F.when(i % 31 == 0, 1).otherwise(seg).cast("string")))
    start = seg * 100 - F.when(i % 11 == 0, 60).otherwise(0)
    rows = table(spark, folder, "events").select(F.expr("event_id div 7").alias("plan"), seg.alias("seg"), slug.alias("slug"), F.when(i % 97 != 0, "t").alias("title"), start.alias("start"), (seg * 100 + 90).alias("end"))
    return G.plan_faults(rows, "plan")


@query("semantic_group_text")
def semantic_group_text(spark, folder):
    """Twenty-five parts in turn are slides; two of three show (most of) the name before."""
    k = F.col("p_partkey")
    shown = F.first("p_name").over(Window.partitionBy(F.expr("p_partkey div 25"), F.expr("p_partkey % 25 div 3")).orderBy(k))
    text = F.when(k % 3 == 1, F.concat(shown, F.lit(" more"))).otherwise(shown)
    rows = table(spark, folder, "part").select(F.expr("p_partkey div 25").alias("clip"), (k % 25).alias("seg_idx"), (k % 25 * 20_000).alias("start_ms"), (k % 25 * 20_000 + 19_000).alias("end_ms"), text.alias("text"), F.when(k % 10 == 9, 0.9).alias("fused"))
    return semantic_groups(rows)
