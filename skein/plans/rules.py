"""Gates, routes, scores, verdicts, tiers, parsers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators import rules as R
from skein.operators.sequences import drop_repeats
from skein.plans.base import query, table
from skein.sources import entities as E

SIGNALS = """signals AS (SELECT doc_id, text, n_chars, source, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE n_chars / 40000.0::DOUBLE END AS density, n_chars / 16.0::DOUBLE AS file_kb, (doc_id * 7 % 250)::DOUBLE AS lap,
  (doc_id % 10) / 10.0::DOUBLE AS vis, (doc_id % 7) / 7.0::DOUBLE AS non, (doc_id % 9) / 9.0::DOUBLE AS ref, (doc_id % 4) / 4.0::DOUBLE AS emp, (doc_id % 5) / 10.0::DOUBLE AS skp, (doc_id % 3) / 10.0::DOUBLE AS con, (doc_id % 20) / 20.0::DOUBLE AS red, (doc_id % 200)::DOUBLE AS spent,
  CASE doc_id % 6 WHEN 0 THEN ['flowchart'] WHEN 1 THEN ['title'] WHEN 2 THEN ['title', 'decorative'] WHEN 3 THEN ['ultrasound', 'anatomy'] WHEN 4 THEN ['table'] ELSE ['photo'] END AS types,
  CASE doc_id % 13 WHEN 0 THEN ['staging_schema'] ELSE ['overview'] END AS funs FROM documents)"""


def signals(docs):
    """Stand-ins for the measures and model signals of a slide, by arithmetic on ids and lengths."""
    i, d = F.col("doc_id"), lambda n, m: ((F.col("doc_id") % n) / float(m)).cast("double")
    arr = lambda *x: F.array(*map(F.lit, x))
    types = F.when(i % 6 == 0, arr("flowchart")).when(i % 6 == 1, arr("title")).when(i % 6 == 2, arr("title", "decorative")).when(i % 6 == 3, arr("ultrasound", "anatomy")).when(i % 6 == 4, arr("table")).otherwise(arr("photo"))
    return docs.select(
        "doc_id", "text", "n_chars", "source",
        F.when(i % 11 == 0, None).otherwise(F.col("n_chars") / 40000.0).cast("double").alias("density"), (F.col("n_chars") / 16.0).cast("double").alias("file_kb"), (i * 7 % 250).cast("double").alias("lap"),
        d(10, 10).alias("vis"), d(7, 7).alias("non"), d(9, 9).alias("ref"), d(4, 4).alias("emp"), d(5, 10).alias("skp"), d(3, 10).alias("con"), d(20, 20).alias("red"), (i % 200).cast("double").alias("spent"),
        types.alias("types"), F.when(i % 13 == 0, arr("staging_schema")).otherwise(arr("overview")).alias("funs"),
    )


@query(
    "skip_gate",
    f"""WITH {SIGNALS} SELECT doc_id, coalesce(density < 0.05 AND length(text) < 900 AND file_kb < 80 AND lap < 100, false) AS skip,
  CASE WHEN density IS NULL THEN 'entropy_metrics_missing' ELSE concat_ws(',', CASE WHEN density < 0.05 THEN 'density' END, CASE WHEN length(text) < 900 THEN 'text_len' END, CASE WHEN file_kb < 80 THEN 'file_kb' END, CASE WHEN lap < 100 THEN 'laplacian' END) END AS reasons FROM signals""",
)
def skip_gate(spark, folder):
    """Texts are longer than a slide's here, so their length is taken in units of 45 characters."""
    skip, reasons = R.skip_gate(F.col("density"), F.length("text") / 45, F.col("file_kb"), F.col("lap"))
    return signals(table(spark, folder, "documents")).select("doc_id", F.coalesce(skip, F.lit(False)).alias("skip"), F.array_join(reasons, ",").alias("reasons"))


@query(
    "ocr_router_fallback",
    f"""WITH {SIGNALS}, r AS (SELECT s.doc_id, CASE WHEN source = 'src0' THEN 'keep' WHEN length(text) < 600 AND coalesce(density < 0.03, false) THEN 'skip' WHEN lap < 10 THEN 'fallback' ELSE 'ocr' END AS route, l.doc_id AS ocr_id, l.toxic, l.quality FROM signals s LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id))
SELECT doc_id, route, CASE WHEN route <> 'ocr' THEN NULL WHEN ocr_id IS NULL THEN 'missing' WHEN toxic = 1 THEN 'error' WHEN quality < 1 THEN 'low_confidence' ELSE 'none' END AS reason,
  CASE WHEN route = 'ocr' AND ocr_id IS NOT NULL AND toxic = 0 AND quality >= 1 THEN 'primary' WHEN route = 'skip' THEN NULL ELSE 'quick' END AS engine FROM r""",
)
def ocr_router_fallback(spark, folder):
    """Route, then the reason for the second engine's text, from results joined by id (labels stand for them)."""
    rows = signals(table(spark, folder, "documents"))
    route = R.ocr_route(F.when(F.col("source") == "src0", "pdf").otherwise("video"), F.length("text") / 50, F.col("density"), F.when(F.col("lap") >= 10, F.lit("image")))
    done = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality")).withColumn("found", F.lit("text"))
    both = rows.select("doc_id", route.alias("route")).join(done, "doc_id", "left")
    reason = R.ocr_fallback(F.col("found"), F.when(F.col("toxic") == 1, "failed"), F.col("quality").cast("double"))
    both = both.withColumn("reason", F.when(F.col("route") == "ocr", reason))
    return both.select("doc_id", "route", "reason", F.when(F.col("reason") == "none", "primary").when(F.col("route") == "skip", None).otherwise("quick").alias("engine"))


def _sql_score() -> str:
    bonus = " + ".join(f"CASE WHEN list_contains(types, '{k}') THEN {v} ELSE 0.0 END::DOUBLE" for k, v in R.BONUSES.items())
    return f"greatest(0.0, least(1.0, vis * 0.15::DOUBLE + non * 0.25::DOUBLE + ref * 0.3::DOUBLE + emp * 0.15::DOUBLE + least(spent / 120, 1.0::DOUBLE) * 0.15::DOUBLE + {bonus} - skp * 0.3::DOUBLE - con * 0.2::DOUBLE - CASE WHEN red > 0.7 THEN 0.2 ELSE 0.0 END::DOUBLE))"


@query(
    "tier_score",
    f"""WITH {SIGNALS}, s AS (SELECT *, {_sql_score()} AS score FROM signals),
t AS (SELECT *, CASE WHEN density IS NULL THEN 3 WHEN list_has_any(funs, ['staging_schema']) THEN 1 WHEN doc_id % 6 IN (1, 2) THEN 3 WHEN red > 0.9 THEN 3 WHEN round(score, 9) >= 0.65 THEN 1 WHEN round(score, 9) >= 0.4 THEN 2 ELSE 3 END AS t0,
  CASE WHEN density IS NULL THEN 'no_signals' WHEN list_has_any(funs, ['staging_schema']) THEN 'function' WHEN doc_id % 6 IN (1, 2) THEN 'content' WHEN red > 0.9 THEN 'redundant' ELSE 'score' END AS r0 FROM s),
f AS (SELECT *, doc_id % 6 = 3 AND t0 = 3 AND density IS NOT NULL AS fl FROM t)
SELECT doc_id, round(score, 6) AS score, CASE WHEN fl THEN 2 ELSE t0 END AS tier, CASE WHEN fl THEN 'imaging_floor' ELSE r0 END AS reason,
  CASE WHEN (CASE WHEN fl THEN 2 ELSE t0 END) > 2 THEN NULL WHEN doc_id % 6 IN (0, 4) THEN 600 WHEN doc_id % 6 = 3 THEN 500 WHEN (CASE WHEN fl THEN 2 ELSE t0 END) = 1 THEN 450 ELSE 400 END AS embed_width FROM f""",
)
def tier_score(spark, folder):
    """Score, tier with its overrides, and embed width."""
    parts = {"visual_complexity": "vis", "non_textual": "non", "reference_density": "ref", "emphasis": "emp", "time_spent_s": "spent", "skip": "skp", "confusion": "con", "redundancy": "red"}
    score = R.tier_score({k: F.col(v) for k, v in parts.items()}, F.col("types"))
    rows = signals(table(spark, folder, "documents")).withColumn("score", score)
    tier, reason = R.tier_of(F.round("score", 9), F.col("types"), F.col("funs"), F.col("red"), F.col("density").isNotNull())
    rows = rows.withColumn("tier", tier).withColumn("reason", reason)
    return rows.select("doc_id", F.round("score", 6).alias("score"), "tier", "reason", R.embed_width(F.col("tier"), F.col("types")).alias("embed_width"))


@query(
    "tier_parse",
    """WITH v AS (SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '1' WHEN 2 THEN 'T2 core' WHEN 3 THEN '2.0' WHEN 4 THEN 'none' WHEN 5 THEN '10' WHEN 6 THEN 'true' WHEN 7 THEN 'tier-' || p_size ELSE p_size::VARCHAR END AS v FROM part)
SELECT p_partkey, CASE WHEN v IS NULL THEN 3 WHEN regexp_full_match(v, '-?[0-9]+([.][0-9]+)?') THEN trunc(v::DOUBLE)::INT WHEN regexp_extract(v, '[1-9]') <> '' THEN regexp_extract(v, '[1-9]')::INT ELSE 1 END AS tier FROM v""",
)
def tier_parse(spark, folder):
    k = F.col("p_partkey") % 9
    v = F.when(k == 0, None).when(k == 1, "1").when(k == 2, "T2 core").when(k == 3, "2.0").when(k == 4, "none").when(k == 5, "10").when(k == 6, "true").when(k == 7, F.concat(F.lit("tier-"), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string"))
    return table(spark, folder, "part").select("p_partkey", v.alias("v")).select("p_partkey", T.parse_tier(F.col("v")).alias("tier"))


@query(
    "language_verdict",
    """WITH c AS (SELECT source, sum(len(regexp_extract_all(text, '[\\x{4e00}-\\x{9fff}\\x{3400}-\\x{4dbf}]'))) AS cjk, sum(len(regexp_extract_all(text, '[A-Za-z]'))) AS latin FROM documents GROUP BY ROLLUP (source))
SELECT coalesce(source, '(all)') AS source, cjk::BIGINT AS cjk, latin::BIGINT AS latin, CASE WHEN cjk / (cjk + latin) >= 0.6 THEN 'zh' WHEN latin / (cjk + latin) >= 0.85 AND cjk / (cjk + latin) < 0.1 THEN 'en' ELSE 'bilingual' END AS lang, round(least(1.0, 0.5 + CASE WHEN cjk / (cjk + latin) >= 0.6 THEN (cjk / (cjk + latin) - 0.6) / 0.4 WHEN latin / (cjk + latin) >= 0.85 AND cjk / (cjk + latin) < 0.1 THEN (latin / (cjk + latin) - 0.85) / 0.15 ELSE 0 END) + 1e-9, 2) AS confidence FROM c""",
)
def language_verdict(spark, folder):
    """Per clip (source) and pooled, in one pass by rollup."""
    cjk, latin = T.script_ratios(F.col("text"))
    rows = table(spark, folder, "documents").select("source", cjk.alias("c"), latin.alias("l")).rollup("source").agg(F.sum("c").alias("cjk"), F.sum("l").alias("latin"))
    lang, confidence = R.language_verdict(F.col("cjk"), F.col("latin"))
    return rows.select(F.coalesce("source", F.lit("(all)")).alias("source"), "cjk", "latin", lang.alias("lang"), confidence.alias("confidence"))


@query(
    "script_class",
    f"""WITH {E.NOTE_LINES}, c AS (SELECT CASE WHEN length(f) > 0 AND len(regexp_extract_all(f, '[\\x{{3400}}-\\x{{4dbf}}\\x{{4e00}}-\\x{{9fff}}\\x{{f900}}-\\x{{faff}}]')) >= 0.3 * length(f) THEN 'cjk' ELSE 'latin' END AS script, NOT regexp_matches(line, '[\\pL\\pN\\pM]') AS wordless FROM (SELECT line, regexp_replace(line, '\\s+', '', 'g') AS f FROM note_lines))
SELECT script, wordless, count(*) AS n FROM c GROUP BY 1, 2""",
)
def script_class(spark, folder):
    line = F.col("line")
    return E.note_lines(table(spark, folder, "documents")).groupBy(T.script_class(line).alias("script"), T.wordless(line).alias("wordless")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "chrome_line_filter",
    "SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT (contains(x, 'idiot') OR contains(x, 'token') OR contains(x, 'copyright'))), chr(10)) AS text, len(list_filter([source, 'lab ' || lang, '12:30 PM', ' ', 'long label 2024-01-05 with much more text'], lambda x: trim(x) <> '' AND NOT contains(x, 'src1') AND NOT (regexp_matches(x, '\\d{1,2}[:.]\\d{2}|\\d{2,4}[-/.]\\d{1,2}[-/.]\\d{1,2}') AND length(trim(x)) <= 25))) AS n_labels FROM documents",
)
def chrome_line_filter(spark, folder):
    """Lines with interface words go; labels lose blanks, interface words and short time codes (word lists are parameters)."""
    labels = F.array("source", F.concat(F.lit("lab "), "lang"), F.lit("12:30 PM"), F.lit(" "), F.lit("long label 2024-01-05 with much more text"))
    return table(spark, folder, "documents").select("doc_id", T.strip_chrome_lines(F.col("text"), ["idiot", "token", "copyright"]).alias("text"), F.size(T.clean_labels(labels, ["src1"])).alias("n_labels"))


@query(
    "tolerant_json_props",
    "SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL ELSE (props->>'$.k')::BIGINT END AS k, CASE WHEN event_id % 5 = 4 THEN 0.0 ELSE (props->>'$.k')::DOUBLE / 100 END AS redundancy, CASE WHEN event_id % 5 = 4 THEN 0 ELSE 1 END AS n_types FROM events",
)
def tolerant_json_props(spark, folder):
    """Model replies as JSON, fenced, in prose, or broken; signals with defaults for whatever is missing."""
    i, p = F.col("event_id") % 5, F.col("props")
    reply = F.when(i == 1, F.concat(F.lit("```json\n"), p, F.lit("\n```"))).when(i == 2, F.concat(F.lit("Here it is: "), p, F.lit(" as asked."))).when(i == 4, F.lit('{"k": ')).otherwise(p)
    rows = table(spark, folder, "events").select("event_id", T.tolerant_json(reply).alias("v"))
    k = F.try_variant_get("v", "$.k", "bigint")
    types = F.when(k.isNotNull(), F.array(k.cast("string"))).otherwise(F.array().cast("array<string>"))  # a scalar becomes a list of one
    return rows.select("event_id", k.alias("k"), F.coalesce(F.try_variant_get("v", "$.k", "double") / 100, F.lit(0.0)).alias("redundancy"), F.size(types).alias("n_types"))


@query(
    "filename_time_parse",
    "SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:00') END AS taken FROM events",
)
def filename_time_parse(spark, folder):
    """Times from file names of four makes; one of them holds an impossible date."""
    k = F.col("event_id") % 4
    named = lambda before, fmt, after: F.concat(F.lit(before), F.date_format("ts", fmt), F.lit(after))
    name = F.when(k == 0, named("IMG_", "yyyyMMdd_HHmmss", ".jpg")).when(k == 1, named("clip ", "yyyy-MM-dd HH.mm", ".mov")).when(k == 2, named("rec-", "yyMMdd-HHmm", ".wav")).otherwise(F.lit("note_20241399_256199.txt"))
    return table(spark, folder, "events").select("event_id", F.date_format(T.filename_time(name), "yyyy-MM-dd HH:mm:ss").alias("taken"))


@query(
    "timestamp_normalize",
    """SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL WHEN 0 THEN strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS local, CASE event_id % 5 WHEN 0 THEN 'utc' WHEN 1 THEN 'tagged' WHEN 2 THEN 'exif' WHEN 3 THEN 'iso' ELSE 'none' END AS form FROM events""",
)
def timestamp_normalize(spark, folder):
    i = F.col("event_id") % 5
    at = lambda fmt: F.date_format("ts", fmt)
    raw = F.when(i == 0, F.concat(at("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(i == 1, F.concat(at("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))).when(i == 2, at("yyyy:MM:dd HH:mm:ss")).when(i == 3, at("yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("2024:13:45 99:00:00"))
    rows = table(spark, folder, "events").select("event_id", raw.alias("raw"))
    value, form = T.normalize_time(F.col("raw"), 8)
    return rows.select("event_id", F.date_format(value, "yyyy-MM-dd HH:mm:ss").alias("local"), form.alias("form"))


@query(
    "slide_search_text",
    f"""WITH {SIGNALS}, s AS (SELECT doc_id, source, CASE WHEN trim(text) <> '' AND coalesce(list_sum(list_transform(regexp_extract_all(text, '[A-Za-z]{{3,}}'), lambda w: length(w))), 0) >= 14 AND NOT list_has_any(types, ['ultrasound', 'decorative']) THEN trim(text) WHEN list_has_any(types, ['table', 'flowchart', 'diagram', 'algorithm', 'chart']) THEN 'summary ' || source ELSE NULL END AS t FROM signals),
q AS (SELECT doc_id, source, left(trim(regexp_replace(t, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')), 240) AS text FROM s WHERE t IS NOT NULL)
SELECT doc_id, source, text FROM (SELECT *, lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS was FROM q) WHERE was IS NULL OR was <> text""",
)
def slide_search_text(spark, folder):
    """Text of a slide for search: its words unless it is a scene, else an information graphic's summary; 240 characters are the field's size."""
    rows = signals(table(spark, folder, "documents"))
    has = lambda *x: F.arrays_overlap("types", F.array(*map(F.lit, x)))
    spoken = (F.trim("text") != "") & (T.wordy_chars(F.col("text")) >= 14) & ~has("ultrasound", "decorative")
    text = F.when(spoken, F.trim("text")).when(has("table", "flowchart", "diagram", "algorithm", "chart"), F.concat(F.lit("summary "), "source"))
    short = F.left(F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0b]+", " ")), F.lit(240))
    return drop_repeats(rows.select("doc_id", "source", short.alias("text")).where("text IS NOT NULL"), ["source"], ["doc_id"], "text")


@query(
    "html_strip",
    """SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS text FROM pages""",
)
def html_strip(spark, folder):
    return table(spark, folder, "pages").select("page_id", T.html_text(F.col("html")).alias("text"))


@query(
    "pii_mask",
    "SELECT doc_id, regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+', '[mail]', 'g'), '[0-9]{6,}', '[number]', 'g') AS text FROM documents",
)
def pii_mask(spark, folder):
    """Mail addresses and long numbers are masked, the text's analogue of a redaction band."""
    mail = F.regexp_replace("text", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[mail]")
    return table(spark, folder, "documents").select("doc_id", F.regexp_replace(mail, "[0-9]{6,}", "[number]").alias("text"))


@query(
    "natural_sort",
    """SELECT p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY lpad(regexp_extract(p_brand, '[0-9]+'), 20, '0'), p_partkey) AS place FROM part""",
)
def natural_sort(spark, folder):
    """Brands in natural order within a type: Brand#2 before Brand#10."""
    return table(spark, folder, "part").select("p_partkey", F.row_number().over(Window.partitionBy("p_type").orderBy(T.natural_key(F.col("p_brand")), "p_partkey")).alias("place"))


@query(
    "search_and_terms",
    """WITH u AS (SELECT 0 AS kind, conv_id * 1000 + turn AS id, text FROM conversations UNION ALL SELECT 1, doc_id, text FROM documents),
h AS (SELECT kind, id, text, strpos(lower(text), 'thing') AS p FROM u WHERE contains(lower(text), 'thing') AND contains(lower(text), 'with') ORDER BY kind, id LIMIT 80)
SELECT kind, id, CASE WHEN p > 25 THEN '…' ELSE '' END || replace(substr(text, greatest(p - 24, 1)::BIGINT, 90), 'thing', '<mark>thing</mark>') || CASE WHEN length(text) > greatest(p - 24, 1) + 89 THEN '…' ELSE '' END AS snippet FROM h""",
)
def search_and_terms(spark, folder):
    """All terms as substrings; the first 80 hits, notes before slides, are the report (ids and positions are sorted, texts follow)."""
    notes = table(spark, folder, "conversations").select(F.lit(0).alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    every = notes.unionByName(table(spark, folder, "documents").select(F.lit(1).alias("kind"), F.col("doc_id").alias("id"), "text"))
    low = F.lower("text")
    hits = every.where(F.contains(low, F.lit("thing")) & F.contains(low, F.lit("with"))).orderBy("kind", "id").limit(80)
    at = F.greatest(F.locate("thing", low) - 24, F.lit(1))
    body = F.replace(F.substr("text", at, F.lit(90)), F.lit("thing"), F.lit("<mark>thing</mark>"))
    return hits.select("kind", "id", F.concat(F.when(at > 1, "…").otherwise(""), body, F.when(F.length("text") > at + 89, "…").otherwise("")).alias("snippet"))
