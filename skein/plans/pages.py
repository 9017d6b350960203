"""OCR pages, picture measures, and the small rules of notes, stages and files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skein.functions import pixels as P
from skein.functions import text as T
from skein.plans.base import query, table

BLOCKS = """blocks AS (SELECT l_orderkey AS page, l_linenumber AS i, l_partkey % 40 * 10.0::DOUBLE AS x, l_suppkey % 30 * 10.0::DOUBLE AS y, l_quantity * 4 AS w, (l_partkey % 7 + 1) * 3.0::DOUBLE AS h, 1 - l_discount AS conf, l_returnflag || l_linestatus || '-' || l_partkey AS text FROM lineitem)"""


@query(
    "ocr_page_stats",
    f"""WITH {BLOCKS}, t AS (SELECT page, arg_min(text, (-h, i, text)) AS title FROM blocks WHERE y <= 105 AND length(text) <= 60 GROUP BY 1)
SELECT page, count(*) AS n_blocks, round(avg(conf) + 1e-9, 6) AS confidence, round(least(sum(w * h) / 120000.0, 1.0) + 1e-9, 6) AS density, string_agg(text, ' ' ORDER BY y, x, i, text) AS text, max(title) AS title FROM blocks LEFT JOIN t USING (page) GROUP BY 1""",
)
def ocr_page_stats(spark, folder):
    """Per page: mean confidence, covered share of the image, text in reading order, and the tallest block near the top as title."""
    c = F.col
    blocks = table(spark, folder, "lineitem").select(c("l_orderkey").alias("page"), c("l_linenumber").alias("i"), (c("l_partkey") % 40 * 10.0).alias("x"), (c("l_suppkey") % 30 * 10.0).alias("y"), (c("l_quantity") * 4).alias("w"), ((c("l_partkey") % 7 + 1) * 3.0).alias("h"), (1 - c("l_discount")).alias("conf"), F.concat("l_returnflag", "l_linestatus", F.lit("-"), c("l_partkey").cast("string")).alias("text"))
    x, y, w, h = (c(n) for n in "xywh")
    area = P.polygon_area(F.array(x, x + w, x + w, x), F.array(y, y, y + h, y + h))
    pages = blocks.withColumn("area", area).groupBy("page").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.round(F.avg("conf") + 1e-9, 6).alias("confidence"),
        F.round(F.least(F.sum("area") / 120000.0, F.lit(1.0)) + 1e-9, 6).alias("density"),
        F.array_sort(F.collect_list(F.struct("y", "x", "i", "text"))).alias("read"),  # a page's blocks
        F.min(F.when((y <= 105) & (F.length("text") <= 60), F.struct((-h).alias("h"), "i", "text"))).alias("top"),
    )
    return pages.select("page", "n_blocks", "confidence", "density", F.array_join("read.text", " ").alias("text"), c("top.text").alias("title"))


def _lap() -> str:
    cells = [i for i in range(9, 55) if 0 < i % 8 < 7]
    return "[" + ", ".join(f"e[{i}] + e[{i + 2}] + e[{i - 7}] + e[{i + 9}] - 4 * e[{i + 1}]" for i in cells) + "]"


@query(
    "image_measures",
    f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), m AS (SELECT *, {_lap()} AS l,
  list_transform(range(0, 8), lambda b: len(list_filter(e, lambda x: least(greatest(floor((x + 0.5) * 8), 0), 7) = b)) / 64.0::DOUBLE) AS hist FROM v),
w AS (SELECT *, lag(hist) OVER (PARTITION BY vec_id // 40 ORDER BY vec_id) AS was FROM m)
SELECT vec_id, array_to_string(list_transform(range(1, 65), lambda i: CASE WHEN i % 8 = 0 THEN NULL WHEN e[i + 1] > e[i] THEN '1' ELSE '0' END), '') AS gradient_hash,
  round(list_sum(list_transform(l, lambda x: x * x)) / len(l) - (list_sum(l) / len(l)) ** 2, 6) AS sharpness,
  CASE WHEN was IS NOT NULL THEN round(sqrt(greatest(0.0, 1 - list_sum(list_transform(range(1, 9), lambda i: sqrt(hist[i] * was[i]))))), 4) END AS distance FROM w""",
)
def image_measures(spark, folder):
    """Vectors as 8 by 8 pictures: gradient hash, sharpness, and the histogram distance from the picture before (forty in turn are a clip)."""
    e = F.col("e")
    rows = table(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.select("vec_id", "label", P.gradient_hash(e, 8).alias("gradient_hash"), F.round(P.laplacian_variance(e, 8), 6).alias("sharpness"), P.histogram(e, -0.5, 0.5, 8).alias("hist"))
    rows = rows.withColumn("was", F.lag("hist").over(Window.partitionBy(F.expr("vec_id div 40")).orderBy("vec_id")))
    return rows.select("vec_id", "gradient_hash", "sharpness", F.when(F.col("was").isNotNull(), F.round(P.bhattacharyya(F.col("hist"), F.col("was")), 4)).alias("distance"))


@query(
    "note_and_stage_rules",
    """WITH n AS (SELECT p_partkey, p_size, p_retailprice, CASE p_partkey % 4 WHEN 0 THEN 'L3/seg0' || p_size % 10 || '_' || p_name || '.md' WHEN 1 THEN 'notes/Hub ' || p_brand || '.md' WHEN 2 THEN 'L2/' || p_name || '.md' ELSE p_name || '.md' END AS path, '20240' || (p_size % 9 + 1) || '15_L' || p_size % 3 || '_' || replace(p_name, ' ', '-') || '_' || p_type AS slug FROM part)
SELECT p_partkey, CASE WHEN contains(lower(path), 'hub') THEN 'hub' WHEN starts_with(path, 'L3/') THEN 'l3' WHEN starts_with(path, 'L2/') THEN 'l2' END AS kind, regexp_extract(path, 'seg([0-9]+)', 1) AS seg,
  string_split(slug, '_')[1] AS day, array_to_string(list_filter(string_split(slug, '_')[2:], lambda x: NOT regexp_full_match(x, 'L[0-9]+')), '_') AS topic,
  floor(p_size * 60 * 0.15 + 120)::BIGINT AS transcribe_timeout_s, p_size * 8 AS vlm_timeout_s, abs(p_retailprice - 1000) <= greatest(5.0, 0.05 * p_retailprice) AS reuse_audio,
  CASE WHEN p_size < 10 OR (p_partkey % 100 > 80 AND p_size % 2 = 0) THEN 'blocked' WHEN p_size % 2 = 0 THEN 'warning' ELSE 'ok' END AS gate,
  CASE WHEN p_partkey < 1024 THEN printf('%.1f B', p_partkey + 0.3::DOUBLE) WHEN p_partkey < 1048576 THEN printf('%.1f KB', (p_partkey + 0.3::DOUBLE) / 1024) ELSE printf('%.1f MB', (p_partkey + 0.3::DOUBLE) / 1048576) END AS size FROM n""",
)
def note_and_stage_rules(spark, folder):
    """Note kind and segment from the path, day and topic from the slug, stage budgets, audio reuse, load gate, size text."""
    part, c = table(spark, folder, "part"), F.col
    k = c("p_partkey") % 4
    path = F.when(k == 0, F.concat(F.lit("L3/seg0"), (c("p_size") % 10).cast("string"), F.lit("_"), c("p_name"), F.lit(".md"))).when(k == 1, F.concat(F.lit("notes/Hub "), c("p_brand"), F.lit(".md"))).when(k == 2, F.concat(F.lit("L2/"), c("p_name"), F.lit(".md"))).otherwise(F.concat(c("p_name"), F.lit(".md")))
    slug = F.concat(F.lit("20240"), (c("p_size") % 9 + 1).cast("string"), F.lit("15_L"), (c("p_size") % 3).cast("string"), F.lit("_"), F.replace(c("p_name"), F.lit(" "), F.lit("-")), F.lit("_"), c("p_type"))
    rows = part.select("p_partkey", "p_size", "p_retailprice", path.alias("path"), F.split(slug, "_").alias("slug"))
    kind = F.when(F.contains(F.lower("path"), F.lit("hub")), "hub").when(F.startswith("path", F.lit("L3/")), "l3").when(F.startswith("path", F.lit("L2/")), "l2")
    heavy = c("p_size") % 2 == 0
    return rows.select(
        "p_partkey", kind.alias("kind"), F.regexp_extract("path", "seg([0-9]+)", 1).alias("seg"), F.get("slug", F.lit(0)).alias("day"),
        F.array_join(F.filter(F.slice("slug", F.lit(2), F.size("slug")), lambda x: ~x.rlike("^L[0-9]+$")), "_").alias("topic"),
        F.floor(c("p_size") * 60 * 0.15 + 120).alias("transcribe_timeout_s"), (c("p_size") * 8).alias("vlm_timeout_s"),
        (F.abs(c("p_retailprice") - 1000) <= F.greatest(F.lit(5.0), 0.05 * c("p_retailprice"))).alias("reuse_audio"),
        F.when((c("p_size") < 10) | ((c("p_partkey") % 100 > 80) & heavy), "blocked").when(heavy, "warning").otherwise("ok").alias("gate"),
        T.human_size(c("p_partkey") + 0.3).alias("size"),
    )
