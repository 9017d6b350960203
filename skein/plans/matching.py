"""Entity resolution, votes, nearest hashes, set differences, links and merges by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators import match as M
from skein.operators.sequences import first_wins
from skein.plans.base import query, table
from skein.sources import entities as E


@query(
    "entity_resolution_unique",
    """WITH n AS (SELECT DISTINCT CASE p_size % 3 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN p_name ELSE p_name || ' take ' || p_size END AS name FROM part), s AS (SELECT DISTINCT p_name AS stem FROM part WHERE p_retailprice > 0),
c AS (SELECT name, count(stem) AS k, min(stem) AS stem, bool_or(name = stem) AS ex FROM n LEFT JOIN s ON contains(stem, name) OR contains(name, stem) GROUP BY 1)
SELECT name, CASE WHEN ex THEN name WHEN k = 1 THEN stem END AS stem, CASE WHEN ex THEN 'exact' WHEN k = 1 THEN 'substring' ELSE 'none' END AS how FROM c""",
)
def entity_resolution_unique(spark, folder):
    part = table(spark, folder, "part")
    k = F.col("p_size") % 3
    name = F.when(k == 0, F.split_part("p_name", F.lit(" "), F.lit(1))).when(k == 1, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" take "), F.col("p_size").cast("string")))
    return M.unique_match(part.select(name.alias("name")).distinct(), part.where("p_retailprice > 0").select(F.col("p_name").alias("stem")).distinct())


@query(
    "ngram_vote_offset",
    """WITH d AS (SELECT doc_id AS id, regexp_replace(text, '\\s+', '', 'g') AS t FROM documents), b AS (SELECT item_id AS id, regexp_replace(text, '\\s+', '', 'g') AS t FROM benchmark),
cg AS (SELECT id AS clip, i - 1 AS ct, substr(t, i, 6) AS gram FROM d, unnest(range(1, length(t) - 4)) AS u(i)), rg AS (SELECT id AS rec, i - 1 AS rt, substr(t, i, 6) AS gram FROM b, unnest(range(1, length(t) - 4)) AS u(i)),
few AS (SELECT *, count(*) OVER (PARTITION BY rec, gram) AS f FROM rg QUALIFY f <= 4),
v AS (SELECT clip, rec, (round_even((ct - rt) / 25::DOUBLE, 0) * 25)::BIGINT AS "offset", count(*) AS v FROM cg JOIN few USING (gram) GROUP BY ALL),
s AS (SELECT *, sum(v) OVER (PARTITION BY clip, rec ORDER BY "offset" RANGE BETWEEN 25 PRECEDING AND 25 FOLLOWING)::BIGINT AS votes FROM v),
x AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY votes DESC, rec, "offset") AS r FROM s)
SELECT clip, rec, "offset", votes FROM x WHERE r = 1""",
)
def ngram_vote_offset(spark, folder):
    """Where in which benchmark passage a document's text sits, by votes of 6-grams in bins of 25 characters."""
    clips = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return M.vote_offsets(clips, table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text"), 25)


@query(
    "recording_start_median",
    f"""WITH {E.SPANS}, c AS (SELECT user_id // 5 AS rec, epoch_us(ts) - (event_id % 7) * 1000000 AS t, event_id FROM events)
SELECT rec, count(*) AS n_clips, median(t::DOUBLE) AS start_us, (max(t) - min(t)) / 1000000.0::DOUBLE AS spread_s, (max(t) - min(t)) <= 30000000 AS ok FROM c GROUP BY 1""".replace(f"{E.SPANS}, ", ""),
)
def recording_start_median(spark, folder):
    """Start of a recording: the median of clip starts less their offsets, and how far they spread."""
    t = F.expr("unix_micros(cast(ts as timestamp)) - (event_id % 7) * 1000000L")
    rows = table(spark, folder, "events").select(F.expr("user_id div 5").alias("rec"), t.alias("t"))
    spread = F.max("t") - F.min("t")
    return rows.groupBy("rec").agg(F.count(F.lit(1)).alias("n_clips"), F.median(F.col("t").cast("double")).alias("start_us"), (spread / 1000000.0).alias("spread_s"), (spread <= 30000000).alias("ok"))


def _sign_sql(a: int) -> str:
    return f"list_reduce(list_prepend(0::BIGINT, list_transform(embedding[{a + 1}:{a + 32}], lambda x: CASE WHEN x > 0.2 THEN 1 ELSE 0 END::BIGINT)), lambda s, x: s * 2 + x)"


@query(
    "nearest_hash",
    f"""WITH h AS (SELECT vec_id, label, {_sign_sql(0)} AS hi, {_sign_sql(32)} AS lo FROM embeddings),
p AS (SELECT f.vec_id AS frame, c.vec_id AS entry, bit_count(xor(f.hi, c.hi)) + bit_count(xor(f.lo, c.lo)) AS distance FROM h f JOIN h c ON c.label = 0 AND f.label <> 0)
SELECT frame, entry, distance FROM (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY distance, entry) AS r FROM p WHERE distance <= 6) WHERE r = 1""",
)
def nearest_hash(spark, folder):
    """Nearest cached hash of each frame within six bits; components over 0.2 stand for a picture's bright cells."""
    hi, lo = M.hash_words(F.col("embedding"), 0.2)
    rows = table(spark, folder, "embeddings").select("vec_id", "label", hi.alias("hi"), lo.alias("lo"))
    cache = rows.where("label = 0").select(F.col("vec_id").alias("entry"), F.col("vec_id").alias("pos"), "hi", "lo")
    return M.nearest_hash(rows.where("label <> 0").select(F.col("vec_id").alias("frame"), "hi", "lo"), cache)


@query(
    "set_difference_audit",
    """SELECT 'order_without_line' AS finding, o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'customer_without_order', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'scanned_orders', count(*) FROM orders""",
)
def set_difference_audit(spark, folder):
    """Findings beside the number of rows looked at, so that an empty scan is not a clean one."""
    orders, lines, customers = (table(spark, folder, n) for n in ("orders", "lineitem", "customer"))
    bare = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left_anti").select(F.lit("order_without_line").alias("finding"), F.col("o_orderkey").alias("id"))
    idle = customers.join(orders, customers["c_custkey"] == orders["o_custkey"], "left_anti").select(F.lit("customer_without_order").alias("finding"), F.col("c_custkey").alias("id"))
    return bare.unionByName(idle).unionByName(orders.agg(F.count(F.lit(1)).alias("id")).select(F.lit("scanned_orders").alias("finding"), "id"))


@query(
    "link_resolution_fallback",
    """WITH l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS path, regexp_extract(url, '/([a-z]{2})/', 1) AS kind, page_id % 500 AS seg FROM pages),
by_path AS (SELECT path, min(page_id) AS target FROM l GROUP BY 1), by_seg AS (SELECT kind, seg, min(page_id) AS target FROM l GROUP BY 1, 2),
q AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN path WHEN page_id % 3 = 1 THEN path || 'x' ELSE 'nowhere' END AS ref, kind, CASE WHEN page_id % 3 = 2 THEN -1 ELSE seg END AS seg FROM l)
SELECT page_id, coalesce(p.target, s.target) AS target, CASE WHEN p.target IS NOT NULL THEN 'exact' WHEN s.target IS NOT NULL THEN 'kind_seg' ELSE 'broken' END AS how FROM q LEFT JOIN by_path p ON p.path = q.ref LEFT JOIN by_seg s ON s.kind = q.kind AND s.seg = q.seg""",
)
def link_resolution_fallback(spark, folder):
    """A link goes to the note of that name, else to the one of its kind and segment, else it is broken."""
    rows = table(spark, folder, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://[^/]+(/[^?#]*)", 1).alias("path"), F.regexp_extract("url", "/([a-z]{2})/", 1).alias("kind"), (F.col("page_id") % 500).alias("seg"))
    k = F.col("page_id") % 3
    links = rows.select("page_id", F.when(k == 0, F.col("path")).when(k == 1, F.concat("path", F.lit("x"))).otherwise("nowhere").alias("path"), "kind", F.when(k == 2, -1).otherwise(F.col("seg")).alias("seg"))
    one = links.join(rows.groupBy("path").agg(F.min("page_id").alias("t1")), "path", "left").join(rows.groupBy("kind", "seg").agg(F.min("page_id").alias("t2")), ["kind", "seg"], "left")
    return one.select("page_id", F.coalesce("t1", "t2").alias("target"), F.when(F.col("t1").isNotNull(), "exact").when(F.col("t2").isNotNull(), "kind_seg").otherwise("broken").alias("how"))


@query(
    "image_resolution_ambiguity",
    """WITH c AS (SELECT n_chars, count(*) AS n_files, count(DISTINCT md5(text)) AS n_contents, min(doc_id) AS first_id FROM documents GROUP BY 1)
SELECT n_chars AS name, n_files, n_contents, CASE WHEN n_contents = 1 THEN first_id END AS chosen, CASE WHEN n_contents = 1 THEN 'ok' ELSE 'ambiguous' END AS verdict FROM c""",
)
def image_resolution_ambiguity(spark, folder):
    """Files of one name: equal contents collapse, different ones are an error, never a guess."""
    rows = table(spark, folder, "documents").select(F.col("n_chars").alias("name"), F.md5("text").alias("h"), "doc_id")
    by_content = rows.groupBy("name", "h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
    out = by_content.groupBy("name").agg(F.sum("n").alias("n_files"), F.count(F.lit(1)).alias("n_contents"), F.min("first_id").alias("first_id"))
    one = F.col("n_contents") == 1
    return out.select("name", "n_files", "n_contents", F.when(one, F.col("first_id")).alias("chosen"), F.when(one, "ok").otherwise("ambiguous").alias("verdict"))


@query(
    "duplicate_files",
    "SELECT doc_id, min(doc_id) OVER w AS first_id, count(*) OVER w AS n_same FROM documents WINDOW w AS (PARTITION BY length(text), md5(text))",
)
def duplicate_files(spark, folder):
    """The same-file test: equal length and content; each file with its group's first instead of all pairs."""
    rows = table(spark, folder, "documents").select("doc_id", F.length("text").alias("n"), F.md5("text").alias("h"))
    groups = rows.groupBy("n", "h").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_same"))
    return rows.join(groups, ["n", "h"]).select("doc_id", "first_id", "n_same")


@query(
    "resume_carry_forward",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'carried' ELSE 'redone' END AS origin, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE round(o_totalprice * 2, 2) END AS price FROM orders",
)
def resume_carry_forward(spark, folder):
    """Finished rows are carried unchanged, the others are worked on again; both by key against the earlier output."""
    orders = table(spark, folder, "orders")
    done = orders.where("o_orderstatus = 'F'").select("o_orderkey")
    carried = orders.join(done, "o_orderkey", "left_semi").select("o_orderkey", F.lit("carried").alias("origin"), F.col("o_totalprice").alias("price"))
    redone = orders.join(done, "o_orderkey", "left_anti").select("o_orderkey", F.lit("redone").alias("origin"), F.round(F.col("o_totalprice") * 2, 2).alias("price"))
    return carried.unionByName(redone)


@query(
    "clock_offset_first_selector",
    f"""WITH {E.SPANS}, s AS (SELECT event_id, start_s, end_s, CASE WHEN event_type LIKE 'c%k' THEN 90 WHEN user_id::VARCHAR LIKE '1_' THEN -30 WHEN event_type LIKE '%u%' THEN 5 END AS shift FROM spans)
SELECT event_id, start_s + coalesce(shift, 0) AS start_s, end_s + coalesce(shift, 0) AS end_s, start_s AS raw_start_s, CASE WHEN shift IS NULL THEN 'container' ELSE 'container+offset' END AS time_source FROM s""",
)
def clock_offset_first_selector(spark, folder):
    """Device clock corrections: the first selector that matches source or model shifts both ends; the claim is kept."""
    rows = E.spans(table(spark, folder, "events")).withColumn("model", F.col("user_id").cast("string"))
    both = M.first_selector(rows, [("c*k", 90)], ["event_type"]).withColumnRenamed("shift", "s1")
    both = M.first_selector(both, [("1?", -30)], ["model"]).withColumnRenamed("shift", "s2")
    both = M.first_selector(both, [("*u*", 5)], ["event_type"])
    shift = F.coalesce("s1", "s2", "shift").cast("long")
    moved = lambda c: (F.col(c) + F.coalesce(shift, F.lit(0))).alias(c)
    return both.select("event_id", moved("start_s"), moved("end_s"), F.col("start_s").alias("raw_start_s"), F.when(shift.isNull(), "container").otherwise("container+offset").alias("time_source"))


@query(
    "substring_ordered_collect",
    """WITH t AS (SELECT p_partkey, p_type || ' / ' || p_name || ' / ' || p_brand AS time FROM part), n AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS name FROM part UNION SELECT DISTINCT split_part(p_name, ' ', 2) FROM part)
SELECT p_partkey, coalesce(string_agg(name, ',' ORDER BY strpos(time, name), name) FILTER (name IS NOT NULL), '') AS clips FROM t LEFT JOIN n ON strpos(time, name) > 0 GROUP BY 1""",
)
def substring_ordered_collect(spark, folder):
    """Names found anywhere in a free-text field, in order of place."""
    part = table(spark, folder, "part").select("p_partkey", F.concat_ws(" / ", "p_type", "p_name", "p_brand").alias("time"), "p_name")
    names = part.select(F.explode(F.split("p_name", " ")).alias("name")).distinct()
    met = M.contained(part, "p_partkey", "time", names).select("p_partkey", F.struct("at", "name").alias("x"))
    rows = met.unionByName(part.select("p_partkey", F.lit(None).cast(met.schema["x"].dataType).alias("x")))  # a row without names has its key
    return rows.groupBy("p_partkey").agg(F.array_join(F.array_sort(F.collect_list("x")).getField("name"), ",").alias("clips"))


@query(
    "shingle_jaccard_best",
    """WITH t AS (SELECT DISTINCT p_name || ' ' || p_type AS title FROM part), m AS (SELECT DISTINCT p_name AS match FROM part),
tg AS (SELECT DISTINCT title, substr(f, i, 3) AS g FROM (SELECT title, regexp_replace(lower(title), '\\s+', '', 'g') AS f FROM t), unnest(range(1, length(f) - 1)) AS u(i)), mg AS (SELECT DISTINCT match, substr(f, i, 3) AS g FROM (SELECT match, regexp_replace(lower(match), '\\s+', '', 'g') AS f FROM m), unnest(range(1, length(f) - 1)) AS u(i)),
k AS (SELECT title, match, count(*) AS k FROM tg JOIN mg USING (g) GROUP BY ALL), na AS (SELECT title, count(*) AS na FROM tg GROUP BY 1), nb AS (SELECT match, count(*) AS nb FROM mg GROUP BY 1),
s AS (SELECT title, match, k / (na + nb - k)::DOUBLE AS score FROM k JOIN na USING (title) JOIN nb USING (match))
SELECT title, match, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY score DESC, match) AS r FROM s WHERE score >= 0.34) WHERE r = 1""",
)
def shingle_jaccard_best(spark, folder):
    part = table(spark, folder, "part")
    titles = part.select(F.concat_ws(" ", "p_name", "p_type").alias("title")).distinct()
    return M.best_jaccard(titles, part.select(F.col("p_name").alias("match")).distinct(), 0.34).select("title", "match", F.round("score", 9).alias("score"))


@query(
    "segment_backfill",
    """SELECT p_partkey, p_size AS display_order, coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_name END, t.topic, CASE WHEN length(lower(p_type)) > 0 THEN left(lower(p_type), 16) ELSE 'seg' END) AS title FROM part LEFT JOIN (SELECT p_brand, min(p_name) AS topic FROM part WHERE p_size > 45 GROUP BY 1) t USING (p_brand)""",
)
def segment_backfill(spark, folder):
    """Absent titles are filled from the hub's topic, else from a slug."""
    part = table(spark, folder, "part")
    hub = part.where("p_size > 45").groupBy("p_brand").agg(F.min("p_name").alias("topic"))
    own = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name"))
    return part.join(hub, "p_brand", "left").select("p_partkey", F.col("p_size").alias("display_order"), F.coalesce(own, "topic", T.safe_name(F.lower("p_type"))).alias("title"))


@query(
    "last_wins_lookup",
    "SELECT l_orderkey, arg_max(l_partkey, (l_linenumber, l_partkey)) AS last_part FROM lineitem GROUP BY 1",
)
def last_wins_lookup(spark, folder):
    """Of rows that repeat a key the last one counts."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return first_wins(rows, ["l_orderkey"], [F.desc("l_linenumber"), F.desc("l_partkey")]).select("l_orderkey", F.col("l_partkey").alias("last_part"))
