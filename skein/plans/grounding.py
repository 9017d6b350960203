"""Grounding, keywords, suspects and vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators.ground import ground
from skein.operators.sequences import top_k
from skein.plans.base import query, table
from skein.sources import entities as E


def sql_list(items) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def sql_any(text: str, items) -> str:
    return "(" + " OR ".join(f"contains({text}, '" + x.replace("'", "''") + "')" for x in items) + ")"


def sql_class(t: str) -> str:
    ends = lambda suffixes: " OR ".join(f"(ends_with(lower({t}), '{s}') AND length({t}) > {len(s) + 2})" for s in suffixes)
    return f"""CASE WHEN (length({t}) <= 4 AND regexp_full_match({t}, '[A-Z]+')) OR list_contains({sql_list(a.upper() for a in T.ABBREVIATIONS)}, upper({t})) THEN 'abbreviation'
      WHEN {ends(T.DRUG_SUFFIXES)} THEN 'drug' WHEN {ends(T.TERM_SUFFIXES)} THEN 'medical_term' WHEN length({t}) >= 5 THEN 'general' END"""


#: A map of domains and their hints for the tables at hand (the map is a parameter).
DOMAINS = {"licence": ["licensed under", "copyright"], "contact": ["@", "phone"], "secrets": ["token", "akia"]}

TOKEN = r"[A-Za-z][A-Za-z0-9\-]{1,}|[\x{4e00}-\x{9fff}]{2,}"


@query(
    "ground_slides",
    f"""
WITH RECURSIVE {E.SEGMENTS}, {E.SLIDES},
w AS (SELECT slide_id, clip, quick_text, start_s, end_s, greatest(start_s * 1000 - 20000, 0) AS w0, end_s * 1000 + 20000 AS w1 FROM slides),
heard AS (SELECT w.slide_id, g.clip, g.seg_idx, g.text FROM w JOIN segments g ON g.clip = w.clip AND g.end_ms >= w.w0 AND g.start_ms <= w.w1),
said AS (SELECT slide_id, avg(CASE WHEN {sql_any("lower(text)", T.EMPHASIS)} THEN 1.0 ELSE 0.0 END) AS emphasis,
   avg(CASE WHEN {sql_any("lower(text)", T.CONFUSION)} THEN 1.0 ELSE 0.0 END) AS confusion, count(*) AS n,
   string_agg(regexp_replace(lower(text), '([a-z0-9]+)', chr(1) || '\\1', 'g'), chr(3)) AS low,
   string_agg(regexp_replace(text, '([A-Za-z0-9]+)', chr(1) || '\\1' || chr(2), 'g'), chr(3)) AS own,
   sum(len(regexp_extract_all(text, '\\S+'))) AS n_words FROM heard GROUP BY 1),
toks AS (SELECT slide_id, i, t, {sql_class("t")} AS kind FROM (SELECT slide_id, i, k[i] AS t FROM (SELECT slide_id, regexp_extract_all(quick_text, '{TOKEN}') AS k FROM w), unnest(range(1, len(k) + 1)) AS u(i))),
keys AS MATERIALIZED (SELECT slide_id, key, kind, min(i) AS i FROM (SELECT slide_id, i, kind, CASE WHEN kind = 'abbreviation' THEN t ELSE lower(t) END AS key FROM toks WHERE kind IS NOT NULL) GROUP BY ALL),
meet AS (SELECT DISTINCT clip, seg_idx, key, CASE kind WHEN 'drug' THEN 90 WHEN 'medical_term' THEN 85 ELSE 88 END AS least, lower(text) AS t FROM keys JOIN heard USING (slide_id) WHERE kind <> 'abbreviation' AND length(key) > 7),
fit AS (SELECT *, 2 * length(a) * (100 - least) // 100 AS ed FROM (SELECT clip, seg_idx, key, least, CASE WHEN length(t) < length(key) THEN t ELSE key END AS a, CASE WHEN length(t) < length(key) THEN key ELSE t END AS b, length(t) > 0 AND (contains(t, key) OR contains(key, t)) AS whole FROM meet)),
piece AS (SELECT *, length(a) * k // (ed + 1) AS x, substr(a, length(a) * k // (ed + 1) + 1, length(a) * (k + 1) // (ed + 1) - length(a) * k // (ed + 1)) AS q FROM fit, unnest(range(ed + 1)) AS u(k) WHERE NOT whole),
spot AS (SELECT *, unnest(list_filter(range(1, length(b) + 1), lambda i: substr(b, i, length(q)) = q)) AS spot FROM piece WHERE q <> '' AND contains(b, q)),
start AS (SELECT clip, seg_idx, key, least, a, b, spot - 1 - x + d AS i FROM spot, unnest(range(-ed, ed + 1)) AS u(d)
  UNION ALL SELECT clip, seg_idx, key, least, a, b, i FROM fit, unnest(list_concat(range(-ed, 0), range(length(b) - length(a) + 1, length(b) - length(a) + ed + 1))) AS u(i) WHERE NOT whole),
win AS (SELECT clip, seg_idx, key, least, a, substr(b, greatest(i, 0) + 1, i + length(a) - greatest(i, 0)) AS v FROM start WHERE i BETWEEN 1 - length(a) AND length(b) - 1),
near AS MATERIALIZED (SELECT DISTINCT * FROM win WHERE 100 * levenshtein(a, regexp_replace(v, '[^\\x00-\\x7f]', chr(1), 'g')) <= (100 - least) * (length(a) + length(v))),
lcs AS (SELECT DISTINCT a, v, 0 AS i, list_transform(range(length(v)), lambda x: 0) AS r FROM near
  UNION ALL SELECT a, v, i + 1, list_transform(range(1, length(v) + 1), lambda j: list_max(c[1:j])) FROM (
    SELECT a, v, i, list_transform(range(1, length(v) + 1), lambda j: greatest(r[j], CASE WHEN j > 1 THEN r[j - 1] ELSE 0 END + CASE WHEN a[i + 1] = v[j] THEN 1 ELSE 0 END)) AS c FROM lcs WHERE i < length(a))),
close AS (SELECT clip, seg_idx, key FROM fit WHERE whole UNION SELECT clip, seg_idx, key FROM near n JOIN lcs l ON l.a = n.a AND l.v = n.v AND l.i = length(l.a) WHERE 200 * r[length(l.v)] >= least * (length(l.a) + length(l.v))),
fuzzy AS (SELECT DISTINCT slide_id, key FROM heard JOIN close USING (clip, seg_idx)),
hit AS (SELECT k.*, coalesce(CASE WHEN kind = 'abbreviation' THEN contains(own, regexp_replace(key, '([A-Za-z0-9]+)', chr(1) || '\\1' || chr(2), 'g'))
   WHEN length(key) <= 7 THEN contains(low, regexp_replace(key, '([a-z0-9]+)', chr(1) || '\\1', 'g')) ELSE f.key IS NOT NULL END, false) AS heard
   FROM keys k LEFT JOIN said USING (slide_id) LEFT JOIN fuzzy f USING (slide_id, key)),
names AS (SELECT slide_id, key, min(CASE WHEN heard THEN 0 ELSE 1 END) AS p, min(CASE WHEN heard THEN i END) AS ih, min(i) AS i FROM hit GROUP BY ALL),
tops AS (SELECT slide_id, string_agg(key, ',' ORDER BY r) AS top FROM (SELECT slide_id, key, row_number() OVER (PARTITION BY slide_id ORDER BY p, coalesce(ih, i)) AS r FROM names) WHERE r <= 5 GROUP BY 1),
sums AS (SELECT slide_id, count(*) AS nk, count(*) FILTER (heard) AS nh FROM hit GROUP BY 1),
about AS (SELECT slide_id, lower(quick_text) || chr(3) || coalesce(string_agg(lower(text), chr(3)), '') AS t FROM w LEFT JOIN heard USING (slide_id) GROUP BY slide_id, quick_text)
SELECT w.slide_id, coalesce(s.n, 0) AS n_segments, coalesce(nk, 0) AS n_keywords, round(coalesce(nh / nullif(nk, 0)::DOUBLE, 0.0), 6) AS reference_density,
   round(coalesce(emphasis, 0.0), 6) AS emphasis_score, round(coalesce(confusion, 0.0), 6) AS confusion_score,
   round(CASE WHEN end_s - start_s < 10 AND coalesce(n_words, 0) < 30 THEN 0.9 ELSE 1 - coalesce(nh / nullif(nk, 0)::DOUBLE, 0.0) END, 6) AS skip_score, coalesce(top, '') AS top_keywords,
   array_to_string(list_filter([{", ".join(f"CASE WHEN {sql_any('t', hints)} THEN '{name}' END" for name, hints in DOMAINS.items())}], lambda x: x IS NOT NULL), ',') AS domains
FROM w LEFT JOIN said s USING (slide_id) LEFT JOIN sums USING (slide_id) LEFT JOIN tops USING (slide_id) JOIN about USING (slide_id)
""",
)
def ground_slides(spark, folder):
    return ground(E.slides(table(spark, folder, "documents")), E.segments(table(spark, folder, "conversations")), DOMAINS)


@query(
    "keyword_classify",
    f"SELECT kind, count(*) AS n, count(DISTINCT t) AS n_distinct FROM (SELECT t, {sql_class('t')} AS kind FROM (SELECT unnest(regexp_extract_all(text, '{TOKEN}')) AS t FROM documents)) GROUP BY 1",
)
def keyword_classify(spark, folder):
    tokens = table(spark, folder, "documents").select(F.explode(T.words(F.col("text"), T.GROUNDING_TOKEN)).alias("t"))
    distinct = tokens.groupBy("t").count()  # map-side combined; the class is computed once per distinct token
    return distinct.groupBy(T.keyword_class(F.col("t")).alias("kind")).agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("n_distinct"))


ASCII = r"[A-Za-z][A-Za-z0-9''\-]*"

VOCABULARY = f"""
words AS (SELECT lower(t) AS w FROM (SELECT source, unnest(regexp_extract_all(text, '{ASCII}')) AS t FROM documents) GROUP BY 1 HAVING count(DISTINCT source) >= 3),
glossary AS (SELECT DISTINCT lower(t) AS w FROM (SELECT unnest(regexp_extract_all(text, '{ASCII}')) AS t FROM benchmark)),
suspects AS (SELECT lower(t) AS token, min(seg_idx) AS first_seg, count(*) AS n FROM (SELECT seg_idx, unnest(regexp_extract_all(text, '{ASCII}')) AS t FROM segments)
  WHERE lower(t) NOT IN (SELECT unnest({sql_list(T.STOPWORDS)})) AND lower(t) NOT IN (SELECT w FROM glossary)
    AND CASE WHEN regexp_full_match(t, '[A-Z0-9]{{2,6}}') THEN true ELSE length(t) >= 4 AND lower(t) NOT IN (SELECT w FROM words) END
  GROUP BY 1)"""


#: Distinct words up to which they are broadcast to the corpus (about 40 bytes each); beyond, corpus words are shuffled.
BROADCAST_WORDS = 300_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(documents, books: int = 3, of=None):
    """Words (w, n_books) found in at least ``books`` books (sources); of the words in ``of`` alone, where that is given.

    Letters are made small before words are cut out, so no array is walked twice; with a small ``of`` (counted
    first, then broadcast) other words never leave their task.
    """
    low = F.translate("text", _UPPER, _LOWER)
    found = documents.select("source", F.explode(T.words(low, r"[a-z][a-z0-9'\-]*")).alias("w"))
    if of is not None:
        found = found.join(F.broadcast(of) if of.count() <= BROADCAST_WORDS else of, "w", "left_semi")
    return found.distinct().groupBy("w").agg(F.count(F.lit(1)).alias("n_books")).where(F.col("n_books") >= books)


def suspects(segments, documents, glossary):
    """Tokens of a transcript that no stop word, glossary or vocabulary (of ``documents``) explains: first segment and count."""
    stop = segments.sparkSession.createDataFrame([(w,) for w in T.STOPWORDS], "w string")
    tokens = segments.select("seg_idx", F.explode(T.words(F.col("text"), T.ASCII_TOKEN)).alias("t"))
    counted = tokens.groupBy("t").agg(F.min("seg_idx").alias("first_seg"), F.count(F.lit(1)).alias("n")).withColumn("w", F.lower("t"))
    rest = counted.join(F.broadcast(stop), "w", "left_anti").join(glossary, "w", "left_anti")
    acronym = F.col("t").rlike(T.ACRONYM)
    asked = rest.where(~acronym & (F.length("t") >= 4))
    known = vocabulary(documents, of=asked.select("w").distinct()).select("w")
    return rest.where(acronym).unionByName(asked.join(known, "w", "left_anti")).groupBy(F.col("w").alias("token")).agg(F.min("first_seg").alias("first_seg"), F.sum("n").alias("n"))


def _suspects(spark, folder):
    docs = table(spark, folder, "documents")
    glossary = table(spark, folder, "benchmark").select(F.explode(F.transform(T.words(F.col("text"), T.ASCII_TOKEN), F.lower)).alias("w")).distinct()
    return suspects(E.segments(table(spark, folder, "conversations")), docs, glossary), glossary


@query("suspect_tokens", f"WITH {E.SEGMENTS}, {VOCABULARY} SELECT token, first_seg, n FROM suspects")
def suspect_tokens(spark, folder):
    return _suspects(spark, folder)[0]


HINT_CAP = "greatest(2, length({t}) // 2)"
HINT_PARTS = 32


@query(
    "suspect_hints_topk",
    f"""
WITH {E.SEGMENTS}, {VOCABULARY},
pairs AS (SELECT token, w, levenshtein(token, w) AS d FROM suspects JOIN glossary ON abs(length(w) - length(token)) <= {HINT_CAP.format(t="token")}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY d, d / greatest(length(token), length(w))::DOUBLE, w) AS rank FROM pairs WHERE d > 0 AND d <= {HINT_CAP.format(t="token")})
SELECT token, w AS hint, d AS distance, rank FROM ranked WHERE rank <= 3
""",
)
def suspect_hints_topk(spark, folder):
    return hints(*_suspects(spark, folder))


def hints(found, glossary):
    """Nearest glossary words by capped edit distance, three per suspect.

    Every pair of distinct words within the length band meets; a length's suspects are dealt over ``HINT_PARTS`` keys.
    A letter that the other word lacks costs an edit of its own, so pairs with more such letters than the cap allows
    are dropped before the distance is computed; the distance is part of the join.
    """
    letters = lambda w: F.aggregate(F.split(w, ""), F.lit(0).cast("long"), lambda m, c: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)))
    cap = F.greatest(F.lit(2), F.floor(F.length("token") / 2)).cast("int")
    part = F.pmod(F.xxhash64("token"), F.lit(HINT_PARTS)).cast("int")
    terms = glossary.select("w", F.length("w").alias("n"), letters(F.col("w")).alias("w_letters")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(HINT_PARTS - 1))))
    left = found.select("token", cap.alias("cap"), part.alias("part"), letters(F.col("token")).alias("letters")).withColumn("n", F.explode(F.sequence(F.length("token") - F.col("cap"), F.length("token") + F.col("cap"))))
    near = (left["n"] == terms["n"]) & (left["part"] == terms["part"]) & F.expr("CASE WHEN bit_count(letters & ~w_letters) > cap OR bit_count(w_letters & ~letters) > cap OR token = w THEN false ELSE levenshtein(token, w, cap) >= 0 END")
    pairs = left.join(terms, near).select("token", "w", F.levenshtein("token", "w").alias("d"))
    order = ["d", F.col("d") / F.greatest(F.length("token"), F.length("w")), "w"]
    return top_k(pairs, ["token"], order, 3).select("token", F.col("w").alias("hint"), F.col("d").alias("distance"), "rank")


@query(
    "corpus_scan_capped",
    f"""
WITH files AS (SELECT source, left(text, 300000) AS t FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 15)
SELECT w AS word, count(DISTINCT source) AS n_books FROM (SELECT source, lower(unnest(regexp_extract_all(t, '{ASCII}'))) AS w FROM files) GROUP BY 1 HAVING count(DISTINCT source) >= 3
""",
)
def corpus_scan_capped(spark, folder):
    """The feature is a capped scan: 15 files of a book, 300,000 characters of a file; ids are ranked before texts are read."""
    docs = table(spark, folder, "documents")
    chosen = top_k(docs.select("source", "doc_id"), ["source"], ["doc_id"], 15).select("doc_id")
    files = docs.join(chosen, "doc_id", "left_semi").select("source", F.left("text", F.lit(300_000)).alias("text"))
    return vocabulary(files).select(F.col("w").alias("word"), "n_books")


@query(
    "glossary_first_wins",
    f"""
WITH t AS (SELECT 0 AS file, item_id AS id, unnest(regexp_extract_all(text, '{ASCII}')) AS s, generate_subscripts(regexp_extract_all(text, '{ASCII}'), 1) AS pos FROM benchmark
  UNION ALL SELECT 1, doc_id, unnest(regexp_extract_all(text, '{ASCII}')), generate_subscripts(regexp_extract_all(text, '{ASCII}'), 1) FROM documents WHERE lang = 'en')
SELECT key, surface FROM (SELECT lower(s) AS key, s AS surface, row_number() OVER (PARTITION BY lower(s) ORDER BY file, id, pos) AS r FROM t) WHERE r = 1
""",
)
def glossary_first_wins(spark, folder):
    """One surface form per lower-case token: the first by file, row and place; a struct minimum, combined on the map side."""
    spell = lambda df, file, key: df.select(F.lit(file).alias("file"), F.col(key).alias("id"), F.posexplode(T.words(F.col("text"), T.ASCII_TOKEN)).alias("pos", "surface"))
    every = spell(table(spark, folder, "benchmark"), 0, "item_id").unionByName(spell(table(spark, folder, "documents").where("lang = 'en'"), 1, "doc_id"))
    return every.groupBy(F.lower("surface").alias("key")).agg(F.min(F.struct("file", "id", "pos", "surface")).alias("x")).select("key", F.col("x.surface").alias("surface"))


@query(
    "token_overlap_audit",
    f"""
WITH stop AS (SELECT unnest({sql_list(T.SALIENT_STOP)}) AS w),
cap AS (SELECT item_id, w FROM (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9\\-]{{2,}}')) AS w FROM benchmark) WHERE w NOT IN (SELECT w FROM stop)),
frame AS (SELECT doc_id, w FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9\\-]{{2,}}')) AS w FROM documents) WHERE w NOT IN (SELECT w FROM stop)),
size AS (SELECT doc_id, count(*) AS n FROM frame GROUP BY 1),
pairs AS (SELECT d.doc_id, d.doc_id % (SELECT count(*) FROM benchmark) AS item_id FROM documents d),
shared AS (SELECT p.doc_id, count(*) AS k FROM pairs p JOIN frame f USING (doc_id) JOIN cap c ON c.item_id = p.item_id AND c.w = f.w GROUP BY 1)
SELECT p.doc_id, coalesce(n, 0) AS n_tokens, coalesce(k, 0) AS overlap,
  CASE WHEN coalesce(n, 0) < 3 THEN 'skip' WHEN coalesce(k, 0) = 0 THEN 'none' WHEN k = 1 THEN 'weak' ELSE 'ok' END AS verdict
FROM pairs p LEFT JOIN size USING (doc_id) LEFT JOIN shared USING (doc_id)
""",
)
def token_overlap_audit(spark, folder):
    """Words that a caption (a benchmark passage) shares with its frame (a document)."""
    bench = table(spark, folder, "benchmark")
    count = bench.agg(F.count(F.lit(1)).alias("n_items"))
    docs = table(spark, folder, "documents").crossJoin(F.broadcast(count)).select("doc_id", (F.col("doc_id") % F.col("n_items")).alias("item_id"), T.salient_tokens(F.col("text")).alias("frame"))  # one row
    both = docs.join(bench.select("item_id", T.salient_tokens(F.col("text")).alias("caption")), "item_id")
    n, k = F.size("frame"), F.size(F.array_intersect("frame", "caption"))
    return both.select("doc_id", n.alias("n_tokens"), k.alias("overlap"), F.when(n < 3, "skip").when(k == 0, "none").when(k == 1, "weak").otherwise("ok").alias("verdict"))


