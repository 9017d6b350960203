"""Language ID: text likelihoods, declared markup language, address suffix and host priors, fused by Bayes' rule."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import mix64, stored

BITS = 16
#: Most labelled rows of a language and characters in all that the text model is fitted on; every labelled language is in it.
MAX_ROWS, MAX_CHARS = 800, 12_000_000
#: A text's trigrams count as this many independent ones at most; weight of the parent level in a prior.
EVIDENCE, KAPPA, ALPHA = 60.0, 8.0, 0.5
#: Rows up to which tables of counts by host, suffix or declaration are broadcast whole; beyond, only keys with at least one in
#: so many of all rows are (no more than that many), and the rest is joined by a shuffle in which no key is hot.
BROADCAST_ROWS, HOT_PART = 2000, 1000
#: Sampled ids up to which they are broadcast.
BROADCAST_IDS = 40_000

_DROP = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def visible_text(html: str) -> str:
    """Markup, scripts, styles and comments are dropped; entities stay (their letters are few)."""
    return _DROP.sub(" ", html)


def _buckets(text: str) -> np.ndarray:
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, dtype=np.int64)
    word = (points[:-2] * np.uint64(0x100000001B3) + points[1:-1]) * np.uint64(0x100000001B3) + points[2:]
    return (mix64(word) >> np.uint64(64 - BITS)).astype(np.int64)


def text_model(texts: list[str], langs: list[str]) -> tuple[list[str], np.ndarray]:
    """(languages in order, log-likelihood of every trigram bucket under each), add-half smoothed."""
    names = sorted(set(langs)) or ["und"]
    counts = np.full((len(names), 1 << BITS), 0.5)
    for text, lang in zip(texts, langs, strict=True):
        counts[names.index(lang)] += np.bincount(_buckets(text), minlength=1 << BITS)
    return names, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def fit_text_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Fitted on the first ``MAX_ROWS`` rows of each language by hash of the id, up to ``MAX_CHARS`` characters."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}  # a number a language
    names = sorted(counts)
    if not names:
        return text_model([], [])
    order = [F.xxhash64(id_col), F.col(id_col)]
    # the least hashes: about twice MAX_ROWS of each language are left before rows are ranked, however many there are
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.1, 2.0 * MAX_ROWS / n))]), F.col(lang_col))
    few = known.select(id_col, lang_col).where(F.xxhash64(id_col) / 2.0**64 + 0.5 <= share)
    first = F.row_number().over(Window.partitionBy(lang_col).orderBy(*order))
    ids = few.withColumn("_n", first).where(F.col("_n") <= MAX_ROWS).select(F.col(id_col).alias("_p")).distinct()
    ids = F.broadcast(ids) if len(names) * MAX_ROWS <= BROADCAST_IDS else ids
    rows = known.join(ids, known[id_col] == ids["_p"], "left_semi").orderBy(*order, lang_col, text_col).select(text_col, lang_col)
    texts, langs, chars = [], [], dict.fromkeys(names, 0)
    for text, lang in rows.toLocalIterator():
        if lang in chars and chars[lang] < MAX_CHARS / len(names):
            texts.append(text)
            langs.append(lang)
            chars[lang] += len(text)
    return text_model(texts, langs)


def text_evidence(items: DataFrame, model: tuple[list[str], np.ndarray], markup: str = "markup") -> DataFrame:
    """``items`` (key columns, ``text``, ``markup`` flag) without the text, with ``ll`` (one number a language) and ``best``."""
    names, table = model
    shared = items.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T))  # languages x 65,536 numbers
    keys = [f for f in items.schema.fields if f.name not in ("text", markup)]

    def run(batches):
        for batch in batches:
            at, flag = batch.schema.get_field_index("text"), batch.schema.get_field_index(markup)
            ll = np.zeros((batch.num_rows, len(names)))
            for k, (text, is_markup) in enumerate(zip(batch.column(at).to_pylist(), batch.column(flag).to_pylist(), strict=True)):
                got = _buckets(visible_text(text) if is_markup else text) if text else ()
                if len(got):
                    ll[k] = shared.value[got].mean(0, dtype=np.float64) * min(len(got), EVIDENCE)
            ll = np.round(ll - ll.max(1, keepdims=True), 6)
            best = pa.array([names[j] if any(row) else None for j, row in zip(ll.argmax(1), ll, strict=True)], pa.string())
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in keys]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(list(ll), pa.list_(pa.float64())), best], names=[*[f.name for f in keys], "ll", "best"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys) + ", ll array<double>, best string"
    return items.mapInArrow(run, schema)


def _attach(rows: DataFrame, counts: DataFrame, on: list[str], value: str, total: int) -> DataFrame:
    """``rows`` with the array ``value`` of ``counts`` (``on``, ``n``, ``rows``), null where a key is null or unknown."""
    table = stored(counts, f"{value}-counts")
    plain = table.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("n").alias(value), "rows")
    whole = table.count() <= BROADCAST_ROWS
    hot = plain if whole else plain.where(F.col("rows") * HOT_PART >= total)
    met = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on[:-1]] + [F.col(on[-1]) == F.col(f"_{on[-1]}")])
    keys = [f"_{c}" for c in on]
    rows = rows.join(F.broadcast(hot.drop("rows")), met, "left").drop(*keys)  # at most BROADCAST_ROWS or HOT_PART rows
    if whole:
        return rows
    cold = plain.where(F.col("rows") * HOT_PART < total).select(*keys, F.col(value).alias("_cold"), F.lit(-1).alias("_open"))
    # rows that need nothing more are dealt evenly: they carry a number that no count has
    need = F.col(on[-1]).isNotNull() & F.col(value).isNull()
    rows = rows.withColumn("_turn", F.when(need, F.lit(-1)).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("int")))
    joined = rows.join(cold.hint("merge"), (F.col("_turn") == F.col("_open")) & met, "left")
    return joined.withColumn(value, F.coalesce(value, "_cold")).drop("_turn", "_open", "_cold", *keys)


def fuse(scored: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``lang`` and ``confidence`` to rows with ``declared``, ``suffix``, ``host``, ``ll`` and ``best``.

    Counts of the text's best guesses are grouped by host, suffix and in all. A host's prior
    is its counts (without the row's own guess) and ``KAPPA`` parts of its suffix's prior, that
    one its counts and ``KAPPA`` parts of the overall shares. A declared language weighs by how
    often it stands on texts of each language. Null host, suffix or declaration is no evidence of that level.
    """
    one = lambda col, k: F.sum((F.col(col) == names[k]).cast("long"))
    counts = lambda df, *by: df.groupBy(*by).agg(F.array(*[F.coalesce(one("best", k), F.lit(0)) for k in range(len(names))]).alias("n"), F.count(F.lit(1)).alias("rows"))
    n_rows = scored.count()
    total = counts(scored).select(F.col("n").alias("n_all"))
    rows = _attach(scored, counts(scored.where("host IS NOT NULL"), "suffix", "host"), ["suffix", "host"], "n_host", n_rows)
    rows = _attach(rows, counts(scored.where("suffix IS NOT NULL"), "suffix"), ["suffix"], "n_suffix", n_rows)
    rows = _attach(rows, counts(scored.where("declared IS NOT NULL"), "declared"), ["declared"], "n_told", n_rows)
    rows = rows.crossJoin(F.broadcast(total))  # one row

    def at(array: str, k: int) -> Column:
        return F.coalesce(F.get(F.col(array), F.lit(k)), F.lit(0)).cast("double")

    n_all = sum((at("n_all", k) for k in range(len(names))), F.lit(0.0))
    n_suffix = sum((at("n_suffix", k) for k in range(len(names))), F.lit(0.0))
    n_host = sum((at("n_host", k) for k in range(len(names))), F.lit(0.0))
    parts = []
    for k, name in enumerate(names):
        own = F.coalesce((F.col("best") == name).cast("double"), F.lit(0.0))
        some = F.when(F.col("best").isNotNull(), 1.0).otherwise(0.0)
        whole = (at("n_all", k) + 1) / (n_all + len(names))
        mid = F.when(F.col("suffix").isNull(), whole).otherwise((at("n_suffix", k) - own + KAPPA * whole) / (n_suffix - some + KAPPA))
        prior = F.when(F.col("host").isNull(), mid).otherwise((at("n_host", k) - own + KAPPA * mid) / (n_host - some + KAPPA))
        said = F.when(F.col("declared").isNull(), 0.0).otherwise(F.log((at("n_told", k) + ALPHA) / (at("n_all", k) + ALPHA * 10)))
        parts.append(F.get("ll", F.lit(k)) + F.log(prior) + said)
    logs = F.array(*[F.round(p, 6) for p in parts])
    rows = rows.withColumn("_post", logs).withColumn("_top", F.array_max("_post"))
    mass = F.aggregate(F.transform("_post", lambda x: F.exp(x - F.col("_top"))), F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("lang", F.element_at(F.array(*map(F.lit, names)), F.array_position("_post", F.col("_top")).cast("int"))).withColumn("confidence", F.round(1 / mass, 6))


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def identify(pages: DataFrame, docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """One row per page and per document: ``doc_id`` or ``page_id``, ``host``, ``declared``, ``suffix``, ``lang``, ``confidence``, ``text_lang``.

    ``pages`` (page_id, url, html) have all four kinds of evidence; ``docs`` (doc_id, text,
    source) have text and, as host, their source; their ``lang`` only labels the rows that the
    text model is fitted on. Null or empty texts have no text evidence (``text_lang`` null) and
    fall back on the other kinds, in the end on the overall shares; ties go to the language first
    in the alphabet. Null ids are ids like others. Repeated rows are rows of their own and count as
    such, empty tables give none; other columns are ignored, whatever their names. Texts of any length count
    as ``EVIDENCE`` trigrams at most. Texts are read once, in full; what is exchanged are counts and rows of numbers.
    """
    model = model or fit_text_model(docs)
    declared = F.nullif(F.lower(F.regexp_extract("html", r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})\b""", 1)), F.lit(""))
    host = host_of(F.col("url"))
    web = pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", host.alias("host"), declared.alias("declared"), F.nullif(F.regexp_extract(host, r"\.([a-z]{2,})$", 1), F.lit("")).alias("suffix"), F.col("html").alias("text"), F.lit(True).alias("markup"))
    plain = docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), F.col("source").alias("host"), F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("suffix"), "text", F.lit(False).alias("markup"))
    scored = stored(text_evidence(web.unionByName(plain), model), "language-evidence")
    return fuse(scored, model[0]).select("doc_id", "page_id", "host", "declared", "suffix", "lang", "confidence", F.col("best").alias("text_lang"))
