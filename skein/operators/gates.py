"""Gates between stages: what is complete, what may go on, what must stop; and the order of files in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import text as T

#: Content whose pictures text cannot replace; containers and sound that browsers do not play.
SPATIAL = "flowchart chart kaplan_meier scatter_plot anatomy xray mri ultrasound".split()
REMUX = ".mts .m2ts .ts .avi .wmv .mkv .flv .mpg .mpeg .3gp".split()
WEB_AUDIO = ["aac", "mp3", "opus", "vorbis"]


def canonical_split(rows: DataFrame, flag: Column) -> tuple[DataFrame, DataFrame]:
    """(canonical rows, the others); a null flag is not canonical."""
    keep = F.coalesce(flag.cast("boolean"), F.lit(False))
    return rows.where(keep), rows.where(~keep)


def embeddable(tier: Column, suppressed: Column) -> Column:
    return (F.coalesce(tier, F.lit(3)) <= 2) & (F.coalesce(suppressed, F.lit("")) == "")


def complete(skipped: Column, types: Column) -> Column:
    """Whether an earlier run has done a slide: it was skipped on purpose, or has at least one content type."""
    return F.coalesce(skipped, F.lit(False)) | (F.coalesce(F.size(types), F.lit(0)) > 0)


def paste_allowed(labels: Column, ocr: Column, least: float = 0.20, short: int = 60) -> Column:
    """Whether cached labels may be used on a frame: they share enough of their words with its own text.

    Without labels, or with less than ``short`` characters of text, there is nothing to go by, and they may.
    """
    names = lambda t: F.array_distinct(F.transform(T.words(F.coalesce(t, F.lit("")), T.GUARD_TOKEN), lambda w: F.lower(w)))
    own = names(F.array_join(labels, " "))
    shared = F.size(F.array_intersect(own, names(ocr)))
    return (F.size(own) == 0) | (F.length(F.coalesce(ocr, F.lit(""))) < short) | (shared / F.size(own) >= least)


def overlap_suppressed(slide: Column, written: Column, types: Column, most: float = 0.70) -> Column:
    """Whether a slide's picture adds nothing to what is written: over 70 % of its words are, and it is not spatial content."""
    names = lambda t: F.array_distinct(F.transform(T.words(F.coalesce(t, F.lit("")), T.GUARD_TOKEN), lambda w: F.lower(w)))
    own = names(slide)
    share = F.try_divide(F.size(F.array_intersect(own, names(written))), F.size(own))
    return (F.coalesce(share, F.lit(0.0)) > most) & ~F.coalesce(F.arrays_overlap(types, F.array(*map(F.lit, SPATIAL))), F.lit(False))


def extension(name: Column) -> Column:
    """The part from the last dot on, in lower case; empty when there is none."""
    return F.lower(F.regexp_extract(name, r"(\.[^./\\]*)$", 1))


def stem(name: Column) -> Column:
    """A path's last part without its extension."""
    return F.regexp_replace(F.regexp_extract(name, r"([^/\\]*)$", 1), r"(?<=.)\.[^.]*$", "")


def needs_encoding(name: Column, audio: Column, force: bool = False, compress: bool = False) -> Column:
    """Whether a video must be written anew for browsers: asked for, or its container or its sound is not theirs."""
    return F.lit(force or compress) | extension(name).isin(REMUX) | ~F.lower(F.coalesce(audio, F.lit("?"))).isin(WEB_AUDIO)


def language_code(language: Column) -> Column:
    """The code that a speech service takes: null for automatic, Chinese for bilingual, else itself."""
    return F.when(language == "bilingual", "zh").when(language != "auto", language)


def counters(rows: DataFrame, by: str, called: Column, failed: Column, seconds: Column) -> DataFrame:
    """Per stage: rows, attempts, failures, their share, mean seconds of an attempt, seconds that the rest will take.

    Nothing attempted has no share and no estimate; :func:`guard` treats it as an error.
    """
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    out = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n_input"), n(called).alias("n_called"), n(called & failed).alias("n_failed"), F.avg(F.when(called, seconds)).alias("mean_s"))
    return out.withColumns({"fail_ratio": F.try_divide("n_failed", "n_called"), "eta_s": F.round((F.col("n_input") - F.col("n_called")) * F.col("mean_s"), 1)})


def verdict(n_called: Column, fail_ratio: Column, most: float = 0.20) -> Column:
    return F.when(n_called == 0, "nothing_attempted").when(fail_ratio > most, "failed").otherwise("ok")


class GateError(ValueError):
    """A stage's result must not be used."""


def guard(counted: DataFrame, most: float = 0.20) -> DataFrame:
    """``counted`` itself, unless it is empty or a stage attempted nothing or failed too often: then :class:`GateError`."""
    bad = counted.select(F.count(F.lit(1)).alias("n"), F.count_if(verdict(F.col("n_called"), F.col("fail_ratio"), most) != "ok").alias("bad")).first()
    if not bad.n or bad.bad:
        raise GateError(f"{bad.bad} of {bad.n} stages attempted nothing or failed more than {most:.0%}")
    return counted


def schema_fault(text: Column) -> Column:
    """Why a JSON text is not a result of an OCR engine: the first fault, or ``ok``.

    Wanted are ``fixture`` and ``engine`` (strings), ``blocks`` (a list of objects with a text),
    ``reading_order`` (a list of whole numbers), ``labels`` (a list), ``page_confidence`` and ``latency_s`` (numbers).
    """
    v = F.try_parse_json(text)
    kind = lambda x: F.schema_of_variant(x)
    number = "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
    wanted = {"fixture": "^STRING$", "engine": "^STRING$", "blocks": "^ARRAY.*", "reading_order": "^ARRAY.*", "labels": "^ARRAY.*", "page_confidence": number, "latency_s": number}
    fault = F.when(v.isNull() | ~F.coalesce(kind(v).startswith("OBJECT"), F.lit(False)), "not an object")
    for name, shape in wanted.items():
        part = F.try_variant_get(v, f"$.{name}", "variant")
        fault = fault.when(part.isNull(), f"missing {name}").when(~kind(part).rlike(shape), f"{name} wrong type")
    blocks = F.try_variant_get(v, "$.blocks", "array<variant>")
    malformed = F.transform(blocks, lambda b: F.coalesce(~kind(b).startswith("OBJECT"), F.lit(True)) | F.try_variant_get(b, "$.text", "variant").isNull())
    order = F.try_variant_get(v, "$.reading_order", "array<variant>")
    first = F.array_position(malformed, True)
    fault = fault.when(first > 0, F.concat(F.lit("block "), (first - 1).cast("string"), F.lit(" malformed")))
    return fault.when(F.exists(order, lambda x: F.coalesce(kind(x) != "BIGINT", F.lit(True))), "reading_order not all ints").otherwise("ok")


def ocr_items(text: Column) -> Column:
    """(text, confidence) of every item in either shape of an engine's JSON result.

    A list of ``[box, text, confidence]`` (confidence 0 when absent), alone or as the first of a pair with timings;
    or an object with ``txts``, ``boxes`` and ``scores`` side by side. Null and empty results have no items.
    """
    v = F.try_parse_json(text)
    texts, scores = F.try_variant_get(v, "$.txts", "array<string>"), F.try_variant_get(v, "$.scores", "array<double>")
    named = F.transform(texts, lambda t, i: F.struct(t.alias("text"), F.coalesce(F.get(scores, i), F.lit(0.0)).alias("confidence")))
    pair = F.try_variant_get(v, "$[0][0][1]", "string")  # only a pair's first member holds items there
    rows = F.when(pair.isNotNull(), F.try_variant_get(v, "$[0]", "array<variant>")).otherwise(F.try_variant_get(v, "$", "array<variant>"))
    listed = F.transform(
        F.filter(rows, lambda x: F.try_variant_get(x, "$[1]", "string").isNotNull()),
        lambda x: F.struct(F.try_variant_get(x, "$[1]", "string").alias("text"), F.coalesce(F.try_variant_get(x, "$[2]", "double"), F.lit(0.0)).alias("confidence")),
    )
    return F.coalesce(named, listed, F.array().cast("array<struct<text:string,confidence:double>>"))


def ordering(files: DataFrame, by: str) -> DataFrame:
    """``files`` (name, at, exif: whether the time is a camera's) with ``order_source`` and ``position`` within ``by``.

    Times order files unless all are absent or, of several files, fewer than two differ; then names do, in natural order. Files
    without a time come last, by name.
    """
    w = Window.partitionBy(by)
    n, timed = F.count(F.lit(1)).over(w), F.count("at").over(w)
    differ = F.size(F.collect_set("at").over(w))
    useless = (timed == 0) | ((n > 1) & (differ < 2))
    rows = files.withColumns({"_useless": useless, "_natural": T.natural_key(F.col("name"))})
    source = F.when(F.col("_useless") | F.col("at").isNull(), "filename").when(F.col("exif"), "exif").otherwise("mtime")
    order = Window.partitionBy(by).orderBy(F.when(F.col("_useless"), F.lit(None)).otherwise(F.col("at")).asc_nulls_last(), "_natural", "name")
    return rows.withColumns({"order_source": source, "position": F.row_number().over(order)}).drop("_useless", "_natural")


def bracketed(files: DataFrame, by: str, serial: str, at: str) -> DataFrame:
    """``files`` with ``after`` and ``before``: for one without a time, the times of the nearest timed files by serial number.

    Both look backwards, the second in the opposite order: a frame to the group's end is read anew for every row.
    """
    near = lambda order: F.last(at, ignorenulls=True).over(Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    earlier, later = near(F.col(serial).asc_nulls_first()), near(F.col(serial).desc_nulls_last())
    return files.withColumns({"after": F.when(F.col(at).isNull(), earlier), "before": F.when(F.col(at).isNull(), later)})


def clock_meaning(clips: DataFrame, by: str, at: str, offset: str, duration: str) -> DataFrame:
    """(by, meaning, spread): whether clips' times are of their start or their end, by which reading puts the recording's start in the narrower span.

    ``at`` less ``offset`` is the recording's start if ``at`` is a clip's start; less its ``duration`` as well if it is the end. Equal spans mean start.
    """
    start, end = F.col(at) - F.col(offset), F.col(at) - F.col(offset) - F.col(duration)
    spans = clips.groupBy(by).agg((F.max(start) - F.min(start)).alias("s"), (F.max(end) - F.min(end)).alias("e"))
    return spans.select(by, F.when(F.col("e") < F.col("s"), "end").otherwise("start").alias("meaning"), F.least("s", "e").alias("spread"))


def manifest_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """``manifest`` (idx, src) with ``file``: the file of that path, else the first of that name in any folder; null (with ``error``) when there is none."""
    exact = files.select(F.col("path").alias("src"), F.col("path").alias("_exact")).distinct()
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    named = files.groupBy(base.alias("_base")).agg(F.min("path").alias("_named"))
    rows = manifest.join(exact, "src", "left").join(named, F.regexp_extract("src", r"([^/]*)$", 1) == F.col("_base"), "left")
    file = F.coalesce("_exact", "_named")
    return rows.select(*manifest.columns, file.alias("file"), F.when(file.isNull(), "source file not found").alias("error"))


def durations(rows: DataFrame, by: str, seconds: Column, long: float = 15.0) -> DataFrame:
    """Per ``by``: count, mean, longest, and how many last over ``long`` seconds."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(seconds) + 1e-9, 3).alias("mean_s"), F.max(seconds).alias("max_s"), F.count_if(seconds > long).alias("n_long"))


def size_drift(cells: DataFrame, keys: list[str], size: list[str]) -> DataFrame:
    """Per grid position: pictures, distinct sizes, whether there is more than one size."""
    out = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*size)).alias("n_sizes"))
    return out.withColumn("drift", F.col("n_sizes") > 1)


def terms(text: Column, most: int = 50) -> Column:
    """Capitalised terms and acronyms, distinct, sorted, the first ``most`` (the feature's own limit)."""
    found = F.regexp_extract_all(text, F.lit(r"\b[A-Z][A-Za-z0-9₂₃]+(?:[-_/][A-Za-z0-9]+)*\b"), F.lit(0))
    return F.slice(F.array_sort(F.array_distinct(found)), 1, most)


def reliable(source: Column) -> Column:
    """Whether a capture time is a device's own claim: the file system's time, or none, is not."""
    return ~F.coalesce(source, F.lit("none")).rlike("^(mtime|none)")


def load_verdict(free_mb: Column, util: Column, heaviest_mb: Column, least_free: int = 4000, busy: int = 80, heavy: int = 1024) -> Column:
    """One look at an accelerator: blocked when too little is free, or another heavy user keeps it busy; warning when there is such a user."""
    user = F.coalesce(heaviest_mb >= heavy, F.lit(False))
    return F.when((free_mb < least_free) | (user & (util > busy)), "blocked").when(user, "warning").otherwise("ok")


def polled(polls: DataFrame, by: str, verdict: Column) -> DataFrame:
    """(by, n_polls, verdict): blocked only when every look was, otherwise the worst of those that were not."""
    every = F.bool_and(verdict == "blocked")
    return polls.groupBy(by).agg(F.count(F.lit(1)).alias("n_polls"), F.when(every, "blocked").when(F.bool_or(verdict == "warning"), "warning").otherwise("ok").alias("verdict"))


#: What a picture model reports, by kind.
SIGNALS = {
    "list": ["content_type", "apparent_educational_function", "visible_labels"],
    "bool": ["contains_measurement", "contains_algorithm", "contains_clinical_imaging"],
    "number": ["text_redundancy", "visual_complexity", "non_textual_information_density"],
}


def coerced(text: Column) -> list[Column]:
    """The model's report (JSON) as typed columns: a lone value for a list is a list of it; anything but false, 0, null and
    empty is true; what is no number is 0; what is absent is empty, false or 0."""
    v = F.try_parse_json(text)
    out = []
    for kind, names in SIGNALS.items():
        for name in names:
            part = F.try_variant_get(v, f"$.{name}", "variant")
            shape = F.coalesce(F.schema_of_variant(part), F.lit("VOID"))
            plain = F.try_variant_get(part, "$", "string")
            if kind == "list":
                many = F.coalesce(F.try_variant_get(part, "$", "array<string>"), F.array().cast("array<string>"))
                value = F.when(shape == "VOID", F.array().cast("array<string>")).when(shape.startswith("ARRAY"), many).otherwise(F.array(plain))
            elif kind == "bool":
                value = F.when(shape.isin("VOID", "ARRAY<VOID>", "OBJECT<>"), F.lit(False)).when(shape == "STRING", plain != "").when(shape.rlike("^(ARRAY|OBJECT)"), F.lit(True)).when(shape == "BOOLEAN", plain == "true").otherwise(F.coalesce(plain.try_cast("double") != 0, F.lit(False)))
            else:
                value = F.when(shape == "BOOLEAN", F.when(plain == "true", 1.0).otherwise(0.0)).otherwise(F.coalesce(plain.try_cast("double"), F.lit(0.0)))
            out.append(value.alias(name))
    return out


def plan_faults(rows: DataFrame, by: str) -> DataFrame:
    """Per plan: rows, rows without a slug, title, start or end, rows whose slug another has, rows that start before the one ahead ends, and the verdict.

    ``rows``: ``by``, seg, slug, title, start, end. A plan without faults is ``ok``; else the first kind of fault counts.
    """
    w = Window.partitionBy(by).orderBy("seg", "start")
    needed = F.col("slug").isNull() | F.col("title").isNull() | F.col("start").isNull() | F.col("end").isNull()
    again = (F.count("slug").over(Window.partitionBy(by, "slug")) > 1) & F.col("slug").isNotNull()
    marked = rows.withColumns({"_missing": needed, "_again": again, "_early": F.coalesce(F.col("start") < F.lag("end").over(w), F.lit(False))})
    out = marked.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("_missing").alias("n_missing"), F.count_if("_again").alias("n_repeated"), F.count_if("_early").alias("n_overlaps"))
    verdict = F.when(F.col("n_missing") > 0, "missing").when(F.col("n_repeated") > 0, "duplicate").when(F.col("n_overlaps") > 0, "overlap").otherwise("ok")
    return out.withColumn("verdict", verdict)
