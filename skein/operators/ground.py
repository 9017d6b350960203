"""Grounding: what of a slide's words is said around the time it is shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.functions.fuzzy import heard
from skein.operators.intervals import interval_join

PAD_MS = 20_000
#: Words up to this length must be heard exactly; longer ones with a partial ratio by kind.
EXACT_LENGTH = 7
#: Least partial ratio of a long keyword with a segment.
LEAST = {"drug": 90, "medical_term": 85, "general": 88}
QUICK_SLIDE_S, QUICK_WORDS = 10, 30
_STARTS = r"(?<![a-z0-9])(?=([a-z0-9][a-z0-9-]{1,6}))"
_CJK = r"(?=([\u4e00-\u9fff]{2,7}))"


def keywords(text: Column) -> Column:
    """Distinct (key, kind) of a slide's keywords in order; abbreviations keep their case. A token is classified once."""
    kinds = F.transform(F.array_distinct(T.words(text, T.GROUNDING_TOKEN)), lambda w: F.struct(w.alias("key"), T.keyword_class(w).alias("kind")))
    kept = F.filter(kinds, lambda k: k["kind"].isNotNull())
    return F.array_distinct(F.transform(kept, lambda k: F.struct(F.when(k["kind"] == "abbreviation", k["key"]).otherwise(F.lower(k["key"])).alias("key"), k["kind"].alias("kind"))))


def _heads(text: Column, pattern: str, lengths: list[int]) -> Column:
    """Distinct parts of the given lengths that begin where ``pattern`` matches."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))

    def cut(n: int) -> Column:
        return F.transform(F.filter(found, lambda x: F.length(x) >= n), lambda x: F.left(x, F.lit(n)))

    return F.array_distinct(F.flatten(F.array(*map(cut, lengths))))


def exact_marks(text: Column) -> Column:
    """What a segment's text offers to exact keywords: runs of letters and digits in their own case (after ``=``), and
    parts of up to seven characters from a word's start, or anywhere in Chinese."""
    low = F.lower(text)
    runs = F.transform(F.array_distinct(T.words(text, "[A-Za-z0-9]+")), lambda x: F.concat(F.lit("="), x))
    lengths = list(range(2, EXACT_LENGTH + 1))
    return F.concat(runs, _heads(low, _STARTS, lengths), _heads(low, _CJK, lengths))


def ground(slides: DataFrame, segments: DataFrame, domains: dict[str, list[str]] | None = None) -> DataFrame:
    """Per slide: densities of keywords, emphasis and confusion cues in the window, skip score, five keywords, domains.

    The window is the slide's time and 20 s on either side, not below 0, both ends included; a
    slide without segments keeps its row with zero densities. Abbreviations are heard in
    their own case between non-alphanumerics, keywords of up to seven characters at a word's start,
    longer ones where the partial ratio with one segment is at least 90 for drugs, 85 for
    medical terms and 88 for other words. ``domains`` names those with a hint (a substring, any case) in the slide's or the
    window's text.

    The join is an equi-join on (clip, time cell). Each pair of a slide and a segment is a row of its
    own: exact keywords by a hashed intersection of arrays, long ones in Arrow batches; hits,
    never texts, are gathered per slide.
    """
    w0, w1 = F.greatest((F.col("start_s") * 1000 - PAD_MS), F.lit(0)), F.col("end_s") * 1000 + PAD_MS
    windows = slides.select("slide_id", "start_s", "end_s", F.lower("quick_text").alias("own_low"), keywords(F.col("quick_text")).alias("keys"))
    named = lambda keep: F.transform(F.filter("keys", keep), lambda k: F.when(k["kind"] == "abbreviation", F.concat(F.lit("="), k["key"])).otherwise(k["key"]))
    is_long = lambda k: (k["kind"] != "abbreviation") & (F.length(k["key"]) > EXACT_LENGTH)
    least = F.transform(F.filter("keys", is_long), lambda k: F.when(k["kind"] == "drug", LEAST["drug"]).when(k["kind"] == "medical_term", LEAST["medical_term"]).otherwise(LEAST["general"]))
    windows = windows.select("slide_id", "start_s", "end_s", "own_low", named(lambda k: ~is_long(k)).alias("exact"), named(is_long).alias("long"), least.alias("least"), named(lambda k: F.lit(True)).alias("names"))
    spans = slides.select("slide_id", F.col("clip").alias("s_clip"), w0.alias("w0"), w1.alias("w1"))
    low = F.lower("text")
    cue = lambda parts: T.any_contains(low, parts).cast("double")
    hints = [F.when(T.any_contains(low, [h.lower() for h in parts]), F.lit(name)) for name, parts in (domains or {}).items()]
    texts = segments.select("clip", "seg_idx", "start_ms", "end_ms", low.alias("low"), exact_marks(F.col("text")).alias("marks"), cue(T.EMPHASIS).alias("e"), cue(T.CONFUSION).alias("c"), F.size(T.words(F.col("text"), r"\S+")).alias("n"), F.array_compact(F.array(*hints)).cast("array<string>").alias("about"))
    pairs = interval_join(spans, texts, [("s_clip", "clip")], ("w0", "w1"), ("start_ms", "end_ms"), 60_000)
    pairs = pairs.select(F.col("slide_id").alias("_slide"), "seg_idx", "e", "c", "n", "about", "marks", "low")
    none = F.array().cast("array<string>")
    # keywords are found once; the join and the sums below share one exchange by slide
    met = windows.join(pairs, F.col("slide_id") == F.col("_slide"), "left")
    met = met.withColumn("hit", F.concat(F.coalesce(F.array_intersect("exact", "marks"), none), F.coalesce(heard("long", "least", "low"), none)))
    gathered = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    own = [F.first(c).alias(c) for c in ("start_s", "end_s", "own_low", "names")]
    rows = met.groupBy("slide_id").agg(*own, F.avg("e").alias("emphasis"), F.avg("c").alias("confusion"), F.sum("n").alias("n_words"), F.count("seg_idx").alias("n_segments"), gathered("hit").alias("hit"), gathered("about").alias("about"))
    rows = rows.withColumn("hits", F.array_intersect("names", "hit"))
    plain = lambda names: F.transform(names, lambda x: F.when(F.startswith(x, F.lit("=")), F.right(x, F.length(x) - 1)).otherwise(x))
    n, h = F.size("names"), F.size("hits")
    density = F.when(n > 0, h / n).otherwise(0.0)
    quick = (F.col("end_s") - F.col("start_s") < QUICK_SLIDE_S) & (F.coalesce("n_words", F.lit(0)) < QUICK_WORDS)
    shown = [F.when(F.array_contains(F.coalesce("about", none), name) | T.any_contains(F.col("own_low"), [h.lower() for h in parts]), F.lit(name)) for name, parts in (domains or {}).items()]
    out = rows.select(
        "slide_id",
        F.coalesce("n_segments", F.lit(0)).alias("n_segments"),
        n.alias("n_keywords"),
        F.round(density, 6).alias("reference_density"),
        F.round(F.coalesce("emphasis", F.lit(0.0)), 6).alias("emphasis_score"),
        F.round(F.coalesce("confusion", F.lit(0.0)), 6).alias("confusion_score"),
        F.round(F.when(quick, 0.9).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - density))), 6).alias("skip_score"),
        F.array_join(F.slice(F.array_distinct(plain(F.concat("hits", "names"))), 1, 5), ",").alias("top_keywords"),
        F.array_join(F.array_compact(F.array(*shown)).cast("array<string>"), ",").alias("domains"),
    )
    return out if domains else out.drop("domains")
