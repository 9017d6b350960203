"""Rule scoring: skip gate, OCR routing, tiers, embed widths, language verdict, severities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Gates, weights, bonuses, thresholds and widths.
SKIP = {"density": 0.05, "text_len": 20, "file_kb": 80, "laplacian": 100}
WEIGHTS = {"visual_complexity": 0.15, "non_textual": 0.25, "reference_density": 0.30, "emphasis": 0.15, "time_spent": 0.15}
PENALTIES = {"skip": 0.30, "confusion": 0.20}
REDUNDANCY = (0.7, 0.20)
BONUSES = {"flowchart": 0.15, "kaplan_meier": 0.15, "ultrasound": 0.10, "xray": 0.10, "mri": 0.10, "anatomy": 0.08, "scatter_plot": 0.08, "decorative": -0.40}
TIERS = (0.65, 0.40)
FORCE_TIER_1 = ["diagnostic_algorithm", "treatment_protocol", "staging_schema"]
FORCE_TIER_3 = [["decorative"], ["title"], ["title", "decorative"]]
IMAGING = ["ultrasound", "xray", "mri"]


def skip_gate(density: Column, text_len: Column, file_kb: Column, laplacian: Column) -> tuple[Column, Column]:
    """(skip?, reasons): all four measures under their limits; an unknown density, size or sharpness keeps the slide."""
    tests = {"density": density < SKIP["density"], "text_len": text_len < SKIP["text_len"], "file_kb": file_kb < SKIP["file_kb"], "laplacian": laplacian < SKIP["laplacian"]}
    missing = density.isNull() | file_kb.isNull() | laplacian.isNull()
    reasons = F.filter(F.array(*[F.when(t, k) for k, t in tests.items()]), lambda x: x.isNotNull())
    return ~missing & reduce(lambda a, b: a & b, tests.values()), F.when(missing, F.array(F.lit("entropy_metrics_missing"))).otherwise(reasons)


def ocr_route(source: Column, text_len: Column, density: Column, image: Column) -> Column:
    """keep (text came with the page), skip (hardly any text), fallback (no image) or ocr."""
    thin = (text_len < 12) & density.isNotNull() & (density < 0.03)
    return F.when(source == "pdf", "keep").when(F.coalesce(thin, F.lit(False)), "skip").when(image.isNull(), "fallback").otherwise("ocr")


def ocr_fallback(text: Column, error: Column, confidence: Column) -> Column:
    """Why the second engine's text is taken: missing, error, low confidence; none when the first stands."""
    return F.when(text.isNull(), "missing").when(error.isNotNull(), "error").when(confidence < 0.60, "low_confidence").otherwise("none")


def tier_score(parts: dict[str, Column], types: Column) -> Column:
    """Weighted sum with content bonuses and speaker penalties, within 0 and 1."""
    zero = lambda name: F.coalesce(parts[name], F.lit(0.0))
    spent = F.least(zero("time_spent_s") / 120, F.lit(1.0))
    total = sum((zero(k) * w for k, w in WEIGHTS.items() if k != "time_spent"), F.lit(0.0)) + spent * WEIGHTS["time_spent"]
    for kind, bonus in BONUSES.items():
        total = total + F.when(F.array_contains(types, kind), bonus).otherwise(0.0)
    total = total - zero("skip") * PENALTIES["skip"] - zero("confusion") * PENALTIES["confusion"]
    total = total - F.when(zero("redundancy") > REDUNDANCY[0], REDUNDANCY[1]).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))


def tier_of(score: Column, types: Column, functions: Column, redundancy: Column, has_signals: Column) -> tuple[Column, Column]:
    """(tier, reason): functions that force 1, content that forces 3, the score's tier; imaging is at least 2."""
    by_score = F.when(score >= TIERS[0], 1).when(score >= TIERS[1], 2).otherwise(3)
    only = reduce(lambda a, b: a | b, [(F.size(F.array_except(types, F.array(*map(F.lit, s)))) == 0) & (F.size(F.array_distinct(types)) == len(s)) for s in FORCE_TIER_3])
    forced = F.arrays_overlap(functions, F.array(*map(F.lit, FORCE_TIER_1)))
    tier = F.when(~has_signals, 3).when(forced, 1).when(only, 3).when(redundancy > 0.9, 3).otherwise(by_score)
    reason = F.when(~has_signals, "no_signals").when(forced, "function").when(only, "content").when(redundancy > 0.9, "redundant").otherwise("score")
    floor = F.arrays_overlap(types, F.array(*map(F.lit, IMAGING))) & (tier == 3) & has_signals
    return F.when(floor, 2).otherwise(tier), F.when(floor, "imaging_floor").otherwise(reason)


def embed_width(tier: Column, types: Column) -> Column:
    """Pixels by content: wide diagrams, then images, then plain slides; none beyond tier 2."""
    wide = F.arrays_overlap(types, F.array(F.lit("flowchart"), F.lit("table")))
    image = F.arrays_overlap(types, F.array(*map(F.lit, IMAGING)))
    return F.when(tier > 2, F.lit(None)).when(wide, 600).when(image, 500).when(tier == 1, 450).otherwise(400)


def language_verdict(cjk: Column, latin: Column) -> tuple[Column, Column]:
    """(language, confidence) from character counts: how far a share lies beyond its language's boundary, half at the
    boundary, at most 1, to two places; half for bilingual text."""
    total = cjk + latin
    c, l = F.when(total > 0, cjk / total).otherwise(0.0), F.when(total > 0, latin / total).otherwise(0.0)  # noqa: E741
    lang = F.when(c >= 0.60, "zh").when((l >= 0.85) & (c < 0.10), "en").otherwise("bilingual")
    beyond = F.when(lang == "zh", (c - 0.60) / 0.40).when(lang == "en", (l - 0.85) / 0.15).otherwise(0.0)
    return lang, F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), beyond + 0.5)) + 1e-9, 2)
