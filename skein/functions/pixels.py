"""Picture measures on pixel rows held as arrays: hashes, sharpness, histogram distance; and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _mean(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)


def mean_hash(pixels: Column) -> Column:
    """One character per pixel: whether it exceeds the mean."""
    return F.array_join(F.transform(F.transform(pixels, lambda x: x > _mean(pixels)), lambda b: b.cast("int").cast("string")), "")


def gradient_hash(pixels: Column, width: int) -> Column:
    """One character per neighbouring pair of a row: whether brightness rises."""
    rises = F.transform(pixels, lambda x, i: F.when((i + 1) % width != 0, (F.get(pixels, i + 1) > x).cast("int").cast("string")))
    return F.array_join(F.filter(rises, lambda c: c.isNotNull()), "")


def laplacian_variance(pixels: Column, width: int) -> Column:
    """Variance over the population of the four-neighbour Laplacian of the inner pixels."""
    at = lambda i: F.get(pixels, i)
    inner = F.filter(F.sequence(F.lit(width), F.size(pixels) - width - 1), lambda i: (i % width > 0) & (i % width < width - 1))
    edges = F.transform(inner, lambda i: at(i - 1) + at(i + 1) + at(i - width) + at(i + width) - 4 * at(i))
    squares = F.aggregate(edges, F.lit(0.0), lambda s, x: s + x * x) / F.size(edges)
    return squares - _mean(edges) * _mean(edges)


def histogram(pixels: Column, low: float, high: float, bins: int) -> Column:
    """Shares of pixels per bin; what lies outside counts in the outer bins."""
    bin_of = F.transform(pixels, lambda x: F.least(F.greatest(F.floor((x - low) * bins / (high - low)), F.lit(0)), F.lit(bins - 1)).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.size(F.filter(bin_of, lambda x: x == b)) / F.size(pixels))


def bhattacharyya(p: Column, q: Column) -> Column:
    """Distance of two histograms of shares, from 0 (equal) to 1."""
    common = F.aggregate(F.zip_with(p, q, lambda a, b: F.sqrt(a * b)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), 1 - common))


def fused_similarity(structure: Column, distance: Column) -> Column:
    """0.6 of a structural similarity and 0.4 of a histogram's; unknown structure gives unknown."""
    return 0.6 * structure + 0.4 * (1 - distance)


def polygon_area(xs: Column, ys: Column) -> Column:
    """Area of a polygon by its corners in order."""
    n = F.size(xs)
    terms = F.transform(xs, lambda x, i: x * F.get(ys, (i + 1) % n) - F.get(xs, (i + 1) % n) * F.get(ys, i))
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)) / 2
