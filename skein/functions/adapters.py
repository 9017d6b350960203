"""Foreign engines (recognition, description) behind one batch interface: registry, retries, fallbacks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: name -> function of a list of paths that gives a list of (text, confidence).
ENGINES: dict[str, Callable[[list[str]], list[tuple[str, float]]]] = {}


class Transient(Exception):
    """A failure worth another try."""


def engine(name: str):
    def put(function):
        ENGINES[name] = function
        return function

    return put


def retry(call, tries: int = 3, wait: float = 0.0):
    """The call's result; only transient failures are tried again, each time after twice the wait."""
    for n in range(tries):
        try:
            return call()
        except Transient:
            if n == tries - 1:
                raise
            time.sleep(wait * 2**n)
    return None


def run_engine(images: DataFrame, function: Callable, batch: int = 16, tries: int = 3, wait: float = 0.0) -> DataFrame:
    """(image, text, confidence, error) for ``images`` (image): batches are halved on memory errors, failures stay with their row."""

    def call(paths: list[str]) -> list[tuple]:
        try:
            return [(p, t, c, None) for p, (t, c) in zip(paths, retry(lambda: function(paths), tries, wait), strict=True)]
        except MemoryError:
            half = len(paths) // 2
            return call(paths[:half]) + call(paths[half:]) if half else [(paths[0], None, None, "memory")]
        except Exception as failed:  # a row's failure is data, the next engine's task
            return [(paths[0], None, None, str(failed) or type(failed).__name__)] if len(paths) == 1 else [r for p in paths for r in call([p])]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            paths = part["image"].tolist()
            rows = [r for k in range(0, len(paths), batch) for r in call(paths[k : k + batch])]
            yield pd.DataFrame(rows, columns=["image", "text", "confidence", "error"])

    return images.select("image").mapInPandas(run, "image string, text string, confidence double, error string")


def with_fallback(first: DataFrame, second: DataFrame, least: float = 0.6) -> DataFrame:
    """The first engine's text unless it failed or is unsure; then the second one's, with the reason."""
    other = second.select("image", F.col("text").alias("text2"))
    why = F.when(F.col("error").isNotNull(), "error").when(F.col("text").isNull(), "missing").when(F.col("confidence") < least, "low_confidence")
    both = first.withColumn("reason", why).join(other, "image", "left")
    return both.select("image", F.when(F.col("reason").isNull(), F.col("text")).otherwise(F.coalesce("text2", "text")).alias("text"), "reason")
