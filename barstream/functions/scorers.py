"""Hook for user-supplied text scorers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark import Accumulator
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

NEUTRAL = 0.5


def make_scorer(fn: Callable, max_chars: int | None = None, min_chars: int = 5, batches: bool = False, errors: Accumulator | None = None):
    """Arrow UDF around a scorer of texts.

    ``fn(text) -> score``, or with ``batches`` ``fn(Series of texts) -> Series
    of scores``, which is called once per batch.  Missing or short texts are
    not passed on and score 0.5, as does a text on which ``fn`` raises.  A
    batch on which it raises is passed again text by text, so that a score
    never depends on what else is in the batch.  ``errors``, an accumulator,
    counts the texts that failed (those of a repeated task again).  Texts are
    passed whole unless ``max_chars`` says how much of them the scorer sees.
    """

    def guarded(score_of, text):
        try:
            return float(score_of(text))
        except Exception:
            if errors is not None:
                errors.add(1)
            return NEUTRAL

    def one(text):
        return guarded(fn, text)

    def many(texts: pd.Series) -> pd.Series:
        try:
            return fn(texts).astype("float64")
        except Exception:
            return texts.map(lambda text: guarded(lambda t: fn(pd.Series([t])).iloc[0], text))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        worth = texts[texts.notna() & (texts.str.strip().str.len() >= min_chars)]
        read = worth if max_chars is None else worth.str.slice(0, max_chars)
        out = pd.Series(NEUTRAL, index=texts.index)
        if len(read):
            out[read.index] = many(read) if batches else read.map(one)
        return out

    return score


def register_scorer(spark: SparkSession, name: str, fn: Callable, **limits):
    """Register ``fn`` for SQL under ``name`` and return the UDF."""
    return spark.udf.register(name, make_scorer(fn, **limits))
