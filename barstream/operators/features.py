"""Training data for the direction model, splits and folds."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.functions.columns import DIGESTS, hash_bucket, hash_digest
from barstream.operators.slicing import Ordered, order_axis, order_table, windowed

# The model inputs.
FEATURES = ("close", "volume", "sma_5", "sma_10", "sma_20")
KEYS = ("symbol", "trade_time")


def label_direction(
    df: DataFrame | Ordered,
    horizon: int = 5,
    drop_unlabelled: bool = False,
    order: str | list[str] = "trade_time",
) -> DataFrame:
    """Add future_close and label: 1 if the close ``horizon`` rows on is higher.

    The last rows of a symbol have no future and get 0 unless dropped.
    """
    lead = lambda w: {"future_close": F.lead("close", horizon).over(w)}
    out = windowed(df, lead, "symbol", order, after=horizon)
    out = out.withColumn("label", F.when(F.col("future_close") > F.col("close"), 1).otherwise(0))
    return out.where("future_close IS NOT NULL") if drop_unlabelled else out


def drop_incomplete(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows where every named column has a value."""
    return df.na.drop(subset=list(columns))


def training_frame(
    prices: DataFrame | None,
    indicators: DataFrame | Ordered,
    horizon: int = 5,
    drop_unlabelled: bool = False,
    rows_per_part: int | None = None,
) -> DataFrame:
    """Keys, features and label; the rows are put in order and stored for it (see order_table).

    Indicators that are an ordered table of their own (``ordered_indicators``)
    are labelled as they lie; they take no prices beside them.

    Prices and indicators are joined on symbol and time; keys that occur twice
    multiply.  Indicators already hold close and volume, so ``prices=None``
    gives the same rows without the join when they come from the same prices.
    """
    if isinstance(indicators, Ordered):
        if prices is not None:
            raise ValueError("ordered indicators hold the prices already")
        labelled = label_direction(indicators, horizon, drop_unlabelled)
        return drop_incomplete(labelled.select(*KEYS, *FEATURES, "label"), (*FEATURES, "label"))
    if prices is None:
        joined = indicators.select(*KEYS, *FEATURES)
    else:
        left = prices.select(*KEYS, "close", "volume")
        right = indicators.select(*KEYS, "sma_5", "sma_10", "sma_20")
        joined = left.join(right, list(KEYS), "inner")
    labelled = label_direction(order_table(joined, "symbol", "trade_time", rows_per_part), horizon, drop_unlabelled)
    return drop_incomplete(labelled.select(*KEYS, *FEATURES, "label"), (*FEATURES, "label"))


def assemble(df: DataFrame, columns=FEATURES, output: str = "features") -> DataFrame:
    """Add the feature vector; rows with a missing input are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip").transform(df)


def mark_split(
    df: DataFrame,
    keys: list[str],
    test: float = 0.2,
    seed: int = 42,
    mode: str = "hash",
    time: str = "trade_time",
) -> DataFrame:
    """Add ``is_test``.

    ``hash`` picks rows by a hash of their key; ``time`` puts the newest share
    of the time axis into the test side, so that training sees no later rows.
    """
    if mode == "hash":
        picked = hash_digest(*keys, seed=seed) < test * DIGESTS
    elif mode == "time":
        axis = order_axis(df, time)
        cut = df.select(axis.alias("x")).agg(F.percentile_approx("x", 1.0 - test, 10_000)).scalar()
        picked = axis > cut
    else:
        raise ValueError(f"unknown split mode {mode!r}")
    return df.withColumn("is_test", picked)


def split(df: DataFrame, keys: list[str], test: float = 0.2, seed: int = 42, **options):
    """(train, test) frames."""
    marked = mark_split(df, keys, test, seed, **options)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def add_folds(df: DataFrame, keys: list[str], k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1 by a hash of the row key."""
    return df.withColumn("fold", hash_bucket(*keys, seed=seed, buckets=k))
