"""Technical indicators per symbol, in time order.

Every function takes a frame, or an ordered table (``slicing.order_table``) in
which no symbol is too large for a task; such a table has its own key and order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barstream.functions.columns import ratio
from barstream.operators.ranking import latest_per_key
from barstream.operators.recurrence import Smooth, smooth
from barstream.operators.slicing import Ordered, extended, windowed

KEY, TIME = "symbol", "trade_time"
SPANS = (5, 10, 20)


def _order(order):
    return [order] if isinstance(order, str) else list(order)


def sma(
    df: DataFrame | Ordered,
    spans: tuple[int, ...] = SPANS,
    column: str = "close",
    key: str = KEY,
    order: str | list[str] = TIME,
) -> DataFrame:
    """Add ``sma_<n>``: mean of this row and the n-1 before it.

    Early rows average what exists.  All spans share one exchange and sort.
    """
    return windowed(df, _means(spans, column), key, order, before=max(spans) - 1)


def _means(spans: tuple[int, ...], column: str):
    return lambda w: {f"sma_{n}": F.avg(column).over(w.rowsBetween(1 - n, 0)) for n in spans}


def ordered_indicators(prices: Ordered) -> Ordered:
    """The ordered prices with their three SMAs, stored in order for what is computed from them (the label)."""
    return extended(prices, _means(SPANS, "close"), before=max(SPANS) - 1)


def newest_indicators(prices: DataFrame) -> DataFrame:
    """Each symbol's newest row of the indicator table, averaged over its newest rows alone."""
    rows = latest_per_key(prices, KEY, TIME, n=max(SPANS))
    return latest_per_key(indicator_table(rows), KEY, TIME)


def indicator_table(prices: DataFrame | Ordered, order: str | list[str] = TIME) -> DataFrame:
    """The stored indicator table: symbol, time, close, volume and three SMAs."""
    if isinstance(prices, Ordered):
        return sma(prices).select(KEY, TIME, "close", "volume", *[f"sma_{n}" for n in SPANS])
    extra = [c for c in _order(order) if c != TIME]
    base = prices.select(KEY, TIME, "close", "volume", *extra)
    return sma(base, order=order).drop(*extra)


def boll(
    df: DataFrame | Ordered,
    n: int = 20,
    width: float = 2.0,
    column: str = "close",
    key: str = KEY,
    order: str | list[str] = TIME,
) -> DataFrame:
    """Add boll_mid, boll_upper, boll_lower: mean and +/- width population deviations."""

    def build(w):
        frame = w.rowsBetween(1 - n, 0)
        return {"boll_mid": F.avg(column).over(frame), "_dev": F.stddev_pop(column).over(frame)}

    out = windowed(df, build, key, order, before=n - 1)
    return out.withColumns(
        {
            "boll_upper": F.col("boll_mid") + width * F.col("_dev"),
            "boll_lower": F.col("boll_mid") - width * F.col("_dev"),
        }
    ).drop("_dev")


def ema(
    df: DataFrame | Ordered,
    n: int,
    column: str = "close",
    key: str = KEY,
    order: str | list[str] = TIME,
    name: str | None = None,
) -> DataFrame:
    """Add ``ema_<n>`` with weight 2/(n+1), started at the first value."""
    step = Smooth(name or f"ema_{n}", ((column, 1.0),), 2.0 / (n + 1))
    return smooth(df, [step], key, order)


def macd(
    df: DataFrame | Ordered,
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    column: str = "close",
    key: str = KEY,
    order: str | list[str] = TIME,
) -> DataFrame:
    """Add dif, dea and macd = 2 * (dif - dea).  One shuffle for all three averages."""
    steps = [
        Smooth("_fast", ((column, 1.0),), 2.0 / (fast + 1)),
        Smooth("_slow", ((column, 1.0),), 2.0 / (slow + 1)),
        Smooth("dea", (("_fast", 1.0), ("_slow", -1.0)), 2.0 / (signal + 1)),
    ]
    out = smooth(df, steps, key, order)
    dif = F.col("_fast") - F.col("_slow")
    return out.withColumns({"dif": dif, "macd": 2 * (dif - F.col("dea"))}).drop("_fast", "_slow")


def rsi(
    df: DataFrame | Ordered,
    n: int = 14,
    column: str = "close",
    key: str = KEY,
    order: str | list[str] = TIME,
) -> DataFrame:
    """Add ``rsi_<n>`` (Wilder smoothing, weight 1/n, started at the first change).

    NULL on the first row of a symbol; 50 where nothing has moved.  A row
    without a value is passed over: the next change is from the last value.
    """
    steps = [
        Smooth("_up", ((f"+{column}", 1.0),), 1.0 / n),
        Smooth("_down", ((f"-{column}", 1.0),), 1.0 / n),
    ]
    up, down = F.col("_up"), F.col("_down")
    value = F.when(up.isNotNull(), ratio(100 * up, up + down, 50.0))
    return smooth(df, steps, key, order).withColumn(f"rsi_{n}", value).drop("_up", "_down")
