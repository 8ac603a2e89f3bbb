"""Daily bars and their serving forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.functions.columns import iso_text
from barstream.operators.ranking import latest_per_key, of_codes

BAR_COLUMNS = (
    "stock_code", "start_time", "end_time",
    "open_price", "high_price", "low_price", "close_price", "volume",
)


def daily_bars(prices: DataFrame, ignore_zero: bool = False) -> DataFrame:
    """One bar per symbol and day: first open, high, low, last close, volume.

    First and last go by trade_time, which is unique per symbol in the clean
    table.  All aggregates combine map-side, so a hot symbol sends one row per
    day and task.  ``ignore_zero`` leaves filled-in zero lows out of the low.
    """
    low = F.nullif(F.col("low"), F.lit(0.0)) if ignore_zero else F.col("low")
    kind = "timestamp_ntz" if isinstance(prices.schema["trade_time"].dataType, T.TimestampNTZType) else "timestamp"
    bars = prices.groupBy(F.col("symbol").alias("stock_code"), F.to_date("trade_time").alias("_day")).agg(
        F.min_by("open", "trade_time").alias("open_price"),
        F.max("high").alias("high_price"),
        F.min(low).alias("low_price"),
        F.max_by("close", "trade_time").alias("close_price"),
        F.sum("volume").alias("volume"),
    )
    start = F.col("_day").cast(kind)
    return bars.withColumns(
        {"start_time": start, "end_time": start + F.expr("interval 1 day - interval 1 second")}
    ).select(*BAR_COLUMNS)


def newest_bars(bars: DataFrame, code: str | list[str] | None, days: int) -> DataFrame:
    """The newest ``days`` bars per stock with ISO time, in no order."""
    rows = of_codes(bars, code)
    if isinstance(code, str):
        newest = rows.orderBy(F.desc("start_time")).limit(days)
    else:
        newest = latest_per_key(rows, "stock_code", "start_time", days)
    return newest.select(
        "stock_code",
        iso_text("start_time").alias("time"),
        F.col("open_price").cast("double").alias("open"),
        F.col("high_price").cast("double").alias("high"),
        F.col("low_price").cast("double").alias("low"),
        F.col("close_price").cast("double").alias("close"),
        F.col("volume").cast("bigint").alias("volume"),
    )


def kline(bars: DataFrame, code: str | list[str] | None, days: int = 30) -> DataFrame:
    """The newest ``days`` bars per stock, oldest first."""
    return newest_bars(bars, code, days).orderBy("stock_code", "time")


def candles(klines: DataFrame) -> DataFrame:
    """Chart series: [open, close, low, high] per bar, its time and volume."""
    return klines.select(
        "stock_code",
        F.substring("time", 1, 19).alias("time"),
        F.array("open", "close", "low", "high").alias("candle"),
        "volume",
    )
