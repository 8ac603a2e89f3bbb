"""Vendor tables to messages."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.operators.ranking import first_per_key

# The vendor's column names.
QUOTE_COLUMNS = {"代码": "code", "最新价": "price", "成交量": "volume", "成交额": "turnover"}
NEWS_COLUMNS = {"新闻标题": "title", "新闻内容": "content", "发布时间": "publish_time", "文章来源": "source"}
CLOSE_OF_DAY = " 15:00:00"
DEFAULT_SOURCE = "eastmoney"
# News per stock and the days of the price history, as the collecting job takes them.
NEWS_PER_SYMBOL = 30
HISTORY_START, HISTORY_END = "2025-06-01", "2026-05-31"


def normalize_daily(raw: DataFrame) -> DataFrame:
    """All-text daily bars (symbol, date, OHLC, volume) to typed price messages."""
    prices = [F.expr(f"try_cast({c} AS double)").alias(c) for c in ("open", "high", "low", "close")]
    return raw.select(
        "symbol",
        F.concat(F.col("date"), F.lit(CLOSE_OF_DAY)).alias("trade_time"),
        *prices,
        F.expr("try_cast(volume AS bigint)").alias("volume"),
        F.lit("daily").alias("data_type"),
    )


def normalize_snapshot(
    quotes: DataFrame, watchlist: DataFrame, as_of: datetime | str, order: str | None = None
) -> DataFrame:
    """Market snapshot to messages of the listed stocks, stamped ``as_of``.

    Of several rows of a code the first by ``order`` counts.  The watch-list
    side is left to the optimizer, which broadcasts it when it is small.
    """
    quotes = quotes.withColumnsRenamed(QUOTE_COLUMNS)
    codes = watchlist.select("code").distinct()
    listed = quotes.join(codes, "code", "left_semi")
    first = first_per_key(listed, "code", [order] if order else ["price", "volume", "turnover"])
    stamp = as_of if isinstance(as_of, str) else as_of.isoformat()
    return first.select(
        F.col("code").alias("symbol"),
        F.lit(stamp).alias("trade_time"),
        F.col("price").cast("double").alias("price"),
        F.col("volume").cast("bigint").alias("volume"),
        F.col("turnover").cast("double").alias("turnover"),
        F.lit("realtime").alias("data_type"),
    )


def normalize_news(raw: DataFrame, order: str, limit_per_symbol: int | None = None) -> DataFrame:
    """Vendor news to messages: all, or the first ``limit_per_symbol`` per stock in vendor order."""
    raw = raw.withColumnsRenamed(NEWS_COLUMNS)
    for name in ("content", "source"):
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast("string"))
    rows = raw if limit_per_symbol is None else first_per_key(raw, "symbol", order, limit_per_symbol)
    return rows.select(
        "symbol",
        "title",
        F.coalesce("content", F.lit("")).alias("content"),
        "publish_time",
        F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"),
        F.lit("news").alias("data_type"),
    )


def history(df: DataFrame, start: str | date, end: str | date, time: str = "trade_time") -> DataFrame:
    """Rows of the days start..end, both included.  Plain comparisons reach the scan."""
    kind = df.schema[time].dataType
    first = F.lit(str(start)).cast(kind)
    after = F.date_add(F.lit(str(end)).cast("date"), 1).cast(kind)
    return df.where((F.col(time) >= first) & (F.col(time) < after))


def ingest_counts(df: DataFrame) -> DataFrame:
    """Messages per stock and type, with totals per stock and overall.

    Counted first, rolled up second: the rollup expands the few counts, not
    the messages.
    """
    counts = df.groupBy("symbol", "data_type").agg(F.count("*").alias("_n"))
    return counts.rollup("symbol", "data_type").agg(
        F.sum("_n").alias("n"), F.grouping_id().cast("int").alias("level")
    )
