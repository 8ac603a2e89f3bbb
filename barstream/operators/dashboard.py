"""Queries behind the dashboard: predictions, news and sentiment per stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.functions.columns import fixed_text, iso_text
from barstream.operators.bars import candles, newest_bars
from barstream.operators.ranking import latest_per_key, of_codes

# Neutral gauge and the limits of the colour bands.
NEUTRAL = 0.5
GREEN_ABOVE, RED_BELOW = 0.6, 0.4
# Rows of equal time go by score, so a gauge needs no titles and still covers
# the same scores as the news list.
NEWEST = ["publish_time", "sentiment_score"]


def serve_news(news: DataFrame) -> DataFrame:
    """News with score in the column names and order of the serving table."""
    return news.selectExpr(
        "symbol AS stock_code", "title", "content", "publish_time", "source", "sentiment_score"
    )


def latest_prediction(predictions: DataFrame, code: str | list[str] | None = None) -> DataFrame:
    """The newest prediction per stock."""
    newest = latest_per_key(of_codes(predictions, code), "stock_code", ["predict_time", "confidence"])
    return newest.select("stock_code", "predicted_direction", "confidence", "predict_time")


def format_prediction(predictions: DataFrame) -> DataFrame:
    """Prediction as shown: confidence in per cent with one decimal, ISO time."""
    return predictions.select(
        "stock_code",
        "predicted_direction",
        F.concat(fixed_text(F.col("confidence") * 100, 1), F.lit("%")).alias("confidence_text"),
        iso_text("predict_time").alias("predict_time"),
    )


def latest_news(news: DataFrame, code: str | list[str] | None = None, n: int = 20) -> DataFrame:
    """The newest n news rows per stock, newest first."""
    rows = latest_per_key(of_codes(news, code), "stock_code", [*NEWEST, "title"], n)
    return rows.select("stock_code", "publish_time", "sentiment_score", "title").orderBy(
        "stock_code", F.desc("publish_time")
    )


def sentiment_band(df: DataFrame, score: str = "sentiment_score") -> DataFrame:
    """Add the colour band and the score as text with two decimals."""
    s = F.col(score)
    band = F.when(s > GREEN_ABOVE, "green").when(s < RED_BELOW, "red").otherwise("orange")
    return df.withColumns({"band": band, "score_text": fixed_text(s, 2)})


def _gauge(news: DataFrame, n: int) -> DataFrame:
    newest = latest_per_key(news, "stock_code", NEWEST, n)
    return newest.groupBy("stock_code").agg(F.avg("sentiment_score").alias("gauge"))


def news_gauge(news: DataFrame, watchlist: DataFrame, n: int = 20) -> DataFrame:
    """Mean score of the newest n news rows of each listed stock; 0.5 without news."""
    stocks = watchlist.select(F.col("code").alias("stock_code"))
    return stocks.join(_gauge(news, n), "stock_code", "left").select(
        "stock_code", F.coalesce("gauge", F.lit(NEUTRAL)).alias("gauge")
    )


def dashboard(
    bars: DataFrame,
    predictions: DataFrame,
    news: DataFrame,
    watchlist: DataFrame,
    days: int = 60,
    n_news: int = 20,
) -> DataFrame:
    """One row per listed stock with its bars, prediction, gauge and news.

    The lists hold at most ``days`` and ``n_news`` items: that many are cut
    per stock before anything is gathered.
    """
    series = (
        candles(newest_bars(bars, None, days))
        .groupBy("stock_code")
        .agg(F.array_sort(F.collect_list(F.struct("time", "candle", "volume"))).alias("bars"))
    )
    newest = latest_per_key(news, "stock_code", [*NEWEST, "title"], n_news)
    item = F.struct(iso_text("publish_time").alias("publish_time"), "title", "sentiment_score")
    items = newest.groupBy("stock_code").agg(
        F.avg("sentiment_score").alias("gauge"),
        F.sort_array(F.collect_list(item), asc=False).alias("news"),
    )
    cards = format_prediction(latest_prediction(predictions))
    return (
        watchlist.select(F.col("code").alias("stock_code"))
        .join(series, "stock_code", "left")
        .join(cards, "stock_code", "left")
        .join(items, "stock_code", "left")
        .withColumn("gauge", F.coalesce("gauge", F.lit(NEUTRAL)))
    )
