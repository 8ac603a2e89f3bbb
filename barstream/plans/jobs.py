"""The batch jobs: stored table in, stored or served table out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from barstream.operators.bars import daily_bars
from barstream.operators.dashboard import serve_news
from barstream.operators.features import training_frame, split
from barstream.operators.indicators import indicator_table
from barstream.operators.slicing import order_table
from barstream.plans.learners import evaluate, fit_gbt, load_model, predict_latest, save_model, score
from barstream.sources.tables import overwrite_table, read_table, write_jdbc


def build_indicators(spark: SparkSession, prices_path: str, indicators_path: str) -> None:
    """Recompute the indicator table from the clean prices."""
    prices = read_table(spark, prices_path)
    overwrite_table(indicator_table(order_table(prices, "symbol", "trade_time")), indicators_path)


def train_direction(
    spark: SparkSession, indicators_path: str, model_path: str, **params
) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Fit and store the direction model; returns it with its holdout metrics.

    Indicators hold close and volume, so prices are not joined again.
    """
    indicators = read_table(spark, indicators_path)
    frame = training_frame(None, indicators)
    train, test = split(frame, ["symbol", "trade_time"])
    model = fit_gbt(train, **params)
    save_model(model, model_path)
    return model, evaluate(score(model, test))


def publish_bars(spark: SparkSession, prices_path: str, url: str, table: str = "realtime_klines", **options) -> None:
    """Append daily bars to the serving database."""
    write_jdbc(daily_bars(read_table(spark, prices_path)), url, table, **options)


def publish_news(spark: SparkSession, news_path: str, url: str, table: str = "news_sentiment_mysql", **options) -> None:
    """Append scored news to the serving database."""
    write_jdbc(serve_news(read_table(spark, news_path)), url, table, **options)


def publish_predictions(
    spark: SparkSession, indicators_path: str, model_path: str, url: str, table: str = "predictions", **options
) -> None:
    """Append the newest prediction of every symbol to the serving database."""
    model = load_model(model_path)
    if model is None:
        raise ValueError(f"no model at {model_path}")
    rows = predict_latest(read_table(spark, indicators_path), model).drop("direction_confidence")
    write_jdbc(rows, url, table, **options)
