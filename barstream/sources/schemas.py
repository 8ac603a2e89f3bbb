"""Schemas of the messages and serving tables."""

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    # StructType.fromDDL needs a running session; these are plain "name type" pairs
    kinds = {
        "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(),
        "int": T.IntegerType(), "timestamp": T.TimestampType(),
    }
    pairs = [p.split() for p in text.split(",")]
    return T.StructType([T.StructField(n, kinds[k]) for n, k in pairs])


# Field names and types of the message formats.
PRICE_MESSAGE = _schema(
    "symbol string, trade_time string, open double, high double, low double, "
    "close double, volume bigint, data_type string"
)
SNAPSHOT_MESSAGE = _schema(
    "symbol string, trade_time string, price double, volume bigint, turnover double, data_type string"
)
NEWS_MESSAGE = _schema(
    "symbol string, title string, content string, publish_time string, source string, data_type string"
)
CARD = _schema(
    "name string, avatarUri string, position string, phone string, email string, "
    "company string, bio string, templateIndex int"
)
PREDICTION = _schema("stock_code string, predict_time timestamp, predicted_direction string, confidence double")
WATCHLIST = _schema("code string, baostock_code string, name string")
