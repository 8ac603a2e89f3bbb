"""Inputs of the registered queries, derived by Spark from the given tables.

The same derivations in SQL are in ``checks/sql.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TICK = ["symbol", "trade_time", "open", "high", "low", "close", "volume", "data_type"]
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to 6 decimals, as on the SQL side."""
    return df.select(
        *[
            (F.round(f.name, digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def ticks(spark, sf_dir, *extra) -> DataFrame:
    e = table(spark, sf_dir, "events")
    value = F.col("value")
    return e.select(
        F.col("user_id").cast("string").alias("symbol"),
        F.col("ts").alias("trade_time"),
        value.alias("open"), value.alias("high"), value.alias("low"), value.alias("close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.lit("daily").alias("data_type"),
        *extra,
    )


def dirty_base(spark, sf_dir) -> DataFrame:
    t = ticks(spark, sf_dir, F.col("event_id").alias("arrival"), "event_type")
    kind = F.col("event_type")
    return t.withColumns(
        {
            "close": F.when(kind == "error", -F.col("close")).otherwise(F.col("close")),
            "low": F.when(kind != "signup", F.col("low")),
            "volume": F.when(F.col("arrival") % 97 != 0, F.col("volume")),
        }
    )


def dirty_ticks(spark, sf_dir) -> DataFrame:
    """Ticks with invalid prices, gaps, copies and late corrections."""
    base = dirty_base(spark, sf_dir)
    copies = base.where("event_type = 'click'").withColumn("arrival", F.col("arrival") + 10**9)
    late = base.where("event_type = 'error' AND arrival % 8 = 0").withColumns(
        {"close": -F.col("close"), "arrival": F.col("arrival") + 2 * 10**9}
    )
    return base.unionByName(copies).unionByName(late).select(*TICK, "arrival")


def snapshot_messages(spark, sf_dir) -> DataFrame:
    """Ticks in the shape of realtime messages: a price and an ISO time."""
    return ticks(spark, sf_dir).select(
        "symbol",
        F.date_format("trade_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("trade_time"),
        F.col("close").alias("price"),
        "volume",
        (F.col("close") * F.col("volume")).alias("turnover"),
        F.lit("realtime").alias("data_type"),
    )


def unique_ticks(spark, sf_dir) -> DataFrame:
    """Dirty ticks to the second, one row per key: the first by arrival."""
    from barstream.operators.ranking import first_per_key

    base = dirty_base(spark, sf_dir).withColumn("trade_time", F.date_trunc("second", "trade_time").cast("timestamp_ntz"))
    return first_per_key(base, ["symbol", "trade_time"], "arrival")


def news(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("symbol"),
        F.col("text").alias("title"),
        F.when(F.col("lang") != "de", F.col("text")).alias("content"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id AS int))").alias("publish_time"),
        F.when(F.col("lang") != "fr", F.col("lang")).alias("source"),
        F.lit("news").alias("data_type"),
        "doc_id",
    )


def scored_news(spark, sf_dir, symbol: str = "source") -> DataFrame:
    """News with a fixed score formula, in serving columns."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.expr(symbol).alias("stock_code"),
        F.col("text").alias("title"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id AS int))").alias("publish_time"),
        ((F.col("n_chars") % 101) / 100.0).alias("sentiment_score"),
    )


def predictions(spark, sf_dir) -> DataFrame:
    t = ticks(spark, sf_dir)
    return t.select(
        F.col("symbol").alias("stock_code"),
        F.col("trade_time").alias("predict_time"),
        F.when(F.col("volume") % 2 == 0, "UP").otherwise("DOWN").alias("predicted_direction"),
        (F.col("close") / 500.0).alias("confidence"),
    )


def customer_watchlist(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("code"))


def tab_class(spark, sf_dir, label="l_returnflag = 'R'") -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.select(*LINE_KEYS, *FEATURES, F.expr(f"CAST({label} AS int)").alias("label"))


SEPARABLE = "l_quantity * (1 - l_discount) > 25"


def model_scores(spark, sf_dir) -> DataFrame:
    t = tab_class(spark, sf_dir)
    one = lambda name, score: F.struct(F.lit(name).alias("model"), F.expr(score).alias("score"))
    rows = F.array(one("discount", "l_discount * 10"), one("tax", "l_tax * 12.5"), one("quantity", "l_quantity / 50"))
    return (
        t.select("label", F.explode(rows).alias("m"))
        .select("m.model", "label", "m.score")
        .withColumn("prediction", F.when(F.col("score") >= 0.5, 1).otherwise(0))
    )


def contacts(spark, sf_dir) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    named = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    blank = key % 50 == 0
    text = lambda value: F.when(blank, "").otherwise(value)
    return named.select(
        "c_custkey",
        text(F.col("c_name")).alias("name"),
        F.lit("").alias("avatarUri"),
        text(F.col("c_mktsegment")).alias("position"),
        text(F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("+1-"), key.cast("string")))).alias("phone"),
        text(F.when(key % 5 == 0, "  ").otherwise(F.concat("c_name", F.lit("@example.com")))).alias("email"),
        text(F.col("n_name")).alias("company"),
        F.lit("").alias("bio"),
        (key % 4).cast("int").alias("templateIndex"),
    )


def contact_changes(spark, sf_dir) -> DataFrame:
    """Full save, template save, and a second full save of even contacts."""
    full = contacts(spark, sf_dir)
    fields = [c for c in full.columns if c not in ("c_custkey", "templateIndex")]
    patch = full.select(
        "c_custkey", *[F.lit(None).cast("string").alias(c) for c in fields],
        ((F.col("templateIndex") + 1) % 3).cast("int").alias("templateIndex"), F.lit(2).alias("seq"),
    )
    again = full.where("c_custkey % 2 = 0").withColumns({"bio": F.concat(F.lit("about "), "name"), "seq": F.lit(3)})
    return full.withColumn("seq", F.lit(1)).unionByName(patch).unionByName(again)
