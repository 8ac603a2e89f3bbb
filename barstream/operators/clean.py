"""From raw messages to the clean price table.  Works on batches and streams."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.functions.columns import ISO_TIME_FRACTION, MESSAGE_TIME, parse_time
from barstream.operators.ranking import first_per_key
from barstream.sources.schemas import NEWS_MESSAGE, PRICE_MESSAGE

KEYS = ("symbol", "trade_time")
# What a missing price field becomes.
FILL = {"volume": 0, "open": 0.0, "high": 0.0, "low": 0.0, "close": 0.0}


def parse_messages(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON ``value`` (text or bytes) to columns.

    Malformed JSON gives a row of NULLs; unknown fields are dropped.
    """
    data = F.from_json(F.col("value").cast("string"), schema).alias("_data")
    return df.select(*keep, data).select(*keep, "_data.*")


def parse_prices(
    df: DataFrame, accept_snapshots: bool = False, keep: tuple[str, ...] = (), ntz: bool = False
) -> DataFrame:
    """Price messages with ``trade_time`` as a timestamp.

    Snapshot messages (``price``, ISO time) lack ``close`` and a fitting time,
    so cleaning drops them; ``accept_snapshots`` maps them instead.
    """
    if not accept_snapshots:
        parsed = parse_messages(df, PRICE_MESSAGE, keep)
        return parsed.withColumn("trade_time", parse_time("trade_time", ntz=ntz))
    schema = T.StructType(PRICE_MESSAGE.fields + [T.StructField("price", T.DoubleType())])
    parsed = parse_messages(df, schema, keep)
    return parsed.withColumns(
        {
            "trade_time": parse_time("trade_time", MESSAGE_TIME, ISO_TIME_FRACTION, ntz=ntz),
            "close": F.coalesce("close", "price"),
        }
    ).drop("price")


def parse_news(df: DataFrame, keep: tuple[str, ...] = (), ntz: bool = False) -> DataFrame:
    """News messages with ``publish_time`` as a timestamp."""
    parsed = parse_messages(df, NEWS_MESSAGE, keep)
    return parsed.withColumn("publish_time", parse_time("publish_time", ntz=ntz))


def sort_messages(df: DataFrame, schema: T.StructType = PRICE_MESSAGE, time: str = "trade_time") -> DataFrame:
    """Messages with ``reason``: why a message cannot be used, NULL if it can.

    ``value`` stays as it came, beside the other columns, so that rejects can
    be stored and sent again.  The first that holds of: ``empty`` (NULL or
    blank), ``malformed`` (no JSON), ``no_object``, ``missing`` (a key or the
    time is absent or null), ``mistyped`` (a field of another kind than the
    schema's; numbers may come as text of a number, keys and times only as
    text), ``bad_time``.  JSON is parsed once, as a VARIANT.
    """
    text, data = F.col("value").cast("string"), F.col("_data")
    get = lambda name, kind: F.try_variant_get(data, f"$.{name}", kind)
    numbers = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    # one step each, so that what is used more than once is worked out once
    parsed = df.withColumn("_data", F.try_parse_json(text))
    parsed = parsed.withColumns(
        {f"_kind_{f.name}": F.schema_of_variant(get(f.name, "variant")) for f in schema.fields}
        | {f"_number_{f.name}": get(f.name, f.dataType.simpleString()) for f in numbers}
    )
    # a field's kind is NULL if it is absent and VOID if it is null
    there = lambda name: F.coalesce(F.col(f"_kind_{name}") != "VOID", F.lit(False))
    wrong_text = [there(f.name) & (F.col(f"_kind_{f.name}") != "STRING") for f in schema.fields if f not in numbers]
    wrong_number = [there(f.name) & ((F.col(f"_kind_{f.name}") == "BOOLEAN") | F.col(f"_number_{f.name}").isNull()) for f in numbers]
    reason = (
        F.when(text.isNull() | (F.trim(text) == ""), "empty")
        .when(data.isNull(), "malformed")
        .when(~F.schema_of_variant(data).startswith("OBJECT"), "no_object")
        .when(~there("symbol") | ~there(time), "missing")
        .when(reduce(or_, wrong_text + wrong_number), "mistyped")
        .when(parse_time(get(time, "string")).isNull(), "bad_time")
    )
    return parsed.withColumn("reason", reason).select(*[F.col(f"`{c}`") for c in df.columns], "reason")


USABLE = "usable"


def quarantine(df: DataFrame, path: str, **options) -> DataFrame:
    """Messages sorted into a folder per reason below ``path``; returns those that can be used.

    For a batch, or a stream's micro-batch inside ``foreachBatch``.  A message
    is parsed once and nothing is shuffled; usable ones lie in the folder
    ``reason=usable``, so a later reader of either kind lists only its own.
    """
    reason = F.coalesce("reason", F.lit(USABLE))
    sort_messages(df, **options).withColumn("reason", reason).write.mode("overwrite").partitionBy("reason").parquet(path)
    return read_sorted(df.sparkSession, path, df.schema).where(F.col("reason") == USABLE).drop("reason")


def read_sorted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All messages that ``quarantine`` has sorted, of the given columns, with their reason."""
    whole = T.StructType([*schema.fields, T.StructField("reason", T.StringType())])
    return spark.read.schema(whole).parquet(path)


def dedup_first(df: DataFrame, keys: tuple[str, ...] = KEYS, arrival: str | None = None) -> DataFrame:
    """One row per key: the first by ``arrival``, then by content."""
    rest = [c for c in df.columns if c not in keys and c != arrival]
    return first_per_key(df, list(keys), ([arrival] if arrival else []) + rest)


def clean_prices(
    df: DataFrame,
    arrival: str | None = None,
    keys: tuple[str, ...] = KEYS,
    dedup_window: str | None = None,
) -> DataFrame:
    """De-duplicate, drop invalid prices, fill missing fields - in this order.

    An invalid first arrival therefore removes a later valid row of its key.
    Batches keep the first row by ``arrival`` (dropped from the result).
    Streams keep whichever row comes first and remember every key.  With
    ``dedup_window`` (such as "1 day") a key is forgotten, and its state freed,
    once its time lies that long before the newest time of the batches before
    the last; rows that arrive later than that are dropped, as they could not
    be told from copies (``streaming.io.late_rows`` counts them).
    """
    if df.isStreaming:
        if dedup_window:
            unique = df.withWatermark("trade_time", dedup_window).dropDuplicatesWithinWatermark(list(keys))
        else:
            unique = df.dropDuplicates(list(keys))
    else:
        unique = dedup_first(df, keys, arrival)
    if arrival:
        unique = unique.drop(arrival)
    return unique.where("close > 0").where("volume >= 0").fillna(FILL)


def assert_unique_key(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Raise ValueError if a key occurs twice; a join on it would multiply rows."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1)
    if not twice.isEmpty():
        raise ValueError(f"duplicate key {tuple(keys)}: {twice.first()}")
    return df
