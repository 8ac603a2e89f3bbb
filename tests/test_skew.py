"""Joins of a table with hot keys, and joins of tables stored alike."""

import random
from collections import Counter

from pyspark.sql import functions as F

from barstream.operators.skew import frequent_keys, hot_key_join
from barstream.operators.text import fit_sentiment, sentiment_score
from barstream.sources.colocated import open_colocated, store_colocated


def _skewed(spark, n=60_000):
    """A third of the rows has one key, a tenth another, the rest has keys of its own; some have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").when(F.col("id") % 100 == 2, None)
    return spark.range(n, numPartitions=8).select(key.otherwise(F.concat(F.lit("k"), (F.col("id") % 20_000).cast("string"))).alias("key"), "id")


def _lookup(spark, *more):
    own = spark.range(15_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.col("id").alias("value"))
    return own.union(spark.createDataFrame([(k, -i) for i, k in enumerate(more)], "key string, value long"))


def test_hot_key_join_is_the_plain_join(spark):
    df = _skewed(spark)
    for lookup in (_lookup(spark, "hot", "warm", None), _lookup(spark, "warm"), _lookup(spark).limit(0)):
        got, want = hot_key_join(df, lookup, "key"), df.join(lookup, "key")
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert hot_key_join(df.limit(0), _lookup(spark, "hot"), "key").count() == 0


def test_frequent_keys_are_named_and_few(spark):
    found = {r["_hash"] for r in frequent_keys(_skewed(spark), "key").collect()}
    assert len(found) <= 1_000 and found >= {r["h"] for r in spark.createDataFrame([("hot",), ("warm",)], "key string").select(F.xxhash64("key").alias("h")).collect()}
    # of many keys that occur once none is named, and however many are frequent no more than asked for are
    assert frequent_keys(spark.range(50_000).select(F.col("id").cast("string").alias("key")), "key").count() == 0
    assert frequent_keys(spark.range(50_000).select((F.col("id") % 50).alias("key")), "key", most=7).count() <= 7


def test_no_hot_row_is_shuffled(spark):
    """What the shuffle join gets of one key is a small part, although the key holds a third of the rows."""
    df = _skewed(spark)
    hot = F.broadcast(frequent_keys(df, "key"))
    shuffled = df.withColumn("_hash", F.xxhash64("key")).join(hot, "_hash", "left_anti").where("key IS NOT NULL")
    assert shuffled.groupBy("key").count().agg(F.max("count")).first()[0] <= 60_000 / 1_000


def test_a_token_in_every_text(spark):
    """Both ways of scoring agree where one token holds most of all words."""
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    texts = [(i, " ".join(["the"] * rng.randint(1, 30) + rng.choices(words, k=8))) for i in range(3_000)] + [(-1, None), (-2, ""), (-3, "the")]
    df = spark.createDataFrame(texts, "id int, title string").repartition(8)
    model = fit_sentiment(df.select(F.col("title").alias("text"), (F.abs("id") % 2).alias("label")))
    scores = [{r["id"]: round(r["sentiment_score"], 9) for r in sentiment_score(df, model, broadcast_rows=n).collect()} for n in (0, 500_000)]
    assert scores[0] == scores[1] and len(scores[0]) == 3_003


def test_colocated_tables_join_without_an_exchange(spark, tmp_path):
    rows = [(s, t, float(t)) for s in ("hot", "a", None) for t in range(40 if s == "hot" else 5)]
    left = spark.createDataFrame(rows, "symbol string, trade_time int, `x.y` double")
    right = spark.createDataFrame(rows[::2], "symbol string, trade_time int, z double")
    keys = ["symbol", "trade_time"]
    store_colocated(left, f"{tmp_path}/left", keys, 6)
    store_colocated(right, f"{tmp_path}/right", keys, 6)
    a, b = (open_colocated(spark, f"{tmp_path}/{name}", keys, 6) for name in ("left", "right"))
    assert a.columns == left.columns and a.count() == left.count()
    joined = a.join(b.hint("merge"), keys)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, left.join(right, keys).collect()))
    per_file = a.where("symbol = 'hot'").groupBy(F.input_file_name()).count()
    assert per_file.count() == 6  # one symbol lies in all buckets
    assert store_colocated(left.limit(0), f"{tmp_path}/none", keys, 6).count() == 0
