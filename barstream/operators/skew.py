"""A lookup by a skewed key: frequent keys stay where they lie, the rest is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that may count as frequent, and counters of the sketch that finds them: fixed, whatever the number of keys.
FREQUENT, COUNTERS = 1_000, 10_000


def frequent_keys(df: DataFrame, key: str, most: int = FREQUENT, counters: int = COUNTERS) -> DataFrame:
    """(_hash): the hashes of at most ``most`` keys, all keys that hold a notable part of the rows among them.

    One pass, combined map-side: a task's sketch has at most ``counters``
    entries of 64-bit hashes, however long the keys are.  Of the keys whose
    count the sketch can tell from its error it names the greatest; in a small
    table keys of few rows may be among them.  NULL keys are not counted.
    """
    hashed = df.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_hash"))
    top = hashed.agg(F.expr(f"approx_top_k(_hash, {most}, {counters})").alias("_top"))
    return top.select(F.explode("_top.item").alias("_hash"))


def hot_key_join(df: DataFrame, lookup: DataFrame, key: str, most: int = FREQUENT, counters: int = COUNTERS) -> DataFrame:
    """``df.join(lookup, key)`` where some keys may hold a large part of ``df``.

    ``lookup`` has one row for each key, may be of any size and is neither
    copied nor salted: its rows of the frequent keys (see frequent_keys; their
    number is bounded) are broadcast to where the rows of ``df`` lie, all
    others meet by a shuffle in which no key is hot.  What is frequent decides
    the way alone, so the result is that of the plain join.  NULL keys match
    nothing; either side may be empty; repeated rows of ``df`` stay.
    """
    hot = frequent_keys(df, key, most, counters)
    hashed = F.xxhash64(key)
    frequent = df.withColumn("_hash", hashed).join(F.broadcast(hot), "_hash", "left_semi").drop("_hash")
    others = df.withColumn("_hash", hashed).join(F.broadcast(hot), "_hash", "left_anti").drop("_hash")
    wanted = lookup.withColumn("_hash", hashed).join(F.broadcast(hot), "_hash", "left_semi").drop("_hash")
    return frequent.join(F.broadcast(wanted), key).unionByName(others.join(lookup, key))
