"""Sentiment of texts by a naive-Bayes token model, as joins and aggregations."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.functions.columns import strip_blank
from barstream.operators.skew import hot_key_join
from barstream.sources.tables import overwrite_table, work_dir

# Neutral score, shortest scored text, characters that the title job reads.
NEUTRAL = 0.5
MIN_CHARS = 5
TITLE_CHARS = 300
# A token is one Chinese character or a run of other letters.
TOKEN = r"[\p{L}&&[^\p{IsHan}]]+|\p{IsHan}"
BROADCAST_ROWS = 500_000
# Sums of texts (24 bytes each) that are brought to the texts; more meet them by a shuffle.
SUM_ROWS = 2_000_000
# Steps of a token's frequency for each doubling, by which the most frequent ones are told.
STEPS = 16


def tokens(text: Column | str) -> Column:
    """Lower-case tokens of a text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def fit_sentiment(labelled: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """(token, llr, n) from texts labelled 1 (positive) or 0: log likelihood ratio
    with Laplace +1, and how often the token occurs in them.  Counts combine
    map-side, so frequent tokens are no hot spot."""
    words = labelled.where(F.col(label).isNotNull()).select(F.explode(tokens(text)).alias("token"), F.col(label).alias("_y"))
    counts = words.groupBy("token").agg(
        F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg")
    )
    total = counts.agg(
        F.struct(F.sum("_pos").alias("p"), F.sum("_neg").alias("n"), F.count("*").alias("v")).alias("t")
    ).scalar()
    positive = (F.col("_pos") + 1).cast("double") / (total["p"] + total["v"])
    negative = (F.col("_neg") + 1).cast("double") / (total["n"] + total["v"])
    return counts.select("token", (F.log(positive) - F.log(negative)).alias("llr"), (F.col("_pos") + F.col("_neg")).alias("n"))


def _model_scorer(model: DataFrame, rest: bool = False):
    """Arrow UDF: tokens of a text -> sum of their llr, NULL if none is known; with ``rest`` also the tokens not known.

    Only for a model counted small: its rows are broadcast.
    """
    rows = model.select("token", "llr").toArrow()
    known_tokens = dict(zip(rows.column("token").to_pylist(), rows.column("llr").to_pylist()))
    table = model.sparkSession.sparkContext.broadcast(known_tokens)

    def look_up(lists: pa.Array) -> tuple[pa.Array, pa.Array]:
        known = table.value
        words = lists.flatten()
        coded = words.dictionary_encode()
        llr = np.array([known.get(t, np.nan) for t in coded.dictionary.to_pylist()] or [np.nan])
        values = llr[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), counts)
        hit = ~np.isnan(values)
        sums = np.bincount(row[hit], weights=values[hit], minlength=len(lists))
        found = np.bincount(row[hit], minlength=len(lists)) > 0
        total = pa.array(sums, mask=~found)
        if not rest:
            return total, None
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=len(lists)))]).astype(np.int32)
        return total, pa.ListArray.from_arrays(pa.array(ends), words.filter(pa.array(~hit)))

    @F.arrow_udf("double")
    def total(lists: pa.Array) -> pa.Array:
        return look_up(lists)[0]

    @F.arrow_udf("struct<sum: double, rest: array<string>>")
    def both(lists: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(list(look_up(lists)), ["sum", "rest"])

    return both if rest else total


def _frequent(model: DataFrame, most: int) -> DataFrame:
    """The model with ``_head``: whether a token is among the most frequent, at most ``most`` of them (none without ``n``)."""
    if "n" not in model.columns:
        return model.withColumn("_head", F.lit(False))
    step = F.floor(STEPS * F.log2(F.greatest("n", F.lit(1)))).cast("int")
    least, room = None, most
    for r in model.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # a few hundred at most
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    return model.withColumn("_head", F.lit(False) if least is None else step >= least)


def _sums(texts: DataFrame, head, tail: DataFrame) -> DataFrame:
    """(_text, _sum) of distinct texts with a known token, out of (_text, _tokens).

    Frequent tokens (``head``) are looked up where the text lies, so of a text
    only its digest and its rare tokens travel; those meet ``tail`` by a join.
    """
    spark, path = texts.sparkSession, work_dir(texts.sparkSession, "rare_tokens")
    parts = texts.select("_text", head("_tokens").alias("_found")).select("_text", "_found.*").dropDuplicates(["_text"])
    overwrite_table(parts, path)
    stored = spark.read.schema(parts.schema).parquet(path)
    words = stored.select("_text", F.explode("rest").alias("token"))
    rare = hot_key_join(words, tail.select("token", "llr"), "token").select("_text", F.col("llr").alias("sum"))
    known = stored.where("sum IS NOT NULL").select("_text", "sum").unionByName(rare)
    return known.groupBy("_text").agg(F.sum("sum").alias("_sum"))


def _sum_finder(sums: DataFrame):
    """Arrow UDF: digest of a text -> its sum, NULL if it has none; only for sums counted few."""
    rows = sums.select("_text", "_sum").toArrow().combine_chunks()
    digests = np.array(rows.column("_text").to_pylist(), dtype="S16")
    order = np.argsort(digests)
    table = sums.sparkSession.sparkContext.broadcast((digests[order], rows.column("_sum").to_numpy()[order]))

    @F.arrow_udf("double")
    def find(asked: pa.Array) -> pa.Array:
        digests, values = table.value
        wanted = np.array(pc.fill_null(asked, b"").to_pylist(), dtype="S16")
        if not len(digests):
            return pa.nulls(len(wanted), pa.float64())
        at = np.minimum(np.searchsorted(digests, wanted), len(digests) - 1)
        there = (digests[at] == wanted) & asked.is_valid().to_numpy(zero_copy_only=False)
        return pa.array(values[at], mask=~there)

    return find


def sentiment_scorer(
    model: DataFrame, text: str = "title", max_chars: int | None = None, output: str = "sentiment_score", broadcast_rows: int = BROADCAST_ROWS
) -> Callable[[DataFrame], DataFrame]:
    """A function that adds a score in [0, 1], 1 = positive, to a frame of texts.

    Missing texts and texts shorter than five characters (blanks at the ends
    not counted) score 0.5, as do texts without known tokens.  Texts are read
    whole unless ``max_chars`` says how much of them counts.

    ``model`` is a stored (token, llr, n) table.  A vocabulary grows with the
    data, so it is counted first: up to ``broadcast_rows`` tokens are
    broadcast, once for all frames that are scored, and texts are scored where
    they lie.  Of a larger one so many of the most frequent tokens (by ``n``,
    which may be missing) are broadcast; the others are joined by token, each
    distinct text once, and the sums are brought back to the texts (at most
    SUM_ROWS of them, else texts meet theirs by a shuffle).  Scoring a frame by
    a larger model runs jobs.  Either way a text has the same score.
    """
    read = F.col(text) if max_chars is None else F.substring(text, 1, max_chars)
    worth = F.length(strip_blank(text)) >= MIN_CHARS
    scored = F.when(worth, tokens(read))
    score = F.coalesce(1 / (1 + F.exp(-F.col("_sum"))), F.lit(NEUTRAL))
    if model.limit(broadcast_rows + 1).count() <= broadcast_rows:
        total = _model_scorer(model)
        return lambda df: df.withColumn("_sum", total(scored)).withColumn(output, score).drop("_sum")

    parts = _frequent(model, broadcast_rows)
    head, tail = _model_scorer(parts.where("_head"), rest=True), parts.where("NOT _head")
    digest = F.unhex(F.md5(text))

    def joined(df: DataFrame) -> DataFrame:
        sums = _sums(df.where(worth).select(digest.alias("_text"), tokens(read).alias("_tokens")), head, tail)
        path = work_dir(df.sparkSession, "text_sums")
        overwrite_table(sums, path)
        sums = df.sparkSession.read.schema(sums.schema).parquet(path)
        if sums.count() <= SUM_ROWS:
            found = df.withColumn("_sum", _sum_finder(sums)(digest))
        else:
            found = df.withColumn("_text", digest).join(sums, "_text", "left").drop("_text")
        return found.withColumn(output, score).drop("_sum")

    return joined


def sentiment_score(df: DataFrame, model: DataFrame, **options) -> DataFrame:
    """``sentiment_scorer`` for one frame."""
    return sentiment_scorer(model, **options)(df)
