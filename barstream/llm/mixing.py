"""Operator 9: mixing sources to target weights by temperature."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstream.llm.common import SPACE, stored

#: Documents in a block of a source's permutation, about.
BLOCK_DOCS = 1024
STEPS = 60
SEED = 17


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    edge = F.when(text.rlike(f"^[{SPACE}]"), 1).otherwise(0) + F.when(text.rlike(rf"[{SPACE}]\z"), 1).otherwise(0)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, f"[{SPACE}]+")) - edge)


def identity(seed: int = SEED) -> Column:
    """What orders documents and tells them apart: 60 bits of the md5 of seed, doc_id and text (null: empty)."""
    parts = [F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def block_order(seed: int, block: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string")))


def weights_at(shares: dict, exponent: float) -> dict:
    """Shares to the power of the exponent, normalised: 1 keeps them, 0 makes all sources equal."""
    raw = {s: p**exponent for s, p in shares.items()}
    total = sum(raw.values())
    return {s: r / total for s, r in raw.items()}


def entropy(weights: dict) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def solve_exponent(tokens: dict, budget: float, entropy_share: float | None, max_repeats: float | None) -> float:
    """The greatest exponent in 0..1 whose weights' entropy is ``entropy_share`` of the way from that of the token
    shares to that of equal weights, raised (towards 1) until no source is repeated more than ``max_repeats`` times.

    Entropy falls and the small sources' repetition falls as the exponent grows, so both are bisected.
    """
    total = sum(tokens.values())
    shares = {s: n / total for s, n in tokens.items()}
    low_entropy, high_entropy = entropy(shares), math.log(len(shares))

    def bisect(holds, low: float, high: float) -> tuple[float, float]:
        """The bracket's ends once it is small: ``holds`` at low, not at high."""
        for _ in range(STEPS):
            mid = (low + high) / 2
            low, high = (mid, high) if holds(mid) else (low, mid)
        return low, high

    exponent = 1.0
    if entropy_share is not None:
        target = low_entropy + entropy_share * (high_entropy - low_entropy)
        if entropy(weights_at(shares, 1.0)) < target:
            exponent = bisect(lambda x: entropy(weights_at(shares, x)) >= target, 0.0, 1.0)[0]
    if max_repeats is not None:

        def too_often(x: float) -> bool:
            return any(w * budget > max_repeats * tokens[s] for s, w in weights_at(shares, x).items())

        if too_often(exponent):
            exponent = 1.0 if too_often(1.0) else bisect(too_often, exponent, 1.0)[1]
    return exponent


def mix(
    df: DataFrame,
    budget_share: float = 1.0,
    entropy_share: float | None = 0.5,
    max_repeats: float | None = 4.0,
    seed: int = SEED,
    n_tokens=None,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """One row per document: doc_id, source, n_tokens, weight, block, copies, last_epoch_rank.

    The budget is ``budget_share`` times all tokens (words by default; pass a
    column as ``n_tokens``).  Sources get weights by ``solve_exponent``; a
    source's part of the budget is filled by whole passes over a permutation of
    its documents and one part of a pass: its documents in order until their
    tokens before them reach what is left.  ``copies`` says how often a document
    is taken, ``last_epoch_rank`` orders a source's documents.

    The permutation is one of blocks, and of the documents within each: blocks
    are dealt by hash, about ``block_docs`` documents each, so no window ever
    holds a source.  Only sums per source reach the driver, and only sums per
    block meet in a window, per source.

    Null sources are a source of their own.  Null and empty texts have no
    tokens: they are taken with the whole passes, and within the last one if it
    is still open where they stand.  Equal rows are dealt apart by a number
    within their block; rows without doc_id are ordered by their texts.  Other
    columns are not read.  An empty table gives an empty result.
    """
    tokens = word_count(F.col("text")) if n_tokens is None else n_tokens
    n = F.greatest(F.coalesce(tokens, F.lit(0)), F.lit(0)).cast("long").alias("n_tokens")
    rows = df.select("doc_id", "source", n, identity(seed).alias("ident"))
    rows = stored(rows, "sized")

    per = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    known = {r["source"]: (r["tokens"], r["docs"]) for r in per.collect()}
    sized = {s: t for s, (t, _) in known.items() if t}
    budget = budget_share * sum(sized.values())
    exponent = solve_exponent(sized, budget, entropy_share, max_repeats) if sized else 1.0
    shares = {s: t / sum(sized.values()) for s, t in sized.items()}
    weights = weights_at(shares, exponent) if sized else {}
    plan = []
    for source, (total, docs) in known.items():
        part = weights.get(source, 0.0) * budget
        whole = int(part // total) if total else 1
        plan.append((source, weights.get(source, 0.0), max(1, -(-docs // block_docs)), whole, part - whole * total if total else 0.0))
    schema = "at string, weight double, blocks long, whole int, part double"
    planned = F.broadcast(df.sparkSession.createDataFrame(plan, schema))

    dealt = rows.join(planned, F.col("source").eqNullSafe(F.col("at"))).drop("at")
    dealt = stored(dealt.withColumn("block", F.pmod("ident", F.col("blocks"))), "dealt")
    sums = dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens"), F.count("*").alias("block_docs"))
    in_order = Window.partitionBy("source").orderBy(block_order(seed, F.col("block"))).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(in_order), F.lit(0)).alias(b) for c, b in (("block_tokens", "before"), ("block_docs", "docs_before"))]
    sums = sums.select(F.col("source").alias("at"), F.col("block").alias("at_block"), *before)
    placed = dealt.join(sums, F.col("source").eqNullSafe(F.col("at")) & (F.col("block") == F.col("at_block")))
    inside = Window.partitionBy("source", "block").orderBy("ident", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    rank = F.col("docs_before") + F.coalesce(F.count("*").over(inside), F.lit(0))
    return placed.select(
        "doc_id", "source", "n_tokens", "weight", "block",
        (F.col("whole") + (start < F.col("part")).cast("int")).alias("copies"), rank.alias("last_epoch_rank"), "ident",
    )


def realised(df: DataFrame, **parameters) -> DataFrame:
    """The mixture: all columns of every document, as often as ``mix`` takes it (not at all for 0).

    Rows that agree in doc_id and text are taken equally often.
    """
    plan = mix(df, **parameters).where("copies > 0").groupBy("ident").agg(F.max("copies").alias("copies"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    met = df.select(row, identity(parameters.get("seed", SEED)).alias("ident")).join(stored(plan, "plan"), "ident")
    return met.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
