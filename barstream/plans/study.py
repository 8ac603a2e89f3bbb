"""Compare classifiers on one table: scale, balance, fit, measure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.operators.features import drop_incomplete, mark_split
from barstream.operators.metrics import apply_threshold, compare_models
from barstream.operators.neighbors import knn
from barstream.operators.tabular import standardize, with_class_weights
from barstream.plans.learners import fit_classifier, score
from barstream.sources.tables import overwrite_table, read_table, work_dir

KINDS = ("lr", "knn", "dt", "rf")


def _knn_scores(train: DataFrame, test: DataFrame, columns: list[str], label: str, k: int) -> DataFrame:
    """Label and share of positive votes per test row."""
    vector = F.array(*[F.col(c).cast("double") for c in columns]).alias("features")
    found = knn(train.select("_id", label, vector), test.select("_id", vector), k, "_id", "features", label)
    share = F.try_divide(F.col("votes"), F.col("neighbours"))
    positive = F.when(F.col("prediction") == 1, share).otherwise(1 - share)
    return test.select("_id", label).join(found.select("_id", positive.alias("score")), "_id").select(label, "score")


def study(
    df: DataFrame,
    columns: list[str],
    keys: list[str],
    label: str = "label",
    kinds: tuple[str, ...] = KINDS,
    threshold: float = 0.5,
    balanced: bool = True,
    k: int = 5,
    seed: int = 42,
    params: dict[str, dict] | None = None,
) -> DataFrame:
    """(model, accuracy, recall, miss_rate, auc) on the test side, best recall first.

    ``keys`` identify a row; they decide its side of the split.  ``balanced``
    weights the rarer class up, ``threshold`` is the score that counts as 1.
    """
    spark = df.sparkSession
    rows = drop_incomplete(df.select(*keys, *columns, label), [*columns, label])
    scaled = mark_split(standardize(rows, list(columns)), keys, seed=seed)
    # the rows and the scores are read several times, so each is written once
    root = work_dir(spark, "study")
    overwrite_table(scaled.withColumn("_id", F.concat_ws("|", *keys)), f"{root}/rows")
    stored = read_table(spark, f"{root}/rows")
    train, test = stored.where(~F.col("is_test")), stored.where("is_test")
    weight = "_weight" if balanced else None
    weighted = with_class_weights(train, label, weight) if balanced else train
    parts = []
    for kind in kinds:
        if kind == "knn":
            part = _knn_scores(train, test, columns, label, k)
        else:
            model = fit_classifier(kind, weighted, columns, label, weight, **(params or {}).get(kind, {}))
            part = score(model, test).select(label, "score")
        parts.append(part.withColumn("model", F.lit(kind)))
    overwrite_table(reduce(DataFrame.unionByName, parts), f"{root}/scores")
    scores = read_table(spark, f"{root}/scores")
    return compare_models(apply_threshold(scores, threshold), label)
