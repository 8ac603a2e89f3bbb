"""Classification metrics.  Each is one aggregation with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.functions.columns import ratio
from barstream.operators.slicing import ROWS_PER_PART, order_table, running_totals

MAX_CLASSES = 1_000


def _count(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("double")


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: rows and accuracy."""
    hit = F.col(label).cast("double") == F.col(prediction).cast("double")
    return df.agg(F.count("*").alias("n_rows"), F.avg(hit.cast("int")).alias("accuracy"))


def _classes(df: DataFrame, label: str, prediction: str) -> list[int]:
    """All classes that occur as truth or prediction, in order; more than MAX_CLASSES are refused."""
    both = F.explode(F.array(F.col(label).cast("int"), F.col(prediction).cast("int"))).alias("c")
    found = [r["c"] for r in df.select(both).where("c IS NOT NULL").distinct().limit(MAX_CLASSES + 1).collect()]
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return sorted(found)


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: tuple[int, ...] | None = None
) -> DataFrame:
    """A row per true class, a column ``pred_<class>`` per predicted class.

    Classes come from the data; with ``classes`` given, ``pred_other`` counts
    the predictions of any other.  Every class has a row, other true classes
    and NULL keep theirs.
    """
    truth, guess = F.col(label).cast("int"), F.col(prediction).cast("int")
    if classes is None:
        return _matrix_of_pairs(df.sparkSession, df.groupBy(truth.alias("t"), guess.alias("g")).count())
    known = list(classes)
    cells = [F.count_if(guess == c).alias(f"pred_{c}") for c in known]
    cells.append(F.count_if(~guess.isin(known)).alias("pred_other"))
    found = df.groupBy(truth.alias("label")).agg(*cells)
    every = df.sparkSession.createDataFrame([(c,) for c in known], "label int")
    nil = every.join(found, "label", "left_anti").select("label", *[F.lit(0).cast("long").alias(c) for c in found.columns[1:]])
    return found.union(nil)


def _matrix_of_pairs(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """The matrix out of (truth, prediction, count), of at most MAX_CLASSES classes: the rows are read once."""
    found = {(r["t"], r["g"]): r["count"] for r in pairs.limit((MAX_CLASSES + 1) ** 2 + 1).collect()}
    known = sorted({c for pair in found for c in pair if c is not None})
    if len(known) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    every = known + [None] * any(t is None for t, _ in found)
    cells = [(t, *[found.get((t, g), 0) for g in known]) for t in every]
    return spark.createDataFrame(cells, ", ".join(["label int", *[f"`pred_{c}` bigint" for c in known]]))


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: tuple[int, ...] | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means.

    0/0 counts as 0.  Classes come from the data unless given.  All counts come
    from one pass over the data; the rows of the report are built from that
    single result row.
    """
    classes = _classes(df, label, prediction) if classes is None else classes
    truth, guess = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = [F.count("*").cast("double").alias("n"), _count(truth == guess).alias("hits")]
    for c in classes:
        counts += [
            _count((truth == c) & (guess == c)).alias(f"tp_{c}"),
            _count(guess == c).alias(f"guess_{c}"),
            _count(truth == c).alias(f"truth_{c}"),
        ]
    one = df.agg(*counts)
    for c in classes:
        precision = ratio(F.col(f"tp_{c}"), F.col(f"guess_{c}"))
        recall = ratio(F.col(f"tp_{c}"), F.col(f"truth_{c}"))
        one = one.withColumns({f"p_{c}": precision, f"r_{c}": recall})
        p, r = F.col(f"p_{c}"), F.col(f"r_{c}")
        one = one.withColumn(f"f_{c}", ratio(2 * p * r, p + r))

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("name"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("bigint").alias("support"),
        )

    def mean(prefix):
        return sum((F.col(f"{prefix}_{c}") for c in classes), F.lit(0.0)) / len(classes)

    def weighted(prefix):
        top = sum((F.col(f"{prefix}_{c}") * F.col(f"truth_{c}") for c in classes), F.lit(0.0))
        return ratio(top, sum((F.col(f"truth_{c}") for c in classes), F.lit(0.0)))

    accuracy, n = ratio(F.col("hits"), F.col("n")), F.col("n")
    rows = [row(str(c), F.col(f"p_{c}"), F.col(f"r_{c}"), F.col(f"f_{c}"), F.col(f"truth_{c}")) for c in classes]
    rows.append(row("accuracy", accuracy, accuracy, accuracy, n))
    rows.append(row("macro avg", mean("p"), mean("r"), mean("f"), n))
    rows.append(row("weighted avg", weighted("p"), weighted("r"), weighted("f"), n))
    return one.select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")


def _score_levels(
    df: DataFrame, group: str, label: str, score: str, rows_per_task: int | None, **sums: Column
) -> DataFrame:
    """One row per group and distinct score: positives, negatives, ``sums``, and
    the negatives up to this score.

    Equal scores are merged map-side, so a score shared by many rows is no hot
    spot; a group with many distinct scores is cut into parts of the axis.
    """
    rows = df.withColumn("_score", F.col(score).cast("double"))
    levels = rows.groupBy(group, "_score").agg(
        _count(F.col(label) == 1).alias("_pos"),
        _count(F.col(label) == 0).alias("_neg"),
        *[column.alias(name) for name, column in sums.items()],
    )
    limit = rows_per_task or ROWS_PER_PART
    biggest = levels.groupBy(group).count().agg(F.max("count")).first()[0] or 0  # heat is many levels, not many rows
    rows = order_table(levels, group, "_score", limit) if biggest > limit else levels
    return running_totals(rows, ["_neg"], group, "_score")


def _auc() -> Column:
    """Share of (positive, negative) pairs in the right order, ties as half."""
    wins = F.sum(F.col("_pos") * (F.col("_neg_upto") - F.col("_neg") / 2))
    return F.try_divide(wins, F.sum("_pos") * F.sum("_neg"))


def auc(
    df: DataFrame, label: str = "label", score: str = "score", by: str | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Exact area under the ROC curve per ``by`` group; NULL if a class is absent."""
    group = by or "_all"
    rows = df if by else df.withColumn("_all", F.lit("all"))
    out = _score_levels(rows, group, label, score, rows_per_task).groupBy(group).agg(_auc().alias("auc"))
    return out if by else out.drop("_all")


def binary_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score",
    by: str | None = None, rows_per_task: int | None = None,
) -> DataFrame:
    """accuracy, recall, miss_rate = 1 - recall and auc, per ``by`` group if given.

    All come from the same per-score counts: one pass over the rows.
    """
    group = by or "_all"
    rows = df if by else df.withColumn("_all", F.lit("all"))
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    levels = _score_levels(
        rows, group, label, score, rows_per_task,
        _hits=_count(y == p), _found=_count((y == 1) & (p == 1)), _rows=F.count("*").cast("double"),
    )
    recall = ratio(F.sum("_found"), F.sum("_pos"))
    out = levels.groupBy(group).agg(
        ratio(F.sum("_hits"), F.sum("_rows"), None).alias("accuracy"),
        recall.alias("recall"),
        (1 - recall).alias("miss_rate"),
        _auc().alias("auc"),
    )
    return out if by else out.drop("_all")


def apply_threshold(df: DataFrame, threshold: float, score: str = "score", output: str = "prediction") -> DataFrame:
    """Predict 1 where the score reaches the threshold."""
    return df.withColumn(output, F.when(F.col(score) >= threshold, 1).otherwise(0))


def threshold_sweep(
    df: DataFrame, thresholds: list[float], label: str = "label", score: str = "score"
) -> DataFrame:
    """Accuracy, precision and recall at each threshold, from one pass."""
    y, s = F.col(label) == 1, F.col(score)
    counts = [F.count("*").cast("double").alias("n"), _count(y).alias("pos")]
    for i, t in enumerate(thresholds):
        counts += [_count(y & (s >= t)).alias(f"tp_{i}"), _count(~y & (s >= t)).alias(f"fp_{i}")]
    one = df.agg(*counts)
    rows = []
    for i, t in enumerate(thresholds):
        tp, fp = F.col(f"tp_{i}"), F.col(f"fp_{i}")
        tn = F.col("n") - F.col("pos") - fp
        rows.append(
            F.struct(
                F.lit(float(t)).alias("threshold"), ratio(tp + tn, F.col("n")).alias("accuracy"),
                ratio(tp, tp + fp).alias("precision"), ratio(tp, F.col("pos")).alias("recall"),
            )
        )
    return one.select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")


def compare_models(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """Metrics per ``model`` column, best recall first, ties by auc."""
    table = binary_metrics(df, label, prediction, score, by="model")
    return table.orderBy(F.desc("recall"), F.desc("auc"), "model")
