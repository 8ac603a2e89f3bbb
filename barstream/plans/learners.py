"""MLlib classifiers: fit, evaluate, tune, save, score."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.operators.features import FEATURES, add_folds, drop_incomplete
from barstream.operators.metrics import (
    classification_metrics,
    classification_report,
    confusion_matrix,
)
from barstream.operators.ranking import latest_per_key

CLASSIFIERS = {
    "lr": lambda **p: LogisticRegression(**p),
    "dt": lambda **p: DecisionTreeClassifier(**{"seed": 42, **p}),
    "rf": lambda **p: RandomForestClassifier(**{"seed": 42, **p}),
    # the direction model's published settings
    "gbt": lambda **p: GBTClassifier(**{"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "seed": 42, **p}),
}
EVALUATORS = {
    "recall": lambda label: MulticlassClassificationEvaluator(
        labelCol=label, metricName="recallByLabel", metricLabel=1.0
    ),
    "accuracy": lambda label: MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
    # 0 bins: exact
    "auc": lambda label: BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0),
}


def make_pipeline(kind: str, columns, label: str = "label", weight: str | None = None, **params) -> Pipeline:
    """Feature assembly and a classifier: lr, dt, rf or gbt."""
    if weight:
        params["weightCol"] = weight
    classifier = CLASSIFIERS[kind](labelCol=label, featuresCol="_features", **params)
    assembler = VectorAssembler(inputCols=list(columns), outputCol="_features", handleInvalid="skip")
    return Pipeline(stages=[assembler, classifier])


@contextmanager
def training_rows(df: DataFrame, columns: list[str], label: str, partitions: int | None = None):
    """Complete rows of the needed columns, ready for the passes of a learner.

    Rows are dealt by their values to a stated number of partitions (the
    session's ``spark.sql.shuffle.partitions`` unless given) and sorted there,
    whatever their number: what a learner samples depends on neither the files
    nor the cores.
    """
    rows = drop_incomplete(df.select(*columns), columns).withColumn(label, F.col(label).cast("double"))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, *columns).sortWithinPartitions(*columns).persist()
    try:
        if rows.isEmpty():
            raise ValueError("no training rows")
        yield rows
    finally:
        rows.unpersist()


def fit_classifier(
    kind: str, train: DataFrame, columns, label: str = "label", weight: str | None = None, **params
) -> PipelineModel:
    """Fit lr, dt, rf or gbt; rows with a missing value are left out."""
    needed = [*columns, label] + ([weight] if weight else [])
    with training_rows(train, needed, label) as rows:
        return make_pipeline(kind, columns, label, weight, **params).fit(rows)


def fit_gbt(train: DataFrame, columns=FEATURES, label: str = "label", **params) -> PipelineModel:
    """Boosted trees: 100 trees of depth 5, rate 0.1 unless given."""
    return fit_classifier("gbt", train, columns, label, **params)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add prediction (0/1) and score = P(label 1)."""
    out = model.transform(df)
    return out.withColumns(
        {"score": vector_to_array("probability")[1], "prediction": F.col("prediction").cast("int")}
    ).drop("_features", "rawPrediction", "probability")


def evaluate(predictions: DataFrame, label: str = "label") -> dict[str, DataFrame]:
    """Accuracy, confusion matrix and report of scored rows."""
    return {
        "metrics": classification_metrics(predictions, label),
        "confusion": confusion_matrix(predictions, label),
        "report": classification_report(predictions, label),
    }


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | None:
    """The stored model, or None if there is none at ``path``."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import AnalysisException

    try:
        return PipelineModel.load(path)
    except AnalysisException:
        return None
    except Py4JJavaError as error:
        if "Input path does not exist" in str(error.java_exception):
            return None
        raise


def direction_columns(df: DataFrame, as_of=None, score: str = "score") -> DataFrame:
    """Predictions in serving form.

    ``confidence`` is P(up) also when the direction is DOWN;
    ``direction_confidence`` is that of the stated direction.  A NULL score
    gives NULL in all three.
    """
    up = F.col(score) > 0.5
    known = F.col(score).isNotNull()
    time = F.current_timestamp() if as_of is None else F.lit(as_of)
    return df.select(
        F.col("symbol").alias("stock_code"),
        time.alias("predict_time"),
        F.when(up, "UP").when(known, "DOWN").alias("predicted_direction"),
        F.col(score).alias("confidence"),
        F.when(up, F.col(score)).otherwise(1 - F.col(score)).alias("direction_confidence"),
    )


def predict_latest(indicators: DataFrame, model: PipelineModel, as_of=None) -> DataFrame:
    """A row per symbol: its newest complete row, scored; NULL where no row is complete."""
    gaps = sum((F.col(c).isNull().cast("int") for c in FEATURES), F.lit(0))
    latest = latest_per_key(indicators.withColumn("_whole", gaps == 0), "symbol", ["_whole", "trade_time"])
    filled = latest.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})
    scored = score(model, filled).withColumn("score", F.when(F.col("_whole"), F.col("score")))
    return direction_columns(scored, as_of)


def _validator(df, kind, columns, label, keys, k, grid, metric, weight, params, parallelism):
    pipeline = make_pipeline(kind, columns, label, weight, **params)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(pipeline.getStages()[1].getParam(name), values)
    points = builder.build()
    needed = [*columns, label, "fold"] + ([weight] if weight else [])
    validator = CrossValidator(
        estimator=pipeline, estimatorParamMaps=points, evaluator=EVALUATORS[metric](label),
        numFolds=k, foldCol="fold", parallelism=parallelism,
    )
    with training_rows(add_folds(df, keys, k), needed, label) as rows:
        return points, validator.fit(rows)


def cross_validate(
    df: DataFrame, kind: str, columns, keys: list[str], label: str = "label", k: int = 5,
    metric: str = "accuracy", weight: str | None = None, parallelism: int = 2, **params,
) -> DataFrame:
    """(metric, mean, deviation) over k hash folds."""
    _, fitted = _validator(df, kind, columns, label, keys, k, {}, metric, weight, params, parallelism)
    row = (metric, float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0]))
    return df.sparkSession.createDataFrame([row], "metric string, mean double, deviation double")


def tune(
    df: DataFrame, kind: str, columns, keys: list[str], grid: dict[str, list], label: str = "label", k: int = 3,
    metric: str = "recall", weight: str | None = None, parallelism: int = 2, **params,
) -> tuple[PipelineModel, DataFrame]:
    """(best model, one row per grid point with its mean metric, best first)."""
    points, fitted = _validator(df, kind, columns, label, keys, k, grid, metric, weight, params, parallelism)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda x: x[0].name)), metric, float(m))
        for point, m in zip(points, fitted.avgMetrics)
    ]
    table = df.sparkSession.createDataFrame(rows, "params string, metric string, mean double")
    return fitted.bestModel, table.orderBy(F.desc("mean"), "params")
