"""Feature, metric, learner, text and contact queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barstream.functions.scorers import register_scorer
from barstream.operators import contacts as C
from barstream.operators import features as FE
from barstream.operators import metrics as M
from barstream.operators import tabular as T
from barstream.operators.indicators import indicator_table, ordered_indicators
from barstream.operators.neighbors import knn as nearest
from barstream.operators.slicing import order_table
from barstream.operators.text import fit_sentiment, sentiment_score
from barstream.plans import learners as L
from barstream.plans.study import study
from barstream.sources.colocated import store_colocated
from barstream.sources.tables import overwrite_table, read_table, work_dir
from checks import fixtures as X
from checks import sql as S

Q, O = {}, {}


def query(name, oracle=None):
    def add(fn):
        Q[name] = fn
        if oracle:
            O[name] = oracle
        return fn

    return add


LABELLED = S.SMA + """, labelled AS (
  SELECT *, lead(close, 5) OVER (PARTITION BY symbol ORDER BY trade_time) AS future_close FROM sma),
frame AS (SELECT symbol, trade_time, close, volume, sma_5, sma_10, sma_20,
  CASE WHEN future_close > close THEN 1 ELSE 0 END AS label FROM labelled)"""
FRAME_COLUMNS = f"symbol, trade_time, close, volume, {S.r('sma_5')}, {S.r('sma_10')}, {S.r('sma_20')}, label"


def _ordered(prices):
    return order_table(prices, "symbol", "trade_time")


def direction_frame(spark, sf_dir, joined=True):
    prices = X.ticks(spark, sf_dir)
    return FE.training_frame(prices if joined else None, indicator_table(_ordered(prices)))


@query("label_direction", f"WITH {LABELLED} SELECT symbol, trade_time, close, future_close, CASE WHEN future_close > close THEN 1 ELSE 0 END AS label FROM labelled")
def label_direction(spark, sf_dir):
    return FE.label_direction(_ordered(X.ticks(spark, sf_dir).select("symbol", "trade_time", "close")))


@query("training_frame", f"WITH {LABELLED} SELECT {FRAME_COLUMNS} FROM frame")
def training_frame(spark, sf_dir):
    return X.rounded(direction_frame(spark, sf_dir))


@query("training_frame_one_input", f"WITH {LABELLED} SELECT {FRAME_COLUMNS} FROM frame")
def training_frame_one_input(spark, sf_dir):
    return X.rounded(direction_frame(spark, sf_dir, joined=False))


@query("training_frame_ordered", f"WITH {LABELLED} SELECT {FRAME_COLUMNS} FROM frame")
def training_frame_ordered(spark, sf_dir):
    """Indicators and label from one stored order of the prices."""
    return X.rounded(FE.training_frame(None, ordered_indicators(_ordered(X.ticks(spark, sf_dir)))))


@query("training_frame_colocated", f"WITH {LABELLED} SELECT {FRAME_COLUMNS} FROM frame")
def training_frame_colocated(spark, sf_dir):
    """Prices and indicators stored by (symbol, time) and joined without an exchange."""
    prices, buckets = X.ticks(spark, sf_dir), int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = lambda df, name: store_colocated(df, work_dir(spark, name), list(FE.KEYS), buckets)
    return X.rounded(FE.training_frame(store(prices, "prices"), store(indicator_table(_ordered(prices)), "indicators")))


@query("split", f"WITH {S.tab_class()} SELECT *, {S.digest(S.LINE_KEY)} < 0.2 * 4294967296 AS is_test FROM tab")
def split(spark, sf_dir):
    return FE.mark_split(X.tab_class(spark, sf_dir), X.LINE_KEYS)


@query("split_small", f"WITH {S.tab_class()} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {S.digest(S.LINE_KEY)} < 0.004 * 4294967296 AS is_test FROM tab")
def split_small(spark, sf_dir):
    return FE.mark_split(X.tab_class(spark, sf_dir), X.LINE_KEYS, test=0.004).select(*X.LINE_KEYS, "is_test")


@query("label_drop_unlabelled", f"WITH {LABELLED} SELECT symbol, trade_time, close, future_close, CASE WHEN future_close > close THEN 1 ELSE 0 END AS label FROM labelled WHERE future_close IS NOT NULL")
def label_drop_unlabelled(spark, sf_dir):
    return FE.label_direction(_ordered(X.ticks(spark, sf_dir).select("symbol", "trade_time", "close")), drop_unlabelled=True)


@query("folds", f"WITH {S.tab_class()} SELECT *, CAST({S.bucket(S.LINE_KEY, 5)} AS INTEGER) AS fold FROM tab")
def folds(spark, sf_dir):
    return FE.add_folds(X.tab_class(spark, sf_dir), X.LINE_KEYS)


# predictions for the metric queries: a fixed rule on the given columns
PREDICTED = S.tab_class() + """, pred AS (
  SELECT label, CASE WHEN l_discount >= 0.06 THEN 1 ELSE 0 END AS prediction FROM tab)"""


def predicted(spark, sf_dir):
    return X.tab_class(spark, sf_dir).select("label", F.when(F.col("l_discount") >= 0.06, 1).otherwise(0).alias("prediction"))


@query("classification_metrics", f"WITH {PREDICTED} SELECT count(*) AS n_rows, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM pred")
def classification_metrics(spark, sf_dir):
    return X.rounded(M.classification_metrics(predicted(spark, sf_dir)))


@query("confusion_matrix", f"""WITH {PREDICTED} SELECT label, count(*) FILTER (prediction = 0) AS pred_0,
  count(*) FILTER (prediction = 1) AS pred_1 FROM pred GROUP BY label""")
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(predicted(spark, sf_dir))


THREE = S.tab_class() + """, pred AS (
  SELECT CASE WHEN l_quantity > 40 THEN 2 ELSE label END AS label, CASE WHEN l_discount >= 0.06 THEN 2 WHEN l_tax > 0.05 THEN 1 ELSE 0 END AS prediction FROM tab)"""


@query("confusion_matrix_multi", f"""WITH {THREE} SELECT label, count(*) FILTER (prediction = 0) AS pred_0,
  count(*) FILTER (prediction = 1) AS pred_1, count(*) FILTER (prediction = 2) AS pred_2 FROM pred GROUP BY label""")
def confusion_matrix_multi(spark, sf_dir):
    rows = X.tab_class(spark, sf_dir)
    guess = F.when(F.col("l_discount") >= 0.06, 2).when(F.col("l_tax") > 0.05, 1).otherwise(0)
    truth = F.when(F.col("l_quantity") > 40, 2).otherwise(F.col("label"))
    return M.confusion_matrix(rows.select(truth.alias("label"), guess.alias("prediction")))


@query(
    "classification_report",
    f"""WITH {PREDICTED}, c AS (
      SELECT k, count(*) FILTER (label = k AND prediction = k)::DOUBLE AS tp, count(*) FILTER (prediction = k)::DOUBLE AS g,
        count(*) FILTER (label = k)::DOUBLE AS t FROM pred, (SELECT unnest([0, 1]) AS k) GROUP BY k),
    m AS (SELECT k, CASE WHEN g = 0 THEN 0 ELSE tp / g END AS p, CASE WHEN t = 0 THEN 0 ELSE tp / t END AS r, t, tp FROM c),
    f AS (SELECT k, p, r, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1, t, tp FROM m)
    SELECT CAST(k AS VARCHAR) AS name, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, CAST(t AS BIGINT) AS support FROM f
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(t), 6), round(sum(tp) / sum(t), 6), round(sum(tp) / sum(t), 6), CAST(sum(t) AS BIGINT) FROM f
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(t) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(p * t) / sum(t), 6), round(sum(r * t) / sum(t), 6), round(sum(f1 * t) / sum(t), 6), CAST(sum(t) AS BIGINT) FROM f""",
)
def classification_report(spark, sf_dir):
    return X.rounded(M.classification_report(predicted(spark, sf_dir)))


@query("auc", f"WITH {S.SCORES}, {S.RANKED} SELECT model, {S.r('auc')} FROM auc")
def auc(spark, sf_dir):
    return X.rounded(M.auc(X.model_scores(spark, sf_dir), by="model"))


COUNTS = """m AS (SELECT model, avg(CAST(label = prediction AS INTEGER)) AS accuracy,
  count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE / count(*) FILTER (label = 1) AS recall FROM scores GROUP BY model)"""


@query("compare_models", f"""WITH {S.SCORES}, {S.RANKED}, {COUNTS} SELECT model, {S.r('accuracy')}, {S.r('recall')},
  {S.r('1 - recall', 'miss_rate')}, {S.r('auc')} FROM m JOIN auc USING (model)""")
def compare_models(spark, sf_dir):
    return X.rounded(M.compare_models(X.model_scores(spark, sf_dir)))


@query(
    "binary_metrics",
    f"""WITH {S.tab_class()}, scores AS (
      SELECT 'x' AS model, label, l_extendedprice AS score, CASE WHEN l_extendedprice >= 40000 THEN 1 ELSE 0 END AS prediction FROM tab),
    {S.RANKED}, {COUNTS} SELECT {S.r('accuracy')}, {S.r('recall')}, {S.r('1 - recall', 'miss_rate')}, {S.r('auc')} FROM m JOIN auc USING (model)""",
)
def binary_metrics(spark, sf_dir):
    scored = M.apply_threshold(X.tab_class(spark, sf_dir), 40000.0, score="l_extendedprice")
    return X.rounded(M.binary_metrics(scored, score="l_extendedprice"))


@query(
    "threshold_sweep",
    f"""WITH {S.tab_class()}, s AS (SELECT label, l_discount * 10 AS score, CAST(i AS DOUBLE) / 10 AS threshold FROM tab, range(1, 10) t(i))
    SELECT threshold, round(avg(CAST((score >= threshold) = (label = 1) AS INTEGER)), 6) AS accuracy,
      round(coalesce(count(*) FILTER (score >= threshold AND label = 1)::DOUBLE / nullif(count(*) FILTER (score >= threshold), 0), 0), 6) AS precision,
      round(count(*) FILTER (score >= threshold AND label = 1)::DOUBLE / count(*) FILTER (label = 1), 6) AS recall
    FROM s GROUP BY threshold""",
)
def threshold_sweep(spark, sf_dir):
    scored = X.tab_class(spark, sf_dir).select("label", (F.col("l_discount") * 10).alias("score"))
    return X.rounded(M.threshold_sweep(scored, [i / 10 for i in range(1, 10)]))


def _z(c):
    return f"round((({c}) - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}"


@query("standardize", f"WITH {S.tab_class()} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(_z(c) for c in X.FEATURES)}, label FROM tab")
def standardize(spark, sf_dir):
    return X.rounded(T.standardize(X.tab_class(spark, sf_dir), X.FEATURES))


NAMES = [*X.FEATURES, "label"]


@query(
    "correlations",
    f"WITH {S.tab_class()} " + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) + 0.0 AS correlation FROM tab" for a in NAMES for b in NAMES
    ),
)
def correlations(spark, sf_dir):
    return X.rounded(T.correlations(X.tab_class(spark, sf_dir), NAMES))


WIDE_COLUMNS = {f"{c}_{n}": f"{c} * {f}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") for n, f in (("a", "1"), ("b", "l_quantity"), ("c", "(l_tax - 0.03)"))}
WIDE_TAB = S.tab_class() + ", wide AS (SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE_COLUMNS.items()) + ", 3.3::DOUBLE AS level FROM tab)"


@query(
    "correlations_wide",
    f"WITH {WIDE_TAB} " + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, " + ("NULL::DOUBLE" if "level" in (a, b) else f"round(corr({a}, {b}), 6) + 0.0") + " AS correlation"
        + ("" if "level" in (a, b) else " FROM wide") for a in [*WIDE_COLUMNS, "level"] for b in [*WIDE_COLUMNS, "level"]
    ),
)
def correlations_wide(spark, sf_dir):
    """Thirteen columns, one of them constant."""
    rows = X.tab_class(spark, sf_dir).select(*[F.expr(f"CAST({e} AS DOUBLE)").alias(n) for n, e in WIDE_COLUMNS.items()], F.lit(3.3).alias("level"))
    return X.rounded(T.correlations(rows, [*WIDE_COLUMNS, "level"]))


@query(
    "select_features",
    f"WITH {S.tab_class(X.SEPARABLE)}, c AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature, corr({a}, label) AS c FROM tab" for a in X.FEATURES
    ) + ") SELECT feature, round(c, 6) + 0.0 AS correlation FROM c ORDER BY abs(c) DESC, feature LIMIT 2",
)
def select_features(spark, sf_dir):
    return X.rounded(T.select_features(X.tab_class(spark, sf_dir, X.SEPARABLE), X.FEATURES, "label", k=2))


@query("class_weights", """SELECT quality AS label, count(*) AS n,
  round(sum(count(*)) OVER () / (count(*) OVER () * count(*)::DOUBLE), 6) AS weight FROM labels GROUP BY quality""")
def class_weights(spark, sf_dir):
    return X.rounded(T.class_weights(X.table(spark, sf_dir, "labels").select(F.col("quality").alias("label"))))


@query("row_weights", """SELECT doc_id, quality AS label,
  round(count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY quality)), 6) AS weight FROM labels""")
def row_weights(spark, sf_dir):
    rows = X.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return X.rounded(T.with_class_weights(rows))


@query("downsample", f"""SELECT doc_id, label FROM (
    SELECT doc_id, quality AS label, count(*) OVER (PARTITION BY quality) AS own FROM labels),
  (SELECT least(count(*) FILTER (quality = 1), count(*) FILTER (quality = 0)) AS rare FROM labels)
  WHERE {S.digest("concat_ws('|', '42', doc_id)")}::DOUBLE * own < 4294967296.0 * rare""")
def downsample(spark, sf_dir):
    return T.downsample(X.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), ["doc_id"])


@query("downsample_rare", f"""WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_orderkey % 997 = 0 AS INTEGER) AS label FROM lineitem)
  SELECT m.* FROM m, (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM m)
  WHERE {S.digest(S.LINE_KEY)}::DOUBLE * CASE WHEN label = 1 THEN p ELSE n END < 4294967296.0 * least(p, n)""")
def downsample_rare(spark, sf_dir):
    rows = X.table(spark, sf_dir, "lineitem").select(*X.LINE_KEYS, (F.col("l_orderkey") % 997 == 0).cast("int").alias("label"))
    return T.downsample(rows, X.LINE_KEYS)


@query(
    "knn",
    """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    n AS (SELECT q.vec_id, t.label FROM v q, v t
      QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY
        list_sum(list_transform(list_zip(q.e, t.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), t.vec_id) <= 5)
    SELECT vec_id, label AS prediction, count(*) AS votes, CAST(sum(count(*)) OVER (PARTITION BY vec_id) AS BIGINT) AS neighbours FROM n GROUP BY vec_id, label
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, label) = 1""",
)
def knn(spark, sf_dir):
    v = X.table(spark, sf_dir, "embeddings")
    return nearest(v, v, k=5, key="vec_id", vector="embedding")


# Frames whose labels a learner must get exactly, so that its predictions can be compared row by row.
CUT = "l_quantity > 25"
# Quantities and sizes above the cut are moved up by 25: a gap that each learner finds, with all rows on both sides.
GAP = "{0} + CASE WHEN {0} > 25 THEN 25 ELSE 0 END"
TEST_SIDE = f"SELECT * FROM tab WHERE {S.digest(S.LINE_KEY)} < 0.2 * 4294967296"
HOLDOUT = f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, label AS prediction FROM ({TEST_SIDE})"


@query(
    "knn_split",
    """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    n AS (SELECT q.vec_id, t.label FROM v q, v t WHERE q.vec_id % 10 = 0 AND t.vec_id % 10 <> 0
      QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY
        list_sum(list_transform(list_zip(q.e, t.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), t.vec_id) <= 5)
    SELECT vec_id, label AS prediction, count(*) AS votes, CAST(sum(count(*)) OVER (PARTITION BY vec_id) AS BIGINT) AS neighbours FROM n GROUP BY vec_id, label
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, label) = 1""",
)
def knn_split(spark, sf_dir):
    """Every tenth vector against the others."""
    v = X.table(spark, sf_dir, "embeddings")
    test = F.col("vec_id") % 10 == 0
    return nearest(v.where(~test), v.where(test), k=5, key="vec_id", vector="embedding")


def _holdout(kind, frame, **params):
    """Fit on the training side, predict the test side."""
    train, test = FE.split(frame, X.LINE_KEYS)
    scored = L.score(L.fit_classifier(kind, train, X.FEATURES, **params), test)
    return scored.select(*X.LINE_KEYS, "label", "prediction")


@query("classifier_lr", f"WITH {S.tab_class(CUT)} {HOLDOUT}")
def classifier_lr(spark, sf_dir):
    return _holdout("lr", X.tab_class(spark, sf_dir, CUT).withColumn("l_quantity", F.expr(GAP.format("l_quantity"))))


@query("classifier_lr_whole")
def classifier_lr_whole(spark, sf_dir):
    """Without the gap; what is predicted at the class border is the fit's, so there is no SQL."""
    return _holdout("lr", X.tab_class(spark, sf_dir, CUT))


@query("classifier_dt", f"WITH {S.tab_class(CUT)} {HOLDOUT}")
def classifier_dt(spark, sf_dir):
    return _holdout("dt", X.tab_class(spark, sf_dir, CUT), maxBins=64)


@query("classifier_rf", f"WITH {S.tab_class(CUT)} {HOLDOUT}")
def classifier_rf(spark, sf_dir):
    return _holdout("rf", X.tab_class(spark, sf_dir, CUT), maxBins=64, featureSubsetStrategy="all")


@query("cross_validate", f"WITH {S.tab_class(CUT)} SELECT 'accuracy' AS metric, avg(CAST(label = CAST({CUT} AS INTEGER) AS DOUBLE)) AS mean, 0.0::DOUBLE AS deviation FROM tab")
def cross_validate(spark, sf_dir):
    return L.cross_validate(X.tab_class(spark, sf_dir, CUT), "dt", X.FEATURES, X.LINE_KEYS, maxBins=64)


BOTH = "l_quantity > 35 AND l_tax > 0.04"
# One cut finds the quantity; what lies above it has the label in fewer than half of its rows, so nothing is found.
TUNED = f"""WITH {S.tab_class(BOTH)} SELECT 'maxDepth=4' AS params, 'recall' AS metric, avg(CAST({BOTH} AS DOUBLE)) AS mean FROM tab WHERE label = 1
  UNION ALL SELECT 'maxDepth=1', 'recall', CASE WHEN avg(label) FILTER (l_quantity > 35) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM tab"""


@query("tune", TUNED)
def tune(spark, sf_dir):
    """Both depths: one cut can't give a label of two conditions."""
    return tune_grid(spark, sf_dir)


@query("tune_grid", TUNED)
def tune_grid(spark, sf_dir):
    frame = X.tab_class(spark, sf_dir, BOTH)
    return L.tune(frame, "dt", X.FEATURES, X.LINE_KEYS, {"maxDepth": [1, 4]}, maxBins=64)[1]


PARTS = """parts AS (SELECT p_partkey, p_size, p_retailprice, CAST(p_size > 25 AS INTEGER) AS label FROM part)"""


@query("model_study", f"""WITH {PARTS}, held AS (SELECT * FROM parts WHERE {S.digest("concat_ws('|', '42', p_partkey)")} < 0.2 * 4294967296)
  SELECT model, avg(CAST(label = CAST(p_size > 25 AS INTEGER) AS DOUBLE)) AS accuracy, avg(CAST(p_size > 25 AS DOUBLE)) FILTER (label = 1) AS recall,
    0.0::DOUBLE AS miss_rate, 1.0::DOUBLE AS auc FROM held, (SELECT unnest(['lr', 'knn', 'dt', 'rf']) AS model) GROUP BY model""")
def model_study(spark, sf_dir):
    """The four learners on the same split of a frame that all of them can tell apart."""
    part = X.table(spark, sf_dir, "part")
    return _studied(part.withColumn("at", F.expr(f"1000 * ({GAP.format('p_size')})")))


@query("model_study_whole")
def model_study_whole(spark, sf_dir):
    """Sizes as they are."""
    return _studied(X.table(spark, sf_dir, "part").withColumn("at", F.col("p_size")))


def _studied(part):
    frame = part.select("p_partkey", "at", "p_retailprice", (F.col("p_size") > 25).cast("int").alias("label"))
    params = {"dt": {"maxBins": 64}, "rf": {"maxBins": 64, "featureSubsetStrategy": "all"}}
    return X.rounded(study(frame, ["at", "p_retailprice"], ["p_partkey"], params=params))


# Boosting over a label that the first tree gets right: every further tree of rate 0.1 adds a tenth of the same gradient
# 4 / (1 + exp(2 f)) on either side, so the margin f after 100 trees is known, and with it each confidence.
@query("gbt_predictions", f"""WITH RECURSIVE {S.TICKS}, boosted AS (
    SELECT 1 AS trees, 1.0::DOUBLE AS f UNION ALL SELECT trees + 1, f + 0.1::DOUBLE * 4 / (1 + exp(2 * f)) FROM boosted WHERE trees < 100),
  sure AS (SELECT 1 / (1 + exp(-2 * f)) AS p FROM boosted WHERE trees = 100),
  last AS (SELECT symbol, arg_max(volume, trade_time) > 50 AS up FROM ticks GROUP BY symbol)
  SELECT symbol AS stock_code, '2024-02-01T00:00:00' AS predict_time, CASE WHEN up THEN 'UP' ELSE 'DOWN' END AS predicted_direction,
    round(CASE WHEN up THEN p ELSE 1 - p END, 6) AS confidence, round(p, 6) AS direction_confidence FROM last, sure""")
def gbt_predictions(spark, sf_dir):
    """The direction model's trees on a label that they can learn everywhere: whether the volume is above 50."""
    indicators = read_table(spark, _stored_indicators(spark, X.ticks(spark, sf_dir)))
    path = work_dir(spark, "direction_model")
    L.save_model(L.fit_gbt(indicators.withColumn("label", (F.col("volume") > 50).cast("int")), maxBins=128), path)
    return X.rounded(L.predict_latest(indicators, L.load_model(path), "2024-02-01T00:00:00"))


@query("gbt_latest")
def gbt_latest(spark, sf_dir):
    """The predictions themselves."""
    prices = X.ticks(spark, sf_dir)
    indicators = read_table(spark, _stored_indicators(spark, prices))
    train, _ = FE.split(FE.training_frame(None, indicators), ["symbol", "trade_time"])
    path = work_dir(spark, "direction_model")
    L.save_model(L.fit_gbt(train), path)
    return L.predict_latest(indicators, L.load_model(path), "2024-02-01T00:00:00")


def _stored_indicators(spark, prices):
    path = work_dir(spark, "indicators")
    overwrite_table(indicator_table(_ordered(prices)), path)
    return path


@query("predict_every_symbol", f"""WITH {S.TICKS}, last AS (SELECT symbol, arg_max(volume, trade_time) AS newest FROM ticks GROUP BY symbol)
  SELECT symbol AS stock_code, newest % 7 <> 0 AS has_newest, TRUE AS predicted FROM last""")
def predict_every_symbol(spark, sf_dir):
    """Symbols whose newest row has a gap are predicted from the row before it."""
    prices = X.ticks(spark, sf_dir)
    newest = prices.groupBy("symbol").agg(F.max_by("volume", "trade_time").alias("newest"), F.max("trade_time").alias("at"))
    rows = indicator_table(_ordered(prices)).join(newest, "symbol")
    gap = (F.col("trade_time") == F.col("at")) & (F.col("newest") % 7 == 0)
    frame = rows.withColumn("sma_20", F.when(~gap, F.col("sma_20"))).withColumn("label", (F.col("close") > 250).cast("int"))
    model = L.fit_classifier("dt", frame, FE.FEATURES)
    out = L.predict_latest(frame, model, "2024-02-01T00:00:00").join(newest, F.col("symbol") == F.col("stock_code"))
    return out.select("stock_code", (F.col("newest") % 7 != 0).alias("has_newest"), F.col("predicted_direction").isNotNull().alias("predicted"))


@query(
    "direction",
    f"""WITH {S.TICKS} SELECT symbol AS stock_code, '2024-02-01T00:00:00' AS predict_time,
      CASE WHEN close / 500.0::DOUBLE > 0.5 THEN 'UP' ELSE 'DOWN' END AS predicted_direction, close / 500.0::DOUBLE AS confidence,
      round(CASE WHEN close / 500.0::DOUBLE > 0.5 THEN close / 500.0::DOUBLE ELSE 1 - close / 500.0::DOUBLE END, 6) AS direction_confidence
    FROM ticks""",
)
def direction(spark, sf_dir):
    scored = X.ticks(spark, sf_dir).withColumn("score", F.col("close") / 500.0)
    out = L.direction_columns(scored, "2024-02-01T00:00:00")
    return out.withColumn("direction_confidence", F.round("direction_confidence", 6))


LABEL_ROWS = 2_000_000


def _labelled(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = X.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    # a label is 12 bytes: texts are not shuffled to meet so many
    return docs.join(F.broadcast(marks) if marks.count() <= LABEL_ROWS else marks, "doc_id")


@query("sentiment_model", f"WITH {S.MODEL} SELECT token, {S.r('llr')} FROM model")
def sentiment_model(spark, sf_dir):
    return X.rounded(fit_sentiment(_labelled(spark, sf_dir)).select("token", "llr"))


def _scored(spark, sf_dir, max_chars, **options):
    docs = X.table(spark, sf_dir, "documents").select("doc_id", "text")
    path = work_dir(spark, "sentiment_model")
    overwrite_table(fit_sentiment(_labelled(spark, sf_dir)), path)
    out = sentiment_score(docs, read_table(spark, path), text="text", max_chars=max_chars, **options)
    return X.rounded(out.drop("text"))


@query("sentiment", f"WITH {S.MODEL}, {S.scored('text')} SELECT doc_id, {S.r('sentiment_score')} FROM sentiment")
def sentiment(spark, sf_dir):
    """Whole texts."""
    return _scored(spark, sf_dir, None)


@query("sentiment_join", f"WITH {S.MODEL}, {S.scored('text')} SELECT doc_id, {S.r('sentiment_score')} FROM sentiment")
def sentiment_join(spark, sf_dir):
    """Whole texts, with the token table joined instead of broadcast."""
    return _scored(spark, sf_dir, None, broadcast_rows=0)


@query("sentiment_title_limit", f"WITH {S.MODEL}, {S.scored('substring(text, 1, 300)')} SELECT doc_id, {S.r('sentiment_score')} FROM sentiment")
def sentiment_title_limit(spark, sf_dir):
    """The scorer's 300-character limit for titles, which is part of its definition."""
    return _scored(spark, sf_dir, 300)


@query(
    "scorer_udf",
    """SELECT doc_id, CASE WHEN length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) < 5 THEN 0.5
      ELSE round((length(text) - length(replace(text, 'e', ''))) / length(text)::DOUBLE, 6) END AS score FROM documents""",
)
def scorer_udf(spark, sf_dir):
    share = register_scorer(spark, "e_share", lambda texts: texts.str.count("e") / texts.str.len(), batches=True)
    docs = X.table(spark, sf_dir, "documents")
    return X.rounded(docs.select("doc_id", share("text").alias("score")))


@query("vcards", f"""WITH {S.CONTACTS} SELECT c_custkey, 'BEGIN:VCARD' || nl || 'VERSION:3.0' || nl
  || CASE WHEN trim(phone) <> '' THEN 'TEL;TYPE=CELL:' || phone || nl ELSE '' END
  || CASE WHEN trim(email) <> '' THEN 'EMAIL:' || email || nl ELSE '' END
  || CASE WHEN trim(name) <> '' THEN 'FN;CHARSET=UTF-8:' || name || nl ELSE '' END
  || CASE WHEN trim(company) <> '' THEN 'ORG;CHARSET=UTF-8:' || company || nl ELSE '' END
  || CASE WHEN trim(position) <> '' THEN 'TITLE;CHARSET=UTF-8:' || position || nl ELSE '' END
  || 'END:VCARD' || nl AS vcard FROM contacts, (SELECT chr(13) || chr(10) AS nl)""")
def vcards(spark, sf_dir):
    return C.vcards(X.contacts(spark, sf_dir), "c_custkey")


@query("nonempty_contacts", f"""WITH {S.CONTACTS} SELECT * FROM contacts
  WHERE trim(name || "avatarUri" || position || phone || email || company || bio) <> ''""")
def nonempty_contacts(spark, sf_dir):
    return C.nonempty_contacts(X.contacts(spark, sf_dir))


@query("fill_contacts", f"""WITH {S.CONTACTS} SELECT * REPLACE (coalesce(nullif(phone, ''), '') AS phone,
  CASE WHEN "templateIndex" IN (0, 1, 2) THEN "templateIndex" ELSE 0 END AS "templateIndex") FROM contacts""")
def fill_contacts(spark, sf_dir):
    return C.fill_contacts(X.contacts(spark, sf_dir).withColumn("phone", F.nullif(F.col("phone"), F.lit(""))))


@query("fold_contacts", f"""WITH {S.CONTACTS} SELECT * REPLACE (
    CASE WHEN c_custkey % 2 = 0 THEN 'about ' || name ELSE bio END AS bio,
    CASE WHEN c_custkey % 2 = 0 THEN "templateIndex" ELSE CAST(("templateIndex" + 1) % 3 AS INTEGER) END AS "templateIndex")
  FROM contacts""")
def fold_contacts(spark, sf_dir):
    return C.fold_contacts(X.contact_changes(spark, sf_dir), "c_custkey")


@query("contact_profile", f"""WITH {S.CONTACTS} SELECT c_custkey,
  CAST((trim(phone) <> '') AS INTEGER) + CAST((trim(email) <> '') AS INTEGER) + CAST((trim(company) <> '') AS INTEGER) AS filled_lines,
  substring(name, 1, 1) AS initial FROM contacts""")
def contact_profile(spark, sf_dir):
    return C.contact_profile(X.contacts(spark, sf_dir), "c_custkey")
