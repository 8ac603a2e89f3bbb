"""Price, indicator, dashboard and ingestion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barstream.functions.columns import iso_text, parse_time
from barstream.operators import bars as B
from barstream.operators import dashboard as D
from barstream.operators import indicators as I
from barstream.operators.clean import clean_prices, parse_prices, quarantine, read_sorted
from barstream.operators.incremental import State, advance
from barstream.operators.slicing import order_table
from barstream.sources import normalize as N
from barstream.sources import serving
from barstream.sources.tables import read_table, overwrite_table, register_views, sql_indicators, to_messages, work_dir
from barstream.sources.watchlist import STOCKS, watchlist
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


def _ordered(spark, sf_dir, *columns):
    """Prices in order, cut into parts of equal size."""
    prices = X.ticks(spark, sf_dir).select("symbol", "trade_time", "close", *columns)
    return order_table(prices, "symbol", "trade_time")


def _table(spark, sf_dir):
    return I.indicator_table(_ordered(spark, sf_dir, "volume"))


SMA_COLUMNS = f"symbol, trade_time, close, volume, {S.r('sma_5')}, {S.r('sma_10')}, {S.r('sma_20')}"


@query("sma", f"WITH {S.SMA} SELECT {SMA_COLUMNS} FROM sma")
def sma(spark, sf_dir):
    return X.rounded(_table(spark, sf_dir))


@query("sma_sql", f"WITH {S.SMA} SELECT {SMA_COLUMNS} FROM sma")
def sma_sql(spark, sf_dir):
    register_views(spark, {"indicators": _table(spark, sf_dir)})
    return X.rounded(sql_indicators(spark))


@query("stored_indicators", f"WITH {S.SMA} SELECT {SMA_COLUMNS} FROM sma")
def stored_indicators(spark, sf_dir):
    path = work_dir(spark, "indicators")
    overwrite_table(_table(spark, sf_dir), path, sort_by=("symbol", "trade_time"))
    return X.rounded(read_table(spark, path))


FOLD = "list_reduce(list({x}) OVER w, lambda a, x: {keep} * a + {alpha} * x)"


def _fold(x, n):
    alpha = f"(2.0::DOUBLE / {n + 1})"
    return FOLD.format(x=x, keep=f"(1 - {alpha})", alpha=alpha)


RUNNING = "WINDOW w AS (PARTITION BY symbol ORDER BY trade_time ROWS UNBOUNDED PRECEDING)"


@query(
    "ema",
    f"WITH {S.TICKS} SELECT symbol, trade_time, {S.r(_fold('close', 12), 'ema_12')} FROM ticks {RUNNING}",
)
def ema(spark, sf_dir):
    prices = _ordered(spark, sf_dir)
    return X.rounded(I.ema(prices, 12).drop("close"))


@query(
    "macd",
    f"""WITH {S.TICKS}, a AS (
      SELECT symbol, trade_time, {_fold('close', 12)} - {_fold('close', 26)} AS dif FROM ticks {RUNNING}),
    b AS (SELECT symbol, trade_time, dif, {_fold('dif', 9)} AS dea FROM a {RUNNING})
    SELECT symbol, trade_time, {S.r('dif')}, {S.r('dea')}, {S.r('2 * (dif - dea)', 'macd')} FROM b""",
)
def macd(spark, sf_dir):
    prices = _ordered(spark, sf_dir)
    return X.rounded(I.macd(prices).drop("close"))


def _wilder(x):
    return FOLD.format(x=x, keep="(1 - 1.0::DOUBLE / 14)", alpha="(1.0::DOUBLE / 14)")


@query(
    "rsi",
    f"""WITH {S.TICKS}, d AS (
      SELECT symbol, trade_time, close - lag(close) OVER (PARTITION BY symbol ORDER BY trade_time) AS c FROM ticks),
    g AS (SELECT symbol, trade_time, greatest(c, 0.0) AS up, greatest(-c, 0.0) AS down FROM d WHERE c IS NOT NULL),
    s AS (SELECT symbol, trade_time, {_wilder('up')} AS up, {_wilder('down')} AS down FROM g {RUNNING})
    SELECT symbol, trade_time,
      CASE WHEN s.up IS NOT NULL THEN round(CASE WHEN up + down = 0 THEN 50.0 ELSE 100 * up / (up + down) END, 6) + 0.0 END AS rsi_14
    FROM d LEFT JOIN s USING (symbol, trade_time)""",
)
def rsi(spark, sf_dir):
    prices = _ordered(spark, sf_dir)
    return X.rounded(I.rsi(prices).drop("close"))


@query(
    "boll",
    f"""WITH {S.TICKS}, b AS (
      SELECT symbol, trade_time, avg(close) OVER w AS m, stddev_pop(close) OVER w AS s FROM ticks
      WINDOW w AS (PARTITION BY symbol ORDER BY trade_time ROWS 19 PRECEDING))
    SELECT symbol, trade_time, {S.r('m', 'boll_mid')}, {S.r('m + 2 * s', 'boll_upper')}, {S.r('m - 2 * s', 'boll_lower')} FROM b""",
)
def boll(spark, sf_dir):
    prices = _ordered(spark, sf_dir)
    return X.rounded(I.boll(prices).drop("close"))


@query(
    "clean_prices",
    f"""WITH {S.DIRTY} {S.CLEAN} FROM (
      SELECT * FROM dirty QUALIFY row_number() OVER (PARTITION BY symbol, trade_time ORDER BY arrival) = 1)
    WHERE close > 0 AND volume >= 0""",
)
def clean(spark, sf_dir):
    return clean_prices(X.dirty_ticks(spark, sf_dir), arrival="arrival")


@query(
    "json_roundtrip",
    f"""WITH {S.DIRTY} SELECT symbol, date_trunc('second', trade_time) AS trade_time, open, high, low, close, volume, data_type
    FROM dirty
    UNION ALL SELECT symbol, NULL, NULL, NULL, NULL, NULL, volume, 'realtime' FROM ticks
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM ticks WHERE event_type = 'error'""",
)
def json_roundtrip(spark, sf_dir):
    daily = to_messages(X.dirty_ticks(spark, sf_dir).drop("arrival"))
    realtime = to_messages(X.snapshot_messages(spark, sf_dir))
    broken = X.table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.concat(F.lit('{"symbol": "'), "user_id", F.lit('", "close": ')).alias("value")
    )
    return parse_prices(daily.unionByName(realtime).unionByName(broken), ntz=True)


@query(
    "accept_snapshots",
    f"""WITH {S.TICKS} SELECT symbol, trade_time, close, volume, data_type FROM (
      SELECT symbol, trade_time, close, volume, 'realtime' AS data_type FROM ticks) WHERE volume >= 0""",
)
def accept_snapshots(spark, sf_dir):
    messages = to_messages(X.snapshot_messages(spark, sf_dir))
    parsed = parse_prices(messages, accept_snapshots=True, ntz=True)
    return clean_prices(parsed).select("symbol", "trade_time", "close", "volume", "data_type")


@query(
    "parse_time",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE date_trunc('second', ts) END AS parsed
    FROM events""",
)
def parsed_times(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_type") == "error", iso_text("ts"))
        .when(F.col("event_type") == "signup", F.concat(F.lit("on "), F.date_format("ts", "yyyy-MM-dd")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return e.select("event_id", parse_time(text, ntz=True).alias("parsed"))


@query("daily_bars", f"WITH {S.BARS} SELECT * FROM bars")
def daily_bars(spark, sf_dir):
    return B.daily_bars(X.ticks(spark, sf_dir))


@query("daily_bars_ignore_zero", f"""WITH {S.BARS.replace("min(low)", "min(nullif(CASE WHEN volume % 3 <> 0 THEN low ELSE 0.0 END, 0.0))")} SELECT * FROM bars""")
def daily_bars_ignore_zero(spark, sf_dir):
    """Every third low is a filled-in zero."""
    zeroed = X.ticks(spark, sf_dir).withColumn("low", F.when(F.col("volume") % 3 != 0, F.col("low")).otherwise(0.0))
    return B.daily_bars(zeroed, ignore_zero=True)


@query(
    "kline_latest",
    f"""WITH {S.BARS} SELECT stock_code, strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS time, open_price AS open,
      high_price AS high, low_price AS low, close_price AS close, volume
    FROM bars QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY start_time DESC) <= 20""",
)
def kline_latest(spark, sf_dir):
    return B.kline(B.daily_bars(X.ticks(spark, sf_dir)), None, days=20)


@query(
    "kline_one",
    f"""WITH {S.BARS} SELECT stock_code, strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS time, open_price AS open,
      high_price AS high, low_price AS low, close_price AS close, volume
    FROM bars WHERE stock_code = '7' ORDER BY start_time DESC LIMIT 30""",
)
def kline_one(spark, sf_dir):
    return B.kline(B.daily_bars(X.ticks(spark, sf_dir)), "7")


@query(
    "candles",
    f"""WITH {S.BARS} SELECT stock_code, strftime(start_time, '%Y-%m-%dT%H:%M:%S') AS time,
      concat_ws('|', open_price, close_price, low_price, high_price) AS candle, volume
    FROM bars QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY start_time DESC) <= 60""",
)
def candles(spark, sf_dir):
    series = B.candles(B.newest_bars(B.daily_bars(X.ticks(spark, sf_dir)), None, 60))
    return series.withColumn("candle", F.array_join(F.col("candle").cast("array<string>"), "|"))


@query(
    "latest_indicator",
    f"""WITH {S.SMA} SELECT {SMA_COLUMNS} FROM sma
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trade_time DESC) = 1""",
)
def latest_indicator(spark, sf_dir):
    return X.rounded(I.newest_indicators(X.ticks(spark, sf_dir)))


LATEST = """SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY predict_time DESC) = 1"""


@query("latest_prediction", f"WITH {S.PREDICTIONS} {LATEST}")
def latest_prediction(spark, sf_dir):
    return D.latest_prediction(X.predictions(spark, sf_dir))


# printf rounds by the exact binary value but exact ties to even; those go up here
CARD = """SELECT stock_code, predicted_direction,
       CASE WHEN regexp_matches(printf('%.40f', confidence * 100), '\\.[0-9]50*$')
            THEN printf('%.1f%%', floor(confidence * 1000) / 10 + 0.1) ELSE printf('%.1f%%', confidence * 100) END AS confidence_text,
       strftime(predict_time, '%Y-%m-%dT%H:%M:%S') AS predict_time"""


@query("prediction_card", f"WITH {S.PREDICTIONS} {CARD} FROM predictions")
def prediction_card(spark, sf_dir):
    return D.format_prediction(X.predictions(spark, sf_dir))


NEWEST_NEWS = """SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY publish_time DESC, title DESC) <= 20"""


@query("news_latest20", f"WITH {S.scored_news()} {NEWEST_NEWS}")
def news_latest20(spark, sf_dir):
    return D.latest_news(X.scored_news(spark, sf_dir))


@query(
    "sentiment_band",
    f"""WITH {S.scored_news()} SELECT stock_code, publish_time, sentiment_score,
      CASE WHEN sentiment_score > 0.6 THEN 'green' WHEN sentiment_score < 0.4 THEN 'red' ELSE 'orange' END AS band,
      printf('%.2f', sentiment_score) AS score_text FROM scored""",
)
def sentiment_band(spark, sf_dir):
    return D.sentiment_band(X.scored_news(spark, sf_dir).drop("title"))


def _listed(spark, sf_dir):
    sources = X.table(spark, sf_dir, "documents").select(F.col("source").alias("code"))
    nations = X.table(spark, sf_dir, "nation").select(F.col("n_name").alias("code"))
    return sources.unionByName(nations).distinct()


@query(
    "news_gauge",
    f"""WITH {S.scored_news()}, g AS (SELECT stock_code, avg(sentiment_score) AS g FROM ({NEWEST_NEWS}) GROUP BY 1)
    SELECT code AS stock_code, round(coalesce(g, 0.5), 6) AS gauge
    FROM (SELECT source AS code FROM documents UNION SELECT n_name FROM nation) LEFT JOIN g ON code = stock_code""",
)
def news_gauge(spark, sf_dir):
    return X.rounded(D.news_gauge(X.scored_news(spark, sf_dir), _listed(spark, sf_dir)))


NEWS_CODE = "CAST(doc_id % 200 AS {})"


@query(
    "dashboard",
    f"""WITH {S.BARS}, predictions AS (
      SELECT symbol AS stock_code, trade_time AS predict_time,
        CASE WHEN volume % 2 = 0 THEN 'UP' ELSE 'DOWN' END AS predicted_direction, close / 500.0::DOUBLE AS confidence FROM ticks),
    {S.scored_news(NEWS_CODE.format('VARCHAR'))},
    k AS (SELECT stock_code, string_agg(strftime(start_time, '%Y-%m-%dT%H:%M:%S') || ' ' || open_price || '|' || close_price
        || '|' || low_price || '|' || high_price || ' ' || volume, ',' ORDER BY start_time) AS bars
      FROM (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY start_time DESC) <= 60) GROUP BY 1),
    c AS ({CARD} FROM ({LATEST})),
    g AS (SELECT stock_code, avg(sentiment_score) AS g, string_agg(strftime(publish_time, '%Y-%m-%dT%H:%M:%S') || ' ' || title,
        ',' ORDER BY publish_time DESC, title DESC) AS news
      FROM ({NEWEST_NEWS}) GROUP BY 1)
    SELECT w.code AS stock_code, k.bars, c.predicted_direction, c.confidence_text, c.predict_time,
      round(coalesce(g.g, 0.5), 6) AS gauge, g.news
    FROM (SELECT CAST(c_custkey AS VARCHAR) AS code FROM customer) w
    LEFT JOIN k ON k.stock_code = w.code LEFT JOIN c ON c.stock_code = w.code LEFT JOIN g ON g.stock_code = w.code""",
)
def dashboard(spark, sf_dir):
    board = D.dashboard(
        B.daily_bars(X.ticks(spark, sf_dir)),
        X.predictions(spark, sf_dir),
        X.scored_news(spark, sf_dir, NEWS_CODE.format("string")),
        X.customer_watchlist(spark, sf_dir),
    )
    bar = lambda b: F.concat_ws(" ", b["time"], F.array_join(b["candle"].cast("array<string>"), "|"), b["volume"].cast("string"))
    item = lambda n: F.concat_ws(" ", n["publish_time"], n["title"])
    text = {"bars": F.array_join(F.transform("bars", bar), ","), "news": F.array_join(F.transform("news", item), ",")}
    return X.rounded(board.withColumns(text))


@query(
    "serve_news",
    f"""WITH {S.NEWS} SELECT symbol AS stock_code, title, content, publish_time, source,
      round((length(title) % 101) / 100.0::DOUBLE, 6) AS sentiment_score FROM news""",
)
def serve_news(spark, sf_dir):
    scored = X.news(spark, sf_dir).withColumn("sentiment_score", (F.length("title") % 101) / 100.0)
    return X.rounded(D.serve_news(scored))


@query(
    "normalize_daily",
    """SELECT CAST(user_id AS VARCHAR) AS symbol, strftime(ts, '%Y-%m-%d') || ' 15:00:00' AS trade_time,
      value AS open, value AS high, CASE WHEN event_type = 'signup' THEN NULL ELSE value END AS low, value AS close,
      CAST(props->>'k' AS BIGINT) AS volume, 'daily' AS data_type FROM events""",
)
def normalize_daily(spark, sf_dir):
    raw = X.ticks(spark, sf_dir, "event_type").select(
        "symbol",
        F.date_format("trade_time", "yyyy-MM-dd").alias("date"),
        F.col("open").cast("string"), F.col("high").cast("string"),
        F.when(F.col("event_type") == "signup", "--").otherwise(F.col("low").cast("string")).alias("low"),
        F.col("close").cast("string"), F.col("volume").cast("string"),
    )
    return N.normalize_daily(raw)


@query(
    "snapshot_watchlist",
    f"""WITH {S.TICKS} SELECT symbol, '2024-02-01T10:00:00' AS trade_time, close AS price, volume,
      close * volume AS turnover, 'realtime' AS data_type
    FROM ticks WHERE symbol IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY arrival) = 1""",
)
def snapshot_watchlist(spark, sf_dir):
    t = X.ticks(spark, sf_dir, F.col("event_id").alias("arrival"))
    quotes = t.select(
        F.col("symbol").alias("代码"), F.col("close").alias("最新价"), F.col("volume").alias("成交量"),
        (F.col("close") * F.col("volume")).alias("成交额"), "arrival",
    )
    return N.normalize_snapshot(quotes, X.customer_watchlist(spark, sf_dir), "2024-02-01T10:00:00", order="arrival")


@query(
    "normalize_news",
    f"""WITH {S.NEWS} SELECT symbol, title, coalesce(content, '') AS content, strftime(publish_time, '%Y-%m-%d %H:%M:%S') AS publish_time,
      coalesce(source, 'eastmoney') AS source, data_type
    FROM news QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY doc_id) <= 30""",
)
def normalize_news(spark, sf_dir):
    raw = X.news(spark, sf_dir).select(
        "symbol", F.col("title").alias("新闻标题"), F.col("content").alias("新闻内容"),
        F.date_format("publish_time", "yyyy-MM-dd HH:mm:ss").alias("发布时间"), F.col("source").alias("文章来源"), "doc_id",
    )
    return N.normalize_news(raw, "doc_id", N.NEWS_PER_SYMBOL)


@query(
    "history_range",
    f"""WITH {S.TICKS} SELECT symbol, trade_time, close, volume FROM ticks
    WHERE trade_time >= TIMESTAMP '2024-01-05' AND trade_time < TIMESTAMP '2024-01-21'""",
)
def history_range(spark, sf_dir):
    return N.history(X.ticks(spark, sf_dir), "2024-01-05", "2024-01-20").select("symbol", "trade_time", "close", "volume")


@query(
    "ingest_counts",
    """SELECT CAST(user_id AS VARCHAR) AS symbol, event_type AS data_type, count(*) AS n,
      CAST(grouping(CAST(user_id AS VARCHAR), event_type) AS INTEGER) AS level
    FROM events GROUP BY ROLLUP (CAST(user_id AS VARCHAR), event_type)""",
)
def ingest_counts(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    return N.ingest_counts(e.select(F.col("user_id").cast("string").alias("symbol"), F.col("event_type").alias("data_type")))


@query(
    "incremental_indicators",
    f"SELECT * FROM ({O['sma']})" + "".join(f" JOIN ({O[name]}) USING (symbol, trade_time)" for name in ("ema", "macd", "rsi", "boll")),
)
def incremental_indicators(spark, sf_dir):
    """The history, its stored state, and the last day appended: equal to the full recompute."""
    prices = X.ticks(spark, sf_dir).select("symbol", "trade_time", "close", "volume")
    last = F.lit(prices.agg(F.max(F.to_date("trade_time"))).first()[0])
    path = work_dir(spark, "incremental")
    history, state = advance(prices.where(F.to_date("trade_time") < last))
    overwrite_table(history, f"{path}/history")
    state.save(f"{path}/state")
    day, _ = advance(prices.where(F.to_date("trade_time") >= last), State.load(spark, f"{path}/state"))
    return X.rounded(read_table(spark, f"{path}/history").unionByName(day))


@query(
    "bars_served",
    f"""WITH {S.BARS} SELECT stock_code, start_time, open_price, high_price, low_price, close_price, volume,
      strftime(start_time, '%Y-%m') AS run_id FROM bars""",
)
def bars_served(spark, sf_dir):
    """Bars added to the serving table month by month; every month is sent twice."""
    bars = B.daily_bars(X.ticks(spark, sf_dir)).drop("end_time").withColumn("month", F.date_format("start_time", "yyyy-MM"))
    path = work_dir(spark, "served")
    stored = f"{path}/bars"
    overwrite_table(bars, stored, partition_by="month")
    schema = bars.drop("month").schema
    source = spark.read.schema(bars.schema).parquet(stored)
    for month in sorted(r["month"] for r in source.select("month").distinct().collect()):
        rows = source.where(F.col("month") == month).drop("month")
        serving.add_run(rows, f"{path}/served", month)
        serving.add_run(rows, f"{path}/served", month)
    return serving.read_runs(spark, f"{path}/served", schema)


@query(
    "quarantine_counts",
    f"""WITH {S.TICKS} SELECT CASE arrival % 16 WHEN 0 THEN 'empty' WHEN 1 THEN 'empty' WHEN 2 THEN 'malformed'
      WHEN 3 THEN 'no_object' WHEN 4 THEN 'missing' WHEN 5 THEN 'mistyped' WHEN 6 THEN 'bad_time' ELSE 'usable' END AS reason,
      count(*) AS n, CAST(sum(arrival) AS BIGINT) AS arrivals FROM ticks GROUP BY 1""",
)
def quarantine_counts(spark, sf_dir):
    """Messages of which some are broken: how many there are of each kind."""
    arrival = F.col("event_id").alias("arrival")
    whole = X.ticks(spark, sf_dir, arrival).withColumn("trade_time", F.date_format("trade_time", "yyyy-MM-dd HH:mm:ss"))
    kind, fields = F.col("arrival") % 16, F.struct(*X.TICK)
    text = lambda changed: F.to_json(changed)
    value = (
        F.when(kind == 1, "  ")
        .when(kind == 2, F.expr("substring(to_json(struct(symbol, trade_time)), 1, length(to_json(struct(symbol, trade_time))) - 1)"))
        .when(kind == 3, F.to_json(F.array("close", "open")))
        .when(kind == 4, text(fields.dropFields("symbol")))
        .when(kind == 5, text(fields.withField("close", F.lit("n/a"))))
        .when(kind == 6, text(fields.withField("trade_time", F.substring("trade_time", 12, 8))))
        .when(kind > 6, text(fields))
    )
    messages = whole.select("arrival", value.alias("value"))
    path = work_dir(spark, "messages")
    quarantine(messages, path)
    sorted_out = read_sorted(spark, path, messages.schema)
    return sorted_out.groupBy("reason").agg(F.count("*").alias("n"), F.sum("arrival").alias("arrivals"))


WATCHED = ", ".join(f"('{code}', '{name}')" for code, name in STOCKS)


@query(
    "watchlist_prices",
    f"""WITH {S.TICKS}, watched(code, name) AS (VALUES {WATCHED})
    SELECT code, CASE WHEN code[1] IN ('5', '6', '9') THEN 'sh.' WHEN code[1] IN ('4', '8') THEN 'bj.' ELSE 'sz.' END || code AS baostock_code,
      name, count(symbol) AS n, arg_max(close, trade_time) AS last_close
    FROM watched LEFT JOIN ticks ON lpad(symbol, 6, '0') = code GROUP BY code, name""",
)
def watchlist_prices(spark, sf_dir):
    """Every watched stock with the number of its prices and the last of them; symbols are codes without leading zeros."""
    prices = X.ticks(spark, sf_dir).groupBy(F.lpad("symbol", 6, "0").alias("code")).agg(
        F.count("*").alias("n"), F.max_by("close", "trade_time").alias("last_close")
    )
    return watchlist(spark).join(prices, "code", "left").fillna({"n": 0})
