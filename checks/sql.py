"""SQL fragments: the inputs of ``checks/fixtures.py`` as common table expressions."""

TICKS = """ticks AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, ts AS trade_time, value AS open, value AS high, value AS low,
         value AS close, CAST(props->>'k' AS BIGINT) AS volume, 'daily' AS data_type, event_id AS arrival, event_type
  FROM events)"""

BASE = TICKS + """, base AS (
  SELECT symbol, trade_time, open, high, CASE WHEN event_type <> 'signup' THEN low END AS low,
         CASE WHEN event_type = 'error' THEN -close ELSE close END AS close,
         CASE WHEN arrival % 97 <> 0 THEN volume END AS volume, data_type, arrival, event_type
  FROM ticks)"""

DIRTY = BASE + """, dirty AS (
  SELECT * FROM base
  UNION ALL SELECT * REPLACE (arrival + 1000000000 AS arrival) FROM base WHERE event_type = 'click'
  UNION ALL SELECT * REPLACE (-close AS close, arrival + 2000000000 AS arrival) FROM base
            WHERE event_type = 'error' AND arrival % 8 = 0)"""

UNIQUE = BASE + """, uniq AS (
  SELECT * FROM (SELECT * REPLACE (date_trunc('second', trade_time) AS trade_time) FROM base)
  QUALIFY row_number() OVER (PARTITION BY symbol, trade_time ORDER BY arrival) = 1)"""

CLEAN = """SELECT symbol, trade_time, coalesce(open, 0.0) AS open, coalesce(high, 0.0) AS high,
       coalesce(low, 0.0) AS low, close, volume, data_type"""

NEWS = """news AS (
  SELECT source AS symbol, text AS title, CASE WHEN lang <> 'de' THEN text END AS content,
         TIMESTAMP '2024-01-01' + doc_id * INTERVAL 1 MINUTE AS publish_time,
         CASE WHEN lang <> 'fr' THEN lang END AS source, 'news' AS data_type, doc_id
  FROM documents)"""


def scored_news(symbol: str = "source") -> str:
    return f"""scored AS (
  SELECT {symbol} AS stock_code, text AS title, TIMESTAMP '2024-01-01' + doc_id * INTERVAL 1 MINUTE AS publish_time,
         (n_chars % 101) / 100.0::DOUBLE AS sentiment_score
  FROM documents)"""


PREDICTIONS = TICKS + """, predictions AS (
  SELECT symbol AS stock_code, trade_time AS predict_time,
         CASE WHEN volume % 2 = 0 THEN 'UP' ELSE 'DOWN' END AS predicted_direction, close / 500.0::DOUBLE AS confidence
  FROM ticks)"""

BARS = TICKS + """, bars AS (
  SELECT symbol AS stock_code, CAST(CAST(trade_time AS DATE) AS TIMESTAMP) AS start_time,
         CAST(CAST(trade_time AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS end_time,
         arg_min(open, trade_time) AS open_price, max(high) AS high_price, min(low) AS low_price,
         arg_max(close, trade_time) AS close_price, CAST(sum(volume) AS BIGINT) AS volume
  FROM ticks GROUP BY ALL)"""

SMA = TICKS + """, sma AS (
  SELECT symbol, trade_time, close, volume,
         avg(close) OVER (PARTITION BY symbol ORDER BY trade_time ROWS 4 PRECEDING) AS sma_5,
         avg(close) OVER (PARTITION BY symbol ORDER BY trade_time ROWS 9 PRECEDING) AS sma_10,
         avg(close) OVER (PARTITION BY symbol ORDER BY trade_time ROWS 19 PRECEDING) AS sma_20
  FROM ticks)"""

LINE_KEY = "concat_ws('|', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def digest(key: str) -> str:
    return f"CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT)"


def bucket(key: str, buckets: int) -> str:
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % {buckets})"


def tab_class(label: str = "l_returnflag = 'R'") -> str:
    return f"""tab AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
         CAST({label} AS INTEGER) AS label FROM lineitem)"""


SCORES = tab_class() + """, scores AS (
  SELECT model, label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM (
    SELECT 'discount' AS model, label, l_discount * 10 AS score FROM tab
    UNION ALL SELECT 'tax', label, l_tax * 12.5::DOUBLE FROM tab
    UNION ALL SELECT 'quantity', label, l_quantity / 50 FROM tab))"""

RANKED = """ranked AS (
  SELECT model, label, avg(pos) OVER (PARTITION BY model, score) AS mean_rank FROM (
    SELECT model, label, score, row_number() OVER (PARTITION BY model ORDER BY score) AS pos FROM scores)),
auc AS (
  SELECT model, (sum(mean_rank) FILTER (label = 1) - p * (p + 1) / 2) / (p * n) AS auc FROM (
    SELECT model, label, mean_rank,
           CAST(sum(label) OVER (PARTITION BY model) AS DOUBLE) AS p,
           CAST(sum(1 - label) OVER (PARTITION BY model) AS DOUBLE) AS n FROM ranked)
  GROUP BY model, p, n)"""

CONTACTS = """contacts AS (
  SELECT c_custkey, CASE WHEN b THEN '' ELSE c_name END AS name, '' AS "avatarUri",
         CASE WHEN b THEN '' ELSE c_mktsegment END AS position,
         CASE WHEN b OR c_custkey % 3 = 0 THEN '' ELSE '+1-' || c_custkey END AS phone,
         CASE WHEN b THEN '' WHEN c_custkey % 5 = 0 THEN '  ' ELSE c_name || '@example.com' END AS email,
         CASE WHEN b THEN '' ELSE n_name END AS company, '' AS bio,
         CAST(c_custkey % 4 AS INTEGER) AS "templateIndex"
  FROM (SELECT *, c_custkey % 50 = 0 AS b FROM customer JOIN nation ON c_nationkey = n_nationkey))"""

TOKENS = r"regexp_extract_all(lower({}), '\p{{Han}}|[^\P{{L}}\p{{Han}}]+')"

MODEL = f"""tok AS (
  SELECT unnest({TOKENS.format('text')}) AS token, quality AS y FROM documents JOIN labels USING (doc_id)),
cnt AS (SELECT token, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM tok GROUP BY token),
tot AS (SELECT sum(pos) AS p, sum(neg) AS n, count(*) AS v FROM cnt),
model AS (
  SELECT token, ln(CAST(pos + 1 AS DOUBLE) / (p + v)) - ln(CAST(neg + 1 AS DOUBLE) / (n + v)) AS llr FROM cnt, tot)"""


def scored(text: str) -> str:
    return f"""words AS (
  SELECT doc_id, unnest({TOKENS.format(text)}) AS token FROM documents
  WHERE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) >= 5),
sums AS (SELECT doc_id, sum(llr) AS s FROM words JOIN model USING (token) GROUP BY doc_id),
sentiment AS (
  SELECT doc_id, coalesce(1 / (1 + exp(-s)), 0.5) AS sentiment_score FROM documents LEFT JOIN sums USING (doc_id))"""


def r(expression: str, name: str | None = None) -> str:
    """Rounded to 6 decimals, without negative zero."""
    return f"round({expression}, 6) + 0.0 AS {name or expression}"
