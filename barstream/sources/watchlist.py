"""The stock watch-list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barstream.sources.schemas import WATCHLIST

# The default stocks as (code, name).
STOCKS = (
    ("000001", "平安银行"),
    ("600036", "招商银行"),
    ("000858", "五粮液"),
    ("601318", "中国平安"),
    ("002415", "海康威视"),
    ("000002", "万科A"),
    ("600519", "贵州茅台"),
    ("000333", "美的集团"),
    ("002594", "比亚迪"),
    ("300750", "宁德时代"),
    ("601166", "兴业银行"),
    ("600016", "民生银行"),
    ("000651", "格力电器"),
    ("002304", "洋河股份"),
    ("600030", "中信证券"),
    ("601888", "中国中免"),
    ("002352", "顺丰控股"),
    ("600309", "万华化学"),
    ("002475", "立讯精密"),
    ("600900", "长江电力"),
)


def vendor_code(code: str) -> str:
    """Code with its exchange by the first digit: 5, 6 and 9 Shanghai, 4 and 8 Beijing, others Shenzhen."""
    return f"{'sh' if code[0] in '569' else 'bj' if code[0] in '48' else 'sz'}.{code}"


def watchlist(spark: SparkSession, stocks=STOCKS) -> DataFrame:
    """(code, baostock_code, name) rows, from (code, name) or from (code, vendor code, name)."""
    rows = [s if len(s) == 3 else (s[0], vendor_code(s[0]), s[1]) for s in stocks]
    return spark.createDataFrame(rows, WATCHLIST)
