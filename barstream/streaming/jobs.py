"""Price and news streams to their stored tables."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from barstream.operators.clean import clean_prices, parse_news, parse_prices
from barstream.operators.text import sentiment_scorer
from barstream.streaming.io import append_batches, bounded_state


def store_prices(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    dedup_window: str | None = None,
    accept_snapshots: bool = False,
    ntz: bool = False,
) -> StreamingQuery:
    """Parse, clean and append price messages.

    With a ``dedup_window`` keys are forgotten that long past the newest time,
    so the state stays as large as the window's keys, and lies in RocksDB.
    """
    clean = clean_prices(parse_prices(messages, accept_snapshots, ntz=ntz), dedup_window=dedup_window)
    with bounded_state(messages.sparkSession) if dedup_window else nullcontext():
        return append_batches(clean, path, checkpoint, interval)


def store_news(
    messages: DataFrame,
    model: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    max_chars: int | None = None,
    ntz: bool = False,
) -> StreamingQuery:
    """Parse, score and append news messages.

    ``model`` is a stored token table; its scorer is made once, before the
    stream starts.  Titles are read whole; the title job passes TITLE_CHARS.
    """
    scored = sentiment_scorer(model, max_chars=max_chars)
    return append_batches(parse_news(messages, ntz=ntz), path, checkpoint, interval, transform=scored)
