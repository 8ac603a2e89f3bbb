"""Operator 12: token counts of documents, each distinct pre-token encoded once."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import SLICE, per_process, stored, task_begins

BLANK, SIGN = " ", "▁"
#: A pre-token: blanks and what follows them up to the next blank, or one line end or tab.  The vocabulary has no
#: piece in which a blank follows another character, nor one with a line end or tab, so no piece crosses these borders.
PRE_TOKEN = re.compile(r" *[^ \n\t]+| +|[\n\t]")
#: The most frequent pre-tokens, of at most so many characters, are looked up where the texts lie; the others are joined.
HEAD, HEAD_CHARS = 150_000, 40
#: Distinct pre-tokens that a task gathers before it hands their counts on.
TASK_TOKENS = 200_000


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text as the vocabulary sees it: a blank put before it, its blank sign being a blank."""
    return PRE_TOKEN.findall(BLANK + text.replace(SIGN, BLANK)) if text else []


def check_vocabulary(pieces) -> None:
    """Raise ValueError if a piece could cross the borders of pre-tokens, or if texts are normalised."""
    every = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    if any(re.search(rf"[^{SIGN}]{SIGN}|[\n\t ]", p) for p in every):
        raise ValueError("pieces of this vocabulary cross the borders of pre-tokens")
    if pieces.decode(pieces.encode("ﬁ  ½ Ａ ")) != "ﬁ  ½ Ａ ":
        raise ValueError("this vocabulary normalises texts")


def piece_counts(pieces, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token.

    The vocabulary puts a blank before what it encodes.  So a pre-token that
    begins with a blank gives it up (one of a single blank is one piece);
    another is encoded behind a line end, whose pieces are taken off again.
    """
    opened = [t.startswith(BLANK) for t in tokens]
    each = pieces.encode([t[1:] if o else "\n" + t for t, o in zip(tokens, opened)], num_threads=1)
    before = len(pieces.encode("\n"))
    return [1 if t == BLANK else len(ids) if o else len(ids) - before for ids, t, o in zip(each, tokens, opened)]


def frequencies(df: DataFrame, text: str = "text") -> DataFrame:
    """(token, n): every distinct pre-token of all texts and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_begins()
        counts: Counter = Counter()
        for one in _texts(batches, 0):
            counts.update(pre_tokens(one or ""))
            if len(counts) >= TASK_TOKENS:
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    return df.select(text).mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[str | None]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield from batch.column(column).slice(at, SLICE).to_pylist()


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["token", "n"])


def with_pieces(tokens: DataFrame, model: str) -> DataFrame:
    """(token, n, pieces): every distinct pre-token encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        task_begins(("counting", model))
        pieces = per_process(("counting", model), lambda: sentencepiece.SentencePieceProcessor(model_file=model))
        for batch in batches:
            for part in (batch.slice(at, SLICE) for at in range(0, batch.num_rows, SLICE)):
                found = piece_counts(pieces, part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.int64())], ["token", "n", "pieces"])

    return tokens.select("token", "n").mapInArrow(run, "token string, n bigint, pieces bigint")


def _frequent(table: DataFrame, head: int) -> dict[str, int]:
    rows = table.where(F.length("token") <= HEAD_CHARS).orderBy(F.desc("n"), "token").limit(head).select("token", "pieces")
    found = rows.toArrow()
    return dict(zip(found.column("token").to_pylist(), found.column("pieces").to_pylist()))


def document_tokens(df: DataFrame, known: dict[str, int], key: str, text: str) -> DataFrame:
    """(ident, key, n_bytes, n_known, rest): per document the pieces of its known pre-tokens and the others' counts."""
    table = df.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_begins()
        pieces, row = table.value, TaskContext.get().partitionId() << 33
        rest_kind = pa.list_(pa.struct([("token", pa.string()), ("n", pa.int64())]))
        for batch in batches:
            for part in (batch.slice(at, SLICE) for at in range(0, batch.num_rows, SLICE)):
                n_known, rest = [], []
                for one in part.column(2).to_pylist():
                    found, other = 0, []
                    for token, n in Counter(pre_tokens(one or "")).items():
                        count = pieces.get(token)
                        if count is None:
                            other.append((token, n))
                        else:
                            found += n * count
                    n_known.append(found)
                    rest.append([{"token": t, "n": n} for t, n in other])
                ident = pa.array(range(row, row + part.num_rows), pa.int64())
                row += part.num_rows
                columns = [ident, part.column(0), part.column(1), pa.array(n_known, pa.int64()), pa.array(rest, rest_kind)]
                yield pa.RecordBatch.from_arrays(columns, ["ident", "key", "n_bytes", "n_known", "rest"])

    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    kind = df.schema[key].dataType.simpleString()
    schema = f"ident bigint, key {kind}, n_bytes bigint, n_known bigint, rest array<struct<token:string,n:bigint>>"
    return df.select(F.col(key).alias("key"), n_bytes, text).mapInArrow(run, schema)


def count_tokens(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = 4096, head: int = HEAD) -> DataFrame:
    """key, n_bytes, n_tokens and over_limit (more than ``limit``) of every whole text, under a sentencepiece vocabulary.

    Texts are cut into pre-tokens that no piece crosses.  Each distinct one is
    encoded once, whatever its frequency; a document's count is the sum over
    its distinct pre-tokens of frequency times pieces.  The ``head`` most
    frequent pre-tokens are broadcast (their number and length are bounded),
    the rest are joined by a shuffle: none of them is frequent, so none is a
    hot key.  Ids are never written.

    Null and empty texts have 0 bytes and 0 tokens.  Repeated rows, and rows
    of one or no key, each come back.  Other columns are not read.  An empty
    table gives no rows.
    """
    import sentencepiece

    check_vocabulary(sentencepiece.SentencePieceProcessor(model_file=model))
    table = stored(with_pieces(stored(frequencies(df, text), "pre-tokens"), model), "pieces")
    docs = stored(document_tokens(df, _frequent(table, head), key, text), "documents")
    open_docs = F.size("rest") > 0
    each = docs.where(open_docs).select("ident", F.explode("rest").alias("r")).select("ident", "r.token", "r.n")
    sums = each.join(table.select("token", "pieces"), "token").groupBy("ident").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    slim = ["ident", "key", "n_bytes", "n_known"]
    whole = docs.where(open_docs).select(slim).join(sums, "ident").unionByName(docs.where(~open_docs).select(*slim, F.lit(0).cast("long").alias("more")))
    n_tokens = F.col("n_known") + F.col("more")
    return whole.select(F.col("key").alias(key), "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
