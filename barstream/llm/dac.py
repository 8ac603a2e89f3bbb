"""Operator 5: token ids in files of directly addressable codes."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barstream.llm.common import SLICE, per_process, task_begins
from barstream.llm.vocabularies import PIECES, WORDS, WordBpeTable

MAGIC = b"DAC1"
CHUNK_BITS = 8
#: Bits of a bitmap that share an entry of its rank directory.
RANK_BITS = 512
#: A segment is closed by the document that brings it to this many ids.
SEGMENT_IDS = 1 << 20


def encode(ids: np.ndarray) -> bytes:
    """Ids below 2**32 as chunk levels.

    Layout (little-endian): magic, u32 levels, u64 ids; then for each level u64
    chunks, the chunks of 8 bits, and but for the last level a bitmap (bit set:
    the id goes on in the next level) and its rank directory (u32 set bits
    before every 512th bit).
    """
    rest, parts = np.asarray(ids, np.uint64), []
    n_levels = max(1, -(-int(rest.max(initial=0)).bit_length() // CHUNK_BITS))
    for level in range(n_levels):
        parts += [struct.pack("<Q", len(rest)), (rest & np.uint64(255)).astype(np.uint8).tobytes()]
        rest = rest >> np.uint64(CHUNK_BITS)
        if level < n_levels - 1:
            goes_on = rest > 0
            bits = np.packbits(goes_on, bitorder="little")
            per = np.add.reduceat(goes_on, np.arange(0, len(goes_on), RANK_BITS)) if len(goes_on) else np.empty(0, np.int64)
            parts += [bits.tobytes(), (np.cumsum(per) - per).astype("<u4").tobytes()]
            rest = rest[goes_on]
    return MAGIC + struct.pack("<IQ", n_levels, len(ids)) + b"".join(parts)


class Codes:
    """Reads encoded ids: any one without decoding others, or all."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("these bytes are no directly addressable codes")
        n_levels, self.n = struct.unpack_from("<IQ", data, 4)
        at, self.levels = 16, []
        for level in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n
            bits = ranks = None
            if level < n_levels - 1:
                bits = np.frombuffer(data, np.uint8, -(-n // 8), at)
                at += len(bits)
                ranks = np.frombuffer(data, "<u4", -(-n // RANK_BITS), at)
                at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """One id: a chunk, a bit and a rank for each of its levels."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // RANK_BITS
            inside = np.unpackbits(bits[block * RANK_BITS // 8 : (i >> 3) + 1], bitorder="little")[: i - block * RANK_BITS]
            i = int(ranks[block]) + int(inside.sum())
            shift += CHUNK_BITS
        return value

    def all(self) -> np.ndarray:
        out: np.ndarray | None = None
        for chunks, bits, _ in reversed(self.levels):
            level = chunks.astype(np.uint32)
            if out is not None:
                level[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)] |= out << np.uint32(CHUNK_BITS)
            out = level
        return out


def write_tokens(
    df: DataFrame, folder: str, tokenizer: str, end_id: int, shards: int | None = None, segment_ids: int = SEGMENT_IDS,
    remembered: tuple[int, int] = (WORDS, PIECES),
) -> None:
    """Encode whole texts in ascending doc_id order and write them below ``folder``.

    ``tokenizer`` is a tokenizers file that drops white space; ``end_id``
    closes every document.  ``segments`` has one row per segment: shard,
    segment, base (ids before it in its shard), n_ids, doc_ids, ends (of its
    documents, counted from its start) and codes.  Whole documents stay in one
    segment.  Shards are ranges of doc_id, so their order is that of documents.

    ``remembered`` bounds the words and the pieces of words whose ids a worker
    keeps (each twice, see Recent): fewer take less memory and more time.

    Null and empty texts have the end id alone.  Null doc_ids come first;
    repeated doc_ids are ordered by a hash of their texts, so equal rows may
    stand in any order.  Other columns are not read.
    """
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_begins(("word bpe", tokenizer))
        table = per_process(("word bpe", tokenizer), lambda: WordBpeTable(tokenizer, *remembered))
        shard, segment, base = TaskContext.get().partitionId(), 0, 0
        doc_ids, ids, ends = [], [], []
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = np.append(table.of_text(text), np.int32(end_id))
                doc_ids.append(doc_id)
                ids.append(own)
                ends.append(len(own) + (ends[-1] if ends else 0))
                if ends[-1] >= segment_ids:
                    yield _segment(shard, segment, base, doc_ids, ids, ends)
                    segment, base = segment + 1, base + ends[-1]
                    doc_ids, ids, ends = [], [], []
        if doc_ids:
            yield _segment(shard, segment, base, doc_ids, ids, ends)

    schema = "shard int, segment int, base bigint, n_ids bigint, doc_ids array<bigint>, ends array<bigint>, codes binary"
    ordered.select("doc_id", "text").mapInArrow(run, schema).write.parquet(f"{folder}/segments")


def _segment(shard, segment, base, doc_ids, ids, ends) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    columns = {
        "shard": pa.array([shard], pa.int32()), "segment": pa.array([segment], pa.int32()), "base": pa.array([base], pa.int64()),
        "n_ids": pa.array([ends[-1]], pa.int64()), "doc_ids": pa.array([doc_ids], longs), "ends": pa.array([ends], longs),
        "codes": pa.array([encode(np.concatenate(ids))], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """The written segments with ``start``: ids of all documents before them.  One row per shard is summed up."""
    rows = spark.read.parquet(f"{folder}/segments")
    per = rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    return rows.join(F.broadcast(per), "shard").withColumn("start", F.col("shard_start") + F.col("base"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian u32) of every written document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_begins()
        for batch in batches:
            for start, doc_ids, ends, codes in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "ends", "codes"))):
                ids = Codes(codes).all().astype("<u4")
                begins = [0, *ends[:-1]]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "start": pa.array([start + a for a in begins], pa.int64()),
                    "n_tokens": pa.array([b - a for a, b in zip(begins, ends)], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends)], pa.int64()),
                })

    rows = segments(spark, folder).select("start", "doc_ids", "ends", "codes")
    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """(position, id) for each ``position`` in the whole sequence; positions outside of it are left out.

    Each lookup touches one chunk, bit and rank a level.  A position meets the
    segments of its own shard only, whose starts are ordered.
    """
    rows = segments(spark, folder)
    per = rows.groupBy("shard").agg(F.min("start").alias("first"), F.max(F.col("start") + F.col("n_ids")).alias("last"))
    placed = positions.select("position").join(F.broadcast(per), (F.col("position") >= F.col("first")) & (F.col("position") < F.col("last")))
    met = placed.join(rows.select("shard", "start", "n_ids", "codes"), "shard")
    met = met.where((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, starts, codes = (batch.column(c).to_pylist() for c in ("position", "start", "codes"))
            found = [Codes(code)[i - start] for i, start, code in zip(at, starts, codes)]
            yield pa.RecordBatch.from_pydict({"position": pa.array(at, pa.int64()), "id": pa.array(found, pa.int64())})

    return met.select("position", "start", "codes").mapInArrow(run, "position bigint, id bigint")
