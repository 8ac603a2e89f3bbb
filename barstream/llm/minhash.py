"""Operator 6: near-duplicate documents by fast similarity sketching."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.llm.common import long, stored, text_rows
from barstream.llm.components import connected_components
from barstream.llm.shingles import Sketcher, shingle_set, word_hasher

# 32 bands of 4 coordinates: a pair of similarity 0.8 is missed once in 2e7, one of 0.85 once in 2e10.
BANDS, ROWS = 32, 4
#: A block of a large group holds about so many members and so many shingles.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 500_000


def sketches(df: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands): the set's size, its 128-bit digest and its band keys (null: no words)."""

    def per_text():
        hasher, sketcher = word_hasher(), Sketcher(bands, rows)

        def one(text):
            found = shingle_set(text, words, hasher)
            if not len(found):
                return 0, None, None
            return len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), sketcher.band_keys(found)

        return one

    fields = [long("n_shingles"), T.StructField("set_key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    return text_rows(df, ["doc_id"], fields, per_text)


def shingle_sets(df: DataFrame, words: int) -> DataFrame:
    """(rep, shingles): the whole set of each document."""

    def per_text():
        hasher = word_hasher()
        return lambda text: (shingle_set(text, words, hasher).view("int64"),)

    fields = [T.StructField("shingles", T.ArrayType(T.LongType()))]
    return text_rows(df, ["doc_id"], fields, per_text).withColumnRenamed("doc_id", "rep")


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of word shingles have a Jaccard
    similarity of ``percent`` or more; ``component_id`` is the least doc_id
    that links lead to, ``kept`` marks it.

    1. Equal sets are one class, stood for by its least doc_id.
    2. Each class's sketch is cut into bands; classes with an equal band share
       a bucket, and each bucket has a hub, the member whose buckets hold most
       rows.  All pairs of a bucket lie among the members of its hub.
    3. Members are compared with their hub on whole sets.
    4. Only where a hub has members outside its component are members compared
       with each other, block by block inside tasks: 1 - similarity is a metric,
       so members are cut by their distance from the hub into cells as wide as
       the largest distance of a link, and only equal and neighbouring cells
       meet.  No pair is ever written unless it is a link.

    Null and empty texts have no set: they are linked with nothing and kept.
    Rows without doc_id get no component_id and are kept.  Rows that share a
    doc_id are one document for linking: whatever one of them is linked with,
    all are; each comes back.  Other columns are not read.
    """
    rows = stored(sketches(df, words), "sketches")
    known = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    least = F.min(F.struct("doc_id", "n_shingles", "bands")).alias("m")
    classes = stored(known.groupBy("set_key").agg(least).select("set_key", F.col("m.doc_id").alias("rep"), "m.bands"), "classes")

    posted = classes.select("rep", F.explode("bands").alias("band"))
    shared = stored(posted.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    members = stored(posted.join(shared, "band"), "members")
    weight = stored(members.groupBy("rep").agg(F.sum("n").alias("weight")), "weight")
    ids = weight.select(F.col("rep").alias("doc_id"))
    sets = stored(shingle_sets(df.select("doc_id", "text").join(ids, "doc_id", "left_semi"), words), "sets")
    ranked = members.join(weight, "rep").groupBy("band").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("hub"))
    hubs = stored(ranked, "hubs")
    spokes = stored(_similarity(members.join(hubs, "band").where("rep <> hub").select("hub", "rep").distinct(), sets), "spokes")

    union = F.col("n_rep") + F.col("n_hub") - F.col("inter")
    links = spokes.where(100 * F.col("inter") >= percent * union).select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    links = stored(links.union(_same_document(known, classes)), "links")
    joined = stored(connected_components(links), "joined")
    more = stored(_links_within(spokes, joined, sets, percent), "links")
    joined = stored(connected_components(links.union(more)), "joined")

    found = joined.select(F.col("node").alias("rep"), "component")
    label = classes.select(F.col("set_key").alias("class_key"), "rep").join(found, "rep", "left")
    label = stored(label.select("class_key", F.coalesce("component", "rep").alias("component_id")), "label")
    back = rows.select("doc_id", "n_shingles", "set_key").join(label, F.col("set_key") == F.col("class_key"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return back.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", kept)


def _same_document(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of different texts that share a doc_id: each to the one of the least rep."""
    texts = known.select("doc_id", "set_key").distinct()
    several = texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    met = stored(texts.join(several, "doc_id", "left_semi").join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep"), "shared-ids")
    least = met.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return met.join(least, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b"))


def _similarity(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(hub, rep, inter, n_rep, n_hub): sizes of whole sets and of what they share."""
    left = sets.select(F.col("rep").alias("hub"), F.col("shingles").alias("of_hub"))
    both = pairs.join(left, "hub").join(sets, "rep")
    sizes = F.size("shingles").alias("n_rep"), F.size("of_hub").alias("n_hub")
    return both.select("hub", "rep", F.size(F.array_intersect("shingles", "of_hub")).alias("inter"), *sizes)


def _links_within(spokes: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one hub that hub links have not joined yet."""
    node = joined.select(F.col("node").alias("rep"), F.col("component").alias("found"))
    of_hub = joined.select(F.col("node").alias("hub"), F.col("component").alias("hub_found"))
    placed = spokes.join(node, "rep", "left").join(of_hub, "hub", "left")
    component, home = F.coalesce("found", "rep"), F.coalesce("hub_found", "hub")
    union = F.col("n_rep") + F.col("n_hub") - F.col("inter")
    # the cell of a distance, in steps of 1 - percent / 100, on whole numbers; one row's distance may be the edge itself
    cell = F.floor((100 * (union - F.col("inter")) - 1) / (F.lit(max(100 - percent, 1)) * union))
    placed = stored(placed.select("hub", "rep", "n_rep", component.alias("component"), (component == home).alias("home"), F.greatest(cell, F.lit(0)).alias("cell")), "placed")
    stray = stored(placed.where("NOT home").select("hub").distinct(), "stray")
    rows = stored(placed.join(stray, "hub"), "rows")

    per = rows.groupBy("hub", "cell").agg(F.count("*").alias("n"), F.sum("n_rep").alias("size"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("size") / BLOCK_SHINGLES))
    per = per.groupBy("hub").agg(F.map_from_entries(F.collect_list(F.struct("cell", blocks.alias("k")))).alias("cells"), F.sum("n").alias("n"), F.sum("size").alias("size"))
    whole = (F.col("n") <= BLOCK_ROWS) & (F.col("size") <= BLOCK_SHINGLES)
    per = stored(per.select("hub", F.when(~whole, F.col("cells")).alias("cells")), "cells")

    at = rows.join(per, "hub")
    count = lambda c: F.coalesce(F.try_element_at("cells", c), F.lit(0))
    each = lambda n, make: F.transform(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>")), make)
    key = lambda c, i, d, j: F.struct(c.alias("c"), i.alias("i"), d.alias("d"), j.alias("j"))
    c, i = F.col("cell"), F.pmod(F.xxhash64("rep"), F.greatest(count(F.col("cell")), F.lit(1)))
    with_own = each(count(c), lambda j: key(c, F.least(i, j), c, F.greatest(i, j)))
    with_next = each(count(c + 1), lambda j: key(c, i, c + 1, j))
    with_last = each(count(c - 1), lambda j: key(c - 1, j, c, i))
    zero = F.lit(0).cast("long")
    keys = F.when(F.col("cells").isNull(), F.array(key(zero, zero, zero, zero))).otherwise(F.concat(with_own, with_next, with_last))
    dealt = at.select("hub", "rep", "component", F.explode(keys).alias("key"))
    full = dealt.join(sets, "rep").select("hub", "key", "rep", "component", "shingles")
    ordered = full.repartition("hub", "key").sortWithinPartitions("hub", "key")
    return ordered.mapInArrow(lambda batches: _compare_runs(batches, percent), "a long, b long").distinct()


def _compare_runs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Compare the rows of each run of one (hub, key), which blocks bound in size."""
    run, now = [], None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("hub", "key", "rep", "component")]
        lists = batch.column("shingles")
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        found = []
        for at, (hub, key, rep, component) in enumerate(zip(*columns)):
            if (hub, key) != now:
                found += _links_of(run, percent)
                run, now = [], (hub, key)
            run.append((rep, component, values[ends[at] : ends[at + 1]]))
        yield _edges(found)
    yield _edges(_links_of(run, percent))


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array([x[n] for x in found], pa.int64()) for n, k in enumerate("ab")})


def _links_of(run: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links that join rows of different components: a spanning forest of them."""
    if len({component for _, component, _ in run}) < 2:
        return []
    sizes = np.array([len(x) for _, _, x in run])
    inter = shared_counts([x for _, _, x in run])
    near = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
    root = {component: component for _, component, _ in run}

    def top(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        x, y = top(run[i][1]), top(run[j][1])
        if x != y:
            root[x] = y
            out.append((run[i][0], run[j][0]))
    return out


def shared_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements each two of the sets share: products of 0/1 blocks, ``width`` elements at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    counts = np.diff(np.r_[starts, len(values)])
    column = np.repeat(np.arange(len(starts)), counts)
    often = np.repeat(counts > 1, counts)  # what one set alone has is shared by none
    owner, column = owner[often], np.unique(column[often], return_inverse=True)[1]
    total = np.zeros((len(sets), len(sets)), np.int64)
    n = column.max() + 1 if len(column) else 0
    for begin in range(0, n, width):
        inside = slice(*np.searchsorted(column, [begin, begin + width]))
        block = np.zeros((len(sets), min(width, n - begin)), np.float32)
        block[owner[inside], column[inside] - begin] = 1
        total += (block @ block.T).astype(np.int64)
    return total
