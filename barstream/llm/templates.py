"""Operator 1: line dedup by a log-template tree, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import SPACE, stored

#: Leading tokens that, with the token count, make a leaf of the tree.
DEPTH = 4
#: Lines of fewer tokens are left alone.
MIN_TOKENS = 3
#: A template is dropped if so many documents have it, and a token is part of it if so many have it there.
MIN_DOCS = 10
#: Of a template's tokens, at least this share is fixed; the leading ones, which say little, are among them.
MIN_FIXED = 0.5
#: Of a line's later tokens that are no fields from the start, at least this share is fixed.
MIN_LATER = 0.6
FIELD = "<*>"
#: Keys are broadcast up to this count (8 bytes each) and joined by shuffle beyond it.
BROADCAST_KEYS = 500_000


def plain_lines(text: Column) -> Column:
    """Lines with single blanks between tokens and a field sign for tokens with a digit."""
    masked = F.when(text.rlike("[0-9]"), F.regexp_replace(text, rf"(?<![^{SPACE}])[^{SPACE}0-9]*+[0-9][^{SPACE}]*+", FIELD)).otherwise(text)
    blanks = r"[ \t\x0B\x0C\r]"
    single = F.when(masked.rlike(rf"[\t\x0B\x0C\r]|  "), F.regexp_replace(masked, rf"{blanks}++", " ")).otherwise(masked)
    return F.split(single, "\n")


def _matching(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key (8 bytes) is among stored keys."""
    small = keys.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if small else keys, on)


def recurring_lines(df: DataFrame, **parameters) -> DataFrame:
    """(doc_id, text_hash, line_no, template) of every line that has a recurring template."""
    lines, keys = _grown(df, **parameters)
    return lines.join(keys, "line_key").drop("line_key")


def _generalised(rows: DataFrame, depth: int, min_fixed: float, min_later: float) -> DataFrame:
    """line_key, rung, template and its key, for rows of a line, its later tokens and the rung from which these are fixed.

    Only templates that are mostly fixed: as a whole, and in their later tokens.
    """
    lead = F.slice(F.split("line", " "), 1, depth)
    stays = lambda p: p["rung"] >= F.col("rung")
    tail = F.transform("later", lambda p: F.when(stays(p), p["token"]).otherwise(FIELD))
    kept = F.size(F.filter("later", stays))
    words = F.size(F.filter("later", lambda p: p["token"] != FIELD))
    fixed = F.size(F.filter(lead, lambda t: t != FIELD)) + kept
    good = (fixed >= min_fixed * (F.size(lead) + F.size("later"))) & (kept >= min_later * words)
    template = F.array_join(F.concat(lead, tail), " ").alias("template")
    return rows.where(good).select("line_key", "rung", template).withColumn("template_key", F.xxhash64("template"))


def _recurring(pairs: DataFrame, named: DataFrame, min_docs: int) -> DataFrame:
    """(template_key) of the templates that enough documents have."""
    of_docs = pairs.select("line_key", "doc_id", "text_hash").join(named.select("line_key", "template_key"), "line_key")
    docs = of_docs.select("template_key", "doc_id", "text_hash").distinct().groupBy("template_key").count()
    return docs.where(F.col("count") >= min_docs).select("template_key")


def _grown(
    df: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS, min_fixed: float = MIN_FIXED, min_later: float = MIN_LATER
) -> tuple[DataFrame, DataFrame]:
    """Lines (doc_id, text_hash, line_no, line_key), and (line_key, template) of those with a recurring template.

    The tree: lines go to leaves by token count and their first ``depth``
    tokens, tokens with a digit being fields.  In a leaf, the token at a later
    place stays if ``min_docs`` (document, line) pairs have it there, else the
    place becomes a field.  A template recurs if ``min_docs`` documents have it
    and it is mostly fixed: ``min_fixed`` of all its tokens, and ``min_later`` of
    those later tokens that have no digit.  So lines that share an opening only
    are no template, however many there are.

    In a large leaf the values of a field pass ``min_docs`` too.  So a line
    whose template does not recur is tried again with that count doubled, again
    and again, until all its later places are fields; such a template recurs by
    the documents of these lines alone, and a line takes the least count at
    which its template does.

    Only leaves met by several documents go past the first pass, each distinct
    line of theirs once, so that neither a frequent line nor a frequent leaf is
    gathered anywhere.
    """
    lines = df.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(plain_lines(F.col("text"))).alias("line_no", "raw"))
    lines = lines.withColumn("line", F.trim("raw")).withColumn("tokens", F.split("line", " "))
    lines = lines.where(F.size("tokens") >= min_tokens)
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)).alias("leaf")
    lines = stored(lines.select("doc_id", "text_hash", "line_no", "line", leaf, F.xxhash64("line").alias("line_key")), "lines")

    document = F.struct("doc_id", "text_hash")
    met = lines.groupBy("leaf").agg(F.count("*").alias("n"), F.min(document).alias("a"), F.max(document).alias("b"))
    leaves = stored(met.where((F.col("n") >= min_docs) & ~F.col("a").eqNullSafe(F.col("b"))).select("leaf"), "leaves")
    pairs = _matching(lines, leaves, "leaf").groupBy("line_key", "leaf", "doc_id", "text_hash").agg(F.first("line").alias("line"))
    pairs = stored(pairs, "pairs")
    distinct = stored(pairs.groupBy("line_key", "leaf").agg(F.min("line").alias("line"), F.count("*").alias("n")), "distinct")

    later = distinct.select("line_key", "leaf", "n", F.posexplode(F.split("line", " ")).alias("place", "token")).where(F.col("place") >= depth)
    support = later.where(F.col("token") != FIELD).groupBy("leaf", "place", "token").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
    rung = F.length(F.bin(F.floor(F.col("n") / min_docs).cast("long"))).alias("rung")
    fixed = stored(support.select("leaf", "place", "token", rung), "fixed")
    placed = F.struct("place", "token", F.coalesce("rung", F.lit(0)).alias("rung"))
    places = later.drop("n").join(fixed, ["leaf", "place", "token"], "left").groupBy("line_key", "leaf").agg(F.sort_array(F.collect_list(placed)).alias("later"))
    lines_of = distinct.select("line_key", "leaf", "line").join(stored(places, "places"), ["line_key", "leaf"], "left")
    nothing = F.array().cast("array<struct<place:int,token:string,rung:int>>")
    lines_of = stored(lines_of.select("line_key", "line", F.coalesce("later", nothing).alias("later")), "lines-of")

    named = stored(_generalised(lines_of.withColumn("rung", F.lit(1)), depth, min_fixed, min_later), "named")
    often = stored(_recurring(pairs, named, min_docs), "often")
    fine = stored(named.join(often, "template_key").select("line_key", "template"), "fine")

    # a line's template changes where a fixed token of it becomes a field
    left = lines_of.join(fine.select("line_key"), "line_key", "left_anti")
    rungs = F.array_distinct(F.transform("later", lambda p: p["rung"]))
    steps = F.filter(F.array_append(rungs, F.array_max(rungs) + 1), lambda r: r > 0)
    steps = left.where(F.size("later") > 0).withColumn("rung", F.explode(steps))
    coarse = stored(_generalised(steps, depth, min_fixed, min_later), "coarse")
    again = stored(_recurring(pairs, coarse, min_docs), "again")
    coarse = coarse.join(again, "template_key").groupBy("line_key").agg(F.min_by("template", "rung").alias("template"))
    keys = stored(fine.unionByName(coarse), "keys")
    return lines.select("doc_id", "text_hash", "line_no", "line_key"), keys


def drop_recurring(df: DataFrame, **parameters) -> DataFrame:
    """doc_id, text, n_lines and n_dropped: every document without its lines of recurring templates.

    Null texts stay null with 0 lines; an empty text has one line, which stays,
    as do blank lines and lines of fewer than ``min_tokens`` tokens.  Copies of
    a text under different doc_ids are different documents; rows that agree in
    doc_id and text are one document, and each comes back.  Null doc_ids are
    allowed.  Other columns are not read.
    """
    lines, keys = _grown(df, **parameters)
    found = _matching(lines, keys.select("line_key"), "line_key")
    of_doc = stored(found.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("dropped")), "dropped")
    rows = df.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    of_doc = of_doc.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "dropped")
    both = rows.join(of_doc, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_dropped = F.coalesce(F.size("dropped"), F.lit(0)).cast("long")
    return both.select("doc_id", text.alias("text"), n_lines.alias("n_lines"), F.greatest(n_dropped, F.lit(0)).alias("n_dropped"))
