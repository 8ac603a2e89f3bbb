"""Operator 8: benchmark decontamination by one Aho-Corasick automaton over word sequences."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.llm.common import long, per_process, stored, string, text_rows

WINDOW = 10
#: Words of the test items in one automaton; more items are scanned for in further passes.
BLOCK_WORDS = 400_000

# Every ASCII byte that is no letter or digit becomes a space, A-Z become a-z; bytes of other characters stay.
_NORMAL = bytes(b if b > 127 or chr(b).isdigit() or "a" <= chr(b) <= "z" else b + 32 if "A" <= chr(b) <= "Z" else 32 for b in range(256))


def normalised(text: str | None) -> bytes:
    """A-Z in lower case, other ASCII than letters and digits blanked; words are what blanks leave."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL)


class Matcher:
    """An automaton over the windows of test items, each written as its words between single blanks."""

    def __init__(self, items: Iterable[tuple[str | None, str]], window: int):
        import ahocorasick

        owners: dict[str, set[str]] = {}
        for item, text in items:
            words = normalised(text).split()
            n = min(window, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                owners.setdefault(spaced(words[i : i + n]), set()).update(() if item is None else (item,))
        self.automaton = ahocorasick.Automaton()
        for key, found in owners.items():
            self.automaton.add_word(key, (key.count(" ") - 1, tuple(found)))
        self.any = bool(owners)
        if self.any:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items whose windows occur."""
        hit, items = np.zeros(len(words) + 1, np.int64), set()
        text = spaced(words)
        found = list(self.automaton.iter(text)) if self.any and words else []
        if found:
            blanks = np.flatnonzero(np.array([c == " " for c in text]))  # the n-th follows n words
            for end, (n, owners) in found:
                last = int(np.searchsorted(blanks, end))
                hit[last - n] += 1
                hit[last] -= 1
                items.update(owners)
        return np.cumsum(hit[:-1]) > 0, items


def spaced(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass")


def word_offsets(text: str, words: list[bytes]) -> list[tuple[int, int]]:
    """Where each normalised word stands in the original text: code points, end exclusive."""
    data, out, at, seen, chars = normalised(text), [], 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    for word in words:
        begin = data.index(word, at)
        chars += len(raw[seen:begin].decode("utf-8", "surrogatepass"))
        end = begin + len(word)
        width = len(raw[begin:end].decode("utf-8", "surrogatepass"))
        out.append((chars, chars + width))
        chars, seen, at = chars + width, end, end
    return out


def find_items(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The kept columns (default doc_id) with n_words, n_hit, items and spans of every document.

    A window is ``window`` consecutive words of an item, or the whole of a
    shorter one that has words.  ``n_hit`` counts the document's words inside
    any occurrence, ``items`` has the ids (as text, sorted, distinct) of the
    items with an occurring window, ``spans`` the hit stretches of the original
    text as start, end, start, end, ... in code points.

    Test items travel to the executors in blocks of at most ``block_words``
    words (counted first), each as one broadcast; every further block is a
    further pass over the documents, written in between.

    Null and empty texts, and items without words, have and match nothing.  The
    windows of a null item_id hit words (n_hit, spans), but name no item.
    Repeated documents come back as they are, repeated
    items count once; an item_id with several texts has the windows of all.
    Columns of the same names in ``benchmark`` do no harm.
    """
    spark = df.sparkSession
    keep = ["doc_id"] if keep is None else keep
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    sized = text_rows(items, ["item"], [long("n"), string("body")], lambda: lambda t: (len(normalised(t).split()), t))
    total = sized.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    if blocks > 1:  # the heaviest block stays under twice the mean, for items far below the bound
        sized = stored(sized, "items")
    part = F.pmod(F.xxhash64("item", "body"), F.lit(blocks))
    out = None
    for block in range(blocks):
        rows = sized.where((part == block) & (F.col("n") > 0)).select("item", "body").distinct().collect()
        found = spark.sparkContext.broadcast([tuple(r) for r in rows])
        carried = keep if block == blocks - 1 or "text" in keep else [*keep, "text"]
        out = _scan(df if out is None else out, found, window, carried, first=out is None)
        if block < blocks - 1:
            out = stored(out, "scanned")
    return out.select(*keep, "n_words", F.size("hit_words").cast("long").alias("n_hit"), "items", "spans")


def _scan(df: DataFrame, found: Broadcast, window: int, keep: list[str], first: bool) -> DataFrame:
    """One pass: adds this block's hits to those of earlier ones (hit_words: numbers of hit words)."""
    name = uuid.uuid4().hex

    def per_text():
        matcher = per_process(("matcher", name), lambda: Matcher(found.value, window))

        def one(row):
            text, hits, items = (row, [], []) if first else (row["text"], row["hit_words"], row["items"])
            words = normalised(text).split()
            hit, new = matcher.scan(words)
            hit[np.array(hits, np.int64)] = True
            at = np.flatnonzero(hit)
            spans = []
            if len(at):
                offsets = word_offsets(text, words[: at[-1] + 1])
                for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                    spans += [offsets[run[0]][0], offsets[run[-1]][1]]
            return len(words), at.tolist(), sorted(new.union(items)), spans

        return one

    longs = T.ArrayType(T.LongType())
    fields = [long("n_words"), T.StructField("hit_words", longs), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", longs)]
    if first:
        return text_rows(df, keep, fields, per_text, kept=("matcher", name))
    return text_rows(df.withColumn("packed", F.struct("text", "hit_words", "items")), keep, fields, per_text, text="packed", kept=("matcher", name))
