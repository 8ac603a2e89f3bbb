"""Operator 2: quality rules on tokeniser fertility."""

from __future__ import annotations

import math
import string
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.llm.common import Bounded, double, flag, long, per_process, text_rows
from barstream.llm.vocabularies import PieceTable

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 3

#: Per script: least and most characters per token, most byte-fallback share, least and most token entropy
#: relative to its ceiling log2(min(tokens, ENTROPY_TOKENS)).  Fixed values.  A script without an entry takes
#: "other".  Scripts that the vocabulary hardly knows fall back to bytes as a rule, so their bands are wide.
BANDS = {
    "latin": (1.6, 6.5, 0.10, 0.68, 1.0),
    "cyrillic": (1.2, 6.5, 0.20, 0.45, 1.0),
    "greek": (0.8, 6.5, 0.60, 0.40, 1.0),
    "han": (0.3, 3.0, 0.90, 0.40, 1.0),
    "kana": (0.3, 3.0, 0.90, 0.40, 1.0),
    "other": (0.2, 8.0, 1.00, 0.35, 1.0),
}
ENTROPY_TOKENS = 512

# First word of a letter's Unicode name, and its script.
SCRIPTS = {"LATIN": "latin", "CYRILLIC": "cyrillic", "GREEK": "greek", "CJK": "han", "HIRAGANA": "kana", "KATAKANA": "kana"}
ASCII_LETTERS = string.ascii_letters.encode()


def script_of(letter: str) -> str | None:
    """A letter's script by its Unicode name; None for what is no letter."""
    if not letter.isalpha():
        return None
    return SCRIPTS.get(unicodedata.name(letter, "").split(" ")[0], "other")


def repeated_words(ids: np.ndarray, width: int = REPEAT_WORDS) -> int:
    """Words (given by number) inside windows of ``width`` words that the text has twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    code, base = ids[:n], int(ids.max()) + 1
    for i in range(1, width):
        if int(code.max()) >= 2**62 // base:
            code = np.unique(code, return_inverse=True)[1]
        code = code * base + ids[i : i + n]
    order = np.sort(code)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, which, counts = np.unique(code, return_inverse=True, return_counts=True)
    inside = np.zeros(len(ids) + 1, np.int64)
    again = np.flatnonzero(counts[which] > 1)
    np.add.at(inside, again, 1)
    np.add.at(inside, again + width, -1)
    return int((np.cumsum(inside) > 0).sum())


def line_and_char_measures(text: str) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))


def token_measures(table: PieceTable, numbers: np.ndarray) -> tuple[int, int, float]:
    """Tokens, byte tokens, and the entropy of the token distribution in bits."""
    tokens = table.ids(numbers)
    if not len(tokens):
        return 0, 0, 0.0
    counts = np.bincount(tokens)
    counts = counts[counts > 0].astype(np.float64)
    entropy = math.log2(len(tokens)) - (counts * np.log2(counts)).sum() / len(tokens)
    return len(tokens), int(table.is_byte[tokens].sum()), max(0.0, float(entropy))


def main_script(text: str, data: bytes, script: Bounded) -> str:
    """The script of most letters ("none" without letters; the first in the alphabet of several)."""
    counts: Counter = Counter()
    if latin := len(data) - len(data.translate(None, ASCII_LETTERS)):
        counts["latin"] = latin
    if not text.isascii():
        distinct = set(text)
        wide = {c: text.count(c) for c in distinct if c > "\x7f"} if len(distinct) < 200 else Counter(text)
        for letter, n in wide.items():
            if letter > "\x7f" and (found := script[letter]):
                counts[found] += n
    return min(counts, key=lambda s: (-counts[s], s)) if counts else "none"


def within_bands(script: str, chars: int, tokens: int, by_bytes: int, entropy: float, bands=BANDS) -> bool:
    if script == "none" or not tokens:
        return False
    low, high, most_bytes, least, most = bands.get(script, bands["other"])
    ceiling = math.log2(max(2, min(tokens, ENTROPY_TOKENS)))
    return low <= chars / tokens <= high and by_bytes <= most_bytes * tokens and least <= entropy / ceiling and (entropy / ceiling <= most or tokens > ENTROPY_TOKENS)


def quality_rules(df: DataFrame, model: str, bands: dict = BANDS, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """doc_id with base measures, token measures and verdicts of every whole text.

    base_failed: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` of them inside repeated windows.  kept: not
    base_failed, and characters per token, byte share and relative entropy lie
    within the bands of the text's main script.

    Null and empty texts have no words: all measures 0, script "none",
    base_failed true.  Each row is judged by itself, repeated rows alike;
    columns other than doc_id and text are not read.
    """

    def per_text():
        table = per_process(("pieces", model), lambda: PieceTable(model))
        scripts = Bounded(script_of)

        def one(text):
            text = text or ""
            data = text.encode("utf-8", "surrogatepass")
            words = data.split()
            ids = table.numbers(words)
            chars, symbols, lines = line_and_char_measures(text)
            repeats = repeated_words(ids)
            tokens, by_bytes, entropy = token_measures(table, ids)
            script = main_script(text, data, scripts)
            failed = len(words) < min_words or 100 * repeats > max_repeat_percent * len(words)
            kept = not failed and within_bands(script, chars, tokens, by_bytes, entropy, bands)
            return len(words), chars, symbols, lines, repeats, failed, kept, script, tokens, by_bytes, entropy

        return one

    counts = [long(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields = [*counts, flag("base_failed"), flag("kept"), T.StructField("script", T.StringType()), long("n_tokens"), long("n_byte_tokens"), double("token_entropy")]
    out = text_rows(df, ["doc_id"], fields, per_text, kept=("pieces", model))
    return out.withColumn("chars_per_token", F.when(F.col("n_tokens") > 0, F.col("word_chars") / F.col("n_tokens")))
