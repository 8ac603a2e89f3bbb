"""Operator 7: quality classifier as a sparse ensemble of rules over text statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import double, stored, text_rows

STATISTICS = (
    "log_words", "word_length", "symbol_share", "pipe_share", "mark_share", "upper_share", "digit_share", "punctuation_share",
    "wide_share", "distinct_share", "top_word_share", "repeat_share", "dup_line_share", "words_per_line", "stopped_line_share",
)
#: At most about so many labelled rows, chosen by a hash of doc_id, are fitted on.
FIT_ROWS = 30_000
TREES, DEPTH, LASSO = 16, 3, 0.001

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MARKS = b"#*$%&<>"


def statistics(text: str | None) -> tuple[float, ...]:
    """The values of STATISTICS; shares of nothing are 0."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, chars = max(1, len(words)), max(1, sum(map(len, words)))
    part = lambda of: len(data) - len(data.translate(None, of))
    counts = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:]))
    repeats = sum(c for c in triples.values() if c > 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    stopped = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    return (
        math.log1p(len(words)), chars / n if words else 0.0, part(_MARKS) / n, part(b"|") / n, part(b"!?") / n, part(_UPPER) / chars,
        part(_DIGITS) / chars, part(_PUNCTUATION) / chars, sum(map(data.count, WIDE)) / chars, len(counts) / n, max(counts.values(), default=0) / n,
        repeats / n, (len(lines) - len(set(lines))) / n_lines, len(words) / n_lines, stopped / n_lines,
    )


# The first bytes of two-, three- and four-byte characters.
WIDE = tuple(bytes([b]) for b in range(0xC3, 0xF5))


def text_statistics(df: DataFrame, keep: list[str]) -> DataFrame:
    """STATISTICS of every whole text beside the kept columns; null texts count as empty ones."""
    return text_rows(df, keep, [double(c) for c in STATISTICS], lambda: statistics)


def tree_paths(text: str) -> list[tuple[tuple[int, str, float], ...]]:
    """The conditions (feature, "<=" or ">", bound) that lead to every node but the root of a printed tree."""
    found, path = [], []
    for line in text.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line):
            depth = len(m[1])
            path = [p for p in path if p[0] < depth] + [(depth, (int(m[2]), m[3], float(m[4])))]
            found.append(tuple(c for _, c in path))
    return found


def simplified(path: tuple[tuple[int, str, float], ...]) -> tuple[tuple[int, str, float], ...]:
    """One bound per feature and side."""
    bounds: dict[tuple[int, str], float] = {}
    for feature, side, bound in path:
        known = bounds.get((feature, side), bound)
        bounds[feature, side] = min(known, bound) if side == "<=" else max(known, bound)
    return tuple((f, s, b) for (f, s), b in sorted(bounds.items()))


def compiled(rule: tuple[tuple[int, str, float], ...]) -> Column:
    """A rule as a condition on the statistics' columns."""
    one = lambda c: F.col(STATISTICS[c[0]]) <= c[2] if c[1] == "<=" else F.col(STATISTICS[c[0]]) > c[2]
    return reduce(lambda a, b: a & b, map(one, rule))


class RuleEnsemble:
    """Weighted rules: (weight, rule) pairs and an intercept; a logistic score."""

    def __init__(self, intercept: float, rules: list[tuple[float, tuple]]):
        self.intercept, self.rules = intercept, rules

    def score(self) -> Column:
        logit = reduce(lambda a, b: a + b, [F.when(compiled(r), w).otherwise(0.0) for w, r in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-logit))

    def describe(self) -> list[str]:
        """The rules in words, the weightiest first."""
        words = lambda rule: " and ".join(f"{STATISTICS[f]} {s} {b:g}" for f, s, b in rule)
        return [f"{w:+.3f} if {words(r)}" for w, r in sorted(self.rules, key=lambda x: -abs(x[0]))]


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO
) -> RuleEnsemble:
    """Learn from the documents that ``labels`` (doc_id and a 0/1 label) names; null and other labels are left out.

    Trees over the statistics give candidate rules, one per node; a logistic
    regression with an L1 penalty weights them and leaves most at 0.  At most
    about ``fit_rows`` labels are used, chosen by a hash of doc_id; their number
    bounds what is broadcast.  Without any labelled document the score is 1/2,
    with one class only its smoothed share.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("double").alias("label")).distinct()
    n, bits = known.count(), 1 << 30
    if n > fit_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(bits)) < int(bits * fit_rows / n))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics").transform(text_statistics(rows, ["label"]))
    known = stored(rows, "fit")
    n, ones = known.agg(F.count("*"), F.sum("label")).first()
    share = ((ones or 0) + 0.5) / (n + 1)
    prior = math.log(share / (1 - share))
    if not n or ones in (0, n):
        return RuleEnsemble(prior, [])
    forest = RandomForestClassifier(featuresCol="statistics", labelCol="label", numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="onethird")
    paths = (p for tree in forest.fit(known).trees for p in tree_paths(tree.toDebugString))
    rules = list(dict.fromkeys(map(simplified, paths)))
    if not rules:
        return RuleEnsemble(prior, [])
    hits = F.array(*[compiled(r).cast("double") for r in rules])
    marked = stored(known.select("label", array_to_vector(hits).alias("hits")), "hits")
    lasso_fit = LogisticRegression(featuresCol="hits", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(marked)
    weights = [(float(w), r) for w, r in zip(lasso_fit.coefficients.toArray(), rules) if w]
    return RuleEnsemble(float(lasso_fit.intercept), weights)
