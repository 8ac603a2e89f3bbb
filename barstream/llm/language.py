"""Operator 3: language identification, words first, shorter character n-grams for unseen words."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import double, per_process, stored, string, text_rows

# A letter, then letters and the marks that belong to them; numerals such as "½" or "Ⅷ" are no letters.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
ORDERS = (5, 4, 3, 2, 1)
#: Most words, and most n-grams of each order, that a model keeps of each language: it bounds what is broadcast.
VOCABULARY, GRAMS = 40_000, 20_000
SMOOTHING = 0.5
#: An n-gram's evidence counts this much of a word's, once more for every order given up.
BACKOFF = 0.6
#: Partial counts of a task are handed on at this many entries.
FLUSH = 400_000
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Runs of letters with their marks, in lower case."""
    return WORD.findall((text or "").lower())


def grams_of(word: str, order: int) -> list[str]:
    """Character n-grams of a word between two blanks."""
    padded = f" {word} " if order > 1 else word
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def word_counts(df: DataFrame) -> DataFrame:
    """(lang, term, n): words per language over all rows with a lang, counted in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > FLUSH:
                yield _count_rows(counts)
                counts = {}
        yield _count_rows(counts)

    rows = df.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return rows.mapInArrow(run, "lang string, term string, n bigint").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, order: int) -> DataFrame:
    """(lang, term, n): n-grams of one order, each word's taken as often as the word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "n"))):
                of_lang = counts.setdefault(lang, Counter())
                for gram in grams_of(word, order):
                    of_lang[gram] += n
            if sum(map(len, counts.values())) > FLUSH:
                yield _count_rows(counts)
                counts = {}
        yield _count_rows(counts)

    grams = words.mapInArrow(run, "lang string, term string, n bigint")
    return grams.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def _count_rows(counts: dict[str, Counter]) -> pa.RecordBatch:
    rows = [(lang, term, n) for lang, terms in counts.items() for term, n in terms.items()]
    kinds = {"lang": pa.string(), "term": pa.string(), "n": pa.int64()}
    return pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(kinds.items())})


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The terms of the highest counts of each language: as many steps of an eighth of an octave, from the top, as hold ``most`` of its terms."""
    totals = stored(counts.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang")), "totals")
    step = lambda n: F.floor(F.log2(n) * 8).cast("int")
    held, least, full = Counter(), {}, set()
    for row in sorted(counts.groupBy("lang", step(F.col("n")).alias("step")).count().collect(), key=lambda r: -r["step"]):
        lang = row["lang"]
        held[lang] += row["count"]
        if held[lang] > most:
            full.add(lang)
        if lang not in full:
            least[lang] = row["step"]
    if not least:
        return totals.limit(0)
    steps = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
    kept = lambda e: F.coalesce(step(e["value"]) >= F.try_element_at(steps, e["key"]), F.lit(False))
    return totals.where(F.exists(F.map_entries("by_lang"), kept))


class Model:
    """Log frequencies per language of known words and n-grams.

    Only what a language has seen of a term is kept: a term that it has not
    seen weighs the same for all terms of one order (``unseen``), and one seen
    n times weighs log(1 + n / SMOOTHING) more.  The model thus grows with the
    counts it was given, not with terms times languages.
    """

    def __init__(self, langs, rows, unseen, ends, seen_by, gains, prior):
        """``rows[0]`` numbers the words, ``rows[k]`` the n-grams of order k; row r's gains are those from ``ends[r]`` to ``ends[r + 1]``."""
        self.langs, self.rows, self.unseen, self.prior = langs, rows, unseen, prior
        self.ends, self.seen_by, self.gains = ends, seen_by, gains

    @classmethod
    def of_counts(cls, tables: dict[int, pa.Table], totals: dict[int, dict[str, int]]) -> Model:
        """From the kept terms (term, langs, counts) and all counts per language, by order (0: words)."""
        langs, rows, unseen, at = sorted(totals[0]), {}, {}, 0
        place = {lang: i for i, lang in enumerate(langs)}
        sizes, seen_by, gains = [np.zeros(1, np.int64)], [], []
        for order, table in sorted(tables.items()):
            terms = table.column("term").to_pylist()
            rows[order] = {term: at + i for i, term in enumerate(terms)}
            at += len(terms)
            total = np.array([totals[order].get(lang, 0) for lang in langs], np.float64)
            unseen[order] = np.log(SMOOTHING / (total + SMOOTHING * (len(terms) + 1)))
            for chunk in table.to_batches():
                names = chunk.column("langs").flatten().dictionary_encode()
                numbers = np.array([place[x] for x in names.dictionary.to_pylist()], np.int32)
                seen_by.append(numbers[names.indices.to_numpy()])
                gains.append(np.log1p(chunk.column("counts").flatten().to_numpy() / SMOOTHING))
                sizes.append(chunk.column("langs").value_lengths().to_numpy().astype(np.int64))
        prior = np.array([totals[0][lang] for lang in langs], np.float64)
        seen_by, gains = np.concatenate([np.zeros(0, np.int32), *seen_by]), np.concatenate([np.zeros(0), *gains])
        return cls(langs, rows, unseen, np.cumsum(np.concatenate(sizes)), seen_by, gains, prior)

    def state(self) -> tuple:
        return self.langs, self.rows, self.unseen, self.ends, self.seen_by, self.gains, self.prior

    def _score(self, at: list[int], weights: list[float], by_order: Counter) -> np.ndarray:
        at, weights = np.array(at), np.array(weights, np.float64)
        begin = self.ends[at]
        size = self.ends[at + 1] - begin
        first = np.cumsum(size) - size
        inside = np.arange(size.sum()) + np.repeat(begin - first, size)
        gain = self.gains[inside] * np.repeat(weights, size)
        score = np.bincount(self.seen_by[inside], gain, len(self.langs))
        return score + sum(weight * self.unseen[order] for order, weight in sorted(by_order.items()))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the posterior; "und" and 0 without letters."""
        words = Counter(words_of(text))
        if not words or not self.langs:
            return UNKNOWN, 0.0
        known, at, weights, by_order = self.rows[0], [], [], Counter()
        for word, n in words.items():
            row = known.get(word)
            if row is not None:
                at.append(row)
                weights.append(n)
                by_order[0] += n
                continue
            weight = float(n)
            for order in ORDERS:
                weight *= BACKOFF
                table = self.rows[order]
                hits = [r for g in grams_of(word, order) if (r := table.get(g)) is not None]
                if hits:
                    at += hits
                    weights += [weight / len(hits)] * len(hits)
                    by_order[order] += weight
                    break
        if not at:
            return self.langs[int(self.prior.argmax())], 1.0 / len(self.langs)
        score = self._score(at, weights, by_order)
        share = np.exp(score - score.max())
        best = int(score.argmax())
        return self.langs[best], float(share[best] / share.sum())


def fit(df: DataFrame, vocabulary: int = VOCABULARY, grams: int = GRAMS) -> Model:
    """A model of all rows with a ``lang``: whole texts are counted on the executors.

    What reaches the driver is bounded by ``vocabulary`` words and ``grams``
    n-grams of each order for each language, its most frequent ones, so that
    no language takes another's place.
    """
    words = stored(word_counts(df), "words")
    tables, totals = {}, {}
    for order in (0, *ORDERS):
        counts = words if order == 0 else stored(gram_counts(words, order), "grams")
        totals[order] = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        top = most_frequent(counts, grams if order else vocabulary)
        tables[order] = top.select("term", F.map_keys("by_lang").alias("langs"), F.map_values("by_lang").alias("counts")).orderBy("term").toArrow()
    return Model.of_counts(tables, totals)


def identify(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text.

    Null texts and texts without a letter are "und" with score 0, as is
    everything under a model that has learned no language.  Texts of which
    nothing is known get the most frequent language.  Rows are judged one by
    one; only doc_id and text are read.
    """
    sent, name = df.sparkSession.sparkContext.broadcast(model.state()), uuid.uuid4().hex
    return text_rows(df, ["doc_id"], [string("lang_pred"), double("score")], lambda: per_process(("language", name), lambda: Model(*sent.value)).predict, kept=("language", name))
