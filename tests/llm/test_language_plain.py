"""The back-off model against a plain one of dictionaries, over a whole table; letters; many languages."""

import math
import unicodedata
from collections import Counter

import numpy as np
import plain
import pytest

from barstream.llm import language, queries


def words(text):
    """Runs of letters and their marks that begin with a letter, character by character."""
    out, word = [], ""
    for ch in (text or "").lower() + " ":
        kind = unicodedata.category(ch)[0]
        if kind == "L" or (kind == "M" and word):
            word += ch
        elif word:
            out.append(word)
            word = ""
    return out


def grams(word, order):
    padded = f" {word} " if order > 1 else word
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def kept_terms(counts, most):
    """Terms of a whole number of steps of an eighth of an octave, from the top, in any language."""
    kept = set()
    for of_lang in counts.values():
        steps = Counter(math.floor(math.log2(n) * 8) for n in of_lang.values())
        held, least = 0, None
        for step in sorted(steps, reverse=True):
            held += steps[step]
            if held > most:
                break
            least = step
        kept |= {t for t, n in of_lang.items() if least is not None and math.floor(math.log2(n) * 8) >= least}
    return kept


def plain_model(rows):
    """{order: (counts by language, kept terms)} of (lang, text) rows."""
    by = {}
    for lang, text in rows:
        by.setdefault(lang, Counter()).update(words(text))
    model = {0: (by, kept_terms(by, language.VOCABULARY))}
    for order in language.ORDERS:
        counts = {lang: Counter() for lang in by}
        for lang, of_lang in by.items():
            for word, n in of_lang.items():
                for gram in grams(word, order):
                    counts[lang][gram] += n
        model[order] = (counts, kept_terms(counts, language.GRAMS))
    return model


def plain_scores(model, text):
    """{lang: score}; None if no letter, empty if nothing is known."""
    found = Counter(words(text))
    if not found:
        return None
    parts = []
    for word, n in found.items():
        if word in model[0][1]:
            parts.append((0, word, n))
            continue
        weight = n
        for order in language.ORDERS:
            weight *= language.BACKOFF
            hits = [g for g in grams(word, order) if g in model[order][1]]
            if hits:
                parts += [(order, g, weight / len(hits)) for g in hits]
                break
    if not parts:
        return {}
    total = {order: {lang: sum(c.values()) for lang, c in counts.items()} for order, (counts, _) in model.items()}
    half = language.SMOOTHING
    return {
        lang: sum(
            w * math.log((model[o][0][lang][t] + half) / (total[o][lang] + half * (len(model[o][1]) + 1))) for o, t, w in parts
        )
        for lang in model[0][0]
    }


def test_equals_the_plain_model(spark, documents):
    rows = documents.select("doc_id", "text", "lang").collect()
    model = plain_model([(r["lang"], r["text"]) for r in rows if r["lang"] and r["text"] and plain.remainder(r["doc_id"]) != 2])
    got = {r["doc_id"]: r for r in queries.Q["op3_language"](spark, plain.SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        scores, pred = plain_scores(model, r["text"]), got[r["doc_id"]]
        if scores is None:
            assert (pred["lang_pred"], pred["score"]) == ("und", 0.0)
        elif scores:
            top = max(scores.values())
            share = 1 / sum(math.exp(s - top) for s in scores.values())
            assert pred["score"] == pytest.approx(share, rel=1e-6)
            assert scores[pred["lang_pred"]] == pytest.approx(top, rel=1e-9)


def test_letters(spark):
    df = spark.createDataFrame([(1, "en", "plain words"), (2, "hi", "हिन्दी भाषा में लिखा")], "doc_id long, lang string, text string")
    model = language.fit(df)
    assert language.words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    for text in ("² ½ Ⅷ ① 12", "́ ि", "_", "…"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("हिन्दी")[0] == "hi"


def test_a_hundred_languages_take_what_they_have_seen(spark):
    rows = [(f"l{i:02}", " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(300))) for i in range(100)]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    terms = sum(map(len, model.rows.values()))
    assert len(model.gains) < 3 * terms  # not terms times languages
    assert all(model.predict(text)[0] == lang for lang, text in rows)
    assert np.all(np.diff(model.ends) > 0)
