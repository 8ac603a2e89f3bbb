"""Rows of one doc_id with different texts."""

import random

import plain
import pytest

from barstream.llm import minhash

TEXTS = [(0, "a b c"), (1, "a b c"), (1, "d e f"), (2, "d e f")]


def test_a_document_joins_what_its_texts_are_linked_with(spark):
    got = minhash.near_duplicates(spark.createDataFrame(TEXTS, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [(0, 0, True), (1, 0, False), (1, 0, False), (2, 0, False)]


@pytest.mark.parametrize("seed", range(3))
def test_shared_ids_against_the_plain_version(spark, seed):
    rnd, vocabulary = random.Random(seed), [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(12):
        words = [rnd.choice(vocabulary) for _ in range(80)]
        for _ in range(4):
            at = rnd.randrange(len(words))
            rows.append((rnd.randrange(30), " ".join([*words[:at], rnd.choice(vocabulary), *words[at + 1 :]])))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert len(got) == len(rows) and {r["doc_id"]: r["component_id"] for r in got} == plain.components(rows, 3, 85)
