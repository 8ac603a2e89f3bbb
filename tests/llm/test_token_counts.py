"""Token counts against the library on whole texts."""

import plain
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from barstream.llm import queries, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def want(rows):
    out = []
    for doc_id, text in rows:
        n = len(PIECES.encode(text or ""))
        out.append((doc_id, len((text or "").encode()), n, n > 4096))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


PARTS = [" ", "  ", "\n", "\t", "\r", "\r\n", "\v", "\f", "▁", "▁▁", "\x00", " ", "　", "a", "the", "The", "1", "23", ";", "});", "//", "é", "é", "日本", "﻿", "😀", "<s>", "</s>", "<unk>", "<0x0A>", "ﬁ"]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), st.text(max_size=40)))
def test_pre_tokens_add_up(text):
    tokens = token_counts.pre_tokens(text)
    assert sum(token_counts.piece_counts(PIECES, tokens)) == len(PIECES.encode(text))
    assert not text or "".join(tokens) == " " + text.replace("▁", " ")


@pytest.mark.parametrize("head", [0, 5, token_counts.HEAD])
def test_odd_rows(spark, head):
    """All pre-tokens joined, most of them, none of them; a document with a column called rest."""
    df = plain.odd(spark).withColumnRenamed("n_words", "rest").withColumnRenamed("items", "token")
    assert got(token_counts.count_tokens(df, MODEL, head=head)) == want([r[:2] for r in plain.ODD])
    assert got(token_counts.count_tokens(df.limit(0), MODEL, head=head)) == []


def test_tasks_hand_on_what_they_gathered(spark, documents, rows, monkeypatch):
    monkeypatch.setattr(token_counts, "TASK_TOKENS", 50)
    from collections import Counter

    counts = Counter(t for _, text in rows for t in token_counts.pre_tokens(text or ""))
    assert {r["token"]: r["n"] for r in token_counts.frequencies(documents).collect()} == counts


def test_registered(spark, rows):
    assert got(queries.Q["op12_token_counts"](spark, plain.SF)) == want(rows)


def test_other_vocabularies_are_refused():
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    with pytest.raises(ValueError):
        token_counts.check_vocabulary(Crossing())
