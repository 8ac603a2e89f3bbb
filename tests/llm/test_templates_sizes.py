"""One template at two sizes."""

import random

import duckdb
import pandas as pd
import plain
import pytest

from barstream.llm import sql, templates


def held_against_others(spark, rows):
    """n_dropped by doc_id: the operator, the plain version and the SQL agree."""
    got = {r["doc_id"]: r["n_dropped"] for r in templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain.templates(rows, templates.DEPTH, templates.MIN_TOKENS, templates.MIN_DOCS, templates.MIN_FIXED, templates.MIN_LATER)
    assert got == {i: len(want.get((i, t), ())) for i, t in rows}
    with duckdb.connect() as con:
        con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
        assert got == {r[0]: r[1] for r in con.execute(f"SELECT doc_id, n_dropped FROM ({sql.OP1})").fetchall()}
    return got


@pytest.mark.parametrize("rows", [12, 1_000, 10_000])
def test_unlike_sentences_of_one_opening_stay(spark, rows):
    rng = random.Random(1)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "lk")]
    lines = [(i, "I think that we " + " ".join(rng.choice(words) for _ in range(4))) for i in range(rows)]
    assert set(held_against_others(spark, lines).values()) == {0}


def test_long_lines_that_recur(spark):
    """The work for a line grows with its tokens, not with their square."""
    line = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(32_000))
    got = templates.drop_recurring(spark.createDataFrame([(i, line) for i in range(12)], "doc_id long, text string")).collect()
    assert all(r["n_dropped"] == 1 for r in got)


@pytest.mark.parametrize(("rows", "tail", "goes"), [(40, " with any questions", 1), (4_000, " with any questions", 1), (4_000, "", 0)])
def test_field_of_frequent_values(spark, rows, tail, goes):
    """At 4,000 rows each of the 40 first and last names has 100, and a pair of names has 2 or 3.

    With nothing but names behind the opening, lines have only that in common, and stay.
    """
    names = [(i, f"Please contact our editor f{chr(97 + i % 40 // 20)}{chr(97 + i % 20)} l{chr(97 + i // 40 % 40 // 20)}{chr(97 + i // 40 % 20)}{tail}\nown") for i in range(rows)]
    others = [(rows + i, f"Please contact our editor {'abcdefgh'[i]}" + " of one more line here") for i in range(8)]
    got = held_against_others(spark, names + others)
    assert all(n == goes * (i < rows) for i, n in got.items())


def test_line_keys_come_once(spark):
    rows = [(i, f"Please contact our editor {'ab'[i % 2]}{'cd'[i // 2 % 2]}x {'efghijkl'[i // 4 % 8]}y with any questions") for i in range(300)]
    found = templates.recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=20)
    assert found.count() == found.select("doc_id", "line_no").distinct().count() == 300
