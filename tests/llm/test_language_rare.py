"""A rare language beside a hot one."""

from barstream.llm import language


def test_rare_language_keeps_its_words(spark):
    hot = " ".join(f"{a}{b}o" for a in "abcdefghij" for b in "klmnpqrstu")
    rare = " ".join(f"{b}{a}o" for a in "abcde" for b in "klmn")
    rows = [("aa", hot)] * 50 + [("bb", rare)] * 2
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"), vocabulary=110, grams=110)
    assert set(rare.split()) | set(hot.split()) == set(model.rows[0])
    assert model.predict(rare)[0] == "bb" and model.predict(hot)[0] == "aa"
