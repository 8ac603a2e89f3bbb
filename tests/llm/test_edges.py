"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import numpy as np
import plain
import public_tokenizers
import pytest

from barstream.llm import components, dac, decontaminate, fertility, language, minhash, mixing, rules, secrets, shingles, templates, urls

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    return plain.odd(spark)


def find(frame, odd):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_fertility(odd):
    got = [r for r in fertility.quality_rules(odd, PIECES).collect()]
    assert len(got) == len(plain.ODD)
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in got) == sorted((r[0] or 0, plain.base_measures(r[1])[0]) for r in plain.ODD)
    assert all(r["base_failed"] and not r["kept"] for r in got if r["doc_id"] in (1, 2, 3, 4))
    assert {r["script"] for r in got if r["doc_id"] in (1, 2, 3, 9)} == {"none"}
    assert fertility.quality_rules(odd.limit(0), PIECES).count() == 0


@pytest.mark.parametrize("line", ["a = a + a\n", "a = b + b\nb = a + a\n", "a = b + 'x1'\nb = a + 'y2'\n"])
def test_constants_that_double(line):
    """Names inside their own chains, and values that would double with every line, take no time."""
    import time

    begin = time.perf_counter()
    text = "b = 'pQ7rS8t'\na = 'U9vW1xY2'\n" + line * 400 + "auth_token = a\n"
    found = {text[x:y] for _, x, y in secrets.literal_spans(text)}
    assert {"U9vW1xY2"} <= found or {"pQ7rS8t"} <= found
    assert time.perf_counter() - begin < 2


@pytest.mark.parametrize("text", ["SECRET_KEY = b'pQ7rS8tU9vW1'", 'api_token = f"pQ7rS8tU9vW1"', 'password = """pQ7rS8tU9vW1"""', 'auth_token = ("pQ7rS8t"\n   "U9vW1")', "db_password = 'pQ7rS8t' 'U9vW1'"])
def test_literal_forms(text):
    assert "".join(text[a:b] for _, a, b in sorted(secrets.literal_spans(text), key=lambda s: s[1])) == "pQ7rS8tU9vW1"


def test_language(odd):
    model = language.fit(odd)
    got = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    assert language.identify(odd, model).count() == len(plain.ODD)
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 9)] == ["und"] * 4 and got[4]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = language.fit(odd.limit(0))
    assert {r["lang_pred"] for r in language.identify(odd, none).collect()} == {"und"}


def test_language_backs_off(spark):
    rows = [("aa", "kato kato mano mano"), ("bb", "wexu wexu zexi zexi")]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.predict("katomano")[0] == "aa" and model.predict("zexuwexi")[0] == "bb"


def test_secrets(odd):
    got = secrets.find_secrets(odd).collect()
    assert len(got) == len(plain.ODD) and all(r["spans"] == "" and r["n_hex"] == 0 for r in got)


@pytest.mark.parametrize(
    "text, kept",
    [
        ('db_password = "hunter2Zq9"', "hunter2Zq9"),
        ("{'clientSecret': 'aB3dE6gH9kL2mN5'}", "aB3dE6gH9kL2mN5"),
        ("K = 'pQ7rS8tU9vW1'\nauth_token = K", "pQ7rS8tU9vW1"),
        ("api_key: sk-aB3dE6gH9kL2mN5\n", "sk-aB3dE6gH9kL2mN5"),
        ('password = "changeme"', None),
        ('token_length: str = "abcdef123456"', None),
        ('title = "aB3dE6gH9kL2mN5"', None),
        ("if a == 'aB3dE6gH9kL2mN5': pass", None),
    ],
)
def test_lexing(text, kept):
    spans = secrets.literal_spans(text)
    assert [text[a:b] for _, a, b in spans] == ([kept] if kept else [])


def test_propagated_parts():
    text = 'a = "pQ7rS8t"\nsecret = a + "U9vW1xY2"\n'
    assert sorted(text[a:b] for _, a, b in secrets.literal_spans(text)) == ["U9vW1xY2", "pQ7rS8t"]


@pytest.mark.parametrize("text", ["token" * 30_000, "=" * 100_000, "a" * 100_000 + "=", "token = " + "ab1" * 30_000, ": " * 50_000])
def test_long_inputs_take_no_time(text):
    assert secrets.base_spans(text) is not None and secrets.literal_spans(text) is not None


def test_codes(spark, odd, tmp_path):
    folder = str(tmp_path / "codes")
    dac.write_tokens(odd, folder, WORDS, 2, shards=3, segment_ids=50)
    got = dac.read_documents(spark, folder).collect()
    assert len(got) == len(plain.ODD)
    known = [(r[0] if r[0] is not None else -1, r[1]) for r in plain.ODD]
    assert sum(r["n_tokens"] for r in got) == sum(n for _, n, _ in [plain.token_rows([k])[k[0]] for k in known])
    order = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in order] == np.cumsum([0] + [r["n_tokens"] for r in order])[:-1].tolist()
    assert [r["doc_id"] or 0 for r in order] == sorted(r[0] or 0 for r in plain.ODD)
    every = [(o["start"] + o["n_tokens"] - 1,) for o in order]
    at = dac.tokens_at(spark, folder, spark.createDataFrame(every + [(10**9,)], "position long")).collect()
    assert len(at) == len(every) and {r["id"] for r in at} == {2}


def test_codes_of_nothing(spark, odd, tmp_path):
    dac.write_tokens(odd.limit(0), str(tmp_path / "none"), WORDS, 2)
    assert dac.read_documents(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("top", [1, 256, 49_408, 2**32])
def test_random_access(n, top):
    ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64)
    codes = dac.Codes(dac.encode(ids))
    assert codes.all().tolist() == ids.tolist() == [codes[i] for i in range(n)]


def test_minhash(odd):
    got = minhash.near_duplicates(odd, words=3, percent=85).collect()
    assert len(got) == len(plain.ODD)
    of = {r["doc_id"]: r for r in got}
    assert [of[i]["n_shingles"] for i in (1, 2, 3, 5)] == [0, 0, 0, 1] and of[6]["component_id"] == 5 and not of[6]["kept"]
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True, True] and of[None]["component_id"] is None
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_large_near_group_equals_all_pairs(spark, monkeypatch, percent):
    """Variants of one text, most of them no links of each other, in blocks of a few rows."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(3)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(160):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            words[at] = f"x{rng.integers(0, 6)}"
        rows.append((i, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == plain.components(rows, 3, percent)


def test_sketch_fills_and_estimates():
    sketcher = shingles.Sketcher(32, 4)
    for n in (1, 5, 60, 2000):
        assert (sketcher.sketch(np.arange(n, dtype=np.uint64)) > 0).all()
    a, b = np.arange(0, 900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    assert abs((sketcher.sketch(a) == sketcher.sketch(b)).mean() - 0.8) < 0.13


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {**{i: 0 for i in range(41)}, 100: 100, 150: 100, 200: 100}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rules(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (8, 3, 1)], "doc_id long, quality int, text int")
    model = rules.fit(odd, labels)
    scored = rules.text_statistics(odd, ["doc_id"]).withColumn("p", model.score()).collect()
    assert len(scored) == len(plain.ODD) and all(0 <= r["p"] <= 1 for r in scored)
    for few, want in ((labels.limit(0), 0.5), (labels.where("doc_id = 5"), 2.5 / 3)):
        one = rules.fit(odd, few)
        assert not one.rules and abs(rules.text_statistics(odd, ["doc_id"]).select(one.score()).first()[0] - want) < 1e-9


def test_paths_of_a_tree():
    text = "Tree\n If (feature 0 <= 1.5)\n  If (feature 2 > 3.0)\n   Predict: 1\n  Else (feature 2 <= 3.0)\n   Predict: 0\n Else (feature 0 > 1.5)\n  Predict: 0\n"
    assert rules.tree_paths(text) == [((0, "<=", 1.5),), ((0, "<=", 1.5), (2, ">", 3.0)), ((0, "<=", 1.5), (2, "<=", 3.0)), ((0, ">", 1.5),)]
    assert rules.simplified(((1, "<=", 4.0), (1, "<=", 2.0), (1, ">", 0.0))) == ((1, "<=", 2.0), (1, ">", 0.0))


@pytest.mark.parametrize("block_words", [4, 400_000])
def test_decontaminate(spark, odd, block_words):
    items = [(1, "one two"), (1, "three"), (2, "Lorem ipsum dolor sit amet consectetur lorem ipsum dolor sit amet"), (3, None), (4, "--"), (None, "one"), (5, "日本語 テキスト")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    got = decontaminate.find_items(odd, benchmark, block_words=block_words).collect()
    known = [i for i in items if i[0] is not None]
    assert known != items  # windows of a null item_id hit, but are no item
    want = sorted((r[0] or 0, *plain.contamination(r[1], items)[:2], plain.contamination(r[1], known)[2]) for r in plain.ODD)
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"]) for r in got) == want
    assert decontaminate.find_items(odd.limit(0), benchmark).count() == 0
    assert decontaminate.find_items(odd, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_spans_of_the_original(spark):
    docs = spark.createDataFrame([(1, "Ünö: -- (Two) THREE; four ünö two"), (2, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([("q", "two three")], "item_id string, text string")
    got = {r["doc_id"]: r["spans"] for r in decontaminate.find_items(docs, benchmark).collect()}
    assert got == {1: [9, 19], 2: []}


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme/de/"), (4, "http://A.Example.ORG"), (4, "http://A.Example.ORG"), (5, "x://example.org/es/1?q"), (6, "http://shop.test/XXX/a"),
            (7, "http://a.test/sussex-adulthood"), (8, "http://casino.test/poker"), (9, "http://notorg/"), (10, "http://a.com/de/b://c"), (11, "http://éxxx.test/")]
    pages = spark.createDataFrame([(*r, "v", "h") for r in rows], "page_id long, url string, verdict string, host string")
    got = {r["page_id"]: r for r in urls.judge_urls(pages).collect()}
    assert urls.judge_urls(pages).count() == len(rows) and urls.judge_urls(pages.limit(0)).count() == 0
    verdicts = {i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in got.items()}
    assert verdicts[1] == verdicts[2] == ("", "", None, "allow") and verdicts[4] == ("a.example.org", "", None, "allow")
    assert verdicts[5] == ("example.org", "/es/1", "example.org/es/", "block") and verdicts[10][2:] == ("com/de/", "block")
    assert [verdicts[i][3] for i in (3, 6, 7, 8, 9, 11)] == ["allow", "block", "allow", "block", "allow", "allow"]


def test_templates(spark, odd):
    got = templates.drop_recurring(odd, min_docs=2).collect()
    assert len(got) == len(plain.ODD) and {r["doc_id"]: r["text"] for r in got}[4] == plain.LONG
    assert templates.drop_recurring(odd.limit(0)).count() == 0
    lines = [(i, f"user name{i} logged in from host {c} today\n{c}{c} has words of its own") for i, c in enumerate("abcdefghijkl")]
    kept = templates.drop_recurring(spark.createDataFrame(lines, "doc_id long, text string"), depth=1, min_docs=10).collect()
    assert all(r["n_dropped"] == 1 and r["text"].endswith("has words of its own") for r in kept)


def test_mixing(spark, odd):
    got = mixing.mix(odd).collect()
    assert len(got) == len(plain.ODD) and all(r["copies"] >= 0 for r in got)
    assert mixing.mix(odd.limit(0)).count() == 0
    assert set(mixing.realised(odd).columns) == set(odd.columns)


def test_exponent():
    tokens = {"a": 9000, "b": 900, "c": 100}
    at = lambda **k: mixing.weights_at({s: n / 10_000 for s, n in tokens.items()}, mixing.solve_exponent(tokens, 10_000, **k))
    assert abs(at(entropy_share=None, max_repeats=None)["a"] - 0.9) < 1e-12
    half = mixing.entropy(at(entropy_share=0.5, max_repeats=None))
    shares = mixing.entropy({s: n / 10_000 for s, n in tokens.items()})
    assert abs(half - (shares + 0.5 * (np.log(3) - shares))) < 1e-9
    assert at(entropy_share=1.0, max_repeats=4.0)["c"] * 10_000 <= 400 + 1e-6


def test_blocks_of_a_hot_source(spark):
    rows = [(i, "a b c", "hot" if i % 3 else "cold") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_docs=50).toPandas()
    assert got.groupby(["source", "block"]).size().max() < 120
    for source, own in got.groupby("source"):
        assert sorted(own.last_epoch_rank) == list(range(len(own)))
        assert own.sort_values("last_epoch_rank").copies.is_monotonic_decreasing
