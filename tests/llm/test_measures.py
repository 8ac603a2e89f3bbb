"""What operators 2, 4 and 7 add to their contracts, against plain versions over whole tables."""

import math
import random

import plain
import plain_measures
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from barstream.llm import fertility, queries, rules, secrets


def test_op2_tokens_and_verdict(spark, rows):
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    odd = [(10**9 + n, text) for n, text in enumerate(dict.fromkeys(r[1] for r in plain.ODD))]
    odd += [(2 * 10**9 + n, t) for n, t in enumerate(["ΑΒΓ δέλτα " * 40, "сто слов о разном и ещё " * 20, "漢字かな交じり文 " * 60, "▁a ▁▁ b▁", "🙂🙃 ok " * 50, "नमस्ते दुनिया " * 60])]
    every = rows + odd
    table = spark.createDataFrame(every, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r for r in fertility.quality_rules(table, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert len(got) == len(every)
    for doc_id, text in every:
        r, (n, by_bytes, entropy) = got[doc_id], plain_measures.token_measures(pieces, text)
        kind = plain_measures.script(text)
        assert (r["n_tokens"], r["n_byte_tokens"], r["script"]) == (n, by_bytes, kind), doc_id
        assert math.isclose(r["token_entropy"], entropy, rel_tol=1e-9, abs_tol=1e-9)
        assert r["kept"] == (not r["base_failed"] and plain_measures.fertile(fertility.BANDS, kind, r["word_chars"], n, by_bytes, r["token_entropy"]))


def test_op7_scores(spark):
    """Every score of the query is that of its rules, worked out row by row from plainly counted statistics."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = rules.fit(docs, labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    assert len(model.rules) > 3
    got = {r["doc_id"]: r for r in queries.Q["op7_rules"](spark, sf).collect()}
    table = docs.select("doc_id", "text").collect()
    assert len(got) == len(table)
    for doc_id, text in table:
        want = plain_measures.rule_score(rules.STATISTICS, model.intercept, model.rules, plain_measures.statistics(text))
        assert math.isclose(got[doc_id]["score"], want, rel_tol=1e-9), doc_id


def test_op7_statistics_of_odd_texts(spark):
    found = rules.text_statistics(plain.odd(spark), ["doc_id", "text"]).collect()
    assert len(found) == len(plain.ODD)
    for r in found:
        for name, want in plain_measures.statistics(r["text"]).items():
            assert math.isclose(r[name], want, rel_tol=1e-9, abs_tol=1e-12), (r["doc_id"], name)


def test_op4_planted_literals(spark):
    """Literals planted at known places in 2,000 sources: all secrets are found, and nothing else."""
    rng = random.Random(4)
    want = {}
    texts = []
    for i in range(2_000):
        text, spans = plain_measures.planted_source(rng)
        texts.append((i, text))
        want[i] = spans
    out = secrets.find_secrets(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()
    assert sum(map(len, want.values())) > 500
    for r in out:
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert {(int(a), int(b)) for kind, a, b in spans if kind == "literal"} == want[r["doc_id"]], (r["doc_id"], texts[r["doc_id"]][1])
