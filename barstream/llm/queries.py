"""Registered queries of the numbered operators: thin calls with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from barstream.llm import dac, decontaminate, fertility, language, minhash, mixing, product_codes, rules, secrets, sql, templates, token_counts, urls, vector_file
from barstream.llm.common import held_out, read, remainder, work_folder

Q, O = {}, {}  # noqa: E741


def register(name, sql=None):
    def add(fn):
        Q[name] = fn
        if sql:
            O[name] = sql
        return fn

    return add


def vocabulary_path(name):
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op6_minhash", sql.OP6)
def op6_minhash(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=85)


@register("op8_decontaminate", sql.OP8)
def op8_decontaminate(spark, sf_dir):
    found = decontaminate.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    n_items = F.size("items").cast("long").alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", n_items, ids, (F.col("n_hit") > 0).alias("contaminated"))


@register("op10_url_filter", sql.OP10)
def op10_url_filter(spark, sf_dir):
    return urls.judge_urls(read(spark, sf_dir, "pages"))


@register("op2_fertility")
def op2_fertility(spark, sf_dir, vocabulary="piece_bpe_32k.model"):
    return fertility.quality_rules(read(spark, sf_dir, "documents"), vocabulary_path(vocabulary))


@register("op4_secrets")
def op4_secrets(spark, sf_dir):
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


@register("op5_token_codes")
def op5_token_codes(spark, sf_dir, vocabulary="word_bpe_49k.json"):
    folder = work_folder(spark, "tokens")
    dac.write_tokens(read(spark, sf_dir, "documents"), folder, vocabulary_path(vocabulary), end_id=2)
    return dac.read_documents(spark, folder)


@register("op3_language")
def op3_language(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs.where(remainder(F.col("doc_id")) != 2))
    return language.identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register("op9_mixing", sql.OP9)
def op9_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).withColumn("weight", F.round("weight", 9)).drop("ident")


@register("op7_rules")
def op7_rules(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = rules.fit(docs, labels.where(remainder(F.col("doc_id")) != 2))
    scored = rules.text_statistics(docs, ["doc_id"]).withColumn("score", model.score())
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


@register("op1_templates", sql.OP1)
def op1_templates(spark, sf_dir):
    kept = templates.drop_recurring(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@register("op11_product_codes", sql.OP11)
def op11_product_codes(spark, sf_dir):
    return product_codes.product_codes(read(spark, sf_dir, "embeddings"))


@register("op12_token_counts")
def op12_token_counts(spark, sf_dir, vocabulary="piece_bpe_32k.model"):
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), vocabulary_path(vocabulary))


@register("op13_clusters", sql.OP13)
def op13_clusters(spark, sf_dir):
    return vector_file.centroid_clusters(read(spark, sf_dir, "embeddings"))
