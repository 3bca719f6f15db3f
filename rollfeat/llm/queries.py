"""One query for each operator of this folder, over whole tables and with production settings."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollfeat.llm import chat, divergence, language, licenses, mixing, neardup, packing, quality, rules, spelling, substring, topk, urls
from rollfeat.llm.store import Store, workers_find_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOP_K = 20
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(workers_find_package(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int) -> F.Column:
    """The part of ``n`` that a document falls in, by the checksum of its id; null without id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def held_out(n: int, part: int) -> F.Column:
    return F.coalesce(fold(n) == part, F.lit(False))


@query
def op1_chat_prefix_targets(spark, sf_dir):
    own = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', :text), (-1L, 1L, 'assistant', :text) AS t(conv_id, turn, role, text)", args={"text": CONTROL_TEXT}
    )
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    examples = chat.expand(conversations)
    trained = F.when(F.col("loss_start").isNotNull(), F.struct("example", chat.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("text")))
    read = examples.groupBy("conv_id").agg(
        F.max(F.struct("example", "formatted")).alias("longest"),
        F.sort_array(F.collect_list(trained)).alias("trained"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    turns = chat.turns_of(F.col("longest.formatted"))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("trained", lambda t: t["text"]), "")
    return read.withColumn("turns", turns).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op2_minhash_lsh_forest(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_language_cross_parsing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(fold(4) != 2).select("text", "lang"))
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query
def op4_best_fit_packing(spark, sf_dir):
    """Lengths are words; copies are texts that agree in their lower-cased words."""
    docs = table(spark, sf_dir, "documents")
    return packing.best_fit(packing_input(docs))


def packing_input(docs: DataFrame) -> DataFrame:
    plain = F.regexp_replace(F.lower(F.col("text")), r"[\x20\x09-\x0D]+", " ")
    return docs.select("doc_id", mixing.n_words(F.col("text")).alias("length"), "source", F.md5(F.btrim(plain)).alias("cluster"))


@query
def op5_nbsvm_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold(5) != 0).select("doc_id", "quality")
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query
def op6_ipf_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "sampled", "target_shares", "reached_shares")


@query
def op7_decision_list_rules(spark, sf_dir):
    measured = Store(spark, "rules").keep(rules.measure(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    learned = rules.fit(measured, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return rules.apply(measured, learned).select("doc_id", *rules.BASE, "base_failed", "kept", "rule")


@query
def op8_ball_tree_top_k(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, rows.where("vec_id % 20 = 0"), TOP_K)


@query
def op9_count_min_substring_dedup(spark, sf_dir):
    kept = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op10_fuzzy_license_scan(spark, sf_dir):
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("spans").alias("n_spans"))


@query
def op11_source_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query
def op12_url_template_tree(spark, sf_dir):
    """The tables hold no labels of URLs, so the templates learn from the URLs that a rule judges."""
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
