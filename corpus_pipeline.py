"""From raw documents to packed sequences: language, near duplicates, repeated passages, mixture, packing.

Each stage takes what its predecessor kept, with the columns of ``documents``, and its decisions take effect: documents
or words that it rejects are gone. The last stage returns the pieces of the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollfeat.llm import language, mixing, neardup, packing, substring
from rollfeat.llm.queries import packing_input
from rollfeat.llm.store import Store, workers_find_package

# No single SQL statement can state these stages; tests/llm checks them one by one.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that a learned language explains; texts without letters and gibberish go."""
    workers_find_package(spark)
    model = language.fit(docs.select("text", "lang"))
    return language.identify(docs, model).where(language.accepted()).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group; documents without id stay."""
    workers_find_package(spark)
    found = neardup.near_duplicates(docs.select("doc_id", "text"))
    gone = found.where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages of earlier documents. A document that lost words has the rest joined by spaces; one that lost all goes."""
    workers_find_package(spark)
    kept = substring.remove_repeats(docs).where("n_removed = 0 OR n_removed < n_words")
    changed = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    columns = [changed.alias("text") if c == "text" else F.length(changed).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample to flattened shares of source, language and form, keeping four fifths of the words."""
    return mixing.mix(docs).where("sampled").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 words."""
    workers_find_package(spark)
    return packing.best_fit(packing_input(docs))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir))
    return docs
