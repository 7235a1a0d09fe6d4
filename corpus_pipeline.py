"""Documents to training sequences in five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import decontaminate, line_dedup, ngram_join, packing, quality
from quadrille.llm.tables import fresh_name, read_table, stored
from quadrille.session import ship


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts are scored like others. Repeated rows have one score and share their lot. Columns keep their values, whatever their names.
    """
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    score = fresh_name(docs, "_quality")
    return quality.with_quality(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the row with the smallest id, then the smallest row number; rows without an id rank last."""
    return ngram_join.one_of_each_group(docs, width=5, percent=75)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier in the corpus; ``n_chars`` follows the text.

    All rows stay; null texts stay null and keep their ``n_chars``.
    """
    kept = line_dedup.without_repeats(docs, unit="passage", spans=fresh_name(docs, "_spans"))
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return kept.withColumn("n_chars", length).select(*(f"`{c}`" for c in docs.columns))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without benchmark passages, whatever their ids; null and empty texts stay."""
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens. Null and empty texts are pieces of the end id alone; repeated rows are packed as often as they stand."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", keep_one_of_each_group),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", keep_clean),
    ("best-fit packing", pack),
]

#: The classifier, the tokenizer and the packing search have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all sequences; no rows for an empty table."""
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
