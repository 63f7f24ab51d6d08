"""A corpus pipeline of five operators: documents in, packed training sequences out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakejobs.llm import (
    apportionment, jaccard_join, mil_quality, string_kernel, vector_packing,
)
from lakejobs.llm.shipping import ship
from lakejobs.session import fresh_dir

LEAST_LANGUAGE_SCORE = 0.4
LEAST_QUALITY = 0.7

# Stages that SQL cannot express (models, seeded hashes, tokenizers): tested by brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that is known with some certainty; those without a letter go.

    Where there is no language to learn from, only those go."""
    ship(spark)
    model = string_kernel.learn(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = string_kernel.identified(F.col("text"), model)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                         found.alias("found"))
    return marked.where((F.col("found.lang_pred") != "und")
                        & (F.col("found.score") >= LEAST_LANGUAGE_SCORE)).select("doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as good; all, where there is no label to learn from."""
    ship(spark)
    model = mil_quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if model is None:
        return docs
    score = mil_quality.quality_score(F.col("text"), model)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       score.alias("score")).where(
        F.col("score") >= LEAST_QUALITY).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id, those without an id
    last.

    Rows that repeat id and text are one document, all others are told apart."""
    ship(spark)
    # In the order of ids: 16 digits from the least id on, or "~", and the digest of the text.
    number = F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    key = F.concat(F.coalesce(F.lpad(F.hex(number), 16, "0"), F.lit("~")), F.lit(" "),
                   F.coalesce(F.sha2("text", 256), F.lit("")))
    linked = jaccard_join.linked_documents(
        docs.select(key.alias("key"), "text"), id_col="key", id_type="string",
        words=5, percent=80)
    kept = linked.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       key.alias("_key"))
    rows = rows.join(kept, F.col("_key") == F.col("_kept"), "left_semi")
    same = Window.partitionBy("_key").orderBy("_key")
    return rows.withColumn("_nth", F.row_number().over(same)).where("_nth = 1").select("doc.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    ship(spark)
    return apportionment.copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    ship(spark)
    return vector_packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), max_tokens=2048, max_segments=256)


STAGES = [
    ("language ID", language),
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
