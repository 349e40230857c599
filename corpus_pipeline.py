"""A corpus pipeline: each stage reads what the one before kept and writes Parquet.

Stages: toxic documents go; later repeats of passages are cut out, and
documents of which nothing is left go; one document of each group of
near copies stays; documents that hold benchmark passages go; what is left is
encoded and decoded again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import bpe, decontamination, line_dedup, simhash, toxicity
from tokenloom.llm.queries import RANKS, toxicity_model
from tokenloom.session import materialize, scratch_path, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _named(docs: DataFrame) -> DataFrame:
    """`docs` with `__row`, a struct that names a document by key and text, null or not."""
    return docs.withColumn("__row", F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("copy")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model of the labelled ones; null and empty texts stay."""
    ship_package(spark)
    return docs.filter(toxicity.scorer(toxicity_model(spark, sf_dir))(F.col("text")) < 0.5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later repeats of passages; n_chars follows the text. A document that repeats go on to empty is a copy and goes."""
    ship_package(spark)
    kept = line_dedup.without_repeats(docs)
    kept = kept.filter((F.col("__deleted") == 0) | F.col("text").rlike(r"\S"))
    length = F.when(F.col("__deleted") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id, then text hash; rows without an id stay."""
    ship_package(spark)
    named = _named(docs).withColumn("__row", F.when(F.col("doc_id").isNotNull(), F.col("__row")))
    found = simhash.near_duplicates(named, key="__row")
    firsts = found.filter("__row is not null and __row <=> component").select("__row").distinct()
    firsts = materialize(firsts, "kept_rows")
    kept = named.filter("doc_id is not null").join(firsts, "__row", "left_semi").dropDuplicates(["__row"])
    return kept.select(*docs.columns).unionByName(docs.filter("doc_id is null")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    ship_package(spark)
    found = decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = found.filter("n_hit > 0").select(F.struct(F.col("doc_id").alias("id"), "copy").alias("__row")).distinct()
    return _named(docs).join(hit, "__row", "left_anti").select(*docs.columns)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    ship_package(spark)
    return bpe.round_trip(docs, bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeats),
    ("simhash_near_dedup", one_of_each),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_and_decode),
]

# A fitted random field and 64-bit hashes of shingles have no SQL; the tests
# hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
