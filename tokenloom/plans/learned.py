"""Queries: models that Spark fits. They are judged on rows left out of the fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import vectors as V
from tokenloom.operators import learning as L
from tokenloom.plans.registry import query, r_sql, rounded
from tokenloom.sources.corpus import table


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumn("v", V.doubles(F.col("embedding"))).drop("embedding")


@query(
    "perceptron_classifier",
    """
    SELECT label, count(*) AS n_rows, true AS good FROM embeddings
    WHERE substr(md5(vec_id::VARCHAR), 1, 1) < '3' GROUP BY label
    """,
)
def perceptron_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Fit ten classes; the vectors are first moved apart by label, as theirs are at chance.

    Judged on the rows left out of the fit: per label how many there are, and
    whether nine of ten of all are predicted right.
    """
    apart = F.transform("v", lambda x, i: x + F.when(i == F.col("label"), 0.5).otherwise(0.0))
    data = _embeddings(spark, sf).withColumn("v", apart)
    left_out = F.substring(F.md5(F.col("vec_id").cast("string")), 1, 1) < "3"
    scored = L.fit_perceptron(data.filter(~left_out), "v", "label", 10, hidden=(32,)).predict(data.filter(left_out))
    good = L.accuracy(scored, "label") >= 0.9
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("good", F.lit(good))


@query(
    "autoencoder_errors",
    f"""
    WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
    m AS (SELECT i, avg(x) AS mean FROM v GROUP BY i)
    SELECT vec_id, 16::BIGINT AS code_width, {r_sql('sum((x - mean) * (x - mean))')} AS spread, true AS small
    FROM v JOIN m USING (i) GROUP BY vec_id
    """,
)
def autoencoder_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Encode 64 entries in 16 and decode.

    The code and the error split each row's squared distance from the mean,
    so `spread`, their sum, must be just that; the error is the smaller for it.
    """
    data = _embeddings(spark, sf)
    out = L.fit_autoencoder(data, "v", 16).reconstruct(data)
    left = F.col("error") * F.size("decoded")
    spread = V.sum_of_squares(F.col("code")) + left
    return out.select(
        "vec_id",
        F.size("code").cast("bigint").alias("code_width"),
        rounded(spread).alias("spread"),
        (left <= spread + 1e-9).alias("small"),
    )


def _discriminated(found: L.Discriminator, good: bool) -> DataFrame:
    return found.scored.groupBy("is_real").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("good", F.lit(good))


@query(
    "discriminator_shifted",
    "SELECT unnest([0, 1])::INTEGER AS is_real, (SELECT count(*) FROM embeddings) AS n_rows, true AS good",
)
def discriminator_shifted(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors against a copy moved by 0.2 in every entry: easy to tell apart on rows left out."""
    real = _embeddings(spark, sf).select("vec_id", "v")
    moved = real.withColumn("v", F.transform("v", lambda x: x + 0.2))
    found = L.fit_discriminator(real, moved, "v", "vec_id")
    return _discriminated(found, found.auc >= 0.95)


@query(
    "discriminator_halves",
    """
    SELECT (substr(md5(vec_id::VARCHAR), 1, 1) < '8')::INTEGER AS is_real, count(*) AS n_rows, true AS good
    FROM embeddings GROUP BY 1
    """,
)
def discriminator_halves(spark: SparkSession, sf: str) -> DataFrame:
    """One half of the vectors against the other half, with the same settings: not to be told apart on rows left out."""
    data = _embeddings(spark, sf).select("vec_id", "v")
    first = F.substring(F.md5(F.col("vec_id").cast("string")), 1, 1) < "8"
    found = L.fit_discriminator(data.filter(first), data.filter(~first), "v", "vec_id")
    return _discriminated(found, abs(found.auc - 0.5) <= 0.1)
