"""Models that Spark fits and scores: perceptron, linear autoencoder, discriminator."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import vectors as V


def _with_features(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(V.doubles(F.col(vector))))


def vector_width(df: DataFrame, vector: str) -> int:
    """Width of the vector column, read from one row."""
    return df.select(F.size(vector).alias("d")).first()["d"]


@dataclass(frozen=True)
class Perceptron:
    model: MultilayerPerceptronClassificationModel
    vector: str

    def predict(self, df: DataFrame) -> DataFrame:
        """Add `prediction` and the class `probability` array."""
        out = self.model.transform(_with_features(df, self.vector)).drop("features", "rawPrediction")
        return out.withColumn("probability", vector_to_array("probability"))


def fit_perceptron(
    df: DataFrame,
    vector: str,
    label: str,
    classes: int,
    hidden: Sequence[int] = (32,),
    width: int | None = None,
    iterations: int = 60,
    seed: int = 7,
) -> Perceptron:
    """Fit hidden layers of the given sizes; without `width` it is read from the data."""
    d = vector_width(df, vector) if width is None else width
    train = _with_features(df, vector).select("features", F.col(label).cast("double").alias("label"))
    fitter = MultilayerPerceptronClassifier(
        layers=[d, *hidden, classes], maxIter=iterations, seed=seed, featuresCol="features", labelCol="label"
    )
    return Perceptron(fitter.fit(train), vector)


def accuracy(scored: DataFrame, label: str) -> float:
    judged = scored.select("prediction", F.col(label).cast("double").alias("label"))
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(judged)


@dataclass(frozen=True)
class LinearAutoencoder:
    """Encoder and decoder of a linear autoencoder at its optimum: the leading principal axes."""

    model: PCAModel
    mean: list[float]
    vector: str

    def encode(self, df: DataFrame, out: str = "code") -> DataFrame:
        axes = self._axes()
        shift = [-sum(a * m for a, m in zip(axis, self.mean)) for axis in axes]
        return df.withColumn(out, V.linear(F.col(self.vector), axes, shift))

    def decode(self, df: DataFrame, code: str = "code", out: str = "decoded") -> DataFrame:
        return df.withColumn(out, V.linear(F.col(code), list(zip(*self._axes())), self.mean))

    def reconstruct(self, df: DataFrame) -> DataFrame:
        """Add `code`, `decoded` and the mean squared `error` of each row."""
        both = self.decode(self.encode(df))
        off = F.zip_with(V.doubles(F.col(self.vector)), F.col("decoded"), lambda x, y: x - y)
        return both.withColumn("error", V.sum_of_squares(off) / F.size("decoded"))

    def _axes(self) -> list[list[float]]:
        return self.model.pc.toArray().T.tolist()


def fit_autoencoder(df: DataFrame, vector: str, code_width: int) -> LinearAutoencoder:
    """Distributed covariance, then its `code_width` leading axes."""
    from tokenloom.operators.statistics import fit_standardizer

    mean = fit_standardizer(df, vector).mean
    model = PCA(k=code_width, inputCol="features", outputCol="code").fit(_with_features(df, vector).select("features"))
    return LinearAutoencoder(model, mean, vector)


@dataclass(frozen=True)
class Discriminator:
    models: list[Perceptron]
    scored: DataFrame
    auc: float


def fit_discriminator(
    real: DataFrame,
    other: DataFrame,
    vector: str,
    key: str,
    hidden: int = 16,
    iterations: int = 60,
    folds: int = 3,
    seed: int = 7,
) -> Discriminator:
    """Tell rows of two tables apart, judged on rows the model has not seen.

    Rows fall into `folds` parts by a hash of `key`, and each part is scored by
    a model of the others. `scored` has the rows of both with `is_real` and
    `p_real`. An `auc` near 0.5 means the tables look alike, near 1 that they
    differ; it is the mean over the parts.
    """
    both = real.withColumn("is_real", F.lit(1)).unionByName(other.withColumn("is_real", F.lit(0)))
    both = both.withColumn("_fold", F.pmod(F.xxhash64(key), F.lit(folds)))
    judge = BinaryClassificationEvaluator(rawPredictionCol="p_real", labelCol="label")
    width, models, parts, areas = vector_width(both, vector), [], [], []
    for fold in range(folds):
        seen, unseen = both.filter(F.col("_fold") != fold), both.filter(F.col("_fold") == fold)
        models.append(fit_perceptron(seen, vector, "is_real", 2, [hidden], width, iterations, seed))
        part = models[-1].predict(unseen).withColumn("p_real", F.col("probability")[1])
        parts.append(part.drop("probability", "prediction", "_fold"))
        areas.append(judge.evaluate(parts[-1].select("p_real", F.col("is_real").cast("double").alias("label"))))
    return Discriminator(models, reduce(DataFrame.unionByName, parts), sum(areas) / folds)
