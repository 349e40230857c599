"""Sinks: the metrics log, the keyed activation store, chat requests and replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text
from tokenloom.functions import vectors as V

METRICS = "run string, epoch int, step bigint, name string, value double"


def as_metrics(df: DataFrame, run: str, epoch: Column, step: Column, names: Sequence[str]) -> DataFrame:
    """Numeric columns to one row per named scalar."""
    scalars = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names])
    return df.select(
        F.lit(run).alias("run"),
        epoch.cast("int").alias("epoch"),
        step.cast("bigint").alias("step"),
        F.inline(scalars),
    )


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append to the metrics log, partitioned by run and name."""
    metrics.select("run", "epoch", "step", "name", "value").write.mode("append").partitionBy("run", "name").parquet(path)


def read_metrics(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    log = spark.read.schema(METRICS).parquet(path)
    return log if run is None else log.filter(F.col("run") == run)


def first_writes(df: DataFrame, key: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """The earliest write of each key wins; `n_dropped` counts the later ones.

    A minimum that combines inside the tasks, so any number of copies of one
    key reaches the final task as one row per input task.
    """
    first = F.min_by(F.struct(order, *columns), F.col(order)).alias("_f")
    out = df.groupBy(*key).agg(first, (F.count(F.lit(1)) - 1).alias("n_dropped"))
    return out.select(*key, *[F.col("_f")[c].alias(c) for c in (order, *columns)], "n_dropped")


def capture_layers(df: DataFrame, key: Sequence[str], v: Column, layers: Sequence[V.Layer]) -> DataFrame:
    """key, layer, activation: what every layer of a stored net makes of each vector, in one pass.

    Layers are named `layer_1` and on. A layer takes the column of the one
    before; a null vector has null activations.
    """
    out = df.select(*key, V.doubles(v).alias("_0"))
    for i, layer in enumerate(layers):
        made = V.perceptron(F.col(f"_{i}"), [layer])
        out = out.withColumn(f"_{i + 1}", F.when(F.col(f"_{i}").isNotNull(), made))
    rows = [F.struct(F.lit(f"layer_{i + 1}").alias("layer"), F.col(f"_{i + 1}").alias("activation")) for i in range(len(layers))]
    return out.select(*key, F.inline(F.array(*rows)))


def save_cache(df: DataFrame, path: str, layer: str = "layer") -> None:
    """Write a (sample, layer, activation) table with one folder per layer."""
    df.write.partitionBy(layer).parquet(path)


def read_cache(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """Read it back; a single layer reads only its own folder."""
    df = spark.read.parquet(path)
    return df if layer is None else df.filter(F.col("layer") == layer)


def chat_requests(
    df: DataFrame,
    key: Sequence[str],
    prompt: Column,
    model: str,
    system: Column | str = text.SYSTEM_TEXT,
    temperature: float = 0.1,
    max_tokens: int = 100,
) -> DataFrame:
    """One JSON request per row: model, system and user message, sampling settings."""
    system = F.lit(system) if isinstance(system, str) else system
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(text.message("system", system), text.message("user", prompt)).alias("messages"),
        F.lit(temperature).alias("temperature"),
        F.lit(max_tokens).alias("max_tokens"),
    )
    return df.select(*key, F.to_json(body).alias("request"))


def chat_replies(df: DataFrame, key: Sequence[str], reply: str = "reply") -> DataFrame:
    """The text of the first choice of each JSON reply."""
    return df.select(*key, F.get_json_object(reply, "$.choices[0].message.content").alias("content"))
