"""Read text corpora and the project's tables, at once or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("parquet", "json", "orc", "text")


def read_corpus(
    spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType | str | None = None, text: str = "text"
) -> DataFrame:
    """A lazily read corpus; fails before any job if the text column is missing.

    Plain text files give one row per line, in a column of that name.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    if format == "json" and schema is None:
        raise ValueError("give a schema for json, so that nothing has to be read to find one")
    reader = spark.read.format(format)
    df = (reader.schema(schema) if schema is not None and format != "text" else reader).load(path)
    if format == "text":
        df = df.withColumnRenamed("value", text)
    if text not in df.columns or df.schema[text].dataType != T.StringType():
        raise ValueError(f"{path} has no string column {text!r}")
    return df


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part of a table that is stored in fewer pieces than there are cores.

    Meant for heavy work on single rows, such as tokenizing. A table of many
    files already has more pieces than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, **options: str) -> DataFrame:
    """The same table as a stream of files, whether it is one file or a folder."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).options(**options).parquet(f"{folder}/{name}.parquet*")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Document ids and texts, spread over the cores."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"))
