"""Rows by their place in stored files: no key, no sort and no shuffle.

Parquet readers know which file a row is from and its number inside it. With
the files in order of their paths and the rows of each counted from its footer,
that is a place in the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.joins import lookup

PATH, ROW = "_metadata.file_path", "_metadata.row_index"


def file_counts(df: DataFrame) -> list[tuple[str, int]]:
    """(path, rows) of every file with rows, in order of the paths.

    Reads footers only. One entry per file comes to the driver, which has
    listed the same files to plan the scan.
    """
    counted = df.groupBy(F.col(PATH).alias("path")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["path"], r["n"]) for r in counted)


def _starts(counts: Sequence[tuple[str, int]]) -> list[tuple[str, int, int]]:
    """(path, first place, place behind the last)."""
    out, at = [], 0
    for path, n in counts:
        out.append((path, at, at + n))
        at += n
    return out


def _placed(df: DataFrame, starts: Sequence[tuple[str, int, int]], name: str) -> DataFrame:
    columns = df.columns
    if len(starts) <= 1:
        return df.select(*columns, (F.col(ROW) + F.lit(starts[0][1] if starts else 0)).cast("bigint").alias(name))
    files = df.sparkSession.createDataFrame([(p, lo) for p, lo, _ in starts], "_file string, _start bigint")
    rows = lookup(df.select(*columns, F.col(PATH).alias("_file"), F.col(ROW).alias("_row")), files, ["_file"], "inner")
    return rows.select(*columns, (F.col("_start") + F.col("_row")).alias(name))


def with_file_position(df: DataFrame, name: str = "idx") -> DataFrame:
    """Add the place 0 to n - 1 of each row in the table that `df` was read from.

    `df` is a Parquet table as read, before filters and joins: places are those
    of the stored rows. Nothing is shuffled; a table of files and their first
    places goes to the tasks.
    """
    return _placed(df, _starts(file_counts(df)), name)


def file_slice(spark: SparkSession, path: str | Sequence[str], start: int, stop: int, name: str | None = None) -> DataFrame:
    """Rows `[start, stop)` of a stored Parquet table, with their place as `name` if wanted.

    Only the files that the slice meets are read, and only the first and last
    of them are cut.
    """
    if not 0 <= start <= stop:
        raise ValueError("need 0 <= start <= stop")
    whole = spark.read.parquet(*([path] if isinstance(path, str) else path))
    met = [(p, lo, hi) for p, lo, hi in _starts(file_counts(whole)) if lo < stop and hi > start]
    if not met or start == stop:
        out = whole.limit(0)
        return out.withColumn(name, F.lit(None).cast("bigint")) if name else out
    place = name or "__place"
    some = spark.read.schema(whole.schema).parquet(*[unquote(p) for p, *_ in met])
    cut = F.lit(True)
    if met[0][1] < start:
        cut = cut & ((F.col(PATH) != met[0][0]) | (F.col(ROW) >= start - met[0][1]))
    if met[-1][2] > stop:
        cut = cut & ((F.col(PATH) != met[-1][0]) | (F.col(ROW) < stop - met[-1][1]))
    some = some.filter(cut)
    return _placed(some, met, place) if name else some
