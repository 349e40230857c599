"""Batches, padding, repetition and accumulation groups over ordered rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.functions import arrays
from tokenloom.operators.joins import lookup
from tokenloom.operators.order import row_slice, with_row_index
from tokenloom.session import materialize


def with_batch(df: DataFrame, order: str | Sequence[str], size: int) -> DataFrame:
    """Add `batch_id` and the place `slot` in it; the last batch may be short."""
    if size < 1:
        raise ValueError("size must be positive")
    out = with_row_index(df, order, name="_idx")
    out = out.withColumn("batch_id", arrays.whole("_idx", size)).withColumn("slot", F.col("_idx") % size)
    return out.drop("_idx")


def to_columnar(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per batch with each column as an array, in slot order."""
    rows = F.array_sort(F.collect_list(F.struct("slot", *columns)))
    return df.groupBy("batch_id").agg(rows.alias("_r")).select("batch_id", *[F.col("_r")[c].alias(c) for c in columns])


def to_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Back from columnar batches to rows."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.posexplode(F.arrays_zip(*columns)).alias("slot", "_x")).select(
        *kept, F.col("slot").cast("bigint").alias("slot"), *[F.col("_x")[c].alias(c) for c in columns]
    )


def pad_batches(df: DataFrame, ids: str, pad: int = arrays.PAD_ID) -> DataFrame:
    """Right-pad every row to the longest of its batch; adds `width`.

    A batch has a fixed number of rows, so the window over it is small.
    """
    width = F.max(F.size(ids)).over(W.partitionBy("batch_id"))
    return df.withColumn("width", width).withColumn(ids, arrays.pad_right(F.col(ids), F.col("width"), pad))


def padded_batches(df: DataFrame, order: str, ids: str, size: int, pad: int = arrays.PAD_ID) -> DataFrame:
    """`with_batch` and `pad_batches` in one, along the unique key `order`.

    `df` is written once. Batches and widths are worked out on keys and lengths
    alone; the arrays move only if that table is too large to broadcast.
    """
    stored = materialize(df.withColumn("_length", F.size(ids)), "sequences")
    places = with_batch(stored.select(order, "_length"), order, size)
    places = places.withColumn("width", F.max("_length").over(W.partitionBy("batch_id"))).drop("_length")
    out = lookup(stored.drop("_length"), materialize(places, "places"), [order], null_safe=True)
    return out.withColumn(ids, arrays.pad_right(F.col(ids), F.col("width"), pad))


def length_batches(
    df: DataFrame, order: str, ids: str, size: int, pad: int = arrays.PAD_ID, name: str = "idx"
) -> DataFrame:
    """Padded batches of rows of like length, longest first; `name` is a row's place along the unique key `order`.

    Adds `batch_id`, `slot`, `width` and `name`, by which the rows can be put
    back in order. Ties in length follow `order`. Null arrays count as empty
    and stay null. As in `padded_batches`, lengths alone are put in order: they
    are cut into ranges, one that many rows share by the key as well, and the
    arrays move only if the table of places is too large to broadcast.
    """
    stored = materialize(df.withColumn("_length", F.coalesce(F.array_size(ids), F.lit(0))), "sequences")
    keys = with_row_index(stored.select(order, (-F.col("_length")).alias("_shorter")), order, name=name)
    places = with_batch(keys, ["_shorter", order], size)
    places = places.withColumn("width", F.max(-F.col("_shorter")).over(W.partitionBy("batch_id"))).drop("_shorter")
    out = lookup(stored.drop("_length"), materialize(places, "places"), [order], null_safe=True)
    return out.withColumn(ids, arrays.pad_right(F.col(ids), F.col("width"), pad))


def first_batches(df: DataFrame, order: str, size: int, batches: int) -> DataFrame:
    """The rows of the first `batches` batches, with `batch_id` and `slot`; only they are indexed in full."""
    return with_batch(row_slice(df, order, 0, size * batches), order, size)


def repeat_epochs(df: DataFrame, order: str, epochs: int, rows_per_epoch: int | None = None) -> DataFrame:
    """The same leading rows once per epoch, unshuffled, with a global `step`."""
    indexed = with_row_index(df, order, name="idx")
    rows = df.count()
    if rows_per_epoch is not None:
        rows = min(rows, rows_per_epoch)
        indexed = indexed.filter(F.col("idx") < rows_per_epoch)
    n = F.lit(rows).cast("bigint")
    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    return indexed.select("*", epoch).withColumn("step", F.col("epoch") * n + F.col("idx"))


def accumulate(
    df: DataFrame, order: str, value: Column, steps: int, keep_incomplete: bool = False
) -> DataFrame:
    """Mean of `value` per optimizer step, a step being `steps` consecutive rows.

    An incomplete last group makes no update and is left out unless
    `keep_incomplete`.
    """
    rows = with_row_index(df.select(order, value.cast("double").alias("_v")), order, name="_idx")
    out = rows.groupBy(arrays.whole("_idx", steps).alias("step")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("_v") / steps).alias("loss")
    )
    return out if keep_incomplete else out.filter(F.col("n_rows") == steps)


def cosine_rate(step: Column, steps: Column, start: float, end: float = 0.0) -> Column:
    """The learning rate of a step on a half cosine from `start` at step 0 to `end` at step `steps`."""
    return F.lit(end) + (start - end) * (1.0 + F.cos(math.pi * step / steps)) / 2.0


def shape_report(df: DataFrame, ids: str) -> DataFrame:
    """Rows, width, real slots and fill ratio of each batch."""
    out = df.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.size(ids)).cast("bigint").alias("width"),
        F.sum(F.size(ids)).alias("n_real"),
    )
    return out.withColumn("fill", F.col("n_real") / (F.col("n_rows") * F.col("width")))
