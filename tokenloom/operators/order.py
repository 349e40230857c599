"""Row numbers and running totals without moving all rows to one task.

Spark has no file order, so every order-sensitive operator names its order
key. A window without partition columns would put the whole table into one
task, and a window by group alone would do so for a hot group. Here the order
key is cut into ranges of about equal row count; ranks and totals are taken
inside each range, and the total of the earlier ranges is added.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.operators.joins import lookup
from tokenloom.session import materialize

ROWS_PER_RANGE = 400
MAX_RANGES = 10_000
SAMPLES_PER_RANGE = 200
EXACT_DOUBLE = float(2**53)


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _as_double(df: DataFrame, name: str) -> Column:
    """The order key as a double; equal or growing wherever the key grows."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        whole = (F.unix_date(col.cast("date")) * 24 + F.hour(col)) * 60 + F.minute(col)
        return (whole * 60_000_000.0 + (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("long")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    raise TypeError(f"order key {name!r} must be numeric, date or timestamp, not {kind.simpleString()}")


def _cut_points(df: DataFrame, key: Column, ranges: int, rows: int) -> list[float]:
    """About `ranges` - 1 quantiles of the key, repeated where one value is hot.

    The quantiles come from a bounded sample. They only decide where ranges
    begin, never which rows are kept or how they are numbered.
    """
    keys = df.select(key.alias("k"))
    share = SAMPLES_PER_RANGE * ranges / rows
    if share < 1.0:
        keys = keys.sample(fraction=share, seed=17)
    steps = [i / ranges for i in range(1, ranges)]
    found = keys.agg(F.percentile_approx("k", steps, 100 * ranges).alias("q")).first()["q"]
    return list(found or [])


def _bucket(df: DataFrame, key: Column, points: list[float], name: str) -> DataFrame:
    splits = [-math.inf, *sorted({p for p in points if math.isfinite(p)}), math.inf]
    if len(splits) == 2:
        return df.withColumn(name, F.lit(0))
    cut = Bucketizer(splits=splits, inputCol="_key", outputCol=name, handleInvalid="error")
    return cut.transform(df.withColumn("_key", key)).drop("_key").withColumn(name, F.col(name).cast("int"))


def cut_into_ranges(
    df: DataFrame, order: str | Sequence[str], rows_per_range: int = ROWS_PER_RANGE, max_ranges: int = MAX_RANGES
) -> tuple[DataFrame, int]:
    """Add `_range`, a number that never falls along `order`; also return how many there are.

    A value of the first order column that fills whole ranges by itself gets a
    range of its own, which the second order column then cuts further.
    """
    order = _names(order)
    first = _as_double(df, order[0])
    rows = df.count()
    ranges = min(max_ranges, math.ceil(rows / rows_per_range))
    if ranges <= 1:
        return df.withColumn("_range", F.lit(0)), 1
    points = _cut_points(df, first, ranges, rows)
    hot = sorted({a for a, b in zip(points, points[1:]) if a == b and abs(a) < EXACT_DOUBLE})
    points += [math.nextafter(p, math.inf) for p in hot]
    out = _bucket(df, first, points, "_range")
    if not hot or len(order) == 1:
        return out, len(set(points)) + 1
    second = _as_double(df, order[1])
    inner = _cut_points(df.filter(first.isin(hot)), second, ranges, rows)
    out = _bucket(out, second, inner, "_inner")
    width = len(set(inner)) + 1
    inside = F.when(first.isin(hot), F.col("_inner")).otherwise(F.lit(0))
    return out.withColumn("_range", F.col("_range") * width + inside).drop("_inner"), (len(set(points)) + 1) * width


def with_running_total(
    df: DataFrame,
    order: str | Sequence[str],
    measure: Column,
    name: str,
    group: str | Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add the total of `measure` over all earlier rows, per `group` if given.

    `order` must be unique within a group. `df` is shuffled once, by group and
    range. What came before each range joins it as one extra first row, so
    that a single running sum inside the range gives the answer. Only groups
    of more rows than a range has are cut; the others are a range each.
    """
    order, group = _names(order), _names(group)
    out, ranges = cut_into_ranges(df, order, rows_per_range)
    if group and ranges > 1:
        sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
        limit = max(rows_per_range, df.count() // MAX_RANGES)  # what a range holds
        large = materialize(sizes.filter(F.col("_size") > limit), "large_groups")
        out = lookup(out, large, group, null_safe=True)
        out = out.withColumn("_range", F.when(F.col("_size").isNotNull(), F.col("_range")).otherwise(F.lit(0)))
    out = out.withColumn("_measure", measure.cast("long")).withColumn("_row", F.lit(1))
    keys = [*group, "_range"]
    if ranges > 1:
        cut = out
        if group:
            cut, out = out.filter(F.col("_size").isNotNull()), out.drop("_size")
        totals = cut.groupBy(*keys).agg(F.sum("_measure").alias("_total"))
        # At most one row per range in each of these windows.
        earlier = W.partitionBy(*(group or [F.lit(0)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
        before = totals.select(*keys, F.sum("_total").over(earlier).alias("_measure"), F.lit(0).alias("_row"))
        out = out.unionByName(before.filter(F.col("_measure").isNotNull()), allowMissingColumns=True)
    running = W.partitionBy(*keys).orderBy("_row", *order).rowsBetween(W.unboundedPreceding, -1)
    summed = out.withColumn(name, F.coalesce(F.sum("_measure").over(running), F.lit(0).cast("long")))
    return summed.filter(F.col("_row") == 1).drop("_measure", "_row", "_range")


def with_row_index(
    df: DataFrame,
    order: str | Sequence[str],
    group: str | Sequence[str] = (),
    name: str = "idx",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add the position 0..n-1 of each row along `order`, per `group` if given."""
    return with_running_total(df, order, F.lit(1), name, group, rows_per_range)


def row_slice(df: DataFrame, order: str, start: int, stop: int) -> DataFrame:
    """Rows `[start, stop)` along the unique key `order`.

    Positions are worked out on the key column alone. A slice is one stretch of
    the key, so its first and last key become a filter that the scan can use,
    and no payload is shuffled.
    """
    if not 0 <= start <= stop:
        raise ValueError("need 0 <= start <= stop")
    keys = with_row_index(df.select(order), order, name="_idx")
    wanted = keys.filter((F.col("_idx") >= start) & (F.col("_idx") < stop))
    ends = wanted.agg(F.min(order).alias("first"), F.max(order).alias("last")).first()
    if ends["first"] is None:
        return df.limit(0)
    return df.filter(F.col(order).between(F.lit(ends["first"]), F.lit(ends["last"])))


def every_nth(df: DataFrame, order: str | Sequence[str], n: int, name: str = "idx") -> DataFrame:
    """Every n-th row along `order`: those where (index + 1) is a multiple of n."""
    if n < 1:
        raise ValueError("n must be positive")
    return with_row_index(df, order, name=name).filter((F.col(name) + 1) % n == 0)
