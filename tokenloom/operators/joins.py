"""Look rows up in a table with unique keys, whatever the size and skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def _width(field: T.StructField) -> Column:
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(col)
    elif isinstance(kind, (T.StructType, T.MapType)) or (
        isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.NumericType)
    ):
        size = F.octet_length(F.to_json(F.struct(col)))
    elif isinstance(kind, T.ArrayType):
        size = F.size(col) * 8
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(0)).cast("long") + 8


def table_bytes(df: DataFrame) -> int:
    """In-memory size of `df`, measured in one scan that returns one number."""
    row = sum((_width(f) for f in df.schema.fields), F.lit(0).cast("long"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"]


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    null_safe: bool = False,
) -> DataFrame:
    """Join `facts` to `table`, which holds at most one row per key.

    `table` should be stored (a source, or the result of `materialize`), since
    its size is measured first. Up to `max_bytes` it is broadcast and `facts`
    is not shuffled. Above that both sides are shuffled by key; `table` cannot
    be skewed, its keys being unique, and a key that fills much of `facts` is
    split over several tasks by adaptive execution, which the session of
    `tokenloom.session` has on. With `null_safe` a null key meets a null key,
    as it must where `table` was made by grouping `facts`.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup supports left and inner, not {how!r}")
    if table_bytes(table) <= max_bytes:
        table = F.broadcast(table)
    if not null_safe:
        return facts.join(table, on, how)
    for key in on:
        table = table.withColumnRenamed(key, f"__{key}")
    same = [F.col(f"`{key}`").eqNullSafe(F.col(f"`__{key}`")) for key in on]
    return facts.join(table, same, how).drop(*[f"__{key}" for key in on])
