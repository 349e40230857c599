"""Pack token sequences end to end into rows of a fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.arrays import whole
from tokenloom.operators.joins import lookup
from tokenloom.operators.order import with_running_total
from tokenloom.session import materialize


def pack(
    df: DataFrame,
    columns: Sequence[str],
    size: int,
    start: str,
    group: Sequence[str] = (),
    name: str = "pack_id",
) -> DataFrame:
    """Cut equally long arrays, placed at offset `start`, into packs of `size` entries.

    Each row is sliced at the pack borders and the pieces are brought together
    by pack, so a task never holds more than `size` entries of a pack, and the
    shuffle moves pieces, not single tokens. The last pack may be short.
    """
    if size < 1:
        raise ValueError("size must be positive")
    first, length = columns[0], F.size(columns[0])
    lo, hi = whole(start, size), whole(F.col(start) + length - 1, size)

    def piece(p):
        begin = F.greatest(p * size - F.col(start), F.lit(0))
        end = F.least((p + 1) * size - F.col(start), length.cast("bigint"))
        cut = [F.slice(F.col(c), (begin + 1).cast("int"), (end - begin).cast("int")).alias(c) for c in columns]
        return F.struct(p.alias(name), (F.col(start) + begin).alias("_at"), *cut)

    pieces = df.filter(F.size(first) > 0).select(*group, F.inline(F.transform(F.sequence(lo, hi), piece)))
    packs = pieces.groupBy(*group, name).agg(F.array_sort(F.collect_list(F.struct("_at", *columns))).alias("_p"))
    return packs.select(*group, name, *[F.flatten(F.col("_p")[c]).alias(c) for c in columns])


def place_arrays(df: DataFrame, key: Sequence[str], order: str, array: str, group: Sequence[str] = ()) -> DataFrame:
    """Add `_start`, the number of entries of `array` in all earlier rows along `order`, per `group` if given.

    `df` is written once, so whatever made its arrays runs once. The starts are
    worked out on keys and lengths alone and looked up by the unique `key`; the
    arrays move only if the table of starts is too large to broadcast.
    """
    stored = materialize(df.withColumn("_length", F.size(array)), "arrays")
    lengths = stored.select(*key, "_length")
    starts = with_running_total(lengths, order, F.col("_length"), "_start", group=group).drop("_length")
    return lookup(stored.drop("_length"), materialize(starts, "starts"), list(key), null_safe=True)


def pack_sequences(df: DataFrame, order: str, tokens: str, size: int = 512) -> DataFrame:
    """Concatenate token arrays along the unique key `order` and cut every `size` tokens."""
    placed = place_arrays(df.select(order, tokens), [order], order, tokens)
    return pack(placed, [tokens], size, start="_start")
