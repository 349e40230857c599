"""Token-id arrays: masking, shifting, padding and slicing, all row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels that downstream losses and lookups rely on.
IGNORE_ID = -100
VOCABULARY_SIZE = 100_277
PAD_ID = VOCABULARY_SIZE - 1


def whole(x: Column | str, n: int) -> Column:
    """How often `n` goes into the whole number `x`, without a detour over fractions."""
    x = F.col(x) if isinstance(x, str) else x
    return F.call_function("div", x, F.lit(n).cast("bigint"))


def masked_labels(ids: Column, prompt_length: Column, ignore: int = IGNORE_ID) -> Column:
    """Ids with the first `prompt_length` of them replaced by the ignore id."""
    return F.transform(ids, lambda x, i: F.when(i < prompt_length, F.lit(ignore).cast("bigint")).otherwise(x))


def supervised(labels: Column, ignore: int = IGNORE_ID) -> Column:
    """The labels that count in a loss."""
    return F.filter(labels, lambda x: x != ignore)


def all_but_last(items: Column) -> Column:
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0)))


def all_but_first(items: Column) -> Column:
    return F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0)))


def last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def shifted(ids: Column) -> Column:
    """Next-token pairs of a sequence: `inputs` and the `targets` one step on."""
    return F.struct(all_but_last(ids).alias("inputs"), all_but_first(ids).alias("targets"))


def next_pairs(items: Column) -> Column:
    """`{current, next}` for each neighbouring pair in the sequence."""
    return F.arrays_zip(all_but_last(items).alias("current"), all_but_first(items).alias("next"))


def pad_right(ids: Column, width: Column, pad: int = PAD_ID) -> Column:
    fill = F.array_repeat(F.lit(pad).cast("bigint"), (width - F.size(ids)).cast("int"))
    return F.concat(ids, fill)


def positions(items: Column) -> Column:
    """0..n-1 for an array of n items."""
    return F.transform(items, lambda _, i: i.cast("bigint"))


def chunks(items: Column, parts: int) -> Column:
    """Split into equal parts; the length must be a multiple of `parts`."""
    size = (F.size(items) / parts).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice(items, p * size + 1, size))
    return F.when(F.size(items) % parts == 0, cut).otherwise(
        F.raise_error(F.concat(F.lit("length is not a multiple of "), F.lit(parts)))
    )


def as_text(items: Column, separator: str = ",") -> Column:
    return F.array_join(F.transform(items, lambda x: x.cast("string")), separator)
