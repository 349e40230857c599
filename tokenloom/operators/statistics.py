"""Norms, clipping, column standardization and grouped softmax."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions import lists
from tokenloom.functions import vectors as V
from tokenloom.operators.joins import BROADCAST_BYTES, lookup, table_bytes
from tokenloom.session import materialize

# Fixed value: keeps the division defined for a zero norm.
CLIP_EPS = 1e-6
EMBEDDED_TOKENS = 16_384  # tokens whose vectors a task makes at a time
SUMMED_NUMBERS = 16_384  # numbers that are added at a time, so few that they stay near the processor


def global_norm(df: DataFrame, vector: str, by: Sequence[str] = ()) -> DataFrame:
    """L2 norm over all vectors of each group, or of everything."""
    square = V.sum_of_squares(V.doubles(F.col(vector)))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_parts"), F.sqrt(F.sum(square)).alias("norm"))


def clip_by_norm(df: DataFrame, vector: str, max_norm: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """Scale all vectors of a group by one factor so that their norm is at most `max_norm`."""
    norms = global_norm(df, vector, by)
    if by:
        joined = lookup(df, materialize(norms, "norms"), list(by), "inner", null_safe=True)
    else:
        joined = df.withColumn("norm", F.lit(norms.first()["norm"]))
    factor = F.least(F.lit(1.0), max_norm / (F.col("norm") + CLIP_EPS))
    scaled = V.once(factor, lambda f: V.scale(V.doubles(F.col(vector)), f))
    return joined.withColumn(vector, scaled).drop("norm", "n_parts")


@dataclass(frozen=True)
class Standardizer:
    """Mean and biased variance of each vector entry."""

    mean: list[float]
    variance: list[float]
    eps: float

    def apply(self, v: Column) -> Column:
        factor = [1.0 / (var + self.eps) ** 0.5 for var in self.variance]
        centred = F.zip_with(V.doubles(v), F.lit(self.mean).cast("array<double>"), lambda x, m: x - m)
        return F.zip_with(centred, F.lit(factor).cast("array<double>"), lambda x, f: x * f)


def _moments(df: DataFrame, vector: str, by: Sequence[str]) -> DataFrame:
    summary = Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(F.col(vector)))
    out = df.groupBy(*by).agg(summary.alias("s"))
    n = F.col("s.count")
    biased = F.transform(vector_to_array(F.col("s.variance")), lambda x: x * (n - 1) / n)
    return out.select(*by, vector_to_array(F.col("s.mean")).alias("_mean"), biased.alias("_variance"))


def fit_standardizer(df: DataFrame, vector: str, eps: float = V.NORM_EPS) -> Standardizer:
    """One pass over the table; what comes back is two numbers per vector entry."""
    row = _moments(df, vector, []).first()
    return Standardizer(list(row["_mean"]), list(row["_variance"]), eps)


def standardize_groups(df: DataFrame, vector: str, by: Sequence[str], eps: float = V.NORM_EPS) -> DataFrame:
    """Standardize each vector entry within its group."""
    stats = materialize(_moments(df, vector, by), "moments")
    joined = lookup(df, stats, list(by), "inner", null_safe=True)
    centred = F.zip_with(V.doubles(F.col(vector)), F.col("_mean"), lambda x, m: x - m)
    out = F.zip_with(centred, F.col("_variance"), lambda x, var: x / F.sqrt(var + eps))
    return joined.withColumn(vector, out).drop("_mean", "_variance")


def softmax_by(df: DataFrame, score: Column, by: Sequence[str], out: str = "weight") -> DataFrame:
    """Softmax of a score over the rows of each group, of any size.

    Two aggregates that combine inside the tasks, each looked up again; a group
    is never sorted or gathered.
    """
    scored = df.withColumn("_s", score.cast("double"))
    tops = materialize(scored.groupBy(*by).agg(F.max("_s").alias("_top")), "tops")
    lifted = lookup(scored, tops, list(by), "inner", null_safe=True).withColumn("_e", F.exp(F.col("_s") - F.col("_top")))
    sums = materialize(lifted.groupBy(*by).agg(F.sum("_e").alias("_z")), "sums")
    joined = lookup(lifted, sums, list(by), "inner", null_safe=True)
    return joined.withColumn(out, F.col("_e") / F.col("_z")).drop("_s", "_top", "_e", "_z")


def embed_ids(
    long: DataFrame, id_column: str, table: DataFrame, table_id: str, vector: str
) -> DataFrame:
    """Add each row's vector by its id; unknown ids keep a missing vector."""
    keyed = table.select(F.col(table_id).alias(id_column), F.col(vector).alias(vector))
    return lookup(long, keyed, [id_column], "left")


def embed_sequences(
    df: DataFrame,
    key: str,
    ids: str,
    table: DataFrame,
    table_id: str,
    vector: str,
    width: int,
    out: str = "vectors",
    max_bytes: int = BROADCAST_BYTES,
    fold: tuple[Callable[[pa.ListArray], list[pa.Array]], str] | None = None,
) -> DataFrame:
    """key and `out`: the vectors of a whole sequence of ids, in order; null for unknown and null ids.

    `table` has one vector of `width` numbers per id, and `key` is unique. A
    table of up to `max_bytes` is sent to the tasks as one matrix, from which
    they gather; no vector is shuffled. Of a larger one the vectors that the
    sequences name are kept, which ids of a vocabulary bound. Only if these are
    too many still, they are joined to the tokens, and the rows of each
    sequence are put in order again. Null sequences stay null.

    With `fold`, a function and the columns it makes, the whole vectors of
    pieces of rows are handed to it where they are, in the task, as the Arrow
    array that `out` would be; what it makes of them comes back in its place.
    """
    stored = table.schema[vector].dataType.simpleString()
    kind = stored if stored == "array<float>" else "array<double>"  # a float is a double of the same value
    known = table.select(F.col(table_id).cast("bigint").alias("_id"), F.col(vector).cast(kind).alias("_v"))
    known = known.filter(F.col("_id").isNotNull() & F.col("_v").isNotNull())
    key_kind = df.schema[key].dataType.simpleString()
    made, columns = fold or (lambda whole: [whole], f"`{out}` array<array<double>>")

    def batch(keys: pa.Array, whole: pa.ListArray) -> pa.RecordBatch:
        arrays = [keys, *made(whole)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    schema = T.StructType.fromDDL(f"`{key}` {key_kind}, {columns}")
    names = schema.names
    if table_bytes(known) > max_bytes:
        df = materialize(df.select(key, F.col(ids).cast("array<bigint>").alias(ids)), "sequences")
        named = df.select(F.explode(F.array_distinct(ids)).alias("_id")).distinct()
        known = materialize(known.join(named, "_id", "left_semi"), "named_vectors")
    if table_bytes(known) > max_bytes:
        long = df.select(key, F.col(ids).isNull().alias("_none"), F.posexplode_outer(ids).alias("_pos", "_id"))
        placed = F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_v"))
        found = lookup(long, known, ["_id"], "left", 0).groupBy(key)
        found = found.agg(F.array_sort(F.collect_list(placed)).alias("_s"), F.max("_none").alias("_none"))
        found = found.select(key, F.when(~F.col("_none"), F.col("_s")["_v"].cast("array<array<double>>")).alias(out))

        def pass_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                for start, stop in lists.pieces(lists.lengths(rows.column(1)), EMBEDDED_TOKENS):
                    part = rows.slice(start, stop - start)
                    yield batch(part.column(0), part.column(1))

        return found.mapInArrow(pass_by, schema) if fold else found
    rows = known.toArrow()
    order = np.argsort(rows.column(0).to_numpy(), kind="stable")
    numbers = rows.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if len(numbers) != len(order) * width:
        raise ValueError(f"vectors do not all have {width} entries")
    shared = df.sparkSession.sparkContext.broadcast((rows.column(0).to_numpy()[order], numbers.reshape(-1, width)[order]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named, vectors = shared.value
        for rows in batches:
            for start, stop in lists.pieces(lists.lengths(rows.column(1)), EMBEDDED_TOKENS):
                part = rows.slice(start, stop - start)
                wanted = part.column(1).flatten()
                missing = wanted.is_null().to_numpy(zero_copy_only=False)
                number = wanted.fill_null(0).to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(named, number), max(len(named) - 1, 0))
                hit = (named[at] == number) & ~missing if len(named) else np.zeros(len(number), dtype=bool)
                sizes = np.where(hit, width, 0)
                each = lists.regroup(vectors[at[hit]].ravel().astype(float), sizes, pa.array(~hit))
                whole = lists.regroup(each, lists.lengths(part.column(1)), part.column(1).is_null())
                yield batch(part.column(0), whole)

    coded = df.select(F.col(key).alias("key"), F.col(ids).cast("array<bigint>").alias("ids"))
    return coded.mapInArrow(gather, schema)


SEQUENCE_SUMS = "n_tokens bigint, n_found bigint, v_sum double, v_weighted double"


def sequence_sums(whole: pa.ListArray, cycle: int) -> list[pa.Array]:
    """`SEQUENCE_SUMS` of sequences of vectors, a fold of `embed_sequences`.

    How many vectors a sequence has, how many of them are there, the sum of all
    their numbers, and the same with weights that go from 1 to `cycle` and
    round again along the whole sequence. Sums are taken in order; they are
    missing where a vector or a number is. All are of a missing sequence.
    """
    sizes, vectors = lists.lengths(whole), whole.flatten()
    ends = np.cumsum(sizes)
    within = lambda x: (c := np.concatenate([[0], np.cumsum(x)]))[ends] - c[ends - sizes]
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    found, numbers = within(there), vectors.flatten()
    bounds = np.concatenate([[0], np.cumsum(within(lists.lengths(vectors)))])
    holes = np.flatnonzero(numbers.is_null().to_numpy(zero_copy_only=False)) if numbers.null_count else np.zeros(0, int)
    none = whole.is_null().to_numpy(zero_copy_only=False)
    cut = none | (found < sizes) | (np.diff(np.searchsorted(holes, bounds)) > 0)
    step = cycle * max(SUMMED_NUMBERS // cycle, 1)
    weights, held = np.arange(step) % cycle + 1.0, np.empty(step, dtype=complex)
    sums, x = np.zeros(len(sizes), dtype=complex), numbers.to_numpy(zero_copy_only=False)
    for at in np.flatnonzero(~cut):
        for start in range(bounds[at], bounds[at + 1], step):  # a running sum adds in order, here two at a time
            part = x[start : min(start + step, bounds[at + 1])]
            run = held[: len(part)]
            run.real = part
            np.multiply(part, weights[: len(part)], out=run.imag)
            run[0] += sums[at]
            sums[at] = np.add.accumulate(run, out=run)[-1]
    counts = [pa.array(n.astype(np.int64), mask=none) for n in (sizes, found)]
    return counts + [pa.array(total, mask=cut) for total in (sums.real.copy(), sums.imag.copy())]
