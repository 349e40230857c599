"""Ordered series: moving-window convolution, pooling and recurrent folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.functions import lists
from tokenloom.functions import vectors as V
from tokenloom.functions.arrays import whole
from tokenloom.session import materialize

Matrix = Sequence[Sequence[float]]
Cell = Callable[[np.ndarray, np.ndarray], np.ndarray]  # states and inputs, one row a sequence, to the next states
STEPS_PER_TABLE = 10
BLOCK = 1024


def convolve(
    df: DataFrame,
    key: Sequence[str],
    index: str,
    channels: Sequence[str],
    weight: Sequence[Matrix],
    bias: Sequence[float] | None = None,
    stride: int = 1,
    padding: int = 0,
    activation: V.Activation = V.identity,
) -> DataFrame:
    """1-D convolution (cross-correlation) of each key's series, zero padded.

    `index` is the position 0..L-1 in the series, `weight[o][c][j]` the kernel
    from input channel c to output channel o. Output `idx` runs over
    0..floor((L + 2 padding - k) / stride), with columns y0, y1, ...

    The series is cut into blocks, and each block also gets the first rows of
    the next one, as far as the kernel reaches. So a window inside the block
    sees all it needs, one shuffle moves hardly more than the rows themselves,
    and a long series is never brought together in one place.
    """
    kernel, p = len(weight[0][0]), padding
    bias = bias if bias is not None else [0.0] * len(weight)
    if padding < 0 or stride < 1:
        raise ValueError("padding must not be negative, stride must be positive")
    names = [f"y{o}" for o in range(len(weight))]
    block, reach = max(BLOCK, 4 * kernel), max(kernel - 1, 1)

    # The first row of a series also stands for the padding before it.
    index_of = F.col(index).cast("bigint")
    places = F.when(index_of == 0, F.sequence(F.lit(0), F.lit(p)).cast("array<bigint>")).otherwise(F.array(index_of + p))
    raw = df.select(*key, F.explode(places).alias("_pos"), *[F.col(c).cast("double").alias(c) for c in channels])
    padded = raw.select(*key, "_pos", *[F.when(F.col("_pos") < p, 0.0).otherwise(F.col(c)).alias(c) for c in channels])

    own = whole("_pos", block)
    also_before = (F.col("_pos") % block < reach) & (own > 0)
    blocks = F.when(also_before, F.array(own, own - 1)).otherwise(F.array(own))
    rows = padded.withColumn("_block", F.explode(blocks))
    ahead = W.partitionBy(*key, "_block").orderBy("_pos")

    def output(o: int) -> Column:
        total = F.lit(float(bias[o]))
        for c, name in enumerate(channels):
            for j in range(kernel):
                value = F.lead(name, j, 0.0).over(ahead) if j else F.col(name)
                total = total + F.lit(float(weight[o][c][j])) * value
        return activation(total)

    # Up to `p` values may be missing at the end: they are padding.
    needed = kernel - 1 - p
    complete = F.lead("_pos", needed).over(ahead).isNotNull() if needed > 0 else F.lit(True)
    worked = rows.select(
        *key,
        "_pos",
        (own == F.col("_block")).alias("_own"),
        complete.alias("_complete"),
        F.lead("_pos", 1).over(ahead).isNull().alias("_last"),
        *[output(o).alias(n) for o, n in enumerate(names)],
    ).filter("_own")
    out = worked.filter("_complete").select(*key, "_pos", *names)
    if p >= kernel:  # windows that lie in the padding after the last row
        beyond = F.explode(F.sequence(F.col("_pos") + 1, F.col("_pos") + p - kernel + 1)).alias("_pos")
        empty = [activation(F.lit(float(b))).alias(n) for n, b in zip(names, bias)]
        out = out.unionByName(worked.filter("_last").select(*key, beyond, *empty))
    return out.filter(F.col("_pos") % stride == 0).select(*key, whole("_pos", stride).alias("idx"), *names)


def convolve_vectors(
    df: DataFrame,
    key: Sequence[str],
    index: str,
    vector: str,
    weight: np.ndarray | Sequence[Matrix],
    bias: Sequence[float] | None = None,
    stride: int = 1,
    padding: int = 0,
    activation: V.Activation | None = None,
) -> DataFrame:
    """`convolve` for many channels: `vector` holds a row's input channels, `y` its output channels.

    The series is cut into the same overlapping blocks, one row each. In a
    task the windows of a block are gathered into one matrix and multiplied by
    the kernels as another, so the plan is the same for any number of channels
    and taps. A null vector or entry makes the windows over it NaN.
    """
    w = np.asarray(weight, dtype=float)
    outputs, inputs, kernel = w.shape
    b = np.zeros(outputs) if bias is None else np.asarray(bias, dtype=float)
    p = padding
    if padding < 0 or stride < 1:
        raise ValueError("padding must not be negative, stride must be positive")
    size, reach = max(BLOCK, 4 * kernel), max(kernel - 1, 1)

    index_of = F.col(index).cast("bigint")
    places = F.when(index_of == 0, F.sequence(F.lit(0), F.lit(p)).cast("array<bigint>")).otherwise(F.array(index_of + p))
    entries = F.coalesce(V.doubles(F.col(vector)), F.array_repeat(F.lit(float("nan")), inputs))
    raw = df.select(*key, F.explode(places).alias("_pos"), entries.alias("_v"))
    padded = raw.select(*key, "_pos", F.when(F.col("_pos") < p, F.array_repeat(F.lit(0.0), inputs)).otherwise(F.col("_v")).alias("_v"))
    own = whole("_pos", size)
    also_before = (F.col("_pos") % size < reach) & (own > 0)
    rows = padded.withColumn("_block", F.explode(F.when(also_before, F.array(own, own - 1)).otherwise(F.array(own))))
    held = F.array_sort(F.collect_list(F.struct("_pos", "_v")))  # at most `size` + `reach` rows
    blocks = rows.groupBy(*key, "_block").agg(held.alias("_rows"))
    kernels = w.transpose(1, 2, 0).reshape(inputs * kernel, outputs)

    def windows(first: int, block: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of one block begin, and their outputs; `x` begins at place `first`."""
        after = (block + 1) * size - first  # rows from here on belong to the next block
        n, needed = min(len(x), after), max(kernel - 1 - p, 0)
        starts = np.arange(min(n, len(x) - needed))
        starts = starts[(starts + first) % stride == 0]
        ahead = np.concatenate([x, np.zeros((kernel, inputs))])
        seen = np.lib.stride_tricks.sliding_window_view(ahead, kernel, axis=0)[starts]
        found = seen.reshape(len(starts), inputs * kernel) @ kernels + b
        if p >= kernel and len(x) <= after:  # windows in the padding behind the last row
            more = np.arange(len(x), len(x) + p - kernel + 1)
            more = more[(more + first) % stride == 0]
            starts, found = np.concatenate([starts, more]), np.concatenate([found, np.tile(b, (len(more), 1))])
        return starts + first, found

    @F.arrow_udf("array<struct<idx:bigint,y:array<double>>>")
    def worked(block: pa.Array, held: pa.Array) -> pa.Array:
        sizes, flat = lists.lengths(held), held.flatten()
        at = flat.field("_pos").to_numpy(zero_copy_only=False)
        x = lists.numbers(flat.field("_v"))
        if len(x) != len(at) * inputs:
            raise ValueError(f"vectors do not all have {inputs} entries")
        x, ends = x.reshape(len(at), inputs), np.cumsum(sizes)
        made = [windows(int(at[e - n]), k, x[e - n : e]) for k, n, e in zip(block.to_pylist(), sizes, ends, strict=True)]
        idx = np.concatenate([np.zeros(0, dtype=np.int64), *(m[0] for m in made)]) // stride
        y = np.concatenate([np.zeros((0, outputs)), *(m[1] for m in made)])
        vectors = lists.regroup(y.ravel(), np.full(len(idx), outputs), None)
        found = pa.StructArray.from_arrays([pa.array(idx), vectors], names=["idx", "y"])
        return lists.regroup(found, np.array([len(m[0]) for m in made], dtype=int), None)

    out = blocks.select(*key, F.inline(worked("_block", "_rows")))
    return out if activation is None else out.withColumn("y", F.transform("y", activation))


def max_pool(df: DataFrame, key: Sequence[str], index: str, channels: Sequence[str], size: int) -> DataFrame:
    """Largest value of each `size` consecutive positions; an incomplete tail is left out."""
    block = whole(index, size).alias("idx")
    out = df.groupBy(*key, block).agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in channels])
    return out.filter(F.col("_n") == size).drop("_n")


def elman_cell(wx: Matrix, b: Sequence[float], wh: Matrix) -> Cell:
    """h' = relu(Wx x + b + Wh h)"""
    wx_, b_, wh_ = np.array(wx), np.array(b), np.array(wh)
    return lambda h, x: np.maximum(x @ wx_.T + b_ + h @ wh_.T, 0.0)


def gated_cell(wx: Matrix, b: Sequence[float], wh: Matrix, wxz: Matrix, bz: Sequence[float], whz: Matrix) -> Cell:
    """z = sigmoid(Wxz x + bz + Whz h), c = relu(Wx x + b + Wh h), h' = z h + (1 - z) c"""
    candidate = elman_cell(wx, b, wh)
    wxz_, bz_, whz_ = np.array(wxz), np.array(bz), np.array(whz)

    def step(h: np.ndarray, x: np.ndarray) -> np.ndarray:
        a = x @ wxz_.T + bz_ + h @ whz_.T
        gate = 0.5 * (1.0 + np.tanh(0.5 * a))  # the sigmoid, without overflow
        return gate * h + (1.0 - gate) * candidate(h, x)

    return step


def _gather(pieces: DataFrame, by: Sequence[str]) -> DataFrame:
    """The steps of each piece in order, one after the other in `_s`; the caller has bounded their number."""
    steps = F.array_sort(F.collect_list(F.struct("_pos", "_x")))
    out = pieces.groupBy(*by).agg(steps.alias("_s"), F.count(F.lit(1)).alias("_n"))
    return out.withColumn("_s", F.flatten(F.col("_s._x")))


def _zero(hidden: int) -> Column:
    return F.lit([0.0] * hidden).cast("array<double>")


def _run(cell: Cell, hidden: int, start: Column) -> Column:
    """The state after the `_n` steps in `_s`; the sequences of a batch go through the cell side by side."""

    @F.arrow_udf("array<double>")
    def fold(first: pa.Array, steps: pa.Array, count: pa.Array) -> pa.Array:
        n = np.asarray(count.fill_null(0))
        h = lists.numbers(first).reshape(len(n), hidden)
        x = lists.numbers(steps)
        rows = int(n.sum())
        x = x.reshape(rows, len(x) // rows) if rows else x.reshape(0, 1)
        begin = np.cumsum(n) - n
        longest_first = np.argsort(-n, kind="stable")
        begin, ends, state = begin[longest_first], n[longest_first], h[longest_first]
        for t in range(int(n.max(initial=0))):
            still = int(np.searchsorted(-ends, -t, side="left"))  # sequences with more than t steps
            state[:still] = cell(state[:still], x[begin[:still] + t])
        out = np.empty_like(state)
        out[longest_first] = state
        return lists.regroup(out.ravel(), np.full(len(n), hidden), pa.array(np.zeros(len(n), dtype=bool)))

    return fold(start, F.col("_s"), F.col("_n"))


def fold_sequences(
    df: DataFrame,
    key: Sequence[str],
    index: str,
    features: Column,
    cell: Cell,
    hidden: int,
    timesteps: int,
    readout: tuple[Matrix, Sequence[float]] | None = None,
) -> DataFrame:
    """Run a recurrent cell over sequences of up to `timesteps` rows.

    A key's series is cut every `timesteps` rows along `index`; each piece is
    one sequence that starts from a zero state, as in a batch of equally long
    sequences. The pieces of a long series run side by side. Gives the last
    state `h`, or the readout of it.
    """
    pieces = df.select(
        *key,
        whole(index, timesteps).alias("seq_no"),
        (F.col(index) % timesteps).alias("_pos"),
        V.doubles(features).alias("_x"),
    )
    state = _run(cell, hidden, _zero(hidden))
    h = state if readout is None else V.linear(state, *readout)
    return _gather(pieces, [*key, "seq_no"]).select(*key, "seq_no", F.col("_n").alias("n_steps"), h.alias("h"))


def fold_series(
    df: DataFrame,
    key: Sequence[str],
    index: str,
    features: Column,
    cell: Cell,
    hidden: int,
    rows_per_round: int = 100_000,
    readout: tuple[Matrix, Sequence[float]] | None = None,
) -> DataFrame:
    """Run a recurrent cell over each key's whole series, carrying the state on.

    Such a fold is sequential within a key. To keep every task small, round r
    takes rows [r n, (r+1) n) of all keys at once, starting from the states of
    round r-1, so there are as many rounds as the longest series needs and no
    task holds more than n rows of a key. Where sequences may be cut, prefer
    `fold_sequences`, which needs one round.
    """
    rounds = whole(index, rows_per_round).alias("_round")
    rows = df.select(*key, rounds, F.col(index).alias("_pos"), V.doubles(features).alias("_x"))
    rows = rows.repartition("_round", *key)  # so that a round is not spread over a file of every task
    rows = materialize(rows, "series", partition_by="_round")
    last = rows.agg(F.max("_round").alias("r")).first()["r"]
    states = None
    for r in range(0 if last is None else last + 1):
        pieces = _gather(rows.filter(F.col("_round") == r).drop("_round"), key)
        if states is None:
            states = pieces.select(*key, F.col("_n").alias("n_steps"), _run(cell, hidden, _zero(hidden)).alias("_h"))
            continue
        named = {k: f"_piece_{k}" for k in key}
        same = [F.col(k).eqNullSafe(F.col(p)) for k, p in named.items()]  # a null key is a series like any other
        joined = states.join(pieces.withColumnsRenamed(named), same, "left")
        n = F.col("n_steps") + F.coalesce("_n", F.lit(0))
        states = joined.select(*key, n.alias("n_steps"), _run(cell, hidden, F.col("_h")).alias("_h"))
        if (r + 1) % STEPS_PER_TABLE == 0 and r < last:
            states = materialize(states, "states")
    if states is None:
        states = df.select(*key, F.lit(0).cast("bigint").alias("n_steps"), _zero(hidden).alias("_h")).limit(0)
    h = F.col("_h") if readout is None else V.linear(F.col("_h"), *readout)
    return states.select(*key, "n_steps", h.alias("h"))
