"""Similarity-weighted averages over ordered vectors, of whole groups or of sequences of a stated length.

Attention compares every row with every other one. `group_attention` does so
within whole groups of any size: each group is cut into tiles, the rows that a
tile sees pass by it one after the other, and what it has seen so far (largest
score, sum and weighted sum) is all that is kept of them.
`attention` is the cheaper form for input of a fixed length: an ordered series
is cut every `context` rows, each piece is one sequence, and every row belongs
to exactly one. In neither does a pair of rows become a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions import lists
from tokenloom.functions.arrays import whole
from tokenloom.functions.vectors import Layer, doubles, layer_norm, perceptron
from tokenloom.operators.joins import lookup
from tokenloom.operators.order import with_row_index
from tokenloom.session import materialize

Weights = Mapping[str, Sequence[Sequence[float]]] | None
Biases = Mapping[str, Sequence[float]] | None
TILE_ROWS = 4096  # a task holds so many rows of a group at most
TILES = 64  # and a table is cut into about so many tiles, unless they would be larger
SCORES = 1 << 20  # scores that are worked out at once


def cut_sequences(df: DataFrame, order: str, context: int, group: str | Sequence[str] = ()) -> DataFrame:
    """Add `seq_no` and the place `pos` in the sequence, per group along `order`."""
    rows = with_row_index(df, order, group, name="_idx")
    out = rows.withColumn("seq_no", whole("_idx", context)).withColumn("pos", F.col("_idx") % context)
    return out.drop("_idx")


def _projector(weights: Weights, biases: Biases) -> Callable[[np.ndarray, str], np.ndarray]:
    given = {name: np.asarray(m, dtype=float) for name, m in (weights or {}).items()}
    added = {name: np.asarray(b, dtype=float) for name, b in (biases or {}).items()}
    if (set(given) | set(added)) - set("qkvo"):
        raise ValueError("weights and biases may hold q, k, v and o")

    def project(x: np.ndarray, name: str) -> np.ndarray:
        return (x @ given[name].T if name in given else x) + added.get(name, 0.0)

    return project


def _by_head(x: np.ndarray, heads: int) -> np.ndarray:
    if x.shape[1] % heads:
        raise ValueError("vector width is not a multiple of heads")
    return x.reshape(len(x), heads, -1).swapaxes(0, 1)


def _look(q: np.ndarray, k: np.ndarray, v: np.ndarray, hidden: np.ndarray) -> np.ndarray:
    """Per head and row: largest score, sum of weights, weighted sum of `v`, over the keys that are not hidden."""
    scores = q @ k.swapaxes(-1, -2) / np.sqrt(q.shape[-1])
    scores = np.where(hidden, -np.inf, scores)
    top = scores.max(axis=-1, keepdims=True)
    w = np.exp(scores - np.where(np.isfinite(top), top, 0.0))
    return np.concatenate([top, w.sum(axis=-1, keepdims=True), w @ v], axis=-1)


def _merge(parts: np.ndarray) -> np.ndarray:
    """One such look out of several (first axis) at different keys."""
    top = parts[..., :1].max(axis=0)
    share = np.exp(parts[..., :1] - np.where(np.isfinite(top), top, 0.0))
    return np.concatenate([top, (parts[..., 1:] * share).sum(axis=0)], axis=-1)


def _mean(look: np.ndarray) -> np.ndarray:
    """rows x width; zeros for a row that sees nothing."""
    weight = look[..., 1:2]
    mean = np.divide(look[..., 2:], weight, out=np.zeros_like(look[..., 2:]), where=weight > 0)
    return mean.swapaxes(0, 1).reshape(mean.shape[1], -1)


def _hidden(rows: int, seen: np.ndarray, later: bool) -> np.ndarray:
    """rows x keys: keys that are not `seen` and, with `later`, those after the row."""
    out = np.broadcast_to(~seen, (rows, len(seen)))
    return out | np.triu(np.ones(out.shape, dtype=bool), 1) if later else out


class _Tile:
    """Rows of a group that lie together, and what they have seen so far."""

    def __init__(self, name: tuple[int, int], project: Callable[[np.ndarray, str], np.ndarray], heads: int, causal: bool, fan: int):
        self.name, self.project, self.heads, self.causal, self.fan = name, project, heads, causal, fan
        self.rows: list[np.ndarray] = []
        self.flags: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.looks: list[np.ndarray] = []
        self.q: np.ndarray | None = None

    def add(self, x: np.ndarray, seen: np.ndarray, places: np.ndarray) -> None:
        """Rows of the tile itself, in order; all of them come before the first `see`."""
        self.rows.append(x)
        self.flags.append(seen)
        self.places.append(places)

    def see(self, x: np.ndarray, seen: np.ndarray | None = None) -> None:
        """Rows of other tiles, or of the tile itself with the flags of those that may be seen."""
        if self.q is None:
            own = np.concatenate(self.rows)
            self.rows, self.q = [], _by_head(self.project(own, "q"), self.heads)
            self.see(own, np.concatenate(self.flags))
        rows = self.q.shape[1]
        step = max(1, SCORES // (self.heads * rows))
        for start in range(0, len(x), step):
            k, v = (_by_head(self.project(x[start : start + step], name), self.heads) for name in "kv")
            hidden = np.zeros((1, k.shape[1]), dtype=bool)
            if seen is not None:
                hidden = np.broadcast_to(~seen[start : start + step], (rows, k.shape[1]))
                if self.causal:
                    hidden = hidden | (np.arange(start, start + k.shape[1]) > np.arange(rows)[:, None])
            self.looks.append(_look(self.q, k, v, hidden))
            if len(self.looks) == self.fan:
                self.looks = [_merge(np.stack(self.looks))]

    def look(self) -> np.ndarray:
        if self.q is None:
            self.see(np.empty((0, self.rows[0].shape[1])))
        return _merge(np.stack(self.looks))


def _split(flat: pa.Array) -> list[np.ndarray]:
    return np.split(lists.numbers(flat), np.cumsum(lists.lengths(flat))[:-1])


def _flags(flat: pa.Array) -> list[np.ndarray]:
    return [x.astype(bool) for x in _split(flat)]


def _join(out: list[np.ndarray], flat: pa.Array) -> pa.Array:
    return lists.regroup(np.concatenate(out), np.array([len(y) for y in out]), flat.is_null())


def _members(vector: str, keep: Sequence[str], seen: str | None) -> Column:
    """The rows of a sequence by place, with the vector and a flag of 1 where others may see it."""
    flag = F.lit(1) if seen is None else F.coalesce(F.col(seen), F.lit(False)).cast("int")
    return F.array_sort(F.collect_list(F.struct("pos", *keep, doubles(F.col(vector)).alias("_v"), flag.alias("_s"))))


def _spread(df: DataFrame, sequence: Sequence[str], keep: Sequence[str], out: str) -> DataFrame:
    """Back to rows: member i of `_m` gets the i-th part of `_y`."""
    width = F.floor(F.size("_y") / F.size("_m")).cast("int")

    def row(m: Column, i: Column) -> Column:
        kept = [m[c].alias(c) for c in ("pos", *keep)]
        return F.struct(*kept, F.slice(F.col("_y"), i * width + 1, width).alias(out))

    return df.select(*sequence, F.inline(F.transform("_m", row)))


def attention(
    df: DataFrame,
    sequence: Sequence[str],
    vector: str,
    keep: Sequence[str],
    heads: int = 1,
    causal: bool = False,
    weights: Weights = None,
    biases: Biases = None,
    seen: str | None = None,
    out: str = "attended",
) -> DataFrame:
    """Replace each vector by the softmax(q.k / sqrt(width))-weighted mean of its sequence.

    Rows come from `cut_sequences`: `sequence` names their sequence, `pos` the
    place. `weights` and `biases` may hold matrices and offsets `q`, `k`, `v`
    (applied to the vectors) and `o` (applied to the result); without them
    q = k = v. With `heads`, the vector is cut into that many equal parts which
    attend separately. `causal` lets a row see itself and earlier rows only;
    `seen` names a boolean column, and rows where it is not true are seen by
    none. A row that sees nothing has the mean zero.

    A sequence is gathered into one row (its length is bounded by the cut) and
    worked on as one matrix.
    """
    project = _projector(weights, biases)

    def one(x: np.ndarray, flags: np.ndarray) -> np.ndarray:
        q, k, v = (_by_head(project(x, n), heads) for n in "qkv")
        return project(_mean(_look(q, k, v, _hidden(len(x), flags, causal))), "o").ravel()

    @F.arrow_udf("array<double>")
    def run(flat: pa.Array, flags: pa.Array) -> pa.Array:
        return _join([one(x.reshape(len(s), -1), s) for x, s in zip(_split(flat), _flags(flags))], flat)

    gathered = df.groupBy(*sequence).agg(_members(vector, keep, seen).alias("_m"))
    mixed = gathered.withColumn("_y", run(F.flatten(F.col("_m")["_v"]), F.col("_m")["_s"]))
    return _spread(mixed, sequence, keep, out)


def group_attention(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    vector: str,
    keep: Sequence[str],
    heads: int = 1,
    causal: bool = False,
    weights: Weights = None,
    biases: Biases = None,
    seen: str | None = None,
    block: int = 256,
    fan: int = 16,
    out: str = "attended",
) -> DataFrame:
    """As `attention`, exactly, over whole groups of any size; gives `group`, `keep` and `out`.

    A group is cut along `order` into tiles of `block` rows or more: of so many
    that a table has about `TILES` of them, and of `TILE_ROWS` at most. Every
    tile is sent its own rows and, one after the other, those that it sees, so
    a hot group spreads over as many tasks as it has tiles and a row moves once
    per tile that sees it. What the keys so far give is merged whenever `fan`
    looks have come together; they never leave the task. Rows without a vector
    see nothing and are seen by none; their result is null. Work is quadratic
    in a group's rows, as the formula is.
    """
    if not group:
        return group_attention(
            df.withColumn("_all", F.lit(0)), ["_all"], order, vector, keep, heads, causal, weights, biases, seen, block, fan, out
        ).drop("_all")
    project = _projector(weights, biases)

    def finish(tile: _Tile) -> pa.RecordBatch:
        y = project(_mean(tile.look()), "o")
        each = lists.regroup(y.ravel(), np.full(len(y), y.shape[1]), None)
        ids = [pa.array(np.full(len(y), x)) for x in tile.name]
        return pa.RecordBatch.from_arrays([*ids, pa.array(np.concatenate(tile.places)), each], names=["_g", "seq_no", "pos", out])

    def attend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype("int64") for c in ("_g", "_to", "_other")])
            starts = np.flatnonzero(np.any(names[:, 1:] != names[:, :-1], axis=0)) + 1
            for start, stop in zip([0, *starts], [*starts, batch.num_rows]):
                if start == stop:
                    continue
                g, to, other = names[:, start]
                if tile is None or tile.name != (g, to):
                    if tile is not None:
                        yield finish(tile)
                    tile = _Tile((g, to), project, heads, causal, max(2, fan))
                part = batch.slice(start, stop - start)
                x = lists.numbers(part.column("_v")).reshape(stop - start, -1)
                if other:
                    tile.see(x)
                else:
                    tile.add(x, part.column("_s").to_numpy(zero_copy_only=False).astype(bool), part.column("pos").to_numpy())
        if tile is not None:
            yield finish(tile)

    given = df.filter(F.col(vector).isNotNull())
    size = max(block, min(TILE_ROWS, -(-given.count() // TILES)))
    v, kind = F.col(vector), given.schema[vector].dataType
    v = v if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else doubles(v)
    flag = F.lit(True) if seen is None else F.coalesce(F.col(seen), F.lit(False))
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate((*group, *keep))]
    cut = cut_sequences(given, order, size, group)
    rows = materialize(cut.select(*kept, "seq_no", "pos", v.alias("_v"), flag.alias("_s")), "rows")
    by = [f"_k{i}" for i in range(len(group))]
    sizes = rows.groupBy(*by).agg(F.max("seq_no").alias("_last")).withColumn("_g", F.monotonically_increasing_id())
    sizes = materialize(sizes, "group_tiles")
    rows = lookup(rows, sizes, by, "inner", null_safe=True)

    first = F.col("seq_no") if causal else F.lit(0).cast("bigint")
    sent = rows.select("_g", "seq_no", "pos", "_v", "_s", F.explode(F.sequence(first, F.col("_last"))).alias("_to"))
    sent = sent.withColumn("_other", F.col("_to") != F.col("seq_no")).filter("_s or not _other")
    tiles = sizes.agg(F.sum(F.col("_last") + 1)).first()[0] or 1
    spark = df.sparkSession
    tasks = max(6 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = sent.repartition(min(2 * tiles, tasks), "_g", "_to").sortWithinPartitions("_g", "_to", "_other", "seq_no", "pos")
    made = dealt.mapInArrow(attend, f"_g bigint, seq_no bigint, pos bigint, `{out}` array<double>")
    place = ["_g", "seq_no", "pos"]
    found = rows.drop("_v", "_s", "_last").join(made, place)
    found = found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate((*group, *keep))], out)
    absent = df.filter(F.col(vector).isNull()).select(*group, *keep, F.lit(None).cast("array<double>").alias(out))
    return found.unionByName(absent)


def encoder_layer(
    df: DataFrame,
    sequence: Sequence[str],
    vector: str,
    keep: Sequence[str],
    feed_forward: Sequence[Layer],
    heads: int = 1,
    causal: bool = False,
    weights: Weights = None,
    biases: Biases = None,
) -> DataFrame:
    """Score a stored encoder layer: attention, then a feed-forward net, each added to its input and normalized.

    `feed_forward` are layers as for `vectors.perceptron`; the last one must
    give back the width of the vectors.
    """
    mixed = attention(df, sequence, vector, [*keep, vector], heads, causal, weights, biases, out="_a")
    first = mixed.withColumn("_a", layer_norm(F.col("_a"), F.col(vector)))
    fed = first.withColumn("_f", perceptron(F.col("_a"), feed_forward))
    return fed.withColumn(vector, layer_norm(F.col("_f"), F.col("_a"))).drop("_a", "_f")
