"""Vector columns (arrays of numbers): norms, activations, layers, quantization."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import lists

Activation = Callable[[Column], Column]
# Weight rows, bias, activation.
Layer = tuple[Sequence[Sequence[float]], Sequence[float] | None, Activation]
# Number of weights from which on a batch-wise matrix product is the faster way.
WIDE_LAYER = 256
# The usual defaults of batch and layer normalization and of the
# leaky rectifier.
NORM_EPS = 1e-5
LEAK = 0.2


def once(value: Column, use: Activation) -> Column:
    """`use(value)` with the value worked out once per row, not once per use."""
    return F.transform(F.array(value), use)[0]


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def scale(v: Column, factor: Column) -> Column:
    return F.transform(v, lambda x: x * factor)


def sum_of_squares(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)


def identity(x: Column) -> Column:
    return x


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def leaky_relu(x: Column, leak: float = LEAK) -> Column:
    return F.when(x > 0, x).otherwise(x * leak)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def tanh(x: Column) -> Column:
    return F.tanh(x)


# Fixed values of Abramowitz and Stegun 7.1.26, highest power first.
ERF_SERIES = (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592)


def erf(x: Column) -> Column:
    """Error function; absolute error below 1.5e-7 (Abramowitz and Stegun 7.1.26)."""
    t = 1.0 / (1.0 + 0.3275911 * F.abs(x))
    series = F.lit(0.0)
    for c in ERF_SERIES:
        series = (series + c) * t
    return F.signum(x) * (1.0 - series * F.exp(-x * x))


def gelu(x: Column) -> Column:
    """x times the normal distribution function, by `erf` above."""
    return 0.5 * x * (1.0 + erf(x / math.sqrt(2.0)))


def gelu_tanh(x: Column) -> Column:
    """The tanh form of GELU; differs from `gelu` by up to about 5e-4."""
    return 0.5 * x * (1.0 + F.tanh(math.sqrt(2.0 / math.pi) * (x + 0.044715 * x * x * x)))


def softmax(v: Column) -> Column:
    """Softmax over the entries of one array."""
    weights = once(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top)))
    return once(weights, lambda w: once(total(w), lambda z: F.transform(w, lambda x: x / z)))


def layer_norm(
    v: Column,
    residual: Column | None = None,
    eps: float = NORM_EPS,
    gain: Sequence[float] | None = None,
    shift: Sequence[float] | None = None,
) -> Column:
    """Normalize one row to mean 0 and variance 1, after adding the residual.

    Stored `gain` and `shift`, one number per entry, are applied to the result.
    """
    v = doubles(v) if residual is None else add(doubles(v), doubles(residual))
    n = F.size(v)
    centred = once(total(v) / n, lambda mean: F.transform(v, lambda x: x - mean))
    normal = once(centred, lambda c: once(1.0 / F.sqrt(sum_of_squares(c) / n + eps), lambda f: scale(c, f)))
    if gain is not None:
        normal = F.zip_with(normal, _numbers(gain), lambda x, g: x * g)
    return normal if shift is None else add(normal, _numbers(shift))


def _numbers(values: Sequence[float]) -> Column:
    return F.lit([float(x) for x in values]).cast("array<double>")


def _layer(weight: Sequence[Sequence[float]], bias: Sequence[float] | None) -> tuple[list[list[float]], list[float]]:
    rows = [[float(w) for w in row] for row in weight]
    offsets = [float(b) for b in bias] if bias is not None else [0.0] * len(rows)
    if len({len(row) for row in rows}) != 1 or len(offsets) != len(rows):
        raise ValueError("weight must be a rectangle with one bias per row")
    return rows, offsets


def dense(v: Column, weight: Sequence[Sequence[float]], bias: Sequence[float] | None = None) -> Column:
    """`weight @ v + bias` inside the JVM, with the weight as rows."""
    layer = [
        F.struct(F.lit(row).cast("array<double>").alias("w"), F.lit(b).alias("b"))
        for row, b in zip(*_layer(weight, bias))
    ]
    return once(doubles(v), lambda x: F.transform(F.array(*layer), lambda r: dot(r["w"], x) + r["b"]))


def linear(v: Column, weight: Sequence[Sequence[float]], bias: Sequence[float] | None = None) -> Column:
    """As `dense`, but wide layers go through Arrow batches, one matrix product each.

    A vector of another length stops the job, whichever way it goes.
    """
    rows, offsets = _layer(weight, bias)
    fits = v.isNull() | (F.size(v) == len(rows[0]))
    v = F.when(fits, v).otherwise(F.raise_error(F.lit(f"the layer takes vectors of {len(rows[0])} entries")))
    if len(rows) * len(rows[0]) > WIDE_LAYER:
        return _wide_linear(rows, offsets)(v)
    return dense(v, rows, offsets)


def _wide_linear(rows: list[list[float]], offsets: list[float]) -> Callable[[Column], Column]:
    w, b = np.array(rows), np.array(offsets)

    @F.arrow_udf("array<double>")
    def product(v: pa.Array) -> pa.Array:
        out = lists.numbers(v).reshape(-1, w.shape[1]) @ w.T + b
        return lists.regroup(out.ravel(), np.where(v.is_null(), 0, len(b)), v.is_null())

    return product


def activate(v: Column, activation: Activation) -> Column:
    return F.transform(v, activation)


def perceptron(v: Column, layers: Sequence[Layer]) -> Column:
    """Score stored layers `(weight, bias, activation)` one after the other."""
    out = v
    for weight, bias, activation in layers:
        out = linear(out, weight, bias)
        out = out if activation is identity else activate(out, activation)
    return out


def position_vector(pos: Column, width: int, odd: str = "cos", base: float = 10000.0) -> Column:
    """Sinusoidal features of a position: sin in even entries, `odd` in odd ones."""
    if odd not in ("cos", "sin"):
        raise ValueError("odd must be 'cos' or 'sin'")
    entries = []
    for j in range(width):
        angle = pos / F.lit(base ** ((j - j % 2) / width))
        entries.append(F.sin(angle) if j % 2 == 0 or odd == "sin" else F.cos(angle))
    return F.array(*entries)


def position_table(spark: SparkSession, length: int, width: int, odd: str = "cos") -> DataFrame:
    """The features of the places 0 to `length` - 1 as a table `pos`, `dim`, `value`."""
    places = spark.range(length).withColumnRenamed("id", "pos")
    return places.select("pos", F.posexplode(position_vector(F.col("pos"), width, odd)).alias("dim", "value"))


def quantize(v: Column, group: int = 32, bits: int = 4) -> Column:
    """Symmetric low-bit codes per `group` neighbouring entries.

    Gives one `{scale, codes}` per group; codes run from -(2^(bits-1)-1) to
    2^(bits-1)-1 and a group of zeros has scale 1.
    """
    if not 2 <= bits <= 8:
        raise ValueError("bits must be between 2 and 8")
    top = float(2 ** (bits - 1) - 1)
    v = doubles(v)
    starts = F.sequence(F.lit(1), F.size(v), F.lit(group))

    def one(part: Column) -> Column:
        largest = F.array_max(F.transform(part, lambda x: F.abs(x)))
        step = F.when(largest > 0, largest / top).otherwise(F.lit(1.0))
        return once(
            step,
            lambda s: F.struct(s.alias("scale"), F.transform(part, lambda x: F.round(x / s).cast("tinyint")).alias("codes")),
        )

    return F.transform(starts, lambda s: one(F.slice(v, s, F.lit(group))))


def dequantize(groups: Column) -> Column:
    return F.flatten(F.transform(groups, lambda g: F.transform(g["codes"], lambda c: c * g["scale"])))


def pack_codes(codes: Column) -> Column:
    """Codes from -8 to 7 as binary, two a byte, the first of a pair in the high half.

    Behind an odd number stands a zero code. Null if any code is null; a code
    that needs more than four bits stops the job.
    """
    digits = F.array_join(F.transform(codes, lambda c: F.hex((c + 8).cast("bigint"))), "")
    even = F.when(F.size(codes) % 2 == 1, F.concat(digits, F.lit("8"))).otherwise(digits)
    wide = F.raise_error(F.lit("a packed code has four bits")).cast("binary")
    packed = F.when(F.exists(codes, lambda c: ~c.between(-8, 7)), wide).otherwise(F.unhex(even))
    return F.when(~F.exists(codes, lambda c: c.isNull()), packed)


def unpack_codes(packed: Column, n: Column) -> Column:
    """The first `n` codes of a packed column."""
    digits = F.slice(F.split(F.hex(packed), ""), F.lit(1), n)
    return F.transform(digits, lambda d: (F.position(d, F.lit("0123456789ABCDEF")) - 9).cast("tinyint"))


def pack_groups(groups: Column) -> Column:
    """The groups of `quantize` with at most four bits as `{scale, n, packed}`: half a byte an entry."""
    return F.transform(
        groups,
        lambda g: F.struct(g["scale"].alias("scale"), F.size(g["codes"]).alias("n"), pack_codes(g["codes"]).alias("packed")),
    )


def unpack_groups(packed: Column) -> Column:
    """Back to the groups of `quantize`."""
    return F.transform(
        packed, lambda g: F.struct(g["scale"].alias("scale"), unpack_codes(g["packed"], g["n"]).alias("codes"))
    )


class PackedWeights:
    """A weight matrix as rows of four-bit codes, two a byte, with one scale per `group` neighbouring entries."""

    def __init__(self, weight: Sequence[Sequence[float]], group: int = 32):
        rows = np.array(_layer(weight, None)[0])
        if group < 1 or rows.shape[1] % group:
            raise ValueError("the width of the matrix must be a multiple of the group")
        self.height, self.width, self.group = *rows.shape, group
        parts = rows.reshape(self.height, -1, group)
        largest = np.abs(parts).max(axis=2)
        self.scales = np.where(largest > 0, largest / 7, 1.0)
        ratio = parts / self.scales[:, :, None]
        codes = (np.sign(ratio) * np.floor(np.abs(ratio) + 0.5) + 8).astype(np.uint8).ravel()
        codes = np.append(codes, [8] * (codes.size % 2)).astype(np.uint8)
        self.packed = (codes[::2] << 4 | codes[1::2]).tobytes()

    def codes(self) -> np.ndarray:
        """Codes as whole numbers by row, group and entry."""
        both = np.frombuffer(self.packed, np.uint8)
        flat = np.stack([both >> 4, both & 15], axis=1).ravel()[: self.height * self.width]
        return flat.reshape(self.height, -1, self.group).astype(np.int64) - 8

    def error_bound(self, v: Column) -> Column:
        """What no entry of `low_bit_linear(v, self)` is further from the exact product than.

        A weight is off by at most half its scale, an entry of `v` by at most
        half the row's step; each error meets the other factor once.
        """
        heaviest = float((np.abs(self.codes()).sum(axis=2) * self.scales).sum(axis=1).max())
        sizes = F.transform(doubles(v), lambda x: F.abs(x))
        halves = _numbers(np.repeat(self.scales.max(axis=0) / 2, self.group).tolist())
        return dot(sizes, halves) + F.array_max(sizes) / 127.0 / 2.0 * heaviest


def low_bit_linear(v: Column, weights: PackedWeights, bias: Sequence[float] | None = None) -> Column:
    """`weights @ v + bias` with eight-bit entries and four-bit weights.

    Each vector has one step, its largest entry by 127. Codes are multiplied and
    added per group as whole numbers, which a double holds exactly, and only
    the sums are scaled. A null vector, or one with a null or NaN entry, gives
    null; one of another length stops the job.
    """
    width = weights.width
    fits = v.isNull() | (F.size(v) == width)
    v = F.when(fits, v).otherwise(F.raise_error(F.lit(f"the layer takes vectors of {width} entries")))
    offsets = np.zeros(weights.height) if bias is None else np.array([float(b) for b in bias])
    if offsets.shape != (weights.height,):
        raise ValueError("need one bias per row")

    @F.arrow_udf("array<double>")
    def product(v: pa.Array) -> pa.Array:
        x = lists.numbers(v).reshape(-1, width)  # a null entry is NaN here
        known = ~np.isnan(x).any(axis=1)
        largest = np.abs(x).max(axis=1, initial=0.0)
        step = np.where(largest > 0, largest / 127, 1.0)[:, None]
        codes = (np.sign(x) * np.floor(np.abs(x) / step + 0.5)).reshape(len(x), width // weights.group, weights.group)
        out = np.zeros((len(x), weights.height))
        for k, (kernel, scales) in enumerate(zip(weights.codes().transpose(1, 2, 0), weights.scales.T)):
            out += codes[:, k] @ kernel.astype(float) * scales
        out = out * step + offsets
        missing = v.is_null().to_numpy(zero_copy_only=False).copy()
        missing[~missing] = ~known
        return lists.regroup(out[known].ravel(), np.where(missing, 0, weights.height), pa.array(missing))

    return product(v)
