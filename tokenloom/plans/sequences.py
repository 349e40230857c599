"""Queries: moving windows, pooling and recurrent folds over event series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import vectors as V
from tokenloom.operators import series as R
from tokenloom.operators.order import with_row_index
from tokenloom.plans.registry import query, r_sql, rounded, vector_marks, vector_marks_sql
from tokenloom.sources.corpus import table

INDEXED_SQL = """i AS (SELECT user_id, value, event_type,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx FROM events)"""
KERNEL = [0.25, 0.5, 0.25]


def _series(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return with_row_index(events, ["ts", "event_id"], "user_id")


def _channels(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("value") / 100).withColumn("bought", (F.col("event_type") == "purchase").cast("double"))


@query(
    "moving_window",
    f"""
    WITH {INDEXED_SQL}
    SELECT user_id, idx, {r_sql('''0.25::DOUBLE * coalesce(lag(value) OVER w, 0) + 0.5::DOUBLE * value
        + 0.25::DOUBLE * coalesce(lead(value) OVER w, 0)''')} AS y0
    FROM i WINDOW w AS (PARTITION BY user_id ORDER BY idx)
    """,
)
def moving_window(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted moving window of the same length as the series."""
    out = R.convolve(_series(spark, sf), ["user_id"], "idx", ["value"], [[KERNEL]], padding=1)
    return out.select("user_id", "idx", rounded(F.col("y0")).alias("y0"))


# Two input channels to two output channels; kernel of two.
W = [[[0.5, -0.25], [1.0, 0.5]], [[-0.75, 0.25], [0.125, 2.0]]]
B = [0.1, -0.2]


def _output_sql(o: int) -> str:
    terms = [
        f"{W[o][c][j]!r}::DOUBLE * coalesce(CASE WHEN o + {j} - 1 >= 0 THEN x{j}.{name} END, 0)"
        for c, name in enumerate(("amount", "bought"))
        for j in range(2)
    ]
    return f"greatest({' + '.join(terms)} + {B[o]!r}::DOUBLE, 0)"


CONVOLVED_SQL = f"""{INDEXED_SQL},
    ch AS (SELECT user_id, idx, value / 100 AS amount, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS bought FROM i),
    outs AS (SELECT user_id, unnest(range(count(*) + 1)) AS o FROM i GROUP BY user_id),
    conv AS (SELECT outs.user_id, o AS idx, {_output_sql(0)} AS y0, {_output_sql(1)} AS y1
             FROM outs LEFT JOIN ch x0 ON x0.user_id = outs.user_id AND x0.idx = o - 1
             LEFT JOIN ch x1 ON x1.user_id = outs.user_id AND x1.idx = o)"""


def _convolved(spark: SparkSession, sf: str) -> DataFrame:
    return R.convolve(
        _channels(_series(spark, sf)), ["user_id"], "idx", ["amount", "bought"], W, B, padding=1, activation=V.relu
    )


@query("convolved_channels", f"WITH {CONVOLVED_SQL} SELECT user_id, idx, {r_sql('y0')} AS y0, {r_sql('y1')} AS y1 FROM conv")
def convolved_channels(spark: SparkSession, sf: str) -> DataFrame:
    """Two channels in, two out; one output longer than the series."""
    return _convolved(spark, sf).select("user_id", "idx", rounded(F.col("y0")).alias("y0"), rounded(F.col("y1")).alias("y1"))


@query(
    "strided_window",
    f"""
    WITH {INDEXED_SQL}, l AS (SELECT user_id, count(*) AS n FROM i GROUP BY user_id),
    o AS (SELECT user_id, unnest(range((n - 3) // 2 + 1)) AS idx FROM l WHERE n >= 3)
    SELECT o.user_id, o.idx, {r_sql('sum(value * CASE WHEN i.idx = 2 * o.idx + 1 THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END)')} AS y0
    FROM o JOIN i ON i.user_id = o.user_id AND i.idx BETWEEN 2 * o.idx AND 2 * o.idx + 2 GROUP BY o.user_id, o.idx
    """,
)
def strided_window(spark: SparkSession, sf: str) -> DataFrame:
    out = R.convolve(_series(spark, sf), ["user_id"], "idx", ["value"], [[KERNEL]], stride=2)
    return out.select("user_id", "idx", rounded(F.col("y0")).alias("y0"))


@query(
    "pooled_series",
    f"""
    WITH {INDEXED_SQL}
    SELECT user_id, idx // 2 AS idx, max(value) AS value FROM i GROUP BY user_id, idx // 2 HAVING count(*) = 2
    """,
)
def pooled_series(spark: SparkSession, sf: str) -> DataFrame:
    return R.max_pool(_series(spark, sf), ["user_id"], "idx", ["value"], 2)


@query(
    "convolved_and_pooled",
    f"""
    WITH {CONVOLVED_SQL}
    SELECT user_id, idx // 2 AS idx, {r_sql('max(y0)')} AS y0, {r_sql('max(y1)')} AS y1
    FROM conv GROUP BY user_id, idx // 2 HAVING count(*) = 2
    """,
)
def convolved_and_pooled(spark: SparkSession, sf: str) -> DataFrame:
    out = R.max_pool(_convolved(spark, sf), ["user_id"], "idx", ["y0", "y1"], 2)
    return out.select("user_id", "idx", rounded(F.col("y0")).alias("y0"), rounded(F.col("y1")).alias("y1"))


WIDE_IN, WIDE_OUT, TAPS = 64, 128, 3
WIDE = [[[((7 * o + 3 * c + 5 * j) % 11 - 5) / 64 for j in range(TAPS)] for c in range(WIDE_IN)] for o in range(WIDE_OUT)]


@query(
    "wide_convolution",
    f"""
    WITH e AS (SELECT label, embedding::DOUBLE[] AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx FROM embeddings),
    zero AS (SELECT list_transform(range({WIDE_IN}), lambda c: 0.0::DOUBLE) AS z),
    x AS (SELECT label, idx, list_concat(list_concat(coalesce(lag(v) OVER s, z), v), coalesce(lead(v) OVER s, z)) AS x FROM e, zero
          WINDOW s AS (PARTITION BY label ORDER BY idx)),
    k AS (SELECT o, list_transform(range({TAPS * WIDE_IN}), lambda i: ((7 * o + 3 * (i % {WIDE_IN}) + 5 * (i // {WIDE_IN})) % 11 - 5) / 64.0::DOUBLE) AS w
          FROM (SELECT unnest(range({WIDE_OUT})) AS o)),
    y AS (SELECT label, idx, list(greatest(list_inner_product(x, w), 0) ORDER BY o) AS y FROM x, k WHERE idx % 2 = 0 GROUP BY label, idx)
    SELECT label, idx // 2 AS idx, {vector_marks_sql('y')} FROM y
    """,
)
def wide_convolution(spark: SparkSession, sf: str) -> DataFrame:
    """From 64 to 128 channels with three taps, every second place, rectified, along the vectors of each label."""
    rows = with_row_index(table(spark, sf, "embeddings").select("vec_id", "label", "embedding"), "vec_id", "label")
    out = R.convolve_vectors(rows, ["label"], "idx", "embedding", WIDE, stride=2, padding=1, activation=V.relu)
    return out.select("label", "idx", *vector_marks(F.col("y")))


# A recurrent cell with two inputs, three state entries and two outputs.
WX = [[0.5, -0.25], [0.25, 0.75], [-0.5, 0.5]]
BX = [0.1, 0.0, 0.2]
WH = [[0.3, 0.1, -0.2], [0.0, 0.4, 0.1], [0.2, -0.1, 0.3]]
WXZ = [[0.2, 0.4], [-0.3, 0.1], [0.5, -0.6]]
BZ = [0.0, 0.5, -0.5]
WHZ = [[0.1, -0.2, 0.3], [0.2, 0.1, 0.0], [-0.1, 0.3, 0.2]]
READOUT = ([[1.0, -1.0, 0.5], [0.25, 0.5, 2.0]], [0.05, -0.05])
TIMESTEPS = 32


def _dot_sql(row: list[float], v: str) -> str:
    return "(" + " + ".join(f"{w!r}::DOUBLE * {v}[{i + 1}]" for i, w in enumerate(row)) + ")"


def _elman_sql(k: int) -> str:
    return f"greatest({_dot_sql(WX[k], 'x')} + {BX[k]!r}::DOUBLE + {_dot_sql(WH[k], 'h')}, 0)"


def _gated_sql(k: int) -> str:
    z = f"(1 / (1 + exp(-({_dot_sql(WXZ[k], 'x')} + {BZ[k]!r}::DOUBLE + {_dot_sql(WHZ[k], 'h')}))))"
    return f"({z} * h[{k + 1}] + (1 - {z}) * {_elman_sql(k)})"


def _fold_sql(cell) -> str:
    step = ", ".join(cell(k) for k in range(3))
    return f"list_reduce(xs, lambda h, x: [{step}], [0, 0, 0]::DOUBLE[])"


GATED_FOLD_SQL = _fold_sql(_gated_sql)
ELMAN_FOLD_SQL = _fold_sql(_elman_sql)

FEATURES_SQL = f"""{INDEXED_SQL}, f AS (SELECT user_id, idx,
        [value / 100, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END]::DOUBLE[] AS x FROM i)"""


def _sequences_sql(cell) -> str:
    out = [f"{_dot_sql(row, 'h')} + {b!r}::DOUBLE" for row, b in zip(*READOUT)]
    return f"""
    WITH {FEATURES_SQL},
    s AS (SELECT user_id, idx // {TIMESTEPS} AS seq_no, count(*) AS n_steps, list(x ORDER BY idx) AS xs FROM f
          GROUP BY user_id, idx // {TIMESTEPS}),
    r AS (SELECT user_id, seq_no, n_steps, {_fold_sql(cell)} AS h FROM s)
    SELECT user_id, seq_no, n_steps, {r_sql(out[0])} AS y0, {r_sql(out[1])} AS y1 FROM r
    """



def features():
    return F.array(F.col("value") / 100, (F.col("event_type") == "purchase").cast("double"))


def _folded_sequences(spark: SparkSession, sf: str, cell: R.Cell) -> DataFrame:
    out = R.fold_sequences(_series(spark, sf), ["user_id"], "idx", features(), cell, 3, TIMESTEPS, READOUT)
    y = [rounded(F.col("h")[i]).alias(f"y{i}") for i in range(2)]
    return out.select("user_id", "seq_no", "n_steps", *y)


@query("elman_sequences", _sequences_sql(_elman_sql))
def elman_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return _folded_sequences(spark, sf, R.elman_cell(WX, BX, WH))


@query("gated_sequences", _sequences_sql(_gated_sql))
def gated_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return _folded_sequences(spark, sf, R.gated_cell(WX, BX, WH, WXZ, BZ, WHZ))


def _series_sql(fold: str) -> str:
    return f"""
    WITH {FEATURES_SQL}, s AS (SELECT user_id, count(*) AS n_steps, list(x ORDER BY idx) AS xs FROM f GROUP BY user_id),
    r AS (SELECT user_id, n_steps, {fold} AS h FROM s)
    SELECT user_id, n_steps, {r_sql('h[1]')} AS h0, {r_sql('h[2]')} AS h1, {r_sql('h[3]')} AS h2 FROM r
    """


def _folded_series(spark: SparkSession, sf: str, cell: R.Cell) -> DataFrame:
    out = R.fold_series(_series(spark, sf), ["user_id"], "idx", features(), cell, 3, rows_per_round=32)
    return out.select("user_id", "n_steps", *[rounded(F.col("h")[i]).alias(f"h{i}") for i in range(3)])


@query("gated_series", _series_sql(GATED_FOLD_SQL))
def gated_series(spark: SparkSession, sf: str) -> DataFrame:
    """The gated fold over each user's whole series, 32 rows a round."""
    return _folded_series(spark, sf, R.gated_cell(WX, BX, WH, WXZ, BZ, WHZ))


@query("elman_series", _series_sql(ELMAN_FOLD_SQL))
def elman_series(spark: SparkSession, sf: str) -> DataFrame:
    """The plain fold over each user's whole series."""
    return _folded_series(spark, sf, R.elman_cell(WX, BX, WH))
