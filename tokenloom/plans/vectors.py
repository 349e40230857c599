"""Queries: norms, normalization, attention, layers, positions, quantization, stored caches."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import vectors as V
from tokenloom.operators import statistics as S
from tokenloom.operators.attention import attention, cut_sequences, encoder_layer, group_attention
from tokenloom.operators.joins import lookup
from tokenloom.operators.vocabulary import encode_texts, fit_text_vocabulary
from tokenloom.plans.registry import DOC_IDS_SQL, query, r_sql, rounded, vector_marks, vector_marks_sql
from tokenloom.session import materialize, scratch_path
from tokenloom.sources import stores
from tokenloom.sources.corpus import documents, table

E_SQL = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
# Short enough that groups are longer than a sequence, or a block, in small tables too.
CONTEXT = 16
WIDTH = 64


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumnRenamed("embedding", "v")


def _marked(df: DataFrame, column: str, *keep: str) -> DataFrame:
    return df.select(*keep, *vector_marks(F.col(column)))


@query(
    "global_norm",
    f"""
    WITH {E_SQL}
    SELECT label, count(*) AS n_parts, {r_sql('sqrt(sum(list_sum(list_transform(v, lambda x: x * x))))')} AS norm
    FROM e GROUP BY label
    """,
)
def global_norm(spark: SparkSession, sf: str) -> DataFrame:
    return S.global_norm(_embeddings(spark, sf), "v", ["label"]).withColumn("norm", rounded(F.col("norm")))


@query(
    "clipped_vectors",
    f"""
    WITH {E_SQL}, n AS (SELECT label, sqrt(sum(list_sum(list_transform(v, lambda x: x * x)))) AS norm FROM e GROUP BY label),
    c AS (SELECT vec_id, list_transform(v, lambda x: x * least(1.0::DOUBLE, 1.0::DOUBLE / (norm + 1e-6))) AS w
          FROM e JOIN n USING (label))
    SELECT vec_id, {vector_marks_sql('w')} FROM c
    """,
)
def clipped_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _marked(S.clip_by_norm(_embeddings(spark, sf), "v", 1.0, ["label"]), "v", "vec_id")


@query(
    "clipped_table",
    f"""
    WITH {E_SQL}, n AS (SELECT sqrt(sum(list_sum(list_transform(v, lambda x: x * x)))) AS norm FROM e),
    c AS (SELECT vec_id, list_transform(v, lambda x: x * least(1.0::DOUBLE, 5.0::DOUBLE / (norm + 1e-6))) AS w FROM e, n)
    SELECT vec_id, {vector_marks_sql('w')} FROM c
    """,
)
def clipped_table(spark: SparkSession, sf: str) -> DataFrame:
    return _marked(S.clip_by_norm(_embeddings(spark, sf), "v", 5.0), "v", "vec_id")


def _standardized_sql(by: str) -> str:
    return f"""
    WITH {E_SQL}, x AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM e),
    m AS (SELECT *, avg(x) OVER (PARTITION BY {by}d) AS mean, var_pop(x) OVER (PARTITION BY {by}d) AS var FROM x),
    z AS (SELECT vec_id, list((x - mean) / sqrt(var + 1e-5) ORDER BY d) AS w FROM m GROUP BY vec_id)
    SELECT vec_id, {vector_marks_sql('w')} FROM z
    """


@query("standardized_columns", _standardized_sql(""))
def standardized_columns(spark: SparkSession, sf: str) -> DataFrame:
    e = _embeddings(spark, sf)
    return _marked(e.withColumn("v", S.fit_standardizer(e, "v").apply(F.col("v"))), "v", "vec_id")


@query("standardized_groups", _standardized_sql("label, "))
def standardized_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _marked(S.standardize_groups(_embeddings(spark, sf), "v", ["label"]), "v", "vec_id")


@query(
    "normalized_rows",
    f"""
    WITH {E_SQL}, s AS (SELECT vec_id, list_transform(v, lambda x, i: x + v[65 - i]) AS u FROM e),
    m AS (SELECT vec_id, list_transform(u, lambda x: x - list_sum(u) / 64) AS c FROM s),
    z AS (SELECT vec_id, list_transform(c, lambda x: x / sqrt(list_sum(list_transform(c, lambda y: y * y)) / 64 + 1e-5)) AS w
          FROM m)
    SELECT vec_id, {vector_marks_sql('w')} FROM z
    """,
)
def normalized_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Layer normalization of each vector plus a residual, here its mirror image."""
    e = _embeddings(spark, sf)
    return _marked(e.withColumn("v", V.layer_norm(F.col("v"), F.reverse("v"))), "v", "vec_id")


@query(
    "scaled_normal_rows",
    f"""
    WITH {E_SQL}, m AS (SELECT vec_id, list_transform(v, lambda x: x - list_sum(v) / 64) AS c FROM e),
    z AS (SELECT vec_id, list_transform(c, lambda x, i: x / sqrt(list_sum(list_transform(c, lambda y: y * y)) / 64 + 1e-5)
                                                        * (1 + i::DOUBLE / 64) - i::DOUBLE / 100) AS w FROM m)
    SELECT vec_id, {vector_marks_sql('w')} FROM z
    """,
)
def scaled_normal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Layer normalization with a stored gain and shift."""
    gain, shift = [1 + i / 64 for i in range(1, 65)], [-i / 100 for i in range(1, 65)]
    e = _embeddings(spark, sf)
    return _marked(e.withColumn("v", V.layer_norm(F.col("v"), gain=gain, shift=shift)), "v", "vec_id")


# Every entry of every token's vector counts, each place with another weight.
@query(
    "embedded_tokens",
    f"""
    WITH {DOC_IDS_SQL}, {E_SQL}, n AS (SELECT count(*) AS n FROM embeddings),
    hit AS (SELECT c.doc_id, c.pos, e.v FROM coded c CROSS JOIN n LEFT JOIN e ON e.vec_id = c.id % n.n),
    flat AS (SELECT doc_id, count(*) AS n_tokens, count(v) AS n_found, flatten(list(v ORDER BY pos)) AS x FROM hit GROUP BY doc_id)
    SELECT doc_id, n_tokens, n_found, {r_sql('list_sum(x)')} AS v_sum,
           {r_sql('list_sum(list_transform(x, lambda y, i: y * ((i - 1) % 97 + 1)))')} AS v_weighted
    FROM flat
    """,
)
def embedded_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The whole vectors of all tokens of every document, in order."""
    docs, vectors = documents(spark, sf), table(spark, sf, "embeddings")
    ids = encode_texts(docs, ["doc_id"], F.col("text"), fit_text_vocabulary(docs, F.col("text")))
    n = vectors.count()
    ids = ids.filter(F.size("ids") > 0).select("doc_id", F.transform("ids", lambda i: i % n).alias("ids"))
    sums = lambda whole: S.sequence_sums(whole, 97)
    found = S.embed_sequences(ids, "doc_id", "ids", vectors, "vec_id", "embedding", WIDTH, fold=(sums, S.SEQUENCE_SUMS))
    return found.select("doc_id", "n_tokens", "n_found", rounded(F.col("v_sum")).alias("v_sum"), rounded(F.col("v_weighted")).alias("v_weighted"))


def _attention_ctes(causal: bool = False, heads: int = 1) -> str:
    """label, seq_no, pos, vec_id, v in `s`; vec_id, a (the attended vector) in `a`."""
    width = 64 // heads
    mask = "AND k.pos <= q.pos" if causal else ""
    return f"""
    WITH {E_SQL}, i AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx FROM e),
    s AS (SELECT vec_id, label, v, idx // {CONTEXT} AS seq_no, idx % {CONTEXT} AS pos FROM i),
    h AS (SELECT s.*, head, v[head * {width} + 1:(head + 1) * {width}] AS part FROM s, (SELECT unnest(range({heads})) AS head)),
    p AS (SELECT q.vec_id, q.head, k.part, list_inner_product(q.part, k.part) / sqrt({width}::DOUBLE) AS score
          FROM h q JOIN h k ON k.label = q.label AND k.seq_no = q.seq_no AND k.head = q.head {mask}),
    w AS (SELECT vec_id, head, part, exp(score - max(score) OVER (PARTITION BY vec_id, head)) AS w FROM p),
    x AS (SELECT vec_id, head, w, unnest(part) AS x, generate_subscripts(part, 1) AS d FROM w),
    y AS (SELECT vec_id, head, d, sum(w * x) / sum(w) AS y FROM x GROUP BY vec_id, head, d),
    a AS (SELECT vec_id, list(y ORDER BY head, d) AS a FROM y GROUP BY vec_id)"""


def _attention_sql(causal: bool = False, heads: int = 1) -> str:
    return f"""{_attention_ctes(causal, heads)}
    SELECT label, seq_no, pos, vec_id, {vector_marks_sql('a')} FROM a JOIN s USING (vec_id)
    """


def _attended(spark: SparkSession, sf: str, **options: object) -> DataFrame:
    rows = cut_sequences(_embeddings(spark, sf), "vec_id", CONTEXT, "label")
    out = attention(rows, ["label", "seq_no"], "v", ["vec_id"], **options)
    return _marked(out, "attended", "label", "seq_no", "pos", "vec_id")


@query("attention_average", _attention_sql())
def attention_average(spark: SparkSession, sf: str) -> DataFrame:
    return _attended(spark, sf)


@query("causal_attention", _attention_sql(causal=True))
def causal_attention(spark: SparkSession, sf: str) -> DataFrame:
    return _attended(spark, sf, causal=True)


@query("multi_head_attention", _attention_sql(heads=8))
def multi_head_attention(spark: SparkSession, sf: str) -> DataFrame:
    return _attended(spark, sf, heads=8)


@query(
    "whole_group_attention",
    f"""
    WITH {E_SQL}, h AS (SELECT vec_id, label, head, v[head * 8 + 1:(head + 1) * 8] AS part
                        FROM e, (SELECT unnest(range(8)) AS head)),
    p AS (SELECT q.vec_id, q.head, k.part, list_inner_product(q.part, k.part) / sqrt(8::DOUBLE) AS score
          FROM h q JOIN h k ON k.label IS NOT DISTINCT FROM q.label AND k.head = q.head),
    w AS (SELECT vec_id, head, part, exp(score - max(score) OVER (PARTITION BY vec_id, head)) AS w FROM p),
    x AS (SELECT vec_id, head, w, unnest(part) AS x, generate_subscripts(part, 1) AS d FROM w),
    y AS (SELECT vec_id, head, d, sum(w * x) / sum(w) AS y FROM x GROUP BY vec_id, head, d),
    a AS (SELECT vec_id, list(y ORDER BY head, d) AS a FROM y GROUP BY vec_id)
    SELECT label, vec_id, {vector_marks_sql('a')} FROM a JOIN e USING (vec_id)
    """,
)
def whole_group_attention(spark: SparkSession, sf: str) -> DataFrame:
    """Eight heads over all vectors of a label."""
    out = group_attention(_embeddings(spark, sf), ["label"], "vec_id", "v", ["vec_id"], heads=8, block=CONTEXT)
    return _marked(out, "attended", "label", "vec_id")


X_SQL = "((value - 10) / 10)"


def _erf_sql(x: str) -> str:
    """The same approximation of the error function as `vectors.erf`, for x of either sign."""
    t, series = f"(1 / (1 + 0.3275911::DOUBLE * abs({x})))", "0::DOUBLE"
    for c in V.ERF_SERIES:
        series = f"(({series}) + ({c!r})::DOUBLE) * {t}"
    return f"sign({x}) * (1 - ({series}) * exp(-{x} * {x}))"


GELU_SQL = f"0.5::DOUBLE * {X_SQL} * (1 + {_erf_sql(f'({X_SQL} / {math.sqrt(2.0)!r}::DOUBLE)')})"


@query(
    "activations",
    f"""
    SELECT event_id, {r_sql(f'greatest({X_SQL}, 0)')} AS relu,
           {r_sql(f'CASE WHEN {X_SQL} > 0 THEN {X_SQL} ELSE 0.2::DOUBLE * {X_SQL} END')} AS leaky_relu,
           {r_sql(f'1 / (1 + exp(-{X_SQL}))')} AS sigmoid, {r_sql(f'tanh({X_SQL})')} AS tanh,
           {r_sql(f"0.5::DOUBLE * {X_SQL} * (1 + tanh({math.sqrt(2 / math.pi)!r}::DOUBLE * ({X_SQL} + 0.044715::DOUBLE * {X_SQL} * {X_SQL} * {X_SQL})))")} AS gelu_tanh,
           {r_sql(GELU_SQL)} AS gelu
    FROM events
    """,
)
def activations(spark: SparkSession, sf: str) -> DataFrame:
    """Each activation of the centred event value. The error function inside `gelu` has a unit test."""
    x = (F.col("value") - 10) / 10
    named = {
        "relu": V.relu, "leaky_relu": V.leaky_relu, "sigmoid": V.sigmoid, "tanh": V.tanh,
        "gelu_tanh": V.gelu_tanh, "gelu": V.gelu,
    }
    return table(spark, sf, "events").select("event_id", *[rounded(f(x)).alias(n) for n, f in named.items()])


@query(
    "softmax_rows",
    f"""
    WITH {E_SQL}, x AS (SELECT vec_id, list_transform(v, lambda x: exp(x - list_max(v))) AS x FROM e),
    w AS (SELECT vec_id, list_transform(x, lambda y: y / list_sum(x)) AS w FROM x)
    SELECT vec_id, {vector_marks_sql('w')} FROM w
    """,
)
def softmax_rows(spark: SparkSession, sf: str) -> DataFrame:
    e = _embeddings(spark, sf)
    return _marked(e.withColumn("v", V.softmax(V.doubles(F.col("v")))), "v", "vec_id")


@query(
    "softmax_groups",
    """
    WITH s AS (SELECT event_id, user_id, exp(value / 50 - max(value / 50) OVER (PARTITION BY user_id)) AS w FROM events)
    SELECT event_id, user_id, floor(w / sum(w) OVER (PARTITION BY user_id) * 1e6 + 0.5) / 1e6 AS weight FROM s
    """,
)
def softmax_groups(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    out = S.softmax_by(events, F.col("value") / 50, ["user_id"])
    return out.select("event_id", "user_id", rounded(F.col("weight")).alias("weight"))


def weight_rule(rows: int, columns: int, salt: int) -> list[list[float]]:
    """A fixed weight matrix by rule: small multiples of 1/64."""
    return [[((i * 7 + j * 3 + salt) % 11 - 5) / 64 for j in range(columns)] for i in range(rows)]


def norm_ctes(source: str, v: str, out: str) -> str:
    """Row normalization of the 64-wide list `v` of `source`, as `out` in a table of that name."""
    return f"""{out}_c AS (SELECT *, list_transform({v}, lambda x: x - list_sum({v}) / 64) AS centred FROM {source}),
    {out} AS (SELECT * EXCLUDE (centred), list_transform(centred, lambda x: x
        / sqrt(list_sum(list_transform(centred, lambda y: y * y)) / 64 + 1e-5)) AS {out} FROM {out}_c)"""


def weight_sql(rows: int, columns: int, salt: int, v: str) -> str:
    entry = f"((i * 7 + j * 3 + {salt}) % 11 - 5)::DOUBLE / 64"
    row = f"list_transform(range({columns}), lambda j: {entry})"
    return f"list_transform(range({rows}), lambda i: list_inner_product({row}, {v}) + i::DOUBLE / 100)"


@query(
    "masked_attention",
    f"""
    WITH {E_SQL}, m AS (SELECT vec_id, label, vec_id % 5 <> 0 AS seen, {weight_sql(64, 64, 1, 'v')} AS q,
                               {weight_sql(64, 64, 2, 'v')} AS k, {weight_sql(64, 64, 3, 'v')} AS v FROM e),
    p AS (SELECT q.vec_id, k.v, list_inner_product(q.q, k.k) / sqrt(64::DOUBLE) AS score
          FROM m q JOIN m k ON k.label IS NOT DISTINCT FROM q.label AND k.vec_id <= q.vec_id AND k.seen),
    w AS (SELECT vec_id, v, exp(score - max(score) OVER (PARTITION BY vec_id)) AS w FROM p),
    x AS (SELECT vec_id, w, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM w),
    y AS (SELECT vec_id, d, sum(w * x) / sum(w) AS y FROM x GROUP BY vec_id, d),
    a AS (SELECT vec_id, list(y ORDER BY d) AS a FROM y GROUP BY vec_id),
    z AS (SELECT label, vec_id, coalesce(a, list_transform(range(64), lambda i: 0::DOUBLE)) AS a FROM e LEFT JOIN a USING (vec_id)),
    o AS (SELECT label, vec_id, {weight_sql(64, 64, 4, 'a')} AS o FROM z)
    SELECT label, vec_id, {vector_marks_sql('o')} FROM o
    """,
)
def masked_attention(spark: SparkSession, sf: str) -> DataFrame:
    """Whole labels, earlier rows only, every fifth row hidden, with weights and biases."""
    rows = _embeddings(spark, sf).withColumn("seen", F.col("vec_id") % 5 != 0)
    weights = {name: weight_rule(64, 64, salt) for salt, name in enumerate("qkvo", 1)}
    biases = {name: [i / 100 for i in range(64)] for name in "qkvo"}
    out = group_attention(
        rows, ["label"], "vec_id", "v", ["vec_id"], causal=True, weights=weights, biases=biases, seen="seen", block=CONTEXT, fan=2
    )
    return _marked(out, "attended", "label", "vec_id")


@query(
    "perceptron_scores",
    f"""
    WITH {E_SQL}, a AS (SELECT vec_id, {weight_sql(32, 64, 1, 'v')} AS a FROM e),
    b AS (SELECT vec_id, {weight_sql(16, 32, 2, 'list_transform(a, lambda x: greatest(x, 0))')} AS b FROM a),
    c AS (SELECT vec_id, {weight_sql(10, 16, 3, 'list_transform(b, lambda x: greatest(x, 0))')} AS c FROM b)
    SELECT vec_id, {vector_marks_sql('c')} FROM c
    """,
)
def perceptron_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score a stored three-layer perceptron; its first layer is wide, the others are not."""
    shapes = [(32, 64, 1, V.relu), (16, 32, 2, V.relu), (10, 16, 3, V.identity)]
    layers = [(weight_rule(r, c, s), [i / 100 for i in range(r)], act) for r, c, s, act in shapes]
    e = _embeddings(spark, sf)
    return _marked(e.withColumn("v", V.perceptron(F.col("v"), layers)), "v", "vec_id")


@query(
    "encoder_layer",
    f"""{_attention_ctes(heads=8)},
    r1 AS (SELECT vec_id, list_transform(a, lambda x, i: x + v[i]) AS u FROM a JOIN e USING (vec_id)),
    {norm_ctes('r1', 'u', 'n1')},
    f1 AS (SELECT vec_id, n1, {weight_sql(32, 64, 4, 'n1')} AS h FROM n1),
    f2 AS (SELECT vec_id, n1, {weight_sql(32, 32, 5, 'list_transform(h, lambda x: greatest(x, 0))')} AS h FROM f1),
    f3 AS (SELECT vec_id, n1, {weight_sql(64, 32, 6, 'h')} AS h FROM f2),
    r2 AS (SELECT vec_id, list_transform(h, lambda x, i: x + n1[i]) AS w FROM f3),
    {norm_ctes('r2', 'w', 'n2')}
    SELECT vec_id, {vector_marks_sql('n2')} FROM n2
    """,
)
def encoder_layer_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Eight-head attention and a three-layer feed-forward net, with residuals and normalization."""
    shapes = [(32, 64, 4, V.relu), (32, 32, 5, V.identity), (64, 32, 6, V.identity)]
    layers = [(weight_rule(r, c, s), [i / 100 for i in range(r)], act) for r, c, s, act in shapes]
    rows = cut_sequences(_embeddings(spark, sf), "vec_id", CONTEXT, "label")
    return _marked(encoder_layer(rows, ["label", "seq_no"], "v", ["vec_id"], layers, heads=8), "v", "vec_id")


@query(
    "position_features",
    f"""
    WITH {E_SQL}, p AS (SELECT vec_id, list_transform(v, lambda x, i: x + CASE WHEN i % 2 = 1
            THEN sin((vec_id % 128) / pow(10000.0::DOUBLE, (i - 1) / 64.0::DOUBLE))
            ELSE cos((vec_id % 128) / pow(10000.0::DOUBLE, (i - 2) / 64.0::DOUBLE)) END) AS w FROM e)
    SELECT vec_id, {vector_marks_sql('w')} FROM p
    """,
)
def position_features(spark: SparkSession, sf: str) -> DataFrame:
    """Add the sinusoidal features of the place in a 128-row sequence to each vector."""
    e = _embeddings(spark, sf)
    placed = V.add(V.doubles(F.col("v")), V.position_vector(F.col("vec_id") % 128, 64))
    return _marked(e.withColumn("v", placed), "v", "vec_id")


@query(
    "placed_entries",
    f"""
    WITH {E_SQL}, i AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) % {CONTEXT} AS pos FROM e),
    x AS (SELECT vec_id, pos, generate_subscripts(v, 1) - 1 AS dim, unnest(v) AS x FROM i),
    p AS (SELECT *, x + CASE WHEN dim % 2 = 0 THEN sin(pos / pow(10000.0::DOUBLE, dim / 64.0::DOUBLE))
                             ELSE sin(pos / pow(10000.0::DOUBLE, (dim - 1) / 64.0::DOUBLE)) END AS y FROM x)
    SELECT vec_id, pos, count(*) AS width, {r_sql('sum(y)')} AS v_sum, {r_sql('sum(y * (dim + 1))')} AS v_weighted
    FROM p GROUP BY vec_id, pos
    """,
)
def placed_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Add the position table, sine in all entries, to vectors in long form by place and entry."""
    rows = cut_sequences(_embeddings(spark, sf), "vec_id", CONTEXT, "label")
    long = rows.select("vec_id", "pos", F.posexplode(V.doubles(F.col("v"))).alias("dim", "x"))
    features = V.position_table(spark, CONTEXT, 64, odd="sin")
    y = F.col("x") + F.col("value")
    return lookup(long, features, ["pos", "dim"]).groupBy("vec_id", "pos").agg(
        F.count(F.lit(1)).alias("width"),
        rounded(F.sum(y)).alias("v_sum"),
        rounded(F.sum(y * (F.col("dim") + 1))).alias("v_weighted"),
    )


@query(
    "quantized_vectors",
    f"""
    WITH {E_SQL}, g AS (SELECT vec_id, grp, v[grp * 32 + 1:(grp + 1) * 32] AS part FROM e, (SELECT unnest([0, 1]) AS grp)),
    s AS (SELECT *, list_max(list_transform(part, lambda x: abs(x))) / 7 AS step FROM g),
    q AS (SELECT vec_id, grp, part, CASE WHEN step > 0 THEN step ELSE 1 END AS step FROM s),
    c AS (SELECT *, list_transform(part, lambda x: round(x / step)) AS codes FROM q)
    SELECT vec_id, grp AS group_no, {r_sql('step')} AS scale, list_sum(codes)::BIGINT AS code_sum,
           list_sum(list_transform(codes, lambda x, i: x * i))::BIGINT AS code_weighted,
           {r_sql('list_max(list_transform(part, lambda x, i: abs(x - codes[i] * step)))')} AS worst_error
    FROM c
    """,
)
def quantized_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Four-bit codes per 32 entries, with the largest error after dequantizing."""
    e = _embeddings(spark, sf).select("vec_id", V.doubles(F.col("v")).alias("v"))
    coded = e.withColumn("q", V.quantize(F.col("v"), 32, 4))
    off = F.zip_with("v", V.dequantize(F.col("q")), lambda x, y: F.abs(x - y))
    rows = coded.withColumn("off", off).select("vec_id", "off", F.posexplode("q").alias("group_no", "g"))
    codes = F.transform("g.codes", lambda c: c.cast("double"))
    return rows.select(
        "vec_id",
        "group_no",
        rounded(F.col("g.scale")).alias("scale"),
        V.total(codes).cast("bigint").alias("code_sum"),
        V.total(F.transform(codes, lambda c, i: c * (i + 1))).cast("bigint").alias("code_weighted"),
        rounded(F.array_max(F.slice("off", F.col("group_no") * 32 + 1, 32))).alias("worst_error"),
    )


@query(
    "packed_vectors",
    f"""
    WITH {E_SQL}, g AS (SELECT vec_id, grp, v[grp * 32 + 1:(grp + 1) * 32] AS part FROM e, (SELECT unnest([0, 1]) AS grp)),
    s AS (SELECT *, list_max(list_transform(part, lambda x: abs(x))) / 7 AS step FROM g),
    q AS (SELECT vec_id, grp, part, CASE WHEN step > 0 THEN step ELSE 1 END AS step FROM s),
    c AS (SELECT *, list_transform(part, lambda x: round(x / step)::BIGINT) AS codes FROM q)
    SELECT vec_id, grp AS group_no, 16::BIGINT AS n_bytes, {r_sql('step / 2')} AS bound,
           array_to_string(list_transform(codes, lambda x: substr('0123456789ABCDEF', x + 9, 1)), '') AS packed,
           {r_sql('list_max(list_transform(part, lambda x, i: abs(x - codes[i] * step)))')} AS worst_error
    FROM c
    """,
)
def packed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Two four-bit codes a byte per 32 entries, and how far the unpacked vector is off."""
    e = _embeddings(spark, sf).select("vec_id", V.doubles(F.col("v")).alias("v"))
    packed = e.withColumn("q", V.pack_groups(V.quantize(F.col("v"), 32, 4)))
    off = F.zip_with("v", V.dequantize(V.unpack_groups(F.col("q"))), lambda x, y: F.abs(x - y))
    rows = packed.withColumn("off", off).select("vec_id", "off", F.posexplode("q").alias("group_no", "g"))
    return rows.select(
        "vec_id",
        "group_no",
        F.octet_length("g.packed").cast("bigint").alias("n_bytes"),
        rounded(F.col("g.scale") / 2).alias("bound"),
        F.hex("g.packed").alias("packed"),
        rounded(F.array_max(F.slice("off", F.col("group_no") * 32 + 1, 32))).alias("worst_error"),
    )


# The weights of a rule have all their eleven values in any 32 neighbours, so every group has the same scale.
_STEP_SQL = "(5::DOUBLE / 64 / 7)"
_CODE_SQL = f"round(((i * 7 + j * 3 + 7) % 11 - 5)::DOUBLE / 64 / {_STEP_SQL})"
_CODES_SQL = f"list_transform(range(64), lambda j: {_CODE_SQL})"


@query(
    "low_bit_products",
    f"""
    WITH {E_SQL}, m AS (SELECT *, list_max(list_transform(v, lambda x: abs(x))) / 127 AS step FROM e),
    s AS (SELECT vec_id, v, CASE WHEN step > 0 THEN step ELSE 1 END AS step FROM m),
    c AS (SELECT *, list_transform(v, lambda x: round(x / step)) AS codes, {weight_sql(16, 64, 7, 'v')} AS exact FROM s),
    y AS (SELECT *, list_transform(range(16), lambda i:
            list_inner_product({_CODES_SQL}, codes) * {_STEP_SQL} * step + i::DOUBLE / 100) AS y FROM c)
    SELECT vec_id, {vector_marks_sql('y')},
           {r_sql('list_max(list_transform(y, lambda x, i: abs(x - exact[i])))')} AS worst_error,
           {r_sql(f"""list_sum(list_transform(v, lambda x: abs(x))) * {_STEP_SQL} / 2 + list_max(list_transform(v, lambda x: abs(x))) / 127 / 2
               * list_max(list_transform(range(16), lambda i: list_sum(list_transform({_CODES_SQL}, lambda w: abs(w))))) * {_STEP_SQL}""")} AS bound
    FROM y
    """,
)
def low_bit_products(spark: SparkSession, sf: str) -> DataFrame:
    """A layer of packed four-bit weights on eight-bit vectors, with its largest error and the bound on it."""
    weight, bias = weight_rule(16, 64, 7), [i / 100 for i in range(16)]
    packed = V.PackedWeights(weight)
    e = _embeddings(spark, sf).select("vec_id", V.doubles(F.col("v")).alias("v"))
    both = e.withColumn("y", V.low_bit_linear(F.col("v"), packed, bias)).withColumn("exact", V.dense(F.col("v"), weight, bias))
    return both.select(
        "vec_id",
        *vector_marks(F.col("y")),
        rounded(F.array_max(F.zip_with("y", "exact", lambda a, b: F.abs(a - b)))).alias("worst_error"),
        rounded(packed.error_bound(F.col("v"))).alias("bound"),
    )


_RELU_SQL = "list_transform({}, lambda x: greatest(x, 0))"


@query(
    "captured_layers",
    f"""
    WITH {E_SQL}, a AS (SELECT vec_id, {_RELU_SQL.format('a')} AS a FROM (SELECT vec_id, {weight_sql(32, 64, 1, 'v')} AS a FROM e)),
    b AS (SELECT vec_id, {_RELU_SQL.format('b')} AS b FROM (SELECT vec_id, {weight_sql(16, 32, 2, 'a')} AS b FROM a)),
    c AS (SELECT vec_id, {weight_sql(10, 16, 3, 'b')} AS c FROM b),
    captured AS (SELECT vec_id, 'layer_1' AS layer, a AS x FROM a UNION ALL SELECT vec_id, 'layer_2', b FROM b
                 UNION ALL SELECT vec_id, 'layer_3', c FROM c)
    SELECT vec_id, layer, {vector_marks_sql('x')} FROM captured
    """,
)
def captured_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Each layer's activations of a stored net, kept once per vector in a folder per layer and read back."""
    shapes = [(32, 64, 1, V.relu), (16, 32, 2, V.relu), (10, 16, 3, V.identity)]
    layers = [(weight_rule(r, c, s), [i / 100 for i in range(r)], act) for r, c, s, act in shapes]
    path = scratch_path(spark, "layers")
    long = stores.capture_layers(_embeddings(spark, sf), ["vec_id"], F.col("v"), layers)
    kept = stores.first_writes(long.withColumn("seq", F.lit(0)), ["vec_id", "layer"], "seq", ["activation"])
    stores.save_cache(kept.select("vec_id", "layer", "activation"), path)
    return _marked(stores.read_cache(spark, path), "activation", "vec_id", "layer")


def _captured(spark: SparkSession, sf: str) -> DataFrame:
    """Two layers of activations per vector, each written twice; the later copy is shifted."""
    e = _embeddings(spark, sf).select("vec_id", V.doubles(F.col("v")).alias("v"))
    layers = F.array(
        F.struct(F.lit("layer_1").alias("layer"), F.col("v").alias("activation")),
        F.struct(F.lit("layer_2").alias("layer"), V.activate(F.col("v"), V.relu).alias("activation")),
    )
    long = e.select(F.concat(F.lit("sample_"), F.col("vec_id")).alias("sample"), "vec_id", F.inline(layers))
    again = long.withColumn("activation", F.transform("activation", lambda x: x + 1.0))
    return long.withColumn("seq", F.lit(0)).unionByName(again.withColumn("seq", F.lit(1)))


CAPTURED_SQL = f"""{E_SQL}, captured AS (
        SELECT 'sample_' || vec_id AS sample, 'layer_1' AS layer, v AS activation FROM e
        UNION ALL SELECT 'sample_' || vec_id, 'layer_2', list_transform(v, lambda x: greatest(x, 0)) FROM e)"""


@query(
    "first_write_cache",
    f"""
    WITH {CAPTURED_SQL}
    SELECT sample, layer, 1::BIGINT AS n_dropped, {vector_marks_sql('activation')} FROM captured
    """,
)
def first_write_cache(spark: SparkSession, sf: str) -> DataFrame:
    kept = stores.first_writes(_captured(spark, sf), ["sample", "layer"], "seq", ["activation"])
    return _marked(kept, "activation", "sample", "layer", "n_dropped")


@query(
    "stored_cache_layer",
    f"""
    WITH {CAPTURED_SQL}
    SELECT sample, layer, {vector_marks_sql('activation')} FROM captured WHERE layer = 'layer_2'
    """,
)
def stored_cache_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Save the cache with a folder per layer, then read one layer."""
    path = scratch_path(spark, "cache")
    kept = stores.first_writes(_captured(spark, sf), ["sample", "layer"], "seq", ["activation"])
    stores.save_cache(kept.select("sample", "layer", "activation"), path)
    return _marked(stores.read_cache(spark, path, "layer_2"), "activation", "sample", "layer")


@query(
    "chat_exchange",
    """
    SELECT u.conv_id, u.turn, md5(u.text) AS asked_md5, md5(a.text) AS answered_md5, 0.1::DOUBLE AS temperature
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'
    """,
)
def chat_exchange(spark: SparkSession, sf: str) -> DataFrame:
    """Write requests, read them back; put answers into reply objects and take the text out again."""
    from tokenloom.operators.conversations import turn_pairs

    pairs = turn_pairs(table(spark, sf, "conversations"))
    path = scratch_path(spark, "requests")
    stores.chat_requests(pairs, ["conv_id", "turn"], F.col("instruction"), "any-model").write.json(path)
    sent = spark.read.schema("conv_id bigint, turn bigint, request string").json(path)
    message = F.struct(F.struct(F.lit("assistant").alias("role"), F.col("output").alias("content")).alias("message"))
    replies = pairs.select("conv_id", "turn", F.to_json(F.struct(F.array(message).alias("choices"))).alias("reply"))
    answers = stores.chat_replies(replies, ["conv_id", "turn"])
    return sent.join(answers, ["conv_id", "turn"]).select(
        "conv_id",
        "turn",
        F.md5(F.get_json_object("request", "$.messages[1].content")).alias("asked_md5"),
        F.md5("content").alias("answered_md5"),
        F.get_json_object("request", "$.temperature").cast("double").alias("temperature"),
    )
