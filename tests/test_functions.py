"""Column functions on hand-worked rows."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import arrays as A
from tokenloom.functions import text as X
from tokenloom.functions import vectors as V
from tokenloom.operators import vocabulary as vocabulary_module


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column).first()[0]


def vec(spark, column, v):
    return one(spark, column, v=[float(x) for x in v])


def test_templates_keep_every_character(spark):
    i, x, o = F.lit("Add"), F.lit("1 2"), F.lit("3")
    assert one(spark, X.plain_prompt(i, x)) == "## Instruction Add \n ## Input 1 2"
    assert one(spark, X.plain_full(i, x, o)) == "## Instruction Add \n ## Input 1 2 \n ## Output 3"
    full = one(spark, X.instruction_full(i, x, o))
    assert [(m.role, m.content) for m in full] == [
        ("system", "You are an instruction following agent."),
        ("user", "## Instruction: Add\n ## Input: 1 2"),
        ("assistant", "## Output: 3"),
    ]
    assert one(spark, X.wrap(F.lit("t"), 1, 0)) == "1t0"
    assert one(spark, X.wrap(F.lit("t"))) == "<|fim_prefix|>t<|fim_suffx|>"


def test_chat_rendering(spark):
    m = F.array(X.message("user", F.lit("hi")), X.message("assistant", F.lit("yo")))
    body = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert one(spark, X.render_chat(m)) == body
    assert one(spark, X.render_chat(m, add_generation_prompt=True)) == body + "<|im_start|>assistant\n"
    opened = one(spark, X.render_chat(m, default_system="S"))
    assert opened == "<|im_start|>system\nS<|im_end|>\n" + body
    with_system = F.concat(F.array(X.message("system", F.lit("own"))), m)
    assert one(spark, X.render_chat(with_system, default_system="S")).count("system") == 1
    assert one(spark, X.render_chat(F.array().cast(X.MESSAGES))) == ""


def test_roles(spark):
    for given, wanted in [("human", "user"), ("gpt", "assistant"), ("system", "system"), ("tool", "tool")]:
        assert one(spark, X.map_role(F.lit(given))) == wanted
    shared = F.array(F.struct(F.lit("gpt").alias("from"), F.lit("a").alias("value")))
    assert [tuple(m) for m in one(spark, X.map_messages(shared))] == [("assistant", "a")]


def test_tokens_and_markers(spark):
    assert one(spark, X.tokens(F.lit("Où est-il? x2\n"))) == ["Où", "est", "-", "il", "?", "x", "2"]
    assert one(spark, X.tokens(F.lit(" \n"))) == []
    assert one(spark, X.found_markers(F.lit("a <|im_end|> b"))) == ["<|im_end|>"]
    assert one(spark, X.found_markers(F.lit("a im_end b"))) == []


def test_label_mask_lengths(spark):
    ids = F.lit([5, 6, 7]).cast("array<bigint>")
    assert one(spark, A.masked_labels(ids, F.lit(2))) == [-100, -100, 7]
    assert one(spark, A.masked_labels(ids, F.lit(0))) == [5, 6, 7]
    assert one(spark, A.masked_labels(ids, F.lit(9))) == [-100] * 3
    assert one(spark, A.supervised(A.masked_labels(ids, F.lit(2)))) == [7]


def test_shift_pad_and_cut(spark):
    ids = F.lit([1, 2, 3]).cast("array<bigint>")
    empty = F.array().cast("array<bigint>")
    s = one(spark, A.shifted(ids))
    assert (s.inputs, s.targets) == ([1, 2], [2, 3])
    s = one(spark, A.shifted(empty))
    assert (s.inputs, s.targets) == ([], [])
    assert one(spark, A.pad_right(ids, F.lit(5))) == [1, 2, 3, 100276, 100276]
    assert one(spark, A.pad_right(ids, F.lit(3), -100)) == [1, 2, 3]
    assert one(spark, A.chunks(F.lit([1, 2, 3, 4]), 2)) == [[1, 2], [3, 4]]
    assert one(spark, A.last(ids)) == 3 and one(spark, A.last(empty)) is None
    assert one(spark, A.positions(ids)) == [0, 1, 2]
    with pytest.raises(Exception, match="multiple"):
        one(spark, A.chunks(F.lit([1, 2, 3]), 2))


def test_activations(spark):
    for x in (-3.0, -0.7, 0.0, 0.4, 2.5):
        c = F.lit(x)
        assert one(spark, V.relu(c)) == max(x, 0.0)
        assert one(spark, V.leaky_relu(c)) == pytest.approx(x if x > 0 else 0.2 * x)
        assert one(spark, V.sigmoid(c)) == pytest.approx(1 / (1 + math.exp(-x)))
        exact = 0.5 * x * (1 + math.erf(x / math.sqrt(2)))
        assert one(spark, V.gelu(c)) == pytest.approx(exact, abs=5e-7)
        assert one(spark, V.gelu_tanh(c)) == pytest.approx(exact, abs=1e-3)


def test_softmax_and_layer_norm(spark):
    w = vec(spark, V.softmax(F.col("v")), [1, 2, 1000])
    assert sum(w) == pytest.approx(1) and w[2] == pytest.approx(1)
    x, r = np.array([1.0, 2, 3, 6]), np.array([0.5, -1, 0, 2])
    got = one(spark, V.layer_norm(F.col("x"), F.col("r")), x=x.tolist(), r=r.tolist())
    y = x + r
    assert got == pytest.approx(((y - y.mean()) / np.sqrt(y.var() + 1e-5)).tolist())


def test_small_and_wide_layers_agree(spark):
    rng = np.random.default_rng(1)
    w, b, v = rng.normal(size=(40, 30)), rng.normal(size=40), rng.normal(size=30)
    want = (w @ v + b).tolist()
    assert vec(spark, V.linear(F.col("v"), w, b), v) == pytest.approx(want)
    assert vec(spark, V.dense(F.col("v"), w, b), v) == pytest.approx(want)
    with pytest.raises(ValueError):
        V.linear(F.col("v"), [[1.0], [1.0, 2.0]])


def test_position_vector_even_sin_odd_cos(spark):
    got = one(spark, V.position_vector(F.lit(3), 4))
    assert got == pytest.approx([math.sin(3), math.cos(3), math.sin(0.03), math.cos(0.03)])
    got = one(spark, V.position_vector(F.lit(3), 4, odd="sin"))
    assert got == pytest.approx([math.sin(3), math.sin(3), math.sin(0.03), math.sin(0.03)])


def test_quantization_error_is_half_a_step(spark):
    v = np.random.default_rng(2).normal(size=70)
    v[32:64] = 0.0
    groups = vec(spark, V.quantize(F.col("v"), 32, 4), v)
    assert [len(g.codes) for g in groups] == [32, 32, 6]
    assert groups[1].scale == 1.0 and set(groups[1].codes) == {0}
    back = np.array(vec(spark, V.dequantize(V.quantize(F.col("v"), 32, 4)), v))
    steps = np.repeat([g.scale for g in groups], [32, 32, 6])
    assert (np.abs(back - v) <= steps / 2 + 1e-12).all()
    assert max(abs(c) for g in groups for c in g.codes) == 7


def test_packed_codes_come_back(spark):
    rng = np.random.default_rng(5)
    for width in (1, 31, 32, 70):
        v = rng.normal(size=width)
        packed = vec(spark, V.pack_groups(V.quantize(F.col("v"), 32, 4)), v)
        assert [len(g.packed) for g in packed] == [(g.n + 1) // 2 for g in packed] and sum(g.n for g in packed) == width
        codes = vec(spark, V.unpack_groups(V.pack_groups(V.quantize(F.col("v"), 32, 4))), v)
        assert [g.codes for g in codes] == [g.codes for g in vec(spark, V.quantize(F.col("v"), 32, 4), v)]


def test_packed_codes_at_the_edges(spark):
    rows = spark.createDataFrame([(0, [-8, 7, 0]), (1, []), (2, None), (3, [1, None]), (4, [-1])], "k int, c array<int>")
    packed = rows.withColumn("p", V.pack_codes(F.col("c"))).withColumn("u", V.unpack_codes(F.col("p"), F.size("c")))
    got = {r.k: (r.p and bytes(r.p).hex(), r.u) for r in packed.collect()}
    assert got[0] == ("0f88", [-8, 7, 0]) and got[4] == ("78", [-1])
    assert got[1][1] == [] and got[2] == (None, None) and got[3] == (None, None)
    with pytest.raises(Exception, match="four bits"):
        spark.createDataFrame([([8],)], "c array<int>").select(V.pack_codes(F.col("c"))).collect()


def test_low_bit_layer_stays_inside_its_bound(spark):
    rng = np.random.default_rng(6)
    weight, bias = rng.normal(size=(5, 64)), rng.normal(size=5)
    weight[2, :32] = 0.0
    packed = V.PackedWeights(weight.tolist(), 32)
    assert len(packed.packed) == 5 * 64 // 2 and np.abs(packed.codes()).max() == 7
    vectors = [*(rng.normal(size=64) * s for s in (1e-3, 1.0, 50.0)), np.zeros(64)]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(8, None), (9, [None] + [1.0] * 63)]
    df = spark.createDataFrame(rows, "k int, v array<double>")
    out = {r.k: r for r in df.select("k", V.low_bit_linear(F.col("v"), packed, bias).alias("y"), packed.error_bound(F.col("v")).alias("b")).collect()}
    for i, v in enumerate(vectors):
        step = np.abs(v).max() / 127 or 1.0
        codes = (np.sign(v) * np.floor(np.abs(v) / step + 0.5)).reshape(2, 32)
        want = (np.einsum("ogi,gi->og", packed.codes(), codes) * packed.scales).sum(axis=1) * step + bias
        assert np.allclose(out[i].y, want, atol=1e-12)
        assert np.abs(np.array(out[i].y) - (weight @ v + bias)).max() <= out[i].b + 1e-12
    assert out[8].y is None and out[9].y is None
    with pytest.raises(Exception, match="64 entries"):
        spark.createDataFrame([([1.0],)], "v array<double>").select(V.low_bit_linear(F.col("v"), packed)).collect()


def test_batch_tokenizer_is_given_few_characters_at_a_time(spark):
    together = X.batch_tokenizer(lambda texts: [[sum(map(len, texts))] for _ in texts])
    rows = [(i, None if i == 7 else "x" * (3_000_000 if i == 5 else 200_000)) for i in range(20)]
    df = spark.createDataFrame(rows, "i int, t string").coalesce(1).select("i", together("t").alias("n"))
    got = {r.i: r.n for r in df.collect()}
    assert len(got) == 20 and got.pop(7) is None and got.pop(5) == [3_000_000]
    assert all(0 < n[0] <= X.CODED_CHARACTERS for n in got.values())


def test_batch_tokenizer_takes_a_quarter_million_characters_and_keeps_nulls(spark):
    together = X.batch_tokenizer(lambda texts: [[len(texts), sum(map(len, texts))] for _ in texts])
    rows = [(0, None), (1, ""), (2, "é" * 150_000), (3, "x" * 150_000), (4, None), (5, "y")]
    df = spark.createDataFrame(rows, "i int, t string").coalesce(1).select("i", together("t").alias("n"))
    got = {r.i: r.n for r in df.collect()}
    assert got == {0: None, 1: [2, 150_000], 2: [2, 150_000], 3: [2, 150_001], 4: None, 5: [2, 150_001]}


def test_tokens_are_looked_up_in_pieces(spark):
    df = spark.createDataFrame([("a b b",)], "t string")
    vocabulary = vocabulary_module.fit_vocabulary(df, X.tokens(F.col("t")), size=9)
    lists = [["b"] * 300_000, None, ["a", "?"], [], ["b"] * 300_000, ["a"] * 600_000]
    coded = list(vocabulary_module._encoder(vocabulary).func(iter([pa.array(lists, pa.list_(pa.string()))])))
    assert [len(c) for c in coded] == [4, 1, 1]
    ids = pa.concat_arrays(coded)
    assert ids[:4].to_pylist()[1:] == [None, [1, vocabulary.unknown_id], []] and set(ids[5].as_py()) == {1}
    named = list(vocabulary_module._decoder(vocabulary).func(iter([ids])))
    assert [len(c) for c in named] == [4, 1, 1] and named[0].to_pylist()[0] == lists[0]
