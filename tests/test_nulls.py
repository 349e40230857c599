"""Null groups, null texts and vectors of the wrong length: nothing is lost, and size changes nothing."""

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import text
from tokenloom.functions import vectors as V
from tokenloom.operators import batching, conversations, series, statistics
from tokenloom.operators.vocabulary import decode, encode, fit_vocabulary


@pytest.fixture(scope="module")
def grouped(spark):
    return spark.range(100).selectExpr("id", "if(id % 4 = 0, null, id % 4) AS g", "array(double(id), 1.0D) AS v")


def test_the_null_group_stays_in_statistics(grouped):
    assert statistics.softmax_by(grouped, F.col("id") / 100, ["g"]).agg(F.sum("weight")).first()[0] == pytest.approx(4)
    assert statistics.standardize_groups(grouped, "v", ["g"]).count() == 100
    assert statistics.clip_by_norm(grouped, "v", 1.0, ["g"]).count() == 100


def test_turns_without_a_conversation_are_checked(spark):
    turns = spark.createDataFrame([(1, 0, "assistant", "a"), (None, 0, "user", "b"), (None, 1, "user", "c")], "conv_id long, turn long, role string, text string")
    split = conversations.check_turns(turns)
    assert split.kept.count() == 1 and split.rejected.count() == 2


def test_missing_texts(spark):
    turns = spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    assert conversations.supervised_tokens(turns).count() == 0
    chat = F.expr("array(struct('user' AS role, string(null) AS content), struct('assistant' AS role, 'x' AS content))")
    assert spark.range(1).select(text.render_chat(chat)).first()[0] is None
    count = text.batch_tokenizer(lambda texts: [[len(t)] for t in texts])
    rows = spark.createDataFrame([("abc",), (None,)], "t string").select(count(F.col("t")).alias("n")).collect()
    assert sorted((r["n"] for r in rows), key=str) == [None, [3]] or sorted((r["n"] for r in rows), key=str) == [[3], None]


@pytest.mark.parametrize("limit", [10**9, 0])
def test_null_texts_code_alike_at_any_size(spark, limit):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "k long, t string")
    vocabulary = fit_vocabulary(docs, text.tokens(F.col("t")))
    coded = encode(docs, ["k"], text.tokens(F.col("t")), vocabulary, max_bytes=limit)
    assert {r["k"]: r["ids"] is None for r in coded.collect()} == {1: False, 2: True, 3: False}
    back = decode(coded, ["k"], F.col("ids"), vocabulary, max_bytes=limit)
    assert {r["k"]: r["text"] for r in back.collect()} == {1: "a b", 2: None, 3: ""}


@pytest.mark.parametrize("width", [4, 64])
def test_a_vector_of_another_length_stops_the_layer(spark, width):
    layer = [[1.0] * width] * 8
    df = spark.range(2).select(F.array_repeat(F.lit(1.0), F.expr(f"int(if(id = 0, {width} / 2, {width} * 3 / 2))")).alias("v"))
    with pytest.raises(Exception, match="the layer takes vectors"):
        df.select(V.linear(F.col("v"), layer)).collect()


@pytest.mark.parametrize("rows", [8, 1000])
def test_a_null_key_is_a_series(spark, rows):
    df = spark.range(20).selectExpr("string(null) AS k", "id AS i", "array(1.0D) AS x")
    cell = series.elman_cell([[0.1]], [0.0], [[0.2]])
    assert series.fold_series(df, ["k"], "i", F.col("x"), cell, 1, rows).first()["n_steps"] == 20


def test_epochs_leave_no_hole(spark):
    steps = batching.repeat_epochs(spark.range(10), "id", 2, rows_per_epoch=20).select("step").collect()
    assert sorted(r["step"] for r in steps) == list(range(20))
