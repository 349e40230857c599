"""Conversations, batches, packs and vocabularies."""

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import arrays as A
from tokenloom.functions import text as X
from tokenloom.functions import vectors as V
from tokenloom.operators import batching as B
from tokenloom.operators import conversations as C
from tokenloom.operators.packing import pack_sequences
from tokenloom.operators.vocabulary import decode, encode, fit_vocabulary
from tokenloom.plans.preparation import utf8_bytes
from tokenloom.sources import stores

CONV = f"id int, messages {X.MESSAGES}"


def test_nested_check_gives_reasons(spark):
    df = spark.createDataFrame(
        [
            (1, [("user", "q"), ("assistant", "a")]),
            (2, [("assistant", "a"), ("user", "q")]),
            (3, []),
            (4, None),
            (5, [("user", None), ("assistant", "a")]),
        ],
        CONV,
    )
    kept, rejected = C.check_messages(df)
    assert [r.id for r in kept.collect()] == [1]
    assert {r.id: r.reason for r in rejected.collect()} == {
        2: "last turn is not assistant", 3: "no turns", 4: "no turns", 5: "missing role or content",
    }
    assert C.check_messages(df.filter("id = 1"), strict=True).kept.count() == 1
    with pytest.raises(Exception, match="not assistant"):
        C.check_messages(df.filter("id < 3"), strict=True).kept.collect()


def test_flat_check_gives_reasons(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q"), (3, 0, "user", None), (3, 1, "assistant", "a")],
        "conv_id int, turn int, role string, text string",
    )
    kept, rejected = C.check_turns(turns)
    assert {r.conv_id for r in kept.collect()} == {1}
    assert {(r.conv_id, r.reason) for r in rejected.collect()} == {
        (2, "last turn is not assistant"), (3, "missing role or content"),
    }


def test_marker_modes(spark):
    df = spark.createDataFrame([("a <|im_start|>",), ("b",)], "text string")
    assert C.guard_markers(df, "text", "allow").count() == 2
    assert [r.text for r in C.guard_markers(df, "text", "reject").collect()] == ["b"]
    with pytest.raises(ValueError):
        C.guard_markers(df, "text", "drop")


def test_example_flags(spark):
    inst = spark.createDataFrame([("i", "x", "o")], "instruction string, input string, output string")
    for flags in ({"packing": True}, {"style": "plain"}):
        with pytest.raises(NotImplementedError):
            C.message_columns(inst, **flags)
    roles = spark.createDataFrame([([("user", "q"), ("assistant", "a")],)], f"conversations {X.MESSAGES}")
    with pytest.raises(ValueError, match="from"):
        C.message_columns(roles, pre_conv=True, format_change=True)
    shared = spark.createDataFrame(
        [([("human", "q"), ("gpt", "a")],)], "conversations array<struct<from:string,value:string>>"
    )
    row = C.message_columns(shared, pre_conv=True, format_change=True).first()
    assert [tuple(m) for m in row.full] == [("user", "q"), ("assistant", "a")]
    assert [tuple(m) for m in row.prompt] == [("user", "q")]


def test_examples_mask_exactly_the_prompt(spark):
    df = spark.createDataFrame([([("user", "é"), ("assistant", "ok")],)], f"conversations {X.MESSAGES}")
    byte_ids = X.batch_tokenizer(utf8_bytes)
    prompt = "<|im_start|>user\né<|im_end|>\n".encode()
    answer = b"<|im_start|>assistant\nok<|im_end|>\n"
    row = C.build_examples(df, byte_ids, pre_conv=True).first()
    assert row.input_ids == list(prompt + answer)
    assert row.labels == [-100] * len(prompt) + list(answer)
    header = b"<|im_start|>assistant\n"
    row = C.build_examples(df, byte_ids, mask_header=True, pre_conv=True).first()
    assert row.labels == [-100] * len(prompt + header) + list(answer[len(header):])


def test_assembled_examples_lose_nothing(spark):
    turns = spark.range(60).selectExpr("id div 6 AS conv_id", "id % 6 AS turn", "5L AS last_turn")
    encoded = turns.select("*", F.transform(F.sequence(F.lit(1), F.col("turn") + 3), lambda x: x + 10 * F.col("turn")).alias("ids"))
    labelled = C.label_turns(encoded)
    chunks = C.assemble_examples(labelled, 10).orderBy("conv_id", "chunk_no").collect()
    whole = [x + 10 * t for t in range(6) for x in range(1, t + 4)]
    labels = [x if x > 50 else -100 for x in whole]
    for conv in range(10):
        mine = [c for c in chunks if c.conv_id == conv]
        assert [len(c.input_ids) for c in mine] == [10, 10, 10, 3]
        assert sum((c.input_ids for c in mine), []) == whole
        assert sum((c.labels for c in mine), []) == labels


def test_batches_pad_only_at_the_end(spark):
    df = spark.range(20).select("id", F.array_repeat(F.col("id"), (F.col("id") % 5).cast("int")).alias("ids"))
    rows = B.pad_batches(B.with_batch(df, "id", 8), "ids").collect()
    at_once = B.padded_batches(df, "id", "ids", 8).select(*B.pad_batches(B.with_batch(df, "id", 8), "ids").columns).collect()
    assert sorted(map(str, at_once)) == sorted(map(str, rows))
    assert {r.batch_id for r in rows} == {0, 1, 2}
    assert sum(r.batch_id == 2 for r in rows) == 4
    for r in rows:
        n = r.id % 5
        assert r.width == 4 and r.ids == [r.id] * n + [A.PAD_ID] * (4 - n)
    report = {r.batch_id: r for r in B.shape_report(B.with_batch(df, "id", 8), "ids").collect()}
    assert (report[2].n_rows, report[2].width, report[2].n_real) == (4, 4, 10)
    assert report[2].fill == pytest.approx(10 / 16)


def test_columnar_and_back(spark):
    df = spark.range(10).selectExpr("id", "string(id) AS a", "if(id % 3 = 0, null, id) AS b")
    batched = B.with_batch(df, "id", 4)
    columnar = B.to_columnar(batched, ["a", "b"])
    assert columnar.filter("batch_id = 2").first().a == ["8", "9"]
    back = {(r.batch_id, r.slot): (r.a, r.b) for r in B.to_rows(columnar, ["a", "b"]).collect()}
    assert back == {(r.batch_id, r.slot): (r.a, r.b) for r in batched.collect()}


def test_epochs_and_stops(spark):
    df = spark.range(10).selectExpr("id * 2 AS k")
    rows = B.repeat_epochs(df, "k", 2, rows_per_epoch=3).orderBy("step").collect()
    assert [(r.epoch, r.k, r.step) for r in rows] == [(0, 0, 0), (0, 2, 1), (0, 4, 2), (1, 0, 3), (1, 2, 4), (1, 4, 5)]
    assert B.first_batches(df, "k", 4, 2).count() == 8


def test_accumulation_drops_the_incomplete_step(spark):
    df = spark.range(7).selectExpr("id AS k", "double(id) AS x")
    full = B.accumulate(df, "k", F.col("x"), 3).orderBy("step").collect()
    assert [(r.step, r.loss) for r in full] == [(0, pytest.approx(1.0)), (1, pytest.approx(4.0))]
    assert B.accumulate(df, "k", F.col("x"), 3, keep_incomplete=True).count() == 3


def test_packs_hold_every_token_once(spark):
    df = spark.range(100).select("id", F.transform(F.sequence(F.lit(0), F.col("id") % 7), lambda x: F.col("id") * 10 + x).alias("t"))
    df = df.withColumn("t", F.when(F.col("id") % 9 == 0, F.array().cast("array<bigint>")).otherwise(F.col("t")))
    df = df.withColumn("t", F.when(F.col("id") == 50, F.sequence(F.lit(10_000), F.lit(10_099)).cast("array<bigint>")).otherwise(F.col("t")))
    tokens = [x for r in df.orderBy("id").collect() for x in r.t]
    packs = pack_sequences(df, "id", "t", 16).orderBy("pack_id").collect()
    assert [x for p in packs for x in p.t] == tokens
    assert all(len(p.t) == 16 for p in packs[:-1]) and len(packs) == -(-len(tokens) // 16)
    assert [p.pack_id for p in packs] == list(range(len(packs)))


@pytest.mark.parametrize("limit", [10**9, 0])
def test_vocabulary_codes_both_ways(spark, limit):
    df = spark.createDataFrame([(1, "b a b c"), (2, ""), (3, "a b zz")], "id int, text string")
    tokens = X.tokens(F.col("text"))
    vocabulary = fit_vocabulary(df, tokens, size=7)
    table = {r.token: (r.id, r.n) for r in vocabulary.table.collect()}
    assert table["b"] == (0, 3) and table["a"] == (1, 2) and table["c"] == (2, 1)
    assert "zz" not in table  # three places, c sorts before zz
    assert (vocabulary.unknown_id, vocabulary.pad_id) == (5, 6)
    ids = encode(df, ["id"], tokens, vocabulary, max_bytes=limit)
    assert {r.id: r.ids for r in ids.collect()} == {1: [0, 1, 0, 2], 2: [], 3: [1, 0, 5]}
    back = {r.id: r.text for r in decode(ids, ["id"], F.col("ids"), vocabulary, max_bytes=limit).collect()}
    assert back == {1: "b a b c", 2: "", 3: "a b <|unknown|>"}


def test_large_vocabulary_is_cut_exactly(spark):
    df = spark.range(3000).selectExpr("id", "array_repeat(concat('w', id % 700), int(id % 700 % 5 + 1)) AS t")
    counts = {}
    for i in range(3000):
        counts[f"w{i % 700}"] = counts.get(f"w{i % 700}", 0) + i % 700 % 5 + 1
    want = sorted(counts, key=lambda w: (-counts[w], w))[:196]
    got = fit_vocabulary(df, F.col("t"), size=200).table.filter("n > 0").orderBy("id").collect()
    assert [r.token for r in got] == want


def test_length_batches_keep_every_row_and_fill_better(spark):
    lengths = [5] * 400 + [(i * 37) % 90 for i in range(500)] + [None] * 3 + [0] * 4
    rows = [(7 * i, None if n is None else list(range(n))) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "k long, ids array<int>").repartition(5)
    got = B.length_batches(df, "k", "ids", 16, pad=-1).collect()
    order = sorted(rows, key=lambda r: (-len(r[1] or ()), r[0]))
    place = {k: i for i, (k, _) in enumerate(order)}
    assert sorted(r.k for r in got) == [k for k, _ in rows]
    for r in got:
        ids = dict(rows)[r.k]
        members = [len(x or ()) for _, x in order[r.batch_id * 16 : r.batch_id * 16 + 16]]
        assert r.idx == r.k // 7 and r.batch_id * 16 + r.slot == place[r.k] and r.width == max(members)
        assert r.ids == (None if ids is None else ids + [-1] * (r.width - len(ids)))
    assert B.length_batches(df.limit(0), "k", "ids", 16).count() == 0
    plain = B.padded_batches(df.filter("ids IS NOT NULL"), "k", "ids", 16)
    slots = lambda rows: rows.agg(F.sum(F.size("ids"))).first()[0]
    assert slots(B.length_batches(df.filter("ids IS NOT NULL"), "k", "ids", 16)) < slots(plain)


def test_every_layer_is_captured_once(spark):
    layers = [([[1.0, -1.0], [2.0, 0.0], [0.0, 0.5]], [0.0, 1.0, 0.0], V.relu), ([[1.0, 1.0, 2.0]], None, V.identity)]
    df = spark.createDataFrame([(1, [3.0, 4.0], "x"), (2, None, "y")], "id int, v array<double>, layer string")
    got = {(r.id, r.layer): r.activation for r in stores.capture_layers(df, ["id"], F.col("v"), layers).collect()}
    assert got == {(1, "layer_1"): [0.0, 7.0, 2.0], (1, "layer_2"): [11.0], (2, "layer_1"): None, (2, "layer_2"): None}
