"""Next-token model, attention, series, statistics, learning, stores and streams."""

import math
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom import session
from tokenloom.functions import text as X
from tokenloom.functions import vectors as V
from tokenloom.operators import attention as attention_module
from tokenloom.operators import learning as L
from tokenloom.operators import ngrams as N
from tokenloom.operators import series as R
from tokenloom.operators import statistics as S
from tokenloom.operators.batching import cosine_rate
from tokenloom.operators.attention import attention, cut_sequences, group_attention
from tokenloom.operators.vocabulary import encode, fit_vocabulary
from tokenloom.plans import sequences as Q
from tokenloom.session import materialize, scratch_path
from tokenloom.sources import corpus, stores
from tokenloom.streaming import streams


@pytest.fixture(scope="module")
def lm(spark):
    df = spark.createDataFrame([(1, "a b a b a c"), (2, "a b")], "id int, text string")
    vocabulary = fit_vocabulary(df, X.tokens(F.col("text")), size=10)
    encoded = encode(df, ["id"], X.tokens(F.col("text")), vocabulary)
    return encoded, N.fit_ngrams(encoded, "ids", vocabulary)


def test_pair_counts(lm):
    pairs = {(r.context, r.next): r.n for r in lm[1].pairs.collect()}
    # a, b, c = 0, 1, 2; start and end = 6, 7
    assert pairs == {(6, 0): 2, (0, 1): 3, (1, 0): 2, (0, 2): 1, (2, 7): 1, (1, 7): 1}


def test_loss_and_perplexity(spark, lm):
    encoded, model = lm
    scored = {r.id: r for r in N.score_sequences(encoded, "id", "ids", model).collect()}
    nll = -(math.log(3 / 12) + math.log(4 / 14) + math.log(2 / 13))
    assert scored[2].n_targets == 3 and scored[2].nll == pytest.approx(nll)
    total = N.perplexity(N.score_sequences(encoded, "id", "ids", model)).first()
    assert total.ppl == pytest.approx(math.exp(total.loss)) and total.n_targets == 10
    unseen = spark.createDataFrame([(9, [2, 2])], "id int, ids array<bigint>")
    row = N.score_sequences(unseen, "id", "ids", model, ignore=7).first()
    assert row.n_targets == 2 and row.nll == pytest.approx(-(math.log(1 / 12) + math.log(1 / 11)))


def test_ranking_and_ties(lm):
    best = {r.context: r.next for r in N.best_next(lm[1]).collect()}
    assert best == {6: 0, 0: 1, 1: 0, 2: 7}
    assert N.top_next(lm[1], 1).count() == 4
    assert N.top_next(lm[1], 2).count() == 6


@pytest.mark.parametrize("steps", [1, 2, 5, 8])
def test_greedy_continuation(spark, lm, steps):
    starts = spark.createDataFrame([(1, 0), (2, 2), (3, 7)], "id int, context bigint")
    out = {r.id: r.ids for r in N.continue_greedy(starts, lm[1], steps).collect()}
    assert out == {1: [1, 0, 1, 0, 1, 0, 1, 0][:steps], 2: [7], 3: []}
    out = {r.id: r.ids for r in N.continue_greedy(starts, lm[1], steps, append_stop=False).collect()}
    assert out[2] == []
    out = {r.id: r.ids for r in N.continue_greedy(starts, lm[1], steps, stop=1).collect()}
    assert out[1] == [1]


def test_draws_cover_the_line_and_repeat(spark, lm):
    model = lm[1]
    ranges = N.draw_ranges(model, 1.0).orderBy("context", "lo").collect()
    for context in {r.context for r in ranges}:
        mine = [r for r in ranges if r.context == context]
        assert mine[0].lo == 0.0 and mine[-1].hi == 1.0
        assert all(a.hi == b.lo for a, b in zip(mine, mine[1:]))
    starts = spark.range(3000).selectExpr("id", "0L AS context")
    first = {r.id: r.ids for r in N.continue_draws(starts, "id", model, 3, 1.0, 7).collect()}
    again = {r.id: r.ids for r in N.continue_draws(starts.repartition(7), "id", model, 3, 1.0, 7).collect()}
    assert first == again and len(first) == 3000
    assert np.mean([ids[0] == 1 for ids in first.values()]) == pytest.approx(0.75, abs=0.04)
    cold = N.continue_draws(starts, "id", model, 3, 0.02, 7).collect()
    assert all(r.ids == [1, 0, 1] for r in cold)
    assert {r.context: r.next for r in N.draw_next(model, 0, 1).collect()} == {6: 0, 0: 1, 1: 0, 2: 7}


def softmax_rows(s):
    w = np.exp(s - s.max(-1, keepdims=True))
    return w / w.sum(-1, keepdims=True)


@pytest.mark.parametrize("causal", [False, True])
@pytest.mark.parametrize("heads", [1, 2])
def test_attention_against_matrices(spark, causal, heads):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(23, 4))
    mats = {n: rng.normal(size=(4, 4)) for n in "qkvo"}
    df = spark.createDataFrame([(i, "g", v.tolist()) for i, v in enumerate(x)], "id int, g string, v array<double>")
    out = attention(
        cut_sequences(df, "id", 10, "g"), ["g", "seq_no"], "v", ["id"], heads, causal, {n: m.tolist() for n, m in mats.items()}
    )
    got = {r.id: r.attended for r in out.collect()}
    assert len(got) == 23
    for start in (0, 10, 20):
        part = x[start:start + 10]
        q, k, v = (part @ mats[n].T for n in "qkv")
        mixed = []
        for h in range(heads):
            cut = slice(h * 4 // heads, (h + 1) * 4 // heads)
            s = q[:, cut] @ k[:, cut].T / math.sqrt(4 // heads)
            if causal:
                s[np.triu_indices(len(part), 1)] = -np.inf
            mixed.append(softmax_rows(s) @ v[:, cut])
        want = np.hstack(mixed) @ mats["o"].T
        for i, row in enumerate(want):
            assert got[start + i] == pytest.approx(row.tolist())


@pytest.mark.parametrize("causal", [False, True])
@pytest.mark.parametrize("block", [3, 64])
def test_group_attention_against_matrices(spark, causal, block):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(23, 4)) * 8
    mats = {n: rng.normal(size=(4, 4)) for n in "qkvo"}
    offsets = {n: rng.normal(size=4) for n in "qkvo"}
    rows = [(i, None if i < 17 else "g", i % 3 != 0, v.tolist()) for i, v in enumerate(x)] + [(99, "g", True, None)]
    df = spark.createDataFrame(rows, "id int, g string, open boolean, v array<double>")
    got = group_attention(
        df, ["g"], "id", "v", ["id"], 2, causal, {n: m.tolist() for n, m in mats.items()},
        {n: b.tolist() for n, b in offsets.items()}, "open", block=block, fan=2,
    )
    assert got.columns == ["g", "id", "attended"]
    got = {r.id: r.attended for r in got.collect()}
    assert len(got) == 24 and got[99] is None
    for ids in (range(17), range(17, 23)):
        q, k, v = (x[list(ids)] @ mats[n].T + offsets[n] for n in "qkv")
        for row, i in enumerate(ids):
            keys = [j for j, other in enumerate(ids) if other % 3 and (j <= row or not causal)]
            mixed = np.zeros(4)
            for cut in (slice(0, 2), slice(2, 4)):
                if keys:
                    mixed[cut] = softmax_rows(q[row:row + 1, cut] @ k[keys][:, cut].T / math.sqrt(2)) @ v[keys][:, cut]
            assert got[i] == pytest.approx((mixed @ mats["o"].T + offsets["o"]).tolist())


def test_scratch_tables_share_a_folder(spark):
    df = materialize(spark.range(3), "three")
    assert df.count() == 3
    folder = Path(df.inputFiles()[0].removeprefix("file://")).parents[1]
    assert folder.is_dir() and folder.parent.name == spark.sparkContext.applicationId


def test_scratch_tables_go(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_own_folder", lambda _: f"file://{tmp_path}/own")
    materialize(spark.range(3), "three")
    assert (tmp_path / "own").is_dir() and session.remove_scratch(spark)
    assert not (tmp_path / "own").exists() and not session.remove_scratch(spark)


def test_rate_falls_on_a_half_cosine(spark):
    steps = spark.range(5).select(cosine_rate(F.col("id"), F.lit(4), 2.0, 1.0).alias("r")).collect()
    assert [s.r for s in steps] == pytest.approx([1.5 + math.cos(math.pi * i / 4) / 2 for i in range(5)])


def test_group_attention_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, g string, v array<double>")
    assert group_attention(df, ["g"], "id", "v", ["id"]).count() == 0


def convolved(x, w, b, stride, padding):
    padded = np.pad(x, ((0, 0), (padding, padding)))
    k = w.shape[2]
    n = (padded.shape[1] - k) // stride + 1
    return np.array([[np.sum(w[o] * padded[:, i * stride:i * stride + k]) + b[o] for i in range(n)] for o in range(len(w))])


@pytest.mark.parametrize("kernel,stride,padding", [(2, 1, 1), (3, 2, 0), (3, 3, 2), (2, 1, 4)])
@pytest.mark.parametrize("block", [1024, 8])
def test_convolution_against_matrices(spark, monkeypatch, kernel, stride, padding, block):
    monkeypatch.setattr(R, "BLOCK", block)
    rng = np.random.default_rng(4)
    x, w, b = rng.normal(size=(3, 32)), rng.normal(size=(2, 3, kernel)), rng.normal(size=2)
    rows = [("u", i, *x[:, i].tolist()) for i in range(32)]
    df = spark.createDataFrame(rows, "k string, idx bigint, a double, b double, c double")
    out = R.convolve(df, ["k"], "idx", ["a", "b", "c"], w.tolist(), b.tolist(), stride, padding).orderBy("idx").collect()
    want = convolved(x, w, b, stride, padding)
    assert [r.idx for r in out] == list(range(want.shape[1]))
    assert np.allclose([[r.y0, r.y1] for r in out], want.T)


@pytest.mark.parametrize("kernel, stride, padding, block", [(3, 1, 1, 8), (2, 2, 0, 8), (4, 3, 2, 16), (1, 1, 2, 8), (3, 2, 5, 1024)])
def test_wide_convolution_against_the_narrow_one(spark, monkeypatch, kernel, stride, padding, block):
    monkeypatch.setattr(R, "BLOCK", block)
    rng = np.random.default_rng(4)
    x, w, b = rng.normal(size=(3, 33)), rng.normal(size=(5, 3, kernel)), rng.normal(size=5)
    rows = [(None if i > 20 else "u", i % 21, x[:, i].tolist()) for i in range(33)]
    df = spark.createDataFrame(rows, "k string, idx bigint, v array<double>")
    narrow = df.select("k", "idx", *[F.col("v")[c].alias(f"c{c}") for c in range(3)])
    want = R.convolve(narrow, ["k"], "idx", ["c0", "c1", "c2"], w.tolist(), b.tolist(), stride, padding, V.relu).collect()
    got = R.convolve_vectors(df, ["k"], "idx", "v", w, b, stride, padding, V.relu).collect()
    order = lambda rows: sorted(rows, key=lambda r: (str(r.k), r.idx))
    assert [(r.k, r.idx) for r in order(got)] == [(r.k, r.idx) for r in order(want)]
    assert np.allclose([r.y for r in order(got)], [[r[f"y{o}"] for o in range(5)] for r in order(want)])
    assert R.convolve_vectors(df.limit(0), ["k"], "idx", "v", w, b, stride, padding).count() == 0


def test_whole_sequences_of_vectors(spark, monkeypatch):
    monkeypatch.setattr(S, "EMBEDDED_TOKENS", 3)
    vectors = spark.createDataFrame([(5, [1.0, 2.0]), (-1, [3.0, 4.0]), (7, None), (None, [9.0, 9.0])], "id int, v array<float>")
    df = spark.createDataFrame([(1, [5, -1, 6, 5]), (2, []), (3, None), (4, [7, None]), (None, [-1] * 9)], "k bigint, ids array<bigint>")
    a, b = [1.0, 2.0], [3.0, 4.0]
    want = {1: [a, b, None, a], 2: [], 3: None, 4: [None, None], None: [b] * 9}
    for limit in (1 << 20, 0):
        got = {r.k: r.vectors for r in S.embed_sequences(df, "k", "ids", vectors, "id", "v", 2, max_bytes=limit).collect()}
        assert got == want
    assert {tuple(r.vectors) for r in S.embed_sequences(df.filter("k = 4"), "k", "ids", vectors.limit(0), "id", "v", 2).collect()} == {(None, None)}


def test_whole_sequences_of_vectors_are_summed_where_they_are(spark, monkeypatch):
    """A fold meets the same vectors as Spark would, in the task: the plan has no array of vectors."""
    monkeypatch.setattr(S, "EMBEDDED_TOKENS", 3)
    rng = np.random.default_rng(5)
    table = {i: rng.normal(size=3).astype(np.float32).tolist() for i in range(20)}
    vectors = spark.createDataFrame([*table.items(), (30, None)], "id int, v array<float>")
    rows = [(k, rng.integers(0, 20, k * 5).tolist()) for k in range(6)] + [(7, [1, 30]), (8, [2, None, 3]), (9, None), (None, [4, 4])]
    df = spark.createDataFrame(rows, "k bigint, ids array<bigint>")
    fold = (lambda whole: S.sequence_sums(whole, 7)), S.SEQUENCE_SUMS
    for limit in (1 << 20, 0):
        made = S.embed_sequences(df, "k", "ids", vectors, "id", "v", 3, max_bytes=limit, fold=fold)
        got = {r.k: tuple(r)[1:] for r in made.collect()}
        assert len(got) == len(rows)
        for k, ids in rows:
            if ids is None:
                assert got[k] == (None,) * 4
                continue
            found = [table[i] for i in ids if i in table]
            total = weighted = 0.0
            for at, x in enumerate(x for v in found for x in v):
                total, weighted = total + x, weighted + x * (at % 7 + 1)
            assert got[k] == (len(ids), len(found), *((total, weighted) if len(found) == len(ids) else (None, None)))
    monkeypatch.setattr(S, "SUMMED_NUMBERS", 10)
    assert S.sequence_sums(pa.array([[[1.0] * 30], None]), 4) == [pa.array(x) for x in ([1, None], [1, None], [30.0, None], [73.0, None])]
    plan = S.embed_sequences(df, "k", "ids", vectors, "id", "v", 3, fold=fold)._jdf.queryExecution().executedPlan().toString()
    assert "array<array" not in plan
    hole = S.sequence_sums(pa.array([[[1.0, None, 2.0]], [[1.0, 2.0]], [], [None]]), 7)
    assert [x.to_pylist() for x in hole] == [[1, 1, 0, 1], [1, 1, 0, 0], [None, 3.0, 0.0, None], [None, 5.0, 0.0, None]]
    assert S.embed_sequences(df.limit(0), "k", "ids", vectors, "id", "v", 3, fold=fold).count() == 0


def test_only_the_vectors_that_sequences_name_are_sent(spark):
    """A table too large to send whole is cut to the named vectors; no vector is shuffled for every token."""
    vectors = spark.range(500).selectExpr("id", "array(float(id), float(0.1)) AS v")
    df = spark.createDataFrame([(1, [5, 7, 5]), (2, [7, 999, None]), (3, None)], "k bigint, ids array<bigint>")
    got = S.embed_sequences(df, "k", "ids", vectors, "id", "v", 2, max_bytes=1000)
    tenth = float(np.float32(0.1))
    five, seven = [5.0, tenth], [7.0, tenth]
    assert {r.k: r.vectors for r in got.collect()} == {1: [five, seven, five], 2: [seven, None, None], 3: None}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_thirty_two_values_give_thirty_three_then_sixteen(spark):
    df = spark.range(32).selectExpr("'u' AS k", "id AS idx", "double(id) AS x")
    out = R.convolve(df, ["k"], "idx", ["x"], [[[1.0, 10.0]]], padding=1, activation=V.gelu)
    assert out.count() == 33
    pooled = R.max_pool(out, ["k"], "idx", ["y0"], 2)
    assert pooled.count() == 16
    plain = R.max_pool(R.convolve(df, ["k"], "idx", ["x"], [[[1.0, 10.0]]], padding=1), ["k"], "idx", ["y0"], 2)
    # outputs are x[i-1] + 10 x[i]; the last one is x[31] alone and falls in the incomplete tail
    assert plain.filter("idx = 1").first().y0 == 2 + 30
    assert plain.filter("idx = 15").first().y0 == 30 + 310


def gated(x):
    wx, b, wh, wxz, bz, whz = (np.array(m) for m in (Q.WX, Q.BX, Q.WH, Q.WXZ, Q.BZ, Q.WHZ))
    h = np.zeros(3)
    for row in x:
        z = 1 / (1 + np.exp(-(wxz @ row + bz + whz @ h)))
        h = z * h + (1 - z) * np.maximum(wx @ row + b + wh @ h, 0)
    return h


def test_folds_against_a_loop(spark):
    rng = np.random.default_rng(5)
    lengths = {0: 50, 1: 3, 2: 17}
    x = {u: rng.normal(size=(n, 2)) for u, n in lengths.items()}
    rows = [(u, i, v.tolist()) for u, xs in x.items() for i, v in enumerate(xs)]
    df = spark.createDataFrame(rows, "u int, idx bigint, v array<double>").repartition(4)
    cell = R.gated_cell(Q.WX, Q.BX, Q.WH, Q.WXZ, Q.BZ, Q.WHZ)
    whole = {r.u: r for r in R.fold_series(df, ["u"], "idx", F.col("v"), cell, 3, rows_per_round=8).collect()}
    for u, xs in x.items():
        assert whole[u].n_steps == lengths[u] and whole[u].h == pytest.approx(gated(xs).tolist())
    cut = R.fold_sequences(df, ["u"], "idx", F.col("v"), cell, 3, timesteps=20).collect()
    assert len(cut) == 3 + 1 + 1
    for r in cut:
        assert r.h == pytest.approx(gated(x[r.u][r.seq_no * 20:(r.seq_no + 1) * 20]).tolist())
    elman = R.elman_cell(Q.WX, Q.BX, Q.WH)
    row = R.fold_sequences(df.filter("u = 1"), ["u"], "idx", F.col("v"), elman, 3, 20, Q.READOUT).first()
    h = np.zeros(3)
    for v in x[1]:
        h = np.maximum(np.array(Q.WX) @ v + Q.BX + np.array(Q.WH) @ h, 0)
    assert row.h == pytest.approx((np.array(Q.READOUT[0]) @ h + Q.READOUT[1]).tolist())


def test_norm_clip_and_standardize(spark):
    x = np.random.default_rng(6).normal(2, 3, size=(40, 5))
    df = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(x)], "id int, g int, v array<double>")
    assert S.global_norm(df, "v").first().norm == pytest.approx(np.linalg.norm(x))
    clipped = S.clip_by_norm(df, "v", 1.0)
    assert S.global_norm(clipped, "v").first().norm == pytest.approx(1.0, abs=1e-5)
    assert S.global_norm(S.clip_by_norm(df, "v", 1e6), "v").first().norm == pytest.approx(np.linalg.norm(x))
    by_group = S.global_norm(S.clip_by_norm(df, "v", 1.0, ["g"]), "v", ["g"]).collect()
    assert all(r.norm == pytest.approx(1.0, abs=1e-5) for r in by_group)
    z = df.select("id", S.fit_standardizer(df, "v").apply(F.col("v")).alias("z")).orderBy("id").collect()
    assert np.allclose([r.z for r in z], (x - x.mean(0)) / np.sqrt(x.var(0) + 1e-5))
    z = S.standardize_groups(df, "v", ["g"]).orderBy("id").collect()
    for g in (0, 1):
        p = x[g::2]
        assert np.allclose([r.v for r in z if r.g == g], (p - p.mean(0)) / np.sqrt(p.var(0) + 1e-5))


def test_grouped_softmax_sums_to_one(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 0, id % 20) AS g", "double(id) AS s")
    out = S.softmax_by(df, F.col("s"), ["g"])
    assert out.count() == 1000
    assert all(r.w == pytest.approx(1) for r in out.groupBy("g").agg(F.sum("weight").alias("w")).collect())


def test_learning(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 6))
    y = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "v array<double>, y int")
    assert L.accuracy(L.fit_perceptron(df, "v", "y", 2, [4]).predict(df), "y") > 0.95
    flat = x[:, :2] @ rng.normal(size=(2, 6)) + 5
    df = spark.createDataFrame([(v.tolist(),) for v in flat], "v array<double>")
    out = L.fit_autoencoder(df, "v", 2).reconstruct(df)
    first = out.first()
    assert len(first.code) == 2 and len(first.decoded) == 6
    assert out.agg(F.max("error")).first()[0] < 1e-12
    one = L.fit_autoencoder(df, "v", 1).reconstruct(df).agg(F.avg("error")).first()[0]
    values = np.linalg.eigvalsh(np.cov(flat.T, bias=True))
    assert one == pytest.approx(values[:-1].sum() / 6)
    real = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>")
    moved = spark.createDataFrame([((v + 2).tolist(),) for v in x], "v array<double>")
    assert L.fit_discriminator(real, moved, "v", "v", hidden=4).auc > 0.95


def test_first_write_wins(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 's', concat('s', id % 100)) AS sample", "'l' AS layer", "id AS seq", "array(double(id)) AS activation")
    out = {r.sample: r for r in stores.first_writes(df, ["sample", "layer"], "seq", ["activation"]).collect()}
    assert out["s"].seq == 0 and out["s"].n_dropped == 999 and out["s1"].activation == [1.0]


def test_stores(spark):
    path = scratch_path(spark, "metrics")
    df = spark.range(4).selectExpr("id", "double(id) AS loss", "id * 2.0 AS lr")
    stores.append_metrics(stores.as_metrics(df, "r1", F.lit(0), F.col("id"), ["loss", "lr"]), path)
    stores.append_metrics(stores.as_metrics(df, "r2", F.lit(1), F.col("id"), ["loss"]), path)
    assert stores.read_metrics(spark, path).count() == 12
    assert stores.read_metrics(spark, path, "r1").filter("name = 'lr'").agg(F.sum("value")).first()[0] == 12.0
    request = stores.chat_requests(df.limit(1), ["id"], F.lit('say "é"\n'), "m").first().request
    import json

    body = json.loads(request)
    assert body == {
        "model": "m",
        "messages": [
            {"role": "system", "content": "You are an instruction following agent."},
            {"role": "user", "content": 'say "é"\n'},
        ],
        "temperature": 0.1,
        "max_tokens": 100,
    }
    reply = spark.createDataFrame([(1, json.dumps({"choices": [{"message": {"content": "hé"}}]})), (2, "{}")], "id int, reply string")
    assert {r.id: r.content for r in stores.chat_replies(reply, ["id"]).collect()} == {1: "hé", 2: None}


def test_corpus_formats(spark):
    df = spark.createDataFrame([(1, "one"), (2, "two")], "id int, text string")
    for kind in ("parquet", "json", "orc"):
        path = scratch_path(spark, kind)
        df.write.format(kind).save(path)
        got = corpus.read_corpus(spark, path, kind, df.schema)
        assert sorted(r.text for r in got.collect()) == ["one", "two"]
    path = scratch_path(spark, "text")
    df.select("text").write.text(path)
    assert sorted(r.text for r in corpus.read_corpus(spark, path, "text").collect()) == ["one", "two"]
    with pytest.raises(ValueError):
        corpus.read_corpus(spark, path, "json")
    path = scratch_path(spark, "other")
    df.select("id").write.parquet(path)
    with pytest.raises(ValueError, match="text"):
        corpus.read_corpus(spark, path)


def arrivals(spark, *parts):
    path = scratch_path(spark, "arrivals")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_padding_per_arrival(spark):
    df = spark.range(20).select("id", F.array_repeat(F.col("id"), (F.col("id") % 5).cast("int")).alias("ids"))
    path = scratch_path(spark, "padded")
    streams.pad_arrivals(arrivals(spark, df.filter("id < 12"), df.filter("id >= 12")), "id", "ids", 5, path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 20 and {(r.chunk, r.batch_id) for r in rows} == {(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)}
    assert all(len(r.ids) == r.width and r.ids[: r.id % 5] == [r.id] * (r.id % 5) for r in rows)


def test_stream_and_table_agree_on_turns(spark):
    df = spark.createDataFrame(
        [(1, 0, "human", "a b"), (1, 1, "gpt", "c <|im_end|>"), (2, 0, "tool", None)],
        "conv_id int, turn int, role string, text string",
    )
    batch = streams.prepare_turns(df, "reject").collect()
    streamed = streams.run_to_table(streams.prepare_turns(arrivals(spark, df), "reject"), "turns").collect()
    assert batch == streamed and [(r.conv_id, r.role) for r in batch] == [(1, "user")]
    reasons = streams.rejected_turns(df, "reject").collect()
    assert [(r.conv_id, r.reason) for r in reasons] == [(1, "special marker"), (2, "missing role or content")]


def test_group_attention_moves_rows_not_pairs_of_blocks(spark, monkeypatch):
    """What is written between the stages grows with the rows, whatever the block; small tiles give the same means."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    df = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "id int, g int, v array<double>")
    tables = []
    monkeypatch.setattr(attention_module, "materialize", lambda d, name: tables.append(materialize(d, name)) or tables[-1])
    for causal in (False, True):
        got = group_attention(df, ["g"], "id", "v", ["id"], 2, causal, block=2, fan=2)
        assert sum(t.count() for t in tables) <= 2 * len(x)  # 300 blocks meet in 90,000 pairs
        assert got._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 0
        got = {r.id: r.attended for r in got.collect()}
        tables.clear()
        for i in (0, 7, 300, 599):
            keys, mixed = x[: i + 1] if causal else x, np.zeros(4)
            for part in (slice(0, 2), slice(2, 4)):
                mixed[part] = softmax_rows(x[i : i + 1, part] @ keys[:, part].T / math.sqrt(2)) @ keys[:, part]
            assert got[i] == pytest.approx(mixed.tolist())


def test_scores_with_common_pairs_sent_and_rare_ones_joined(spark, lm):
    encoded, model = lm
    odd = encoded.unionByName(spark.createDataFrame([(3, [0, None, 1]), (4, None), (5, [])], "id int, ids array<bigint>"))
    common = N._common_pairs(model, 2).collect()
    assert 0 < len(common) <= 2 and min(r.n for r in common) > 1 and N._common_pairs(model, 0).count() == 0
    want = {r.id: r for r in N.score_sequences(odd, "id", "ids", model).collect()}
    for size in (0, 2 * N.PAIR_BYTES):
        got = N.score_sequences(odd, "id", "ids", model, max_bytes=size).collect()
        assert sorted(r.id for r in got) == sorted(want)
        for r in got:
            assert tuple(r) == pytest.approx(tuple(want[r.id]))
