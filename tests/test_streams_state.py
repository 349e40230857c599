"""Streams with state in Spark's store: folds in the order of time, first writes; and rows by their place in files."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import series as R
from tokenloom.plans import sequences as Q
from tokenloom.session import scratch_path
from tokenloom.sources.positions import file_counts, file_slice, with_file_position
from tokenloom.streaming import folds, streams

BASE = 1_700_000_000


def gated(rows):
    cell = R.gated_cell(Q.WX, Q.BX, Q.WH, Q.WXZ, Q.BZ, Q.WHZ)
    h = np.zeros((1, 3))
    for x in rows:
        h = cell(h, np.array([x], dtype=float))
    return h[0].tolist()


def run_in_parts(spark, parts, run):
    """Each part arrives in a run of its own: the query is restarted in between."""
    folder = scratch_path(spark, "arrivals")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)
        run(spark.readStream.schema(parts[0].schema).parquet(folder))


def fold(spark, parts, path, delay="20 SECONDS", slot=timedelta(seconds=1), key="u"):
    cell = R.gated_cell(Q.WX, Q.BX, Q.WH, Q.WXZ, Q.BZ, Q.WHZ)
    run_in_parts(spark, parts, lambda s: folds.fold_stream(s, key, "t", ["n"], F.col("v"), cell, 3, path, delay, slot))
    return {r[key]: r for r in folds.fold_states(spark, key, path).collect()}


SERIES = "u int, s double, n bigint, v array<double>"


def timed(spark, rows, schema=SERIES):
    return spark.createDataFrame(rows, schema).withColumn("t", F.timestamp_micros((F.col("s") * 1e6).cast("long"))).drop("s")


def test_arrivals_out_of_order_equal_the_batch_fold(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(90, 2))
    rows = [(i % 3, float(BASE + i // 2), i, v.tolist()) for i, v in enumerate(x)]  # two rows a second: ties go by n
    early = [r for i, r in enumerate(rows) if i < 60 and i % 5]
    later = [r for i, r in enumerate(rows) if i >= 60 or not i % 5]
    last = (9, float(BASE + 500), 0, [0.0, 0.0])
    out = fold(spark, [timed(spark, early), timed(spark, [*later, last])], scratch_path(spark, "folded"), "60 SECONDS")
    for u in range(3):
        assert (out[u].n_steps, out[u].n_late, out[u].n_pending) == (30, 0, 0)
        assert out[u].h == pytest.approx(gated(x[u::3]))
    assert (out[9].n_steps, out[9].n_pending) == (0, 1) and out[9].h == [0.0, 0.0, 0.0]


def test_rows_later_than_the_delay_are_counted(spark):
    one = [(1, float(BASE + k), k, [float(k), 1.0]) for k in range(40)]
    path = scratch_path(spark, "folded")
    # Up to second 39: slots that end by second 19 are over.
    two = [(1, BASE + 18.5, 100, [9.0, 9.0]), (1, BASE + 19.5, 101, [5.0, 5.0]), (1, None, 102, [7.0, 7.0]), (2, float(BASE), 1, [1.0, 1.0])]
    out = fold(spark, [timed(spark, one), timed(spark, two), timed(spark, [(3, float(BASE + 400), 0, [0.0, 0.0])])], path)
    assert (out[1].n_steps, out[1].n_late, out[1].n_pending) == (41, 2, 0)
    want = [[float(k), 1.0] for k in range(20)] + [[5.0, 5.0]] + [[float(k), 1.0] for k in range(20, 40)]
    assert out[1].h == pytest.approx(gated(want))
    assert (out[2].n_steps, out[2].n_late) == (0, 1)


def test_a_hot_key_waits_slot_by_slot(spark, monkeypatch):
    n = 3000
    rows = [("hot", BASE + k * 0.01, k, [k % 7 / 7, 1.0]) for k in range(n)] + [("cold", float(BASE + 900), 0, [0.0, 0.0])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        out = fold(spark, [timed(spark, rows[::-1], SERIES.replace("u int", "u string"))], scratch_path(spark, "folded"), "1 SECOND")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert out["hot"].n_steps == n and out["hot"].h == pytest.approx(gated([r[3] for r in rows[:n]]))


def test_keys_may_have_any_name_and_be_null(spark):
    rows = timed(spark, [(None, float(BASE), 1, [1.0, 1.0]), (4, float(BASE + 90), 1, [1.0, 1.0])]).withColumnRenamed("u", "row_key")
    out = fold(spark, [rows], scratch_path(spark, "folded"), key="row_key")
    assert out[None].n_steps == 1 and out[4].n_pending == 1
    with pytest.raises(ValueError):
        folds.fold_stream(rows, "row_key", "t", ["n"], F.col("v"), None, 3, "x", "1 DAY", timedelta(microseconds=5))


def first_writes(spark, parts, delay, times=1):
    path = scratch_path(spark, "firsts")
    run_in_parts(spark, parts, lambda s: [streams.first_writes_arrivals(s, ["k"], "id", "t", delay, path) for _ in range(times)])
    read = lambda name: spark.read.parquet(f"{path}/{name}").collect()
    return {(r.k, r.chunk): (r.id, r.n_dropped) for r in read("firsts")}, {(r.k, r.chunk): r.n_dropped for r in read("dropped")}


@pytest.mark.parametrize("times", [1, 2])
def test_first_writes_on_a_stream(spark, times):
    df = spark.range(40).selectExpr("id % 10 AS k", f"timestamp_seconds({BASE} + id) AS t", "id")
    more = spark.sql(f"SELECT bigint(0) AS k, timestamp_seconds({BASE}) AS t, bigint(-5) AS id UNION ALL SELECT null, null, 50 UNION ALL SELECT null, null, 49")
    firsts, dropped = first_writes(spark, [df.filter("id < 20"), df.filter("id >= 20").union(more)], "1 HOUR", times)
    assert firsts == {**{(k, 0): (k, 1) for k in range(10)}, (None, 1): (49, 1)}
    assert dropped == {(k, 1): 3 if k == 0 else 2 for k in range(10)}


def test_a_first_write_is_forgotten_and_a_late_one_dropped(spark):
    df = spark.range(40).selectExpr("id % 10 AS k", f"timestamp_seconds({BASE} + id) AS t", "id")
    late = spark.sql(f"SELECT bigint(77) AS k, timestamp_seconds({BASE} + 11) AS t, bigint(1) AS id")
    firsts, dropped = first_writes(spark, [df.filter("id < 20"), df.filter("id >= 20").union(late)], "4 SECONDS")
    # Up to second 19 the watermark is at 15: keys last written by second 11 are forgotten.
    assert {k for k, chunk in firsts if chunk == 1} == {0, 1} and firsts[1, 1] == (21, 1)
    assert dropped == {**{(k, 1): 2 for k in range(2, 10)}, (77, 1): 1}


def test_two_arrivals_in_one_run(spark):
    df = spark.range(40).selectExpr("id % 10 AS k", f"timestamp_seconds({BASE} + id) AS t", "id")
    folder, path = scratch_path(spark, "arrivals"), scratch_path(spark, "firsts")
    for part in (df.filter("id < 20"), df.filter("id >= 20")):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    streams.first_writes_arrivals(stream, ["k"], "id", "t", "1 HOUR", path)
    assert sorted((r.chunk, r.id) for r in spark.read.parquet(f"{path}/firsts").collect()) == [(0, k) for k in range(10)]


@pytest.fixture
def stored(spark):
    path = scratch_path(spark, "a table")
    for k, n in enumerate((7, 1, 12)):
        rows = spark.range(n).selectExpr("id % 2 AS a", f"'{k}' AS b")  # rows repeat
        rows.coalesce(1).write.mode("append").parquet(path)
    files = sorted(p for p, _ in file_counts(spark.read.parquet(path)))
    local = [f.removeprefix("file:").replace("%20", " ") for f in files]
    return path, [(r["a"], r["b"]) for f in local for r in pq.read_table("/" + f.lstrip("/")).to_pylist()]


def test_places_in_files(spark, stored):
    path, rows = stored
    got = with_file_position(spark.read.parquet(path)).collect()
    assert sorted((r.idx, (r.a, r.b)) for r in got) == list(enumerate(rows))
    assert "Exchange hashpartitioning" not in with_file_position(spark.read.parquet(path))._jdf.queryExecution().toString()


@pytest.mark.parametrize("start, stop", [(0, 20), (0, 3), (2, 5), (6, 9), (8, 8), (5, 13), (19, 50), (20, 30), (7, 8)])
def test_slices_of_files(spark, stored, start, stop):
    path, rows = stored
    got = file_slice(spark, path, start, stop, "idx").collect()
    assert sorted((r.idx, (r.a, r.b)) for r in got) == list(enumerate(rows))[start:stop]
    assert sorted((r.a, r.b) for r in file_slice(spark, path, start, stop).collect()) == sorted(rows[start:stop])


def test_only_files_that_a_slice_meets_are_read(spark, stored):
    path, rows = stored
    read = file_slice(spark, path, 0, 1)
    assert len(read.inputFiles()) == 1 and read.columns == ["a", "b"]
    with pytest.raises(ValueError):
        file_slice(spark, path, 3, 2)


def test_places_of_one_file_and_of_none(spark):
    path = scratch_path(spark, "single")
    spark.range(5).coalesce(1).write.parquet(path)
    assert [r.idx for r in with_file_position(spark.read.parquet(path)).orderBy("idx").collect()] == [0, 1, 2, 3, 4]
    path = scratch_path(spark, "empty")
    spark.range(0).write.parquet(path)
    assert with_file_position(spark.read.parquet(path)).count() == 0 and file_slice(spark, path, 0, 3, "idx").columns == ["id", "idx"]


class Values:
    """A processor's state and timers in memory, counting its calls."""

    def __init__(self):
        self.held, self.timers, self.folded, self.calls = {}, [], None, 0

    def getValueState(self, name, schema):
        return type("Folded", (), {"get": lambda _: self.folded, "update": lambda _, new: setattr(self, "folded", new)})()

    def getMapState(self, name, key, value):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def keys(self):
        self.calls += 1
        return iter(list(self.held))

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self.held[key]


def test_one_timer_folds_all_slots_that_are_over():
    at = lambda ms: type("Now", (), {"getCurrentWatermarkInMs": lambda _: ms})()
    rows = lambda *ms: iter([pd.DataFrame({"row_ms": ms, "row_known": True, "place": ms, "row_x": [[1.0, 2.0]] * len(ms)})])
    state = Values()
    fold = folds.OrderedFold("u", ["place"], R.gated_cell(Q.WX, Q.BX, Q.WH, Q.WXZ, Q.BZ, Q.WHZ), 3, 10)
    fold.init(state)
    list(fold.handleInputRows((1,), rows(*range(95, 15, -2)), at(0)))
    assert state.timers == [20] and len(state.held) == 9 and state.calls == 9
    list(fold.handleInputRows((1,), rows(5, 17), at(0)))  # before the first that waits
    assert state.timers == [20, 10] and sorted(state.held)[0] == (0,)
    state.calls = 0
    out = list(fold.handleExpiredTimer((1,), at(50), None))
    assert len(out) == 1 and sorted(state.held) == [(s,) for s in range(5, 10)] and state.timers == [20, 10, 60]
    n = int(out[0].n_steps[0])
    assert n + int(out[0].n_pending[0]) == 42 and out[0].h[0] == pytest.approx(gated([[1.0, 2.0]] * n)) and state.calls == 11
    assert list(fold.handleExpiredTimer((1,), at(50), None)) == []  # the second timer finds all done
