"""Row numbers, running totals and lookups, also where keys are far from even."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import order as O
from tokenloom.operators.joins import lookup, table_bytes


def indexed(df, order, group=(), **kw):
    out = O.with_row_index(df, order, group, rows_per_range=kw.pop("rows_per_range", 50))
    return out.collect()


def expected(rows, order, group=()):
    seen, want = {}, {}
    for r in sorted(rows, key=lambda r: tuple(r[c] for c in order)):
        g = tuple(r[c] for c in group)
        want[tuple(r[c] for c in order) + g] = seen.get(g, 0)
        seen[g] = seen.get(g, 0) + 1
    return want


@pytest.mark.parametrize("key", ["id * 7", "id * id * id", "-id", "if(id < 900, id, id * 1000000000000)"])
def test_index_whatever_the_gaps(spark, key):
    df = spark.range(1000).selectExpr(f"{key} AS k").repartition(5)
    rows = indexed(df, "k")
    want = expected(rows, ["k"])
    assert len(rows) == 1000 and all(want[(r.k,)] == r.idx for r in rows)


def test_index_in_one_hot_group(spark):
    df = spark.range(2000).selectExpr("id AS k", "if(id % 3 = 0, 0, id % 50) AS g")
    rows = indexed(df, "k", "g")
    want = expected(rows, ["k"], ["g"])
    assert all(want[(r.k, r.g)] == r.idx for r in rows)
    cut, ranges = O.cut_into_ranges(df, "k", 50)
    assert ranges > 20 and cut.groupBy("g", "_range").count().agg(F.max("count")).first()[0] < 200


def test_index_where_one_time_holds_most_rows(spark):
    df = spark.range(1500).selectExpr("if(id % 3 = 0, id, 600) AS t", "id AS k")
    cut, _ = O.cut_into_ranges(df, ["t", "k"], 50)
    assert cut.groupBy("_range").count().agg(F.max("count")).first()[0] < 300
    rows = indexed(df, ["t", "k"])
    want = expected(rows, ["t", "k"])
    assert all(want[(r.t, r.k)] == r.idx for r in rows)


def test_index_keeps_missing_groups(spark):
    df = spark.range(300).selectExpr("id AS k", "if(id % 2 = 0, null, 'a') AS g")
    rows = indexed(df, "k", "g")
    assert len(rows) == 300 and sorted(r.idx for r in rows if r.g is None) == list(range(150))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_index_by_time(spark, kind):
    start = "timestamp_ntz'2024-03-30 23:00:00.5'"
    step = f"{start} + make_dt_interval(id, 0, 0, 0)" if kind == "date" else f"{start} + make_dt_interval(0, 0, id, 0.25)"
    rows = indexed(spark.range(400).selectExpr("id", f"CAST({step} AS {kind}) AS t"), "t")
    assert all(r.id == r.idx for r in rows) and isinstance(rows[0].t, (dt.date, dt.datetime))


def test_text_is_no_order_key(spark):
    with pytest.raises(TypeError):
        O.with_row_index(spark.range(5000).selectExpr("string(id) AS k"), "k")


def test_running_total_leaves_the_row_itself_out(spark):
    df = spark.range(500).selectExpr("id AS k", "id % 4 AS n")
    rows = O.with_running_total(df, "k", F.col("n"), "before", rows_per_range=40).orderBy("k").collect()
    total = 0
    for r in rows:
        assert r.before == total
        total += r.n


@pytest.mark.parametrize("rows", [300, 5000])
def test_slice_of_few_and_many_rows(spark, rows):
    df = spark.range(rows).selectExpr("id * 3 AS k")
    assert sorted(r.k for r in O.row_slice(df, "k", 100, 200).collect()) == [3 * i for i in range(100, 200)]
    assert O.row_slice(df, "k", rows, rows + 5).count() == 0


@pytest.mark.parametrize("rows", [1000, 3000])
def test_a_text_key_is_refused_at_any_size(spark, rows):
    with pytest.raises(TypeError):
        O.with_row_index(spark.range(rows).selectExpr("string(id) AS k"), "k").count()


@pytest.mark.parametrize("limit", [10**9, 0])
def test_lookup_meets_null_with_null_if_asked(spark, limit):
    facts = spark.range(100).selectExpr("id", "if(id % 4 = 0, null, id % 4) AS k")
    sizes = facts.groupBy("k").count()
    assert lookup(facts, sizes, ["k"], "inner", limit, null_safe=True).columns == ["id", "k", "count"]
    assert [r["count"] for r in lookup(facts, sizes, ["k"], "inner", limit, null_safe=True).collect()] == [25] * 100


def test_structs_count_in_table_bytes(spark):
    df = spark.range(10).selectExpr("named_struct('s', repeat('x', 1000)) AS x", "map(1, repeat('x', 500)) AS m")
    assert table_bytes(df) > 10 * 1500


def test_every_nth(spark):
    assert [r.k for r in O.every_nth(spark.range(120).selectExpr("id AS k"), "k", 50).orderBy("k").collect()] == [49, 99]


@pytest.mark.parametrize("limit", [10**9, 0])
def test_lookup_both_ways(spark, limit):
    facts = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 1, if(id % 10 = 1, null, id)) AS k")
    names = spark.range(500).selectExpr("id AS k", "string(id) AS name")
    left = lookup(facts, names, ["k"], "left", limit).collect()
    assert len(left) == 1000
    assert all(r.name == (str(r.k) if r.k is not None and r.k < 500 else None) for r in left)
    inner = lookup(facts, names, ["k"], "inner", limit)
    assert inner.count() == sum(r.name is not None for r in left)


def test_table_bytes(spark):
    df = spark.createDataFrame([("abc", 1, [1.0, 2.0])], "s string, n bigint, v array<double>")
    assert table_bytes(df) == (3 + 8) + (8 + 8) + (16 + 8)
    assert table_bytes(df.limit(0)) == 0
