"""What several operators of this subpackage need: stored tables, groups cut into bounded tasks, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.joins import lookup
from tokenloom.session import materialize

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; text without other letters takes the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_groups(rows: DataFrame, keys: list[str], each: str, limit: int) -> DataFrame:
    """Cut every group of `keys` into parts, and deal each pair of parts to a task of its own.

    Adds `part`, and `lo`, `hi`: the pair of parts a copy of the row was dealt
    to. A group of up to `limit` rows is one part. `each` names the column
    whose hash picks the part. No row is left out, and no group, however hot,
    puts more than about two parts into one task.
    """
    hot = rows.groupBy(*keys).count().filter(F.col("count") > limit)
    hot = materialize(
        hot.select(*keys, F.ceil(F.col("count") / limit).cast("int").alias("parts")), "hot_groups"
    )
    dealt = lookup(rows, hot, keys).withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(F.lit(7), F.col(each)), "parts").cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (
        dealt.withColumn("lo", F.least("part", "_other"))
        .withColumn("hi", F.greatest("part", "_other"))
        .drop("_other", "parts")
    )


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by `keys`: tables of whole groups, about `rows` rows each, and where groups start."""

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[:1] = True
        for key in keys:
            col = table.column(key).to_numpy()
            new[1:] |= col[1:] != col[:-1]
        return np.flatnonzero(new)

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            cuts = starts(table)
            if len(cuts) > 1:  # the last group may go on
                yield table.slice(0, cuts[-1]), cuts[:-1]
                table = table.slice(cuts[-1])
            held, n = table.to_batches(), table.num_rows
    if n:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(table)


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable, after the links a[i] - b[i] are added to what `labels` already joins."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low = np.minimum(la, lb)
        np.minimum.at(labels, np.concatenate([la, lb, a, b]), np.concatenate([low] * 4))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up
    return labels


def in_partitions(
    df: DataFrame, keys: list[str], order: list[str], fn: Callable, schema: str
) -> DataFrame:
    """Deal rows out by `keys`, sort inside the partitions, and run `fn` over each partition's Arrow batches."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(fn, schema)


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """node, root: the smallest node each node of `edges` (two long columns) can reach; only nodes with links.

    Large stars, then small stars, until nothing changes. Every round writes its
    edges to the shared folder. A node with very many links is only ever the
    skewed side of a join on a table with one row per node.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs, before = materialize(pairs, "links"), None
    for _ in range(rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        pairs = materialize(small, "links")
        after = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            found = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return found.union(found.select(F.col("root").alias("node"), "root").distinct())
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions, F.lit(True))
