"""Filter interaction audit: survival words of all subsets of filters, counted by carry-save adders.

A document that fails the filters of a bit mask `f` survives a subset `s` of
filters if the two have no bit in common. Bit `s` of its 32-bit word says so.
How many words of a part have each bit set is all that any order of the
filters, kept, lost or redundant documents and the Shapley sums depend on.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.operators.joins import lookup
from tokenloom.session import materialize

FILTERS = 5  # 2 ** 5 subsets fill a 32-bit word
PARTS_HELD = 5_000  # parts whose counts a task holds before it hands them on
# The word of each failure mask.
WORDS = np.array([sum(1 << s for s in range(32) if not s & f) for f in range(32)], dtype=np.uint32)


class BitCounts:
    """How many of the added words have each of the 32 bits set.

    Level `k` holds words whose bits weigh 2 ** k. Three words of a level
    become a sum word of that level and a carry word of the next, thirds of a
    whole array at a time, so at most two words a level ever wait.
    """

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def add(self, words: np.ndarray) -> None:
        level = 0
        while len(words):
            if level == len(self.levels):
                self.levels.append(np.zeros(0, dtype=np.uint32))
            here, carries = np.concatenate([self.levels[level], words]), []
            while len(here) >= 3:
                third = len(here) // 3
                a, b, c = here[:third], here[third : 2 * third], here[2 * third : 3 * third]
                half = a ^ b
                carries.append((a & b) | (half & c))
                here = np.concatenate([half ^ c, here[3 * third :]])
            self.levels[level] = here
            words = np.concatenate(carries) if carries else np.zeros(0, dtype=np.uint32)
            level += 1

    def counts(self) -> np.ndarray:
        out, bits = np.zeros(32, dtype=np.int64), np.arange(32, dtype=np.uint32)
        for level, words in enumerate(self.levels):
            out += ((words[:, None] >> bits) & 1).sum(axis=0, dtype=np.int64) << level
        return out


def later_copies(docs: DataFrame, key: str, digest: str) -> DataFrame:
    """`docs` with `_copy`: another row with the same digest has a smaller key.

    Only digests of several rows are joined back, one row each. A digest that
    holds much of the table is combined inside the tasks, and its rows are the
    side that adaptive execution splits where that join is a shuffle.
    """
    shared = docs.groupBy(digest).agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first"))
    shared = materialize(shared.filter(F.col("_n") > 1).select(digest, "_first"), "shared_texts")
    found = lookup(docs, shared, [digest])
    return found.withColumn("_copy", F.coalesce(F.col(key) > F.col("_first"), F.lit(False))).drop("_first")


def survivors(rows: DataFrame, part: str, mask: str, labels: list[str]) -> DataFrame:
    """part, subset (0 to 31), n, and n_<label> for each boolean label column.

    `mask` has bit `i` set where a row fails filter `i`. One pass: every row
    becomes its word, words are added up inside the tasks, and a shuffle of 32
    rows a part and task gives the sums. Null parts are a part of their own.
    """
    names = ["n", *[f"n_{label}" for label in labels]]

    def run(batches):
        held: dict[object, list[BitCounts]] = defaultdict(lambda: [BitCounts() for _ in names])

        def flushed():
            for start in range(0, len(parts := list(held)), 1000):
                some = parts[start : start + 1000]
                sums = [np.concatenate([held[p][k].counts() for p in some]) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(some, dtype=object), 32), pa.string()), pa.array(np.tile(np.arange(32, dtype=np.int32), len(some))), *map(pa.array, sums)],
                    names=["part", "subset", *names],
                )
            held.clear()

        for batch in batches:
            words = WORDS[batch.column(1).to_numpy(zero_copy_only=False)]
            marks = [batch.column(2 + k).to_numpy(zero_copy_only=False) for k in range(len(labels))]
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            known, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes, minlength=len(known)))
            for name, lo, hi in zip(known, np.append(0, ends[:-1]), ends, strict=True):
                at, sums = order[lo:hi], held[name]
                sums[0].add(words[at])
                for k, mark in enumerate(marks):
                    sums[1 + k].add(words[at[mark[at]]])
            if len(held) > PARTS_HELD:
                yield from flushed()
        yield from flushed()

    flags = [F.coalesce(F.col(label).cast("boolean"), F.lit(False)).alias(label) for label in labels]
    flat = rows.select(F.col(part).cast("string").alias("part"), F.col(mask).cast("int").alias("mask"), *flags)
    schema = "part string, subset int, " + ", ".join(f"{name} bigint" for name in names)
    return flat.mapInArrow(run, schema).groupBy("part", "subset").agg(*[F.sum(name).alias(name) for name in names])


def failure_mask(failures: list[Column]) -> Column:
    """Bit `i` is set where condition `i` holds; a null condition doesn't."""
    if not 0 < len(failures) <= FILTERS:
        raise ValueError(f"1 to {FILTERS} filters fit into a word")
    bits = [F.when(F.coalesce(c, F.lit(False)), 1 << i).otherwise(0) for i, c in enumerate(failures)]
    return sum(bits[1:], bits[0])


def orders(counted: DataFrame, letters: str, labels: list[str]) -> DataFrame:
    """One row per part, filter_order and step, from what `survivors` counted.

    kept and removed by the step, redundant (fail its filter, removed before),
    unique_fails (fail no other filter), <label>_lost (removed here), shapley
    (removed by its filter, summed over all orders). 32 numbers a part are
    looked up, no document is.
    """
    names = ["n", *[f"n_{label}" for label in labels]]
    entry = F.struct("subset", *names)
    held = counted.groupBy("part").agg(F.array_sort(F.collect_list(entry)).alias("_s"))  # 32 entries
    every = F.lit(",".join("".join(p) for p in permutations(letters)))
    rows = held.withColumn("filter_order", F.explode(F.split(every, ",")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))

    def bit(at: Column) -> Column:
        found = F.lit(0)
        for i, letter in enumerate(letters):
            found = F.when(F.substring("filter_order", at, F.lit(1)) == letter, 1 << i).otherwise(found)
        return found

    whole, before = (1 << len(letters)) - 1, F.lit(0)
    for i in range(1, len(letters)):
        before = before + F.when(F.col("step") > i, bit(F.lit(i))).otherwise(0)
    rows = rows.withColumn("_bit", bit(F.col("step"))).withColumn("_before", before)
    at = lambda subset, name="n": F.get(F.col("_s"), subset)[name]
    after = F.col("_before") + F.col("_bit")
    lost = {name: at(F.col("_before"), name) - at(after, name) for name in names}
    failing = at(F.lit(0)) - at(F.col("_bit"))
    rows = rows.select(
        "part",
        "filter_order",
        "step",
        "_bit",
        at(after).alias("kept"),
        lost["n"].alias("removed"),
        (failing - lost["n"]).alias("redundant"),
        (at(F.lit(whole) - F.col("_bit")) - at(F.lit(whole))).alias("unique_fails"),
        *[lost[f"n_{label}"].alias(f"{label}_lost") for label in labels],
    )
    return rows.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "_bit"))).drop("_bit")


SPACE = r"[\x20\x09-\x0D]+"


def corpus_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E over whole texts, in all 120 orders.

    A few words, B few different words, C many capitals, D odd signs, E a copy
    of a row with a smaller id. Null texts are empty, a null source is the part
    '', rows without an id are copies of none and have no label; repeated rows
    count each; of several labels of an id one is enough. An empty table gives
    no part and so no row. Texts are read once: what is written and joined is a
    mask and a digest.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("key"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("key", "part", "text", F.array_remove(F.split("text", SPACE), "").alias("words"))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.char_length("text") - F.char_length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failing = [
        n < 200,
        distinct.cast("long") * 100 < n.cast("long") * 50,
        capitals.cast("long") * 100 > F.char_length("text").cast("long") * 2,
        F.col("text").rlike("[#$%&*|]"),
    ]
    flat = rows.select("key", "part", failure_mask(failing).alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    flat = later_copies(materialize(flat, "audited"), "key", "digest")
    flat = flat.select("key", "part", (F.col("mask") + F.when(F.col("_copy"), 16).otherwise(0)).alias("mask"))
    marks = labels.groupBy(F.col("doc_id").alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = lookup(flat, materialize(marks.filter("key is not null and (good or toxic)"), "labelled"), ["key"])
    return orders(survivors(marked, "part", "mask", ["good", "toxic"]), "ABCDE", ["good", "toxic"])
