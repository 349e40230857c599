"""Near-equal embeddings: rotated binary codes estimate inner products, and bounds say which pairs are computed."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import components, in_partitions, join_labels, split_groups, whole_groups
from tokenloom.session import materialize

THRESHOLD = 0.95
RECALL = 0.999  # of a pair just at the threshold; closer pairs are missed far more rarely
EPSILON = 4.0  # width of the confidence bound, in standard errors of the estimate
GROUP = 64  # distinct vectors that a bucket should hold
LIMIT = 1024
SEED = 17
BLOCK = 512


def rotation(width: int, number: int, seed: int = SEED) -> np.ndarray:
    """A random rotation of `width` dimensions, the same in every task."""
    rng = np.random.default_rng([seed, width, number])
    q, r = np.linalg.qr(rng.standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; large and small entries do not overflow."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codes(units: np.ndarray, number: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their signs, and the correction factor: the inner product of a vector and its code."""
    rotated = units @ rotation(units.shape[1], number).T
    signs = rotated >= 0
    return rotated, signs, np.abs(rotated).sum(axis=1) / math.sqrt(units.shape[1])


def estimates(signs: np.ndarray, factor: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of inner products from codes and whole rotated vectors, and the width of their bound.

    The code of x is its signs over the root of the width; <code, y> / factor
    estimates <x, y>, and its error comes from the part of y that x's code
    cannot see.
    """
    width = signs.shape[1]
    found = (np.where(signs, 1.0, -1.0).astype(np.float32) @ others.T.astype(np.float32)) / (math.sqrt(width) * factor[:, None])
    spread = np.sqrt(np.maximum(1 - factor**2, 0) / factor**2) / math.sqrt(max(width - 1, 1))
    return found, EPSILON * spread + 1e-5


def bands(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a bucket and number of buckets a vector is in.

    A sign differs between two vectors at an angle a with probability a / pi.
    More rows take more bits, so that buckets stay small, and then more buckets.
    """
    bits = max(1, math.ceil(math.log2(max(rows, 2) / GROUP)))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(2, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def _band_keys(units: np.ndarray, bits: int, count: int) -> np.ndarray:
    width, need = units.shape[1], bits * count
    signs = np.concatenate([codes(units, 1 + k)[1] for k in range(math.ceil(need / width))], axis=1)[:, :need]
    return (signs.reshape(len(units), count, bits) << np.arange(bits, dtype=np.int64)).sum(axis=2)


def linked_vectors(vectors: DataFrame, rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """rep, root, links: for distinct vectors (rep, copies, v), how many rows each links to, in pieces, and a tree of them.

    Vectors meet in buckets of code bits. In a bucket the estimate's upper
    bound drops most pairs; what is left is computed exactly in double
    precision. A pair that shares several buckets counts in the first alone. A
    hot bucket is cut into parts whose pairs go to different tasks; pairs
    become counts and tree edges there and are never rows.
    """
    bits, count = bands(rows, threshold, recall)

    def keyed(batches):
        for batch in batches:
            lists = batch.column("v")
            widths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            keys = np.zeros((batch.num_rows, count), dtype=np.int64)
            for width in np.unique(widths):
                pick = np.flatnonzero(widths == width)
                block = flat[offsets[pick][:, None] + np.arange(width)]
                keys[pick] = _band_keys(unit(block), bits, count)
            ends = pa.array(np.arange(0, keys.size + 1, count, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), lists, pa.array(widths, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))],
                names=["rep", "copies", "v", "width", "keys"],
            )

    rows_ = vectors.select("rep", "copies", "v").mapInArrow(keyed, "rep long, copies long, v array<double>, width int, keys array<long>")
    rows_ = materialize(rows_, "vector_codes").select("*", F.posexplode("keys").alias("band", "bucket"))
    dealt = split_groups(rows_, ["width", "band", "bucket"], "rep", LIMIT)
    keys = ["width", "band", "bucket", "lo", "hi"]

    def linked(batches):
        for table, starts in whole_groups(batches, keys, 8192):
            ends = np.append(starts[1:], table.num_rows)
            for s, e in zip(starts, ends, strict=True):
                if e - s < 2:
                    continue
                group = table.slice(s, e - s).combine_chunks()
                found = _links(group, threshold)
                if found is not None:
                    yield found

    return in_partitions(dealt, keys, ["rep"], linked, "rep long, root long, links long")


def _links(group: pa.Table, threshold: float) -> pa.RecordBatch | None:
    one = lambda c: group.column(c).to_numpy()
    lists = lambda c: group.column(c).combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
    rep, copies, part = one("rep"), one("copies"), one("part")
    band, cross = int(one("band")[0]), one("lo")[0] != one("hi")[0]
    units, keys = unit(lists("v")), lists("keys")[:, :band]
    rotated, signs, factor = codes(units)
    links, labels = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))
    for a in range(0, len(rep), BLOCK):
        for b in range(a, len(rep), BLOCK):
            i, j = slice(a, a + BLOCK), slice(b, b + BLOCK)
            guess, spread = estimates(signs[i], factor[i], rotated[j])
            near = guess + spread[:, None] >= threshold
            if a == b:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            x, y = x + a, y + b
            if cross:
                other = part[x] != part[y]
                x, y = x[other], y[other]
            first = ~(keys[x] == keys[y]).any(axis=1)
            x, y = x[first], y[first]
            close = np.einsum("ij,ij->i", units[x], units[y]) >= threshold
            x, y = x[close], y[close]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            labels = join_labels(labels, x, y)
    some = np.flatnonzero(links)
    if not len(some):
        return None
    return pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(rep[labels[some]]), pa.array(links[some])], names=["rep", "root", "links"])


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """key, n_links, component_id, kept: one row for every row of `vectors`.

    Equal vectors are one node. A null, empty or zero vector, one with a null,
    infinite or missing number, and one whose key is null link with nothing and
    are their own component. Vectors of different length are not compared. A
    repeated key with another vector is a vector of its own.
    """
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col(key).isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).alias("key"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v"), valid.alias("valid"))
    good = rows.filter("valid")
    nodes = good.groupBy("v").agg(F.min("key").cast("long").alias("least"), F.count("*").alias("copies"))
    # A key that repeats with another vector must still name one node.
    nodes = materialize(nodes.withColumn("rep", F.xxhash64("v")), "vectors")
    pieces = materialize(linked_vectors(nodes, nodes.count(), threshold, recall), "vector_links")
    links = pieces.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(pieces, "rep", "root").withColumnRenamed("node", "rep")
    named = nodes.join(links, "rep", "left").join(roots, "rep", "left")
    named = named.select("v", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("root"))
    firsts = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(firsts, "root").select("v", "component", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    found = good.join(named, "v").select("key", "n_links", "component")
    rest = rows.filter("not valid").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").cast("long").alias("component"))
    both = found.unionByName(rest)
    return both.select(F.col("key").alias(key), "n_links", F.col("component").alias("component_id"), F.col("key").eqNullSafe(F.col("component")).alias("kept"))
