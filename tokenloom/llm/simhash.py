"""SimHash near-duplicates: fingerprints, and a self-join of binary tries under a Hamming budget."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import components, in_partitions, join_labels, split_groups, whole_groups
from tokenloom.session import materialize

BITS = 64
WORDS = 4
BUDGET = 4
SEED = 42
PIECE = 1 << 20  # bytes of a text that are split into words at a time
SPACE = b" \t\n\x0b\x0c\r"
GROUP = 64  # rows that a trie of the self-join should hold on average
LIMIT = 2048  # rows above which a trie is dealt out in parts
FRONTIER = 1 << 20  # node pairs held at a time


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        while end < len(text) and text[end] not in SPACE:
            end += 1
        yield text[start:end].lower().split()
        start = end


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of a UTF-8 text over word shingles; a text without words has 0."""
    counts, total, carry = np.zeros(BITS, dtype=np.int64), 0, []
    for piece in _pieces(text):
        carry += piece
        if len(carry) < words:
            continue
        joined = b" ".join(carry)
        ends = np.cumsum(np.fromiter(map(len, carry), dtype=np.int64, count=len(carry)) + 1)
        starts = np.concatenate([[0], ends[: len(carry) - words]]).tolist()
        cuts = zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[s:e], SEED) for s, e in cuts], dtype="<u8")
        for k in range(0, len(hashes), 1 << 15):
            bits = np.unpackbits(hashes[k : k + (1 << 15)].view(np.uint8), bitorder="little")
            counts += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
        total += len(hashes)
        carry = carry[len(carry) - words + 1 :]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED) if carry else 0
    return int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """key, fp: the 64-bit SimHash of every whole text as a long.

    A-Z count as a-z; words are what white space separates; shingles are
    `words` words, repeats included; a text with fewer words is one shingle. A
    null text is an empty one. One pass, no shuffle; texts are read in pieces.
    """

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = [fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", words) for x in texts]
            fp = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], names=["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, fp long")


def _tables(rows: int, budget: int) -> tuple[list[list[tuple[int, int]]], int]:
    """Bit orders to build tries in, each a list of (first bit, width), and the bits that lead each.

    Of `blocks` blocks at most `budget` differ, so in one of the orders all the
    leading blocks agree. More rows take more, longer leading parts: the trie
    below one holds about `GROUP` rows.
    """
    for blocks in range(budget + 1, BITS // 2):
        edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
        lead = min(edges[i + 1] - edges[i] for i in range(blocks)) * (blocks - budget)
        if rows <= GROUP << lead or blocks >= budget + 4:
            break
    spans = [(edges[i], edges[i + 1] - edges[i]) for i in range(blocks)]
    orders = []
    for chosen in combinations(range(blocks), blocks - budget):
        orders.append([spans[i] for i in chosen] + [x for i, x in enumerate(spans) if i not in chosen])
    return orders, blocks - budget


def _reordered(fp: Column, order: list[tuple[int, int]]) -> Column:
    """The bits of `fp` with the blocks of `order` from the top down."""
    out, top = F.lit(0).cast("long"), BITS
    for first, width in order:
        top -= width
        part = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(part, top))
    return out


def trie_links(group: np.ndarray, bits: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (i < j) of one group whose `bits` differ in at most `budget` places.

    Rows are sorted by (group, bits) and so are the leaves of one binary trie
    per group. Pairs of nodes go down together, eight binary levels a step, and
    carry the bits that differ so far; beyond the budget the pair and all below
    it is dropped. A pair of single leaves is settled at once.
    """
    starts = [np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))]
    same = group[1:] == group[:-1]
    for level in range(1, 9):
        head = bits >> np.uint64(BITS - 8 * level)
        starts.append(np.flatnonzero(np.concatenate([[True], ~same | (head[1:] != head[:-1])])))
    n = len(bits)
    first_child = [np.searchsorted(starts[k + 1], np.append(starts[k], n)) for k in range(8)]
    roots = np.arange(len(starts[0]))
    stack = [(0, roots, roots, np.zeros(len(roots), dtype=np.uint8))]
    while stack:
        level, a, b, differ = stack.pop()
        child = first_child[level]
        na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
        total = np.cumsum(na * nb)
        if len(total) > 1 and total[-1] > FRONTIER:
            cut = max(1, int(np.searchsorted(total, total[-1] // 2)))
            stack += [(level, x[:cut], y[:cut], d[:cut]) for x, y, d in [(a, b, differ)]]
            stack += [(level, x[cut:], y[cut:], d[cut:]) for x, y, d in [(a, b, differ)]]
            continue
        pair = np.repeat(np.arange(len(a)), na * nb)
        at = np.arange(len(pair)) - np.repeat(total - na * nb, na * nb)
        ca, cb = child[a][pair] + at // nb[pair], child[b][pair] + at % nb[pair]
        below = starts[level + 1]
        shift, low = np.uint64(BITS - 8 * (level + 1)), np.uint64(255)
        cross = ((bits[below[ca]] ^ bits[below[cb]]) >> shift) & low
        d = differ[pair] + np.bitwise_count(cross).astype(np.uint8)
        keep = (d <= budget) & (ca <= cb)
        ca, cb, d = ca[keep], cb[keep], d[keep]
        ends = np.append(below, n)
        single = (ends[ca + 1] - ends[ca] == 1) & (ends[cb + 1] - ends[cb] == 1)
        i, j = below[ca[single]], below[cb[single]]
        near = (i < j) & (np.bitwise_count(bits[i] ^ bits[j]) <= budget)
        if near.any():
            yield i[near], j[near]
        if level < 7 and not single.all():
            stack.append((level + 1, ca[~single], cb[~single], d[~single]))


def near_fingerprints(fps: DataFrame, rows: int, budget: int = BUDGET) -> DataFrame:
    """a, b: links that join all distinct `fp` differing in at most `budget` bits into the right components.

    Not every pair: each trie gives a tree over those of its rows that hang
    together, so a group of n near copies costs n rows, not n squared.
    """
    orders, lead = _tables(rows, budget)
    tries = F.array(
        *[
            F.struct(F.lit(k).alias("t"), F.lit(sum(w for _, w in o[:lead])).alias("w"), _reordered(F.col("fp"), o).alias("bits"))
            for k, o in enumerate(orders)
        ]
    )
    rows_ = fps.select("fp", F.explode(tries).alias("x")).select(
        F.col("x.t").alias("t"), F.expr("shiftrightunsigned(x.bits, 64 - x.w)").alias("head"), F.col("x.bits").alias("bits"), "fp"
    )
    keys = ["t", "head", "lo", "hi"]
    dealt = split_groups(rows_, ["t", "head"], "fp", LIMIT)

    def run(batches):
        for table, starts in whole_groups(batches, keys, 1 << 16):
            n = table.num_rows
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
            bits, fp = (table.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("bits", "fp"))
            order = np.lexsort((bits, group))
            group, bits, fp = group[order], bits[order], fp[order].view(np.int64)
            labels = np.arange(n)
            for i, j in trie_links(group, bits, budget):
                labels = join_labels(labels, i, j)
            linked = np.flatnonzero(labels != np.arange(n))
            yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[labels[linked]])], names=["a", "b"])

    return in_partitions(dealt, keys, ["bits"], run, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, budget: int = BUDGET
) -> DataFrame:
    """key, fp, component: the fingerprint of every row and the smallest key it is linked to, directly or not.

    Rows with one fingerprint are one node, so copies cost nothing but their
    own row. Every row of `docs` gives one row; a null key is never the
    smallest, and a group of null keys only has a null component. An empty
    table gives an empty one.
    """
    fps = materialize(fingerprints(docs, key, text, words), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min("key").alias("first")), "nodes")
    linked = components(near_fingerprints(nodes.select("fp"), nodes.count(), budget), "a", "b")
    rooted = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(firsts, "root").select("fp", "component")
    return fps.join(named, "fp").select(F.col("key").alias(key), "fp", "component")
