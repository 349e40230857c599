"""URL rules by a cascade of Bloom filters that is exact over all keys of the corpus."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import ascii_lower
from tokenloom.session import materialize

MAX_BITS = 1 << 26  # of one filter: 8 MB, the proven bound of what is sent to the tasks
LOG = math.log(2)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://`, A-Z lower-cased, and path without query and fragment; else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return ascii_lower(host), path


@dataclass(frozen=True)
class Filter:
    """One level: `bits` as 64-bit words, and the number of probes."""

    size: int
    probes: int
    seed: int
    words: tuple[int, ...]

    def might_hold(self, key: Column) -> Column:
        if not self.size:
            return F.lit(False)
        # One literal that the optimizer folds into an array, not one literal a word.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        held = F.lit(True)
        for at in _places(key, self.size, self.probes, self.seed):
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            held &= F.getbit(word, at.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1
        return held


def _places(key: Column, size: int, probes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), F.lit(i), key), F.lit(size).cast("long")) for i in range(probes)]


def build_filter(keys: DataFrame, n: int, rate: float, seed: int) -> Filter:
    """A Bloom filter of the `n` distinct `key`s with about this rate of false positives."""
    if not n:
        return Filter(0, 0, seed, ())
    rate = min(max(rate, 1e-9), 0.5)
    size = max(64, math.ceil(n * -math.log(rate) / LOG**2))
    if size > MAX_BITS:
        raise ValueError(f"{n} listed keys need {size} bits; one filter holds {MAX_BITS}: cut the list by host first")
    probes = max(1, round(-math.log(rate) / LOG))
    at = F.explode(F.array(*_places(F.col("key"), size, probes, seed)))
    found = keys.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), F.col("at").bitwiseAND(F.lit(63).cast("long")).cast("int").alias("bit"))
    found = found.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    words = [0] * ((size + 63) // 64)
    for row in found.collect():  # at most MAX_BITS / 64 rows
        words[row["word"]] = row["mask"]
    return Filter(size, probes, seed, tuple(words))


@dataclass(frozen=True)
class Cascade:
    """Filters of alternately the listed keys and the false positives of the level before."""

    levels: tuple[Filter, ...]

    def holds(self, key: Column) -> Column:
        """Exact for every key of the universe it was built over."""
        inside = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            inside = F.when(self.levels[k].might_hold(key), inside).otherwise(F.lit(k % 2 == 1))
        return inside


def build_cascade(listed: DataFrame, universe: DataFrame, seed: int = 11, rounds: int = 64) -> Cascade:
    """Level after level until no key is wrong. `listed` and `universe`: distinct, non-null `key`.

    Only the first level sees the whole universe; each later one sees the
    false positives of the one before, which fall off geometrically.
    """
    inside = materialize(listed.select("key").distinct(), "listed")
    outside = universe.select("key").join(inside, "key", "left_anti")
    n_in, n_out, levels = inside.count(), universe.count(), []
    this, other, n, m = inside, outside, n_in, n_out
    while n and len(levels) < rounds:
        # The first level lets through about as many as are listed; later ones half.
        rate = 0.5 if levels else min(0.5, max(n, 1) / max(m, 1) / 2)
        level = build_filter(this, n, rate, seed + len(levels))
        levels.append(level)
        wrong = materialize(other.filter(level.might_hold(F.col("key"))), "false_positives")
        this, other, n, m = wrong, this, wrong.count(), n
    if n:
        raise RuntimeError(f"the cascade did not end in {rounds} levels")
    return Cascade(tuple(levels))


def _key_candidates(lengths: list[int]) -> Column:
    """Every (host suffix, path prefix) that a rule could be, as one string each, the longest first."""
    parts = F.split("__host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), ".")
    )
    prefixes = F.array(*[F.when(F.char_length("__path") >= n, F.substring("__path", 1, n)) for n in sorted(lengths)])
    prefixes = F.filter(prefixes, lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """key, host, path, rule, verdict for every row of `pages`.

    `rules` holds (action, host, path); of several that fit, the longest
    `host + path` wins, then the longer host. The keys of all urls are the
    universe of one cascade that tells listed keys, and the rules that of a
    second that tells blocked ones from allowed ones, so urls are judged where
    they are read, with no join. A url that no rule fits, a null one and one
    without `://` get `default`.
    """
    spark = pages.sparkSession
    if not rules:
        rules = [("allow", "", "\x00")]
    listed = spark.createDataFrame([(h + p,) for _, h, p in rules], "key string").distinct()
    blocked = spark.createDataFrame([(h + p,) for a, h, p in rules if a == "block"], "key string").distinct()
    rows = pages.select(F.col(key).alias("__key"), F.col(url).cast("string").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    rows = rows.select("__key", host.alias("__host"), path.alias("__path"))
    keys = _key_candidates(sorted({len(p) for _, _, p in rules}))
    universe = materialize(rows.select(F.explode(keys).alias("key")).distinct(), "url_keys")
    member = build_cascade(listed, universe)
    block = build_cascade(blocked, listed, seed=101)
    fits = F.filter(keys, member.holds)
    ranked = F.array_max(F.transform(fits, lambda k: F.struct(F.char_length(k).alias("n"), F.instr(k, "/").alias("h"), k.alias("k"))))
    rows = rows.select("__key", "__host", "__path", ranked["k"].alias("__rule"))
    verdict = F.when(F.col("__rule").isNull(), default).when(block.holds(F.col("__rule")), "block").otherwise("allow")
    return rows.select(
        F.col("__key").alias(key), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), verdict.alias("verdict")
    )
