"""Repeated passages: winnowed fingerprints over line hashes, and around those that come again whole runs, joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import all_of
from tokenloom.operators.joins import lookup
from tokenloom.session import materialize

MARK = "\x00"
# A line ends behind any of these. Sentences and clauses count as lines, so
# that a passage set into the middle of another line is still found.
LINE_END = r"[\n.,!?](?:(?<=\n)| )"
BARE_END = r"[\n.,!?](?:(?<=\n)|[ \n]|\z)"
GRAM = 2  # lines hashed together
WINDOW = 3  # grams of which one is selected; shorter runs of MIN_BYTES have fingerprints of their own
CHUNK = 32  # lines whose sizes are summed up in one go: an array grows by copying, so longer chunks cost more a line
NEAR = 16  # lines within which most runs of MIN_BYTES end; longer ones are searched for in the whole text
HOT = 1000  # rows of one fingerprint beyond which they are not shuffled by it
MIN_BYTES = 150  # without line ends; a shorter run stays


def lines(text: Column) -> Column:
    """The lines of a text, ends included: joined they are the text again. An empty text is one empty line."""
    quick = F.split(F.regexp_replace(text, LINE_END + r"(?!\z)", "$0" + MARK), MARK)
    return F.when(F.contains(text, F.lit(MARK)), F.split(text, r"(?<=\n|[.,!?] )(?!\z)")).otherwise(quick)


def bare_lines(text: Column) -> Column:
    """The same lines without their ends; there may be one more, empty, at the end."""
    return F.split(text, BARE_END)


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """d (names the document by key and text, null keys too) and text."""
    body = F.col(text).cast("string")
    return docs.select(F.struct(F.col(key).alias("id"), F.xxhash64(body).alias("copy")).alias("d"), body.alias("text"))


def hashed_lines(docs: DataFrame) -> DataFrame:
    """d, h, n: hash and bytes of each line of `docs` (d, text); none of a null text."""
    rows = docs.filter("text is not null").select("d", bare_lines(F.col("text")).alias("s"))
    return rows.select("d", F.transform("s", lambda x: F.xxhash64(x)).alias("h"), F.transform("s", F.octet_length).alias("n"))


def fingerprints(rows: DataFrame, gram: int = GRAM, window: int = WINDOW, min_bytes: int = MIN_BYTES) -> DataFrame:
    """d, fp, pos of `rows` (d, h, n): any two equal runs of `min_bytes` bytes share one of these.

    Window minima of the gram hashes, of equal ones the leftmost: a run of
    `gram` + `window` - 1 lines holds a whole window. A shorter run may not, so
    every gram from which fewer lines reach `min_bytes` is there too, and every
    run of fewer than `gram` lines that does.
    """
    upto = lambda n: F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(upto(F.size("h") - gram), lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(gram)]))
    rows = rows.select("d", "h", "n", grams.alias("g"))

    def minimum(i: Column) -> Column:
        """Whether the gram at `i` is the leftmost minimum of a window; windows at the ends may be shorter."""
        x = F.get("g", i)
        before = [F.coalesce(x < F.get("g", i - j), F.lit(True)) for j in range(1, window)]
        behind = [F.coalesce(x <= F.get("g", i + j), F.lit(True)) for j in range(1, window)]
        found = F.lit(True)
        for k in reversed(range(window - 1)):  # the first k before are larger: then so must the rest of a window be behind
            found = F.when(before[k], found).otherwise(all_of(behind[: window - 1 - k]))
        return found

    reach = lambda i, m: sum((F.coalesce(F.get("n", i + j), F.lit(0)) for j in range(1, m)), F.get("n", i)) >= min_bytes
    chosen = F.filter(upto(F.size("g") - 1), lambda i: reach(i, gram + window - 2) | minimum(i))
    found = [F.transform(chosen, lambda i: F.struct(F.get("g", i).alias("fp"), i.alias("pos")))]
    for m in range(1, gram):
        alone = F.filter(upto(F.size("h") - m), lambda i: reach(i, m))  # noqa: B023
        hashed = lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(m)], F.lit("alone"))  # noqa: B023, E731
        found.append(F.transform(alone, lambda i: F.struct(hashed(i).alias("fp"), i.alias("pos"))))  # noqa: B023
    return rows.select("d", F.explode(F.concat(*found)).alias("x")).select("d", "x.fp", "x.pos")


def _with(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _offsets(n: Column) -> Column:
    """Sums of `n` in front of each line, and of all: in chunks, so that a text of very many lines stays cheap."""
    add = lambda at, x: F.array_append(at, F.element_at(at, -1) + x)
    part = lambda k: F.slice(n, k * CHUNK + 1, CHUNK)
    last = F.floor(F.size(n) / CHUNK).cast("int")
    chunks = F.sequence(F.lit(0), last)
    whole = F.transform(chunks, lambda k: F.aggregate(part(k), F.lit(0), lambda x, y: x + y))
    bases = F.aggregate(whole, F.array(F.lit(0)), add)
    inner = lambda base, k: F.aggregate(part(k), F.array(base), add)
    sums = lambda base, k: F.when(k == last, inner(base, k)).otherwise(F.slice(inner(base, k), 1, CHUNK))
    return _with(bases, lambda at: F.flatten(F.transform(chunks, lambda k: sums(F.get(at, k), k))))


def windows(rows: DataFrame, min_bytes: int) -> DataFrame:
    """d, fp, start, end: the shortest runs of `min_bytes` bytes in which a line of `hot` lies; `rows` are d, h, n, hot.

    One from every line on, and one up to every line: whichever line of a
    longer run is taken, one of the two holds it and does not leave the run.
    `hot` are sorted positions.
    """
    following = F.flatten(F.transform("hot", lambda p, k: F.array_repeat(p, p - F.coalesce(F.get("hot", k - 1), F.lit(-1)))))
    before = F.flatten(F.transform("hot", lambda p, k: F.array_repeat(p, F.coalesce(F.get("hot", k + 1), F.size("h")) - p)))
    before = F.concat(F.array_repeat(F.lit(-1), F.get("hot", F.lit(0)) + 1), before)
    rows = rows.select("d", "h", _offsets(F.col("n")).alias("at"), following.alias("following"), before.alias("before"))
    rows = materialize(rows, "touched_lines")

    at = lambda i: F.get("at", i)
    lines = F.size("h")
    powers = F.transform(F.sequence(F.ceil(F.log2(lines + 1)).cast("int"), F.lit(0)), lambda k: F.pow(F.lit(2), k).cast("int"))
    furthest = lambda start, fits, steps: F.aggregate(steps, start, lambda i, p: F.when(fits(at(i + p)), i + p).otherwise(i))
    few = F.array(*[F.lit(NEAR >> k) for k in range(1, NEAR.bit_length())])  # NEAR / 2, ..., 1

    def onward(steps: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), lines - 1),
            lambda i: (at(lines) - at(i) >= min_bytes) & (at(F.get("following", i)) - at(i) < min_bytes),
        )
        found = lambda i, x: F.when(at(i + NEAR) < x, furthest(i, lambda y: y < x, steps)).otherwise(furthest(i, lambda y: y < x, few))
        end = lambda i: _with(at(i) + min_bytes, lambda x: found(i, x) + 1)
        return F.transform(starts, lambda i: F.struct(i.alias("start"), end(i).alias("end")))

    def upto(steps: Column) -> Column:
        ends = F.filter(
            F.sequence(F.lit(1), lines),
            lambda j: (at(j) >= min_bytes) & (F.get("before", j) >= 0) & (at(j) - at(F.get("before", j) + 1) < min_bytes),
        )
        found = lambda j, x: F.when(at(j - NEAR) <= x, furthest(j - NEAR, lambda y: y <= x, few)).otherwise(furthest(F.lit(-1), lambda y: y <= x, steps))
        start = lambda j: _with(at(j) - min_bytes, lambda x: found(j, x))
        runs = F.transform(ends, lambda j: F.struct(start(j).alias("start"), j.alias("end")))
        return F.filter(runs, lambda r: at(r["end"] - 1) - at(r["start"]) >= min_bytes)  # else it is one of the others

    found = _with(powers, lambda steps: F.concat(onward(steps), upto(steps)))
    rows = rows.select("d", "h", F.explode(found).alias("r"))
    return rows.select("d", F.xxhash64(F.slice("h", F.col("r.start") + 1, F.col("r.end") - F.col("r.start"))).alias("fp"), "r.start", "r.end")


def _merged(runs: Column) -> Column:
    """Sorted runs joined where they touch. Neither their starts nor their ends go back."""
    opens = lambda r, k: F.coalesce(r["start"] > F.get(runs, k - 1)["end"], F.lit(True))
    heads = F.filter(F.transform(runs, lambda r, k: F.when(opens(r, k), k).otherwise(-1)), lambda k: k >= 0)
    end = lambda heads, j: F.get(runs, F.coalesce(F.get(heads, j + 1), F.size(runs)) - 1)["end"]
    return _with(
        heads,
        lambda heads: F.transform(heads, lambda k, j: F.struct(F.get(runs, k)["start"].alias("start"), end(heads, j).alias("end"))),
    )


def _meet(rows: DataFrame, common: DataFrame) -> DataFrame:
    """`rows` joined to `common` (fp, times, ...) by fp; `times` is how many rows have it.

    Those with a fingerprint of more than HOT rows, of which there are few,
    aren't shuffled by it, so that no task gets all rows of a common one.
    """
    hot = lookup(rows, common.filter(F.col("times") > HOT), ["fp"])
    rest = hot.filter("times is null").select(*rows.columns).join(common.filter(F.col("times") <= HOT), "fp")
    return hot.filter("times is not null").unionByName(rest)


def repeated_runs(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, min_bytes: int = MIN_BYTES) -> DataFrame:
    """d, runs (start, end): the lines of each document of `docs` (d, text) that repeat earlier ones.

    Fingerprints that come again tell where runs may repeat. There, every
    shortest run of `min_bytes` bytes is hashed whole and meets the earliest
    place of its like, by key and position: as many rows as places, however
    common a line is. All lines of a longer run lie in such short ones, so an
    earlier place that goes on otherwise hides nothing, and together they are
    the match extended both ways.
    """
    rows = materialize(hashed_lines(docs), "hashed_lines")
    found = materialize(fingerprints(rows, gram, window, min_bytes), "line_fingerprints")
    again = materialize(found.groupBy("fp").agg(F.count("*").alias("times")).filter("times > 1"), "common_fingerprints")
    hot = _meet(found, again).groupBy("d").agg(F.sort_array(F.collect_set("pos")).alias("hot"))
    hot = materialize(hot, "touched")

    short = materialize(windows(lookup(rows, hot, ["d"], "inner"), min_bytes), "windows")
    firsts = short.groupBy("fp").agg(F.min(F.struct("d", "start")).alias("first"), F.count("*").alias("times")).filter("times > 1")
    later = _meet(short, materialize(firsts, "first_windows")).filter("not (d <=> first.d and start = first.start)")
    runs = later.groupBy("d").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("runs"))
    return materialize(runs, "later_windows").select("d", _merged(F.col("runs")).alias("runs"))


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    gram: int = GRAM,
    window: int = WINDOW,
    min_bytes: int = MIN_BYTES,
) -> DataFrame:
    """`docs` with later repeated runs deleted from `text`, and `__deleted`, how many lines that were.

    Earlier means a smaller key (null first), then the position; repeats inside
    one text count too. A run that is deleted always stays somewhere earlier,
    so no passage is lost. Rows that repeat both key and text are one document
    and are treated alike. Null texts stay null; empty ones stay empty. All
    other columns stay.
    """
    parts = _documents(docs, key, text)
    runs = materialize(repeated_runs(parts, gram, window, min_bytes), "repeated_runs")
    body = F.col(text).cast("string")
    named = docs.withColumn("__d", F.struct(F.col(key).alias("id"), F.xxhash64(body).alias("copy")))
    joined = lookup(named, runs.select(F.col("d").alias("__d"), F.col("runs").alias("__runs")), ["__d"])
    inside = lambda i: F.exists("__runs", lambda r: (i >= r["start"]) & (i < r["end"]))
    joined = joined.withColumn("__all", F.when(F.col("__runs").isNotNull(), lines(body)))
    joined = joined.withColumn("__kept", F.filter("__all", lambda s, i: ~inside(i)))
    changed = F.when(F.col("__runs").isNull(), body).otherwise(F.array_join("__kept", ""))
    deleted = F.coalesce(F.size("__all") - F.size("__kept"), F.lit(0)).cast("long")
    return joined.select(*[changed.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns], deleted.alias("__deleted"))
