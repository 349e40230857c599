"""Phrase collocations from count streams kept in prefix and in suffix order.

Words are counted first. Only words of `min_count` occurrences can be in a
phrase of that many, so texts are written once more as whole numbers with
breaks at cuts and rarer words; pairs, triples and longer phrases are counted
from these in turn, each where the ones before are frequent. The phrases that remain hold all their own beginnings and endings. In
prefix order the counts of a phrase's beginnings, and of what extends it to the
right, lie in the same stretch of the stream; in suffix order those of its
endings and of what extends it to the left. So one pass over each stream, with
its running groups in step, gives all counts a score needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.functions.lists import binary_lengths, pieces
from tokenloom.operators.joins import lookup, table_bytes
from tokenloom.session import materialize

VOCABULARY_BYTES = 32 << 20  # a larger vocabulary is joined word by word instead of being sent to the tasks
PAIR_BYTES = 64 << 20  # more pairs than this are not sent to the tasks; longer phrases then count without their help
WORDS_HELD = 150_000  # different words a task holds before it hands their counts on
STEP = 1 << 20  # bytes of a text cut into words at a time
CHUNK = 500_000  # places whose phrases are counted at a time
PHRASES_HELD = 1 << 18  # different phrases a task holds before it hands their counts on
PART_PLACES = 1 << 20  # places whose phrases are put together at a time
ROW_IDS = 1024  # words of a stored row, up to the next break; readers hold thousands of rows at a time
SALTS = 64
UNKNOWN_LANG = "und"

# The signs that end a piece, mapped to a byte that no text has; A-Z; the tab.
BREAK = b"\xff"
_TABLE = bytearray(range(256))
for _sign in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_sign] = BREAK[0]
for _letter in range(ord("A"), ord("Z") + 1):
    _TABLE[_letter] = _letter + 32
_TABLE[ord("\t")] = ord(" ")
TABLE = bytes(_TABLE)


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words in order, with BREAK where a piece ends; a bounded stretch of the text at a time."""
    text = text.translate(TABLE).replace(BREAK, b" " + BREAK + b" ")
    at = 0
    while at < len(text):
        end = at + STEP
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def words_in(langs: pa.Array, texts: pa.Array) -> Iterator[tuple[str, pa.BinaryArray, np.ndarray]]:
    """The words of `pieces_of`, for all texts of a language together, about `STEP` bytes at a time.

    Each stretch comes as language, words, and whether a piece or a text ends
    before each word, with one entry more for behind the last.
    """
    codes = langs.dictionary_encode()
    for code, lang in enumerate(codes.dictionary.to_pylist()):
        mine = texts.filter(pc.equal(codes.indices, code)).cast(pa.binary())
        for start, stop in pieces(binary_lengths(mine), STEP):
            whole = (BREAK.join(mine.slice(start, stop - start).to_pylist()) + BREAK).translate(TABLE)
            at = 0
            while at < len(whole):
                end = at + STEP
                if end < len(whole):
                    found = [x for x in (whole.find(b" ", end), whole.find(BREAK, end)) if x >= 0]
                    end = min(found, default=len(whole))
                data = np.frombuffer(whole, np.uint8)[at:end]
                ends = data == BREAK[0]
                inside = ~(ends | (data == ord(" ")))
                starts = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
                before, ended = np.cumsum(inside, dtype=np.int32), np.cumsum(ends, dtype=np.int32)
                offsets = np.append(before[starts] - 1, before[-1]).astype(np.int32)
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
                broken = np.diff(ended[starts], prepend=0, append=ended[-1]) > 0
                yield lang, pa.BinaryArray.from_buffers(pa.binary(), len(starts), buffers), broken
                at = end


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, word, n of `lang` and `text`: counted inside the tasks, then by word."""

    def run(batches):
        held: dict[str, list[pa.Table]] = {}
        room = WORDS_HELD

        def holds():
            return sum(len(t) for tables in held.values() for t in tables)

        def merge():
            for lang, tables in held.items():
                if len(tables) > 1:
                    summed = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")])
                    held[lang] = [pa.table({"word": summed["word"], "n": summed["n_sum"]})]

        def flushed():
            for lang, tables in held.items():
                for table in tables:
                    named = pa.array([lang] * len(table), pa.string())
                    yield from pa.table({"lang": named, "word": table["word"].cast(pa.string()), "n": table["n"]}).to_batches()
            held.clear()

        for batch in batches:
            for lang, words, _ in words_in(batch.column(0), batch.column(1)):
                counts = pc.value_counts(words)
                held.setdefault(lang, []).append(pa.table({"word": counts.field(0), "n": counts.field(1)}))
                if holds() > room:
                    merge()
                    if holds() > WORDS_HELD:
                        yield from flushed()
                    room = max(WORDS_HELD, 2 * holds())
        merge()
        yield from flushed()

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """`words` with `id` from 0 on without gaps, written; and how many there are.

    Places inside the written pieces are moved by the sizes of the pieces
    before, one number a piece.
    """
    placed = words.withColumn("_piece", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    sizes = placed.groupBy("_piece").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy(F.lit(0)).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)  # a row a piece
    starts = sizes.select("_piece", F.coalesce(F.sum("_size").over(before), F.lit(0).cast("long")).alias("_start"))
    moved = placed.join(F.broadcast(starts), "_piece").withColumn("id", F.col("_start") + F.col("_place"))
    return materialize(moved.select("lang", "word", "n", "id"), "vocabulary"), placed.count()


def encoded_texts(rows: DataFrame, vocabulary: DataFrame, max_bytes: int = VOCABULARY_BYTES) -> DataFrame:
    """`ids`: the words of texts in order, -1 where no phrase may go on, and at the end of each row.

    A vocabulary of up to `max_bytes` goes to the tasks. A larger one is joined
    word by word and the words of each text are put in order again.
    """
    if table_bytes(vocabulary) > max_bytes:
        return _joined_ids(rows, vocabulary)
    entries = vocabulary.select("lang", "word", "id").toArrow().combine_chunks()
    by_lang = {}
    for lang in pc.unique(entries["lang"]).to_pylist():
        mine = entries.filter(pc.equal(entries["lang"], lang)).combine_chunks()
        by_lang[lang] = mine["word"].cast(pa.binary()).combine_chunks(), mine["id"].to_numpy().astype(np.int32)
    shared = rows.sparkSession.sparkContext.broadcast(by_lang)

    return rows.select("lang", "text").mapInArrow(lambda batches: _coded(batches, shared.value), "ids array<int>")


def _coded(batches: Iterator[pa.RecordBatch], known: dict[str, tuple[pa.BinaryArray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows of ids of the batches' texts, each up to a break; `known` has the words and ids of each language."""
    none = pa.array([], pa.binary()), np.zeros(0, dtype=np.int32)
    for batch in batches:
        held, size = [], 0
        for lang, words, broken in words_in(batch.column(0), batch.column(1)):
            entries, numbers = known.get(lang, none)
            at = pc.fill_null(pc.index_in(words, value_set=entries), -1).to_numpy(zero_copy_only=False)
            ids = np.append(numbers, np.int32(-1))[at]
            held.append(np.insert(ids, np.flatnonzero(broken), -1))  # the last entry of `broken` is behind the last id
            size += len(words)
            if size > CHUNK:  # what is behind the last break goes on in the next stretch
                whole = np.concatenate(held)
                end = len(whole) - int(np.argmax(whole[::-1] < 0)) if (whole < 0).any() else 0
                if end:
                    yield _id_rows(whole[:end])
                held, size = [whole[end:]], len(whole) - end
        if size:
            yield _id_rows(np.concatenate(held))


def _id_rows(ids: np.ndarray) -> pa.RecordBatch:
    """`ids`, which end in a break, as rows of about `ROW_IDS`."""
    keep = np.ones(len(ids), dtype=bool)
    keep[1:] = (ids[1:] >= 0) | (ids[:-1] >= 0)  # one break is enough
    ids = ids[keep]
    breaks = np.flatnonzero(ids < 0) + 1
    ends = breaks[np.searchsorted(breaks, np.arange(ROW_IDS, len(ids), ROW_IDS))]
    offsets = np.unique(np.concatenate([[0], ends, [len(ids)]])).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=["ids"])


def _joined_ids(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for uid, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                at = 0
                for words in pieces_of(text.as_py()):
                    real = [w for w in words if w != BREAK]
                    # A break leaves a gap between places, and so does a word that is not in the vocabulary.
                    places = at + np.cumsum([2 if w == BREAK else 1 for w in words] or [0])
                    at = int(places[-1])
                    places = places[[w != BREAK for w in words]] if words else places[:0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid] * len(real), pa.int64()), pa.array(places, pa.int64()), pa.array([lang] * len(real), pa.string()), pa.array(real, pa.binary()).cast(pa.string())],
                        names=["uid", "place", "lang", "word"],
                    )

    uid = F.monotonically_increasing_id().alias("uid")
    long = rows.select(uid, "lang", "text").mapInArrow(run, "uid bigint, place bigint, lang string, word string")
    long = materialize(long, "words")
    found = lookup(long, vocabulary.select("lang", "word", "id"), ["lang", "word"], "inner", 0)
    placed = found.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("p"))

    def step(x: Column, i: Column) -> Column:
        before = F.get(F.col("p"), i - 1)["place"]
        return F.when(x["place"] - before > 1, F.array(F.lit(-1), x["id"].cast("int"))).otherwise(F.array(x["id"].cast("int")))

    return placed.select(F.concat(F.flatten(F.transform("p", step)), F.array(F.lit(-1))).alias("ids"))


def _listed(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `keys` in the sorted `known`, and which of them are there."""
    found = np.searchsorted(known, keys)
    if not len(known):
        return found, np.zeros(len(keys), dtype=bool)
    return found, known[np.minimum(found, len(known) - 1)] == keys


def phrases_in(
    ids: np.ndarray, size: int, low: int, high: int, pairs: np.ndarray | None, *longer: np.ndarray | None
) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Of each number of words from `low` to `high`: the different phrases in `ids`, a list of columns, and their counts.

    `size` is that of the vocabulary. With `pairs` (first * size + second,
    sorted) only phrases all of whose pairs are listed are counted. `longer`
    are triples (place of the pair in `pairs` * size + third, sorted), phrases
    of four words by the place of their triple, and so on: with these only
    phrases of as many words and more all of whose parts of as many are listed.
    """
    at = np.flatnonzero(ids[:-1] >= 0) if len(ids) else np.zeros(0, dtype=np.int64)
    at = at[ids[at + 1] >= 0]
    if pairs is not None:
        found, known = _listed(ids[at] * size + ids[at + 1], pairs)
        at, found = at[known], found[known]
    linked = np.zeros(len(ids), dtype=bool)  # a listed phrase begins here
    linked[at] = True
    reach = 0
    for words, listed in enumerate(longer, 3):
        if listed is None:
            break
        on = linked[at + 1]
        at, found = at[on], found[on]
        found, known = _listed(found * size + ids[at + words - 1], listed)
        at, found = at[known], found[known]
        linked = np.zeros(len(ids), dtype=bool)
        linked[at] = True
        reach = words - 2
    linked = np.zeros(len(ids), dtype=bool)  # a phrase that long may go on from the last but one word of a listed part
    linked[at + reach] = True
    code, columns, known = ids[at], None, 1
    if pairs is not None and low > reach + 2:  # the listed ones themselves are not asked for: theirs are the first columns
        on, known = linked[at + reach + 1], reach + 2
        at, code = at[on], found[on]
    for words in range(known + 1, high + 1):
        key = code * size + ids[at + words - 1]
        if words < high:
            key, back = np.unique(key, return_inverse=True)
            n = np.bincount(back, minlength=len(key))
        else:
            key, n = np.unique(key, return_counts=True)
        first, final = np.divmod(key, size)
        if columns is None:
            columns = [*_spelled(first, size, pairs, *longer[:reach]), final] if known > 1 else [first, final]
        else:
            columns = [*[c[first] for c in columns], final]
        if words >= low:
            yield columns, n
        if words < high:
            on = linked[at + words - 1] if words > reach else slice(None)
            at, code = at[on], back[on]


def _spelled(places: np.ndarray, size: int, *listed: np.ndarray) -> list[np.ndarray]:
    """The words of the phrases at `places` of the last of `listed`, a list of columns."""
    columns = []
    for known in reversed(listed):
        places, word = np.divmod(known[places], size)
        columns.append(word)
    return [places, *reversed(columns)]


def merged(parts: list[tuple[list[np.ndarray], np.ndarray]], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Phrases of one number of words, a list of columns and counts each, with equal ones put together."""
    columns = [np.concatenate(c) for c in zip(*(columns for columns, _ in parts), strict=True)]
    n = np.concatenate([n for _, n in parts])
    code, below = columns[0], size
    for column in columns[1:]:
        if below * size >= 1 << 63:
            code, below = np.unique(code, return_inverse=True)[1], len(code)
        code, below = code * size + column, below * size
    order = np.argsort(code, kind="stable")
    code = code[order]
    starts = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
    return [c[order[starts]] for c in columns], np.add.reduceat(n[order], starts) if len(starts) else n


class _Held:
    """Counts of phrases, put together whenever there are many pieces of them."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.rows, self.kept, self.parts = size, most, 0, 0, {}

    def add(self, columns: list[np.ndarray], n: np.ndarray) -> None:
        self.parts.setdefault(len(columns), []).append((columns, n))
        self.rows += len(n)
        if self.rows > max(self.most, 2 * self.kept):
            self.merge()

    def merge(self) -> None:
        self.parts = {words: [merged(parts, self.size)] for words, parts in self.parts.items()}
        self.rows = self.kept = sum(len(n) for parts in self.parts.values() for _, n in parts)

    def taken(self) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        self.merge()
        yield from (part for parts in self.parts.values() for part in parts if len(part[1]))
        self.rows, self.kept, self.parts = 0, 0, {}


def _dealt(columns: list[np.ndarray], parts: int) -> np.ndarray:
    """The part, below `parts`, that each phrase belongs to."""
    mixed = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(parts)).astype(np.int32)


def phrase_counts(encoded: DataFrame, size: int, low: int, high: int, *listed: np.ndarray | None) -> DataFrame:
    """w1, w2, ... (-1 behind the end), words, n: counted inside the tasks, then by phrase.

    A task puts the counts of its pieces together until it holds `PHRASES_HELD`,
    and hands them on as arrays, one row for each part that phrases are dealt
    to by their words. Whoever takes over a part puts its arrays together in the
    same way, so no phrase is a row before it is counted to the end. There is a
    part for every `PART_PLACES` words, and a place begins one phrase of a
    length at most, so neither side grows with the table.
    """
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(listed or (None,))
    names = [f"w{i + 1}" for i in range(high)]
    places = encoded.agg(F.sum(F.size("ids").cast("long")).alias("n")).first()["n"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-places // PART_PLACES))

    def run(batches):
        held = _Held(size, PHRASES_HELD)

        def blocks():
            for columns, n in held.taken():
                part = _dealt(columns, parts)
                order = np.argsort(part, kind="stable")
                part = part[order]
                starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                offsets = pa.array(np.append(starts, len(part)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(c[order].astype(np.int32))) for c in columns]
                lists += [pa.nulls(len(starts), pa.list_(pa.int32()))] * (high - len(columns))
                lists.append(pa.ListArray.from_arrays(offsets, pa.array(n[order])))
                yield pa.RecordBatch.from_arrays([pa.array(part[starts]), *lists], names=["part", *names, "n"])

        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten().to_numpy()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            start = 0
            while start < len(flat):
                end = int(ends[min(np.searchsorted(ends, start + CHUNK), len(ends) - 1)])
                for columns, n in phrases_in(flat[start:end].astype(np.int64), size, low, high, *shared.value):
                    held.add(columns, n)
                start = end
                if held.kept > PHRASES_HELD // 2:
                    yield from blocks()
        yield from blocks()

    def put_together(batches):
        held = _Held(size, PHRASES_HELD)
        for batch in batches:
            for words in range(low, high + 1):  # a block of shorter phrases has no list for its later words
                here = batch if low == high else batch.filter(_words_of(batch, words, high))
                if here.num_rows:
                    columns = [here.column(i + 1).flatten().to_numpy().astype(np.int64) for i in range(words)]
                    held.add(columns, here.column(high + 1).flatten().to_numpy())
        for columns, n in held.taken():
            words = np.full(len(n), len(columns), dtype=np.int32)
            columns = columns + [np.full(len(n), -1)] * (high - len(columns))
            whole = pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(words), pa.array(n)], names=[*names, "words", "n"])
            yield from (whole.slice(at, CHUNK) for at in range(0, len(n), CHUNK))

    schema = ", ".join(f"{name} array<int>" for name in names)
    blocks = encoded.select("ids").mapInArrow(run, f"part int, {schema}, n array<bigint>")
    counted = blocks.repartition(parts, "part")
    return counted.mapInArrow(put_together, ", ".join(f"{name} bigint" for name in names) + ", words int, n bigint")


def _words_of(batch: pa.RecordBatch, words: int, high: int) -> pa.Array:
    """Which blocks are of phrases of so many words."""
    there = batch.column(words).is_valid()
    return there if words == high else pc.and_(there, batch.column(words + 1).is_null())


def _sorted_keys(phrases: DataFrame, size: int, *listed: np.ndarray) -> np.ndarray:
    """Phrases of one number of words as `phrases_in` takes them, `listed` being those of fewer; call only after a check of the size."""
    first, *rest = (c.to_numpy() for c in phrases.toArrow().columns)
    keys = first * size + rest[0]
    for known, word in zip(listed, rest[1:], strict=True):
        keys = _listed(keys, known)[0] * size + word
    return np.sort(keys)


def frequent_phrases(encoded: DataFrame, size: int, min_count: int, max_words: int, pair_bytes: int = PAIR_BYTES) -> DataFrame:
    """w1 ... (-1 behind the end), words, n: all phrases of 2 to `max_words` words that occur `min_count` times.

    Phrases of each number of words are only counted where all their parts of
    one word less are frequent, if these are few enough to be sent to the
    tasks; else all longer ones are counted together, wherever what was sent
    allows.
    """
    names = [f"w{i + 1}" for i in range(max_words)]

    def kept(counts: DataFrame, name: str) -> DataFrame:
        frequent = counts.filter(F.col("n") >= min_count)
        none = [F.lit(-1).cast("long").alias(w) for w in names if w not in counts.columns]
        return materialize(frequent.select(*[w for w in names if w in counts.columns], *none, "words", "n"), name)

    out = found = kept(phrase_counts(encoded, size, 2, 2), "phrases_2")
    listed: list[np.ndarray] = []
    for words in range(3, max_words + 1):
        shorter = found.select(*names[: words - 1])
        if table_bytes(shorter) > pair_bytes:
            return out.unionByName(kept(phrase_counts(encoded, size, words, max_words, *listed), "longer"))
        listed.append(_sorted_keys(shorter, size, *listed))
        found = kept(phrase_counts(encoded, size, words, words, *listed), f"phrases_{words}")
        out = out.unionByName(found)
    return out


def _in_step(phrases: DataFrame, columns: list[str], tag: str) -> DataFrame:
    """One pass over the phrases in the order of `columns`.

    Adds `<tag>2`, `<tag>3`, ...: the count of the phrase that the first so
    many columns are, and `<tag>_more`: the largest count among phrases that go
    on from this one by one word. Dealt by the first two columns and sorted
    once; every group below is a stretch of that order.
    """
    out = phrases.repartition(columns[0], columns[1]).sortWithinPartitions(*columns)
    more = F.lit(None).cast("long")
    for depth in range(len(columns) - 1, 1, -1):
        group = W.partitionBy(*columns[:depth])
        out = out.withColumn(f"{tag}{depth}", F.max(F.when(F.col("words") == depth, F.col("n"))).over(group))
        out = out.withColumn(f"_more{depth}", F.max(F.when(F.col("words") == depth + 1, F.col("n"))).over(group))
        more = F.when(F.col("words") == depth, F.col(f"_more{depth}")).otherwise(more)
    return out.withColumn(f"{tag}_more", more).drop(*[f"_more{d}" for d in range(2, len(columns))])


def scored_phrases(phrases: DataFrame, vocabulary: DataFrame, totals: DataFrame, max_words: int, cover: int) -> DataFrame:
    """lang, w1 ..., words, a, l, r, n, score of the phrases that no longer one covers.

    A phrase is covered if a longer one that holds it has at least `cover` per
    cent of its count. Counts never grow with length, so the extensions by one
    word, to either side, are all that has to be asked.
    """
    names = [f"w{i + 1}" for i in range(max_words)]
    out = _in_step(phrases, names, "l")
    for i in range(max_words):  # the same words from the end
        word = F.lit(-1).cast("long")
        for words in range(max(2, i + 1), max_words + 1):
            word = F.when(F.col("words") == words, F.col(f"w{words - i}")).otherwise(word)
        out = out.withColumn(f"v{i + 1}", word)
    out = _in_step(out, [f"v{i + 1}" for i in range(max_words)], "r")
    first = vocabulary.select(F.col("id").alias("w1"), "lang", F.col("n").alias("l1"))
    final = vocabulary.select(F.col("id").alias("v1"), F.col("n").alias("r1"))
    out = lookup(lookup(lookup(out, first, ["w1"], "inner"), final, ["v1"], "inner"), totals, ["lang"], "inner")
    more = F.greatest(F.coalesce("l_more", F.lit(0)), F.coalesce("r_more", F.lit(0)))
    out = out.filter(more * 100 < F.col("n") * cover)
    whole = "CAST(1000 AS DECIMAL(4,0)) * CAST(n AS DECIMAL(17,0)) * CAST(total AS DECIMAL(17,0))"
    options = []
    for k in range(1, max_words):
        rest = F.lit(None).cast("long")
        for words in range(k + 1, max_words + 1):
            rest = F.when(F.col("words") == words, F.col(f"r{words - k}")).otherwise(rest)
        out = out.withColumn(f"_r{k}", rest)
        score = F.expr(f"({whole}) div (CAST(l{k} AS DECIMAL(19,0)) * CAST(_r{k} AS DECIMAL(19,0)))")
        cut = F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"_r{k}").alias("r"))
        options.append(F.when(F.col("words") > k, cut))
    made = out.withColumn("_best", F.array_min(F.filter(F.array(*options), lambda c: c.isNotNull())))
    return made.select(
        "lang", *names, "words", F.col("n").alias("a"), F.col("_best.l").alias("l"), F.col("_best.r").alias("r"), F.col("total").alias("n"), F.col("_best.score").alias("score")
    )


def with_phrase(scored: DataFrame, vocabulary: DataFrame, max_words: int) -> DataFrame:
    """`phrase`, the words with blanks between, in place of their numbers."""
    names = [f"w{i + 1}" for i in range(max_words)]
    keep = ["lang", "a", "l", "r", "n", "score"]
    entries = F.filter(F.array(*names), lambda x: x >= 0)
    long = scored.select(*names, *keep, F.posexplode(entries).alias("_at", "id"))
    named = lookup(long, vocabulary.select("id", "word"), ["id"], "inner")
    words = F.array_sort(F.collect_list(F.struct("_at", "word")))["word"]  # at most `max_words`
    grouped = named.groupBy(*names, *keep).agg(F.array_join(words, " ").alias("phrase"))
    return grouped.select("phrase", *keep)


def best_of_each(rows: DataFrame, group: str, order: list[Column], k: int, spread: Column) -> DataFrame:
    """The first `k` rows of each group with their `rank`; a hot group is thinned in parts first."""
    part = F.pmod(F.xxhash64(spread), F.lit(SALTS))
    parts = W.partitionBy(group, "_part").orderBy(*order)
    few = rows.withColumn("_part", part).withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= k)
    whole = W.partitionBy(group).orderBy(*order)  # at most k * SALTS rows
    return few.withColumn("rank", F.row_number().over(whole).cast("long")).filter(F.col("rank") <= k).drop("_part")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = 100,
    max_words: int = 5,
    cover: int = 100,
    top: int = 2000,
    vocabulary_bytes: int = VOCABULARY_BYTES,
    pair_bytes: int = PAIR_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language.

    Null languages are `und`, null texts empty; repeated rows count each. An
    empty table, or one without a frequent phrase, gives no rows. Scores are
    exact whole numbers; more than 38 digits on the way are an error.
    """
    if not 2 <= max_words:
        raise ValueError("phrases have two words or more")
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    counts = materialize(word_counts(rows), "word_counts")
    totals = materialize(counts.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    vocabulary, size = numbered(counts.filter(F.col("n") >= min_count))
    if size >= 1 << 31:
        raise ValueError("more frequent words than a stored number of 32 bits tells apart; raise min_count")
    encoded = materialize(encoded_texts(rows, vocabulary, vocabulary_bytes), "encoded")
    phrases = frequent_phrases(encoded, max(size, 1), min_count, max_words, pair_bytes)
    scored = scored_phrases(phrases, vocabulary, totals, max_words, cover)
    named = with_phrase(scored, vocabulary, max_words)
    ranked = best_of_each(named, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top, F.col("phrase"))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
