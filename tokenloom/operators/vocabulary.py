"""A counted vocabulary of fixed size, and coding with it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.functions import arrays, lists, text
from tokenloom.operators.joins import BROADCAST_BYTES, lookup, table_bytes
from tokenloom.session import materialize

# Reserved at the top of the id range, in this order; the last one is the pad id.
SPECIALS = (text.START_MARKER, text.END_MARKER, text.UNKNOWN_MARKER, text.PAD_MARKER)
CODED_TOKENS = 1 << 19  # tokens that a task looks up at a time
CODED_BYTES = 1 << 20  # bytes of the texts that a task splits and looks up at a time


@dataclass(frozen=True)
class Vocabulary:
    """`table` has one row per entry: token, id, n (0 for reserved entries)."""

    table: DataFrame
    size: int
    specials: tuple[str, ...]

    def special_id(self, marker: str) -> int:
        return self.size - len(self.specials) + self.specials.index(marker)

    @property
    def unknown_id(self) -> int:
        return self.special_id(text.UNKNOWN_MARKER)

    @property
    def pad_id(self) -> int:
        return self.special_id(text.PAD_MARKER)


def _at_least_as_common(counts: DataFrame, wanted: int) -> DataFrame:
    """Leave out tokens too rare to be among the `wanted` most common ones.

    Counts are grouped into 16 steps per doubling, which is at most about a
    thousand rows whatever the corpus, so the final sort sees little more than
    `wanted` tokens.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    levels = counts.groupBy(step.alias("level")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("level")).collect()
    seen = 0
    for level in levels:
        seen += level["k"]
        if seen >= wanted:
            return counts.filter(step >= level["level"])
    return counts


def fit_vocabulary(
    df: DataFrame,
    tokens: Column,
    size: int = arrays.VOCABULARY_SIZE,
    specials: Sequence[str] = SPECIALS,
) -> Vocabulary:
    """Count tokens; ids go by falling count, then by token, below the reserved ids."""
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return _ranked(counts, size, specials)


def fit_text_vocabulary(
    df: DataFrame,
    words: Column,
    size: int = arrays.VOCABULARY_SIZE,
    specials: Sequence[str] = SPECIALS,
) -> Vocabulary:
    """`fit_vocabulary` of `text.tokens(words)`: texts are split and counted in Arrow pieces inside the tasks."""
    classes = df.sparkSession.sparkContext.broadcast(text.character_classes(df.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text_parts([batch.column(0)]):
                counts = pc.value_counts(text.split_texts(part, classes.value)[0])
                yield pa.RecordBatch.from_arrays(counts.flatten(), names=["token", "n"])

    counts = df.select(text.valid(words).alias("t")).mapInArrow(run, "token string, n bigint")
    return _ranked(counts.groupBy("token").agg(F.sum("n").alias("n")), size, specials)


def _ranked(counts: DataFrame, size: int, specials: Sequence[str]) -> Vocabulary:
    room = size - len(specials)
    if room < 1:
        raise ValueError("size leaves no room for tokens")
    spark = counts.sparkSession
    counts = materialize(counts, "token_counts")
    ranking = [F.desc("n"), F.col("token")]
    kept = _at_least_as_common(counts, room).orderBy(*ranking).limit(room)
    # At most `room` rows, a fixed number, so one ordered window is enough.
    rank = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*ranking)) - 1
    counted = kept.select("token", rank.cast("bigint").alias("id"), "n")
    reserved = spark.createDataFrame(
        [(m, room + i, 0) for i, m in enumerate(specials)], "token string, id bigint, n bigint"
    )
    return Vocabulary(materialize(counted.unionByName(reserved), "vocabulary"), size, tuple(specials))


def token_ids(df: DataFrame, token: str, vocabulary: Vocabulary, out: str = "id") -> DataFrame:
    """Replace a token column by its id; unlisted tokens get the unknown id."""
    table = vocabulary.table.select(F.col("token").alias(token), F.col("id").alias(out))
    coded = lookup(df, table, [token], "left")
    return coded.withColumn(out, F.coalesce(out, F.lit(vocabulary.unknown_id).cast("bigint"))).drop(token)


def _columns(vocabulary: Vocabulary) -> tuple[pa.Array, np.ndarray]:
    """Tokens and ids as arrays, for use inside tasks; call only after a check of the size."""
    entries = vocabulary.table.select("token", "id").toArrow()
    return entries.column("token").combine_chunks(), entries.column("id").to_numpy()


def _parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The lists of Arrow batches, cut into pieces of `CODED_TOKENS` entries."""
    for batch in batches:
        for start, stop in lists.pieces(lists.lengths(batch), CODED_TOKENS):
            yield batch.slice(start, stop - start)


def _text_parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The texts of Arrow batches, cut into pieces of `CODED_BYTES`; a longer text is alone."""
    for batch in batches:
        for start, stop in lists.pieces(lists.binary_lengths(batch), CODED_BYTES):
            yield batch.slice(start, stop - start)


def _text_encoder(vocabulary: Vocabulary) -> Callable[[Column], Column]:
    spark = vocabulary.table.sparkSession
    shared = spark.sparkContext.broadcast((*_columns(vocabulary), text.character_classes(spark)))
    unknown = vocabulary.unknown_id

    @F.arrow_udf("array<bigint>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        entries, ids, classes = shared.value
        for texts in _text_parts(batches):
            tokens, sizes = text.split_texts(texts, classes)
            at = pc.fill_null(pc.index_in(tokens, value_set=entries), -1).to_numpy(zero_copy_only=False)
            yield lists.regroup(np.where(at >= 0, ids[at], unknown), sizes, texts.is_null())

    return code


def encode_texts(
    df: DataFrame,
    key: Sequence[str],
    words: Column,
    vocabulary: Vocabulary,
    out: str = "ids",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`encode` of `text.tokens(words)`; tasks are handed the texts and hold the tokens of one piece at a time."""
    if table_bytes(vocabulary.table) <= max_bytes:
        return df.select(*key, _text_encoder(vocabulary)(text.valid(words)).alias(out))
    return encode(df, key, text.tokens(words), vocabulary, out, max_bytes)


def _encoder(vocabulary: Vocabulary) -> Callable[[Column], Column]:
    sc = vocabulary.table.sparkSession.sparkContext
    shared, unknown = sc.broadcast(_columns(vocabulary)), vocabulary.unknown_id

    @F.arrow_udf("array<bigint>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        entries, ids = shared.value
        for tokens in _parts(batches):
            found = pc.index_in(tokens.flatten(), value_set=entries)
            at = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
            yield lists.regroup(np.where(at >= 0, ids[at], unknown), lists.lengths(tokens), tokens.is_null())

    return code


def _decoder(vocabulary: Vocabulary) -> Callable[[Column], Column]:
    sc = vocabulary.table.sparkSession.sparkContext
    shared = sc.broadcast(_columns(vocabulary))

    @F.arrow_udf("array<string>")
    def name(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        entries, known = shared.value
        for ids in _parts(batches):
            at = pc.index_in(ids.flatten(), value_set=pa.array(known, pa.int64()))
            yield lists.regroup(pc.fill_null(entries.take(at), text.UNKNOWN_MARKER), lists.lengths(ids), ids.is_null())

    return name


def encode(
    df: DataFrame,
    key: Sequence[str],
    tokens: Column,
    vocabulary: Vocabulary,
    out: str = "ids",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Token arrays to id arrays, as `key` and `out`; `key` must be unique.

    A vocabulary of up to `max_bytes` is sent to the tasks and looked up there
    in Arrow batches, without a shuffle. A larger one is joined token by token;
    the regrouping then combines inside each task first, so what is shuffled is
    one array per row.
    """
    if table_bytes(vocabulary.table) <= max_bytes:
        return df.select(*key, _encoder(vocabulary)(tokens).alias(out))
    long = df.select(*key, tokens.isNull().alias("_none"), F.posexplode_outer(tokens).alias("_pos", "_token"))
    coded = token_ids(long, "_token", vocabulary, "_id")
    placed = F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_id"))
    grouped = coded.groupBy(*key).agg(F.array_sort(F.collect_list(placed)).alias("_s"), F.max("_none").alias("_none"))
    return grouped.select(*key, F.when(~F.col("_none"), F.col("_s")["_id"]).alias(out))


def decode(
    df: DataFrame,
    key: Sequence[str],
    ids: Column,
    vocabulary: Vocabulary,
    separator: str = " ",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Id arrays to text; ids outside the vocabulary become the unknown marker.

    Works in the same two ways as `encode`.
    """
    if table_bytes(vocabulary.table) <= max_bytes:
        return df.select(*key, F.array_join(_decoder(vocabulary)(ids), separator).alias("text"))
    long = df.select(*key, ids.isNull().alias("_none"), F.posexplode_outer(ids).alias("_pos", "_entry"))
    names = vocabulary.table.select(F.col("id").alias("_entry"), F.col("token").alias("_token"))
    named = lookup(long, names, ["_entry"], "left", max_bytes)
    token = F.coalesce("_token", F.lit(text.UNKNOWN_MARKER))
    placed = F.when(F.col("_pos").isNotNull(), F.struct(F.col("_pos"), token.alias("token")))
    grouped = named.groupBy(*key).agg(F.array_sort(F.collect_list(placed)).alias("_s"), F.max("_none").alias("_none"))
    return grouped.select(*key, F.when(~F.col("_none"), F.array_join(F.col("_s")["token"], separator)).alias("text"))
