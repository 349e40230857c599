"""Byte-level BPE: merges picked from a hierarchical bitmap of ranks; decoding by table."""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT = 64  # bytes; the ids of a longer pre-token are not remembered
CACHE_BYTES = 16 << 20  # of pre-tokens and ids in one generation, with 100 for each entry; a task remembers two
OUT_BYTES = 2 << 20
STEP = 100_000  # pre-tokens of a text handled at a time
TOGETHER = 256_000  # characters of texts whose pre-tokens are merged together, or one longer text
MERGED = 1 << 14  # bytes of pre-tokens that lie in one queue, or a single longer one
NO_RANK, GONE = -1, -2


class RankQueue:
    """Merges picked from buckets of waiting positions, one bucket a rank.

    Two levels of 256-bit words say which ranks have a bucket; the lowest set
    bit of the upper and then of the lower word is the next rank. Many
    pre-tokens lie in one queue, one behind the other, so a bucket is picked
    once for all of them. The queue is empty again behind every call.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        words = (max(ranks.values(), default=0) >> 8) + 1
        self.bits = [0] * words
        self.one = [1 << i for i in range(max(256, words))]
        self.waiting: dict[int, list[int]] = {}
        single = [bytes([i]) for i in range(256)]
        self.byte = np.array([ranks.get(a, NO_RANK) for a in single], dtype=np.int32)
        self.two = np.array([[ranks.get(a + b, NO_RANK) for b in single] for a in single], dtype=np.int32)

    def _fill(self, pair: np.ndarray) -> int:
        """Buckets of the pairs that all pre-tokens start with; the upper word."""
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        ranks, starts = np.unique(pair[at], return_index=True)
        places, top = at.tolist(), 0
        ends = [*starts[1:].tolist(), len(places)]
        for rank, start, end in zip(ranks.tolist(), starts.tolist(), ends):
            self.waiting[rank] = places[start:end]
            self.bits[rank >> 8] |= self.one[rank & 255]
            top |= self.one[rank >> 8]
        return top

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        return np.frombuffer(self.merge_all([piece])[0], dtype=np.int32).tolist()

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, as packed 32-bit integers: in each always the lowest rank, the leftmost of equals.

        Tokens are a linked list over the pieces, with a wall where one starts.
        An entry is stale once its position's pair has another rank, or none;
        it is skipped.
        """
        get, bits, one, waiting = self.ranks.get, self.bits, self.one, self.waiting
        whole = b"".join(pieces)
        n, starts = len(whole), np.cumsum([0, *map(len, pieces)])
        codes = np.frombuffer(whole, dtype=np.uint8)
        ids = self.byte[codes].tolist()
        first = np.full(n + 1, NO_RANK, dtype=np.int32)
        first[: max(n - 1, 0)] = self.two[codes[:-1], codes[1:]]
        first[starts[1:] - 1] = NO_RANK
        wall = np.zeros(n + 1, dtype=np.uint8)
        wall[starts] = 1
        wall, pair = wall.tobytes(), first.tolist()
        after, before = list(range(1, n + 2)), list(range(-1, n))
        top = self._fill(first)
        while top:
            word = (top & -top).bit_length() - 1
            mask = bits[word]
            low = mask & -mask
            rank = (word << 8) + low.bit_length() - 1
            bits[word] = mask = mask ^ low
            if not mask:
                top ^= one[word]
            bucket = waiting.pop(rank)
            bucket.sort(reverse=True)
            least = rank + 1
            while bucket:
                at = bucket.pop()
                if pair[at] != rank:
                    continue
                gone = after[at]
                end = after[at] = after[gone]
                before[end] = at
                ids[at], ids[gone], pair[gone] = rank, GONE, NO_RANK
                pair[at] = new = NO_RANK if wall[end] else get(whole[at : after[end]], NO_RANK)
                if new >= 0:
                    if new in waiting:
                        waiting[new].append(at)
                    else:
                        waiting[new] = [at]
                        bits[new >> 8] |= one[new & 255]
                        top |= one[new >> 8]
                    if new < least:
                        least = new
                if not wall[at]:
                    at = before[at]
                    pair[at] = new = get(whole[at:end], NO_RANK)
                    if new >= 0:
                        if new in waiting:
                            waiting[new].append(at)
                        else:
                            waiting[new] = [at]
                            bits[new >> 8] |= one[new & 255]
                            top |= one[new >> 8]
                        if new < least:
                            least = new
                if least <= rank and bucket:  # that one is next; what is left here waits on
                    waiting[rank] = bucket + waiting.get(rank, [])
                    bits[rank >> 8] |= one[rank & 255]
                    top |= one[rank >> 8]
                    break
        found = np.array(ids, dtype=np.int32)
        kept = found != GONE
        if (found == NO_RANK).any():
            raise KeyError("a byte without a rank")
        ends = np.concatenate([[0], np.cumsum(kept)])[starts] * 4
        packed, ends = found[kept].tobytes(), ends.tolist()
        return [packed[start:end] for start, end in zip(ends, ends[1:])]


class Tokenizer(dict):
    """Encodes and decodes with the ranks of a tiktoken file; remembers short pre-tokens as packed ids."""

    def __init__(self, file: bytes, pattern: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.fresh: dict[str, bytes] = {}  # merged for the texts at hand
        self.held = 0
        rows = [line.split() for line in file.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.queue = RankQueue(self.ranks)
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        known = sorted(self.bytes)
        self.known, self.tokens = pa.array(known, pa.int32()), pa.array([self.bytes[x] for x in known], pa.binary())
        self.pattern = regex.compile(pattern)

    def __missing__(self, token: str) -> bytes:
        packed = self.older.get(token) or self.fresh[token]
        if len(token) > KEPT:
            return packed
        self.held += len(token) + len(packed) + 100
        self[token] = packed
        return packed

    def forget(self) -> None:
        """Drop what is remembered: a Python worker outlives the task."""
        self.clear()
        self.older, self.fresh, self.held = {}, {}, 0

    def _merge(self, tokens: set[str]) -> None:
        """Put the ids of pre-tokens that are not remembered into `fresh`, MERGED bytes at a time."""
        names, pieces, size = [], [], 0
        for token in tokens:
            piece = token.encode()
            if (whole := self.ranks.get(piece)) is not None:
                self.fresh[token] = array("i", [whole]).tobytes()
                continue
            names.append(token)
            pieces.append(piece)
            size += len(piece)
            if size >= MERGED:
                self.fresh.update(zip(names, self.queue.merge_all(pieces)))
                names, pieces, size = [], [], 0
        if pieces:
            self.fresh.update(zip(names, self.queue.merge_all(pieces)))

    def _packed(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts given as their pre-tokens."""
        if self.held > CACHE_BYTES:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self._merge(set(chain.from_iterable(texts)).difference(self).difference(self.older))
        packed = [b"".join(map(self.__getitem__, tokens)) for tokens in texts]
        self.fresh = {}
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as packed 32-bit integers."""
        if len(text) < STEP:
            return self._packed([self.pattern.findall(text)])[0]
        found = (m.group() for m in self.pattern.finditer(text))
        parts = []
        while part := list(islice(found, STEP)):
            parts += self._packed([part])
        return b"".join(parts)

    def encode_all(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text; those of up to STEP characters are handled together.

        Nothing made here refers back to itself, so no search for such cycles
        among the many small lists is let in.
        """
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode_all(texts)
        finally:
            if collects:
                gc.enable()

    def _encode_all(self, texts: Iterable[str]) -> list[bytes]:
        packed, held, size = [], [], 0
        for text in texts:
            if len(text) < STEP:
                held.append(self.pattern.findall(text))
                size += len(text)
            if held and (size >= TOGETHER or len(text) >= STEP):
                packed += self._packed(held)
                held, size = [], 0
            if len(text) >= STEP:
                packed.append(self.encode(text))
        return packed + self._packed(held)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; null ids are none, and an id without a token raises."""
        flat = lists.flatten()
        dense = len(self.known) == max(self.bytes, default=-1) + 1
        at = flat if dense else pc.index_in(flat, value_set=self.known)
        if at.null_count or len(at) and not 0 <= pc.min(at).as_py() <= pc.max(at).as_py() < len(self.tokens):
            raise KeyError("an id without a token")
        taken = self.tokens.take(at)  # one behind the other, so only the places where texts end are new
        ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()])
        places = np.frombuffer(taken.buffers()[1], dtype=np.int32)[ends] if len(at) else np.zeros(len(ends), dtype=np.int32)
        return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(places), taken.buffers()[2]])


_READY: dict[tuple[int, str], Tokenizer] = {}


def _tokenizer(file: bytes, pattern: str) -> Tokenizer:
    name = (hash(file), pattern)
    if name not in _READY:
        _READY.clear()
        _READY[name] = Tokenizer(file, pattern)
    return _READY[name]


def read_ranks(path: str) -> bytes:
    """The rank file, read once on the driver and sent along with the tasks (about a megabyte)."""
    with open(path, "rb") as f:
        return f.read()


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold up to about OUT_BYTES each, at least one row a range."""
    start = held = 0
    for at, size in enumerate(sizes):
        if at > start and held + size > OUT_BYTES:
            yield start, at
            start, held = at, 0
        held += size
    if sizes:
        yield start, len(sizes)


def _encoded(coder: Tokenizer, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, ids of batches of key, text; batches are cut by size, so long texts do not pile up."""
    try:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for start, end in _slices(sizes):
                part = batch.slice(start, end - start)
                packed = coder.encode_all(x or "" for x in part.column(1).to_pylist())
                ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int32)
                flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["key", "ids"])
    finally:
        coder.forget()


def _decoded(coder: Tokenizer, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, ids, decoded of batches of key, ids."""
    for batch in batches:
        sizes = pc.fill_null(pc.multiply(pc.list_value_length(batch.column(1)), 8), 0).to_pylist()
        for start, end in _slices(sizes):
            part = batch.slice(start, end - start)
            yield pa.RecordBatch.from_arrays([*part.columns, coder.decode_lists(part.column(1))], names=["key", "ids", "decoded"])


def _kind(rows: DataFrame) -> str:
    return rows.schema["key"].dataType.simpleString()


def encode(docs: DataFrame, file: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (array of int): every whole text encoded, without special tokens; null counts as empty.

    One pass, no shuffle. The ranks go to the tasks with the function.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    coded = rows.mapInArrow(lambda batches: _encoded(_tokenizer(file, pattern), batches), f"key {_kind(rows)}, ids array<int>")
    return coded.withColumnRenamed("key", key)


def decode(coded: DataFrame, file: bytes, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, ids, decoded (binary) of every row; null ids are none, and an id without a token raises."""
    rows = coded.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    schema = f"key {_kind(rows)}, ids array<int>, decoded binary"
    done = rows.mapInArrow(lambda batches: _decoded(_tokenizer(file, pattern), batches), schema)
    return done.select(F.col("key").alias(key), F.col("ids").alias(ids), "decoded")


def round_trip(docs: DataFrame, file: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: what encoding and then decoding make of every row, in one pass."""

    def run(batches):
        coder = _tokenizer(file, pattern)
        return _decoded(coder, _encoded(coder, batches))

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    done = rows.mapInArrow(run, f"key {_kind(rows)}, ids array<int>, decoded binary")
    return done.select(
        F.col("key").alias(key),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
