"""Toxicity: a linear-chain conditional random field tags toxic words; marginals give document scores and offsets."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
STOPS = frozenset(".!?\n")
FEATURES = 1 << 20  # hashed features of a word
SAMPLE = 1500  # labelled rows of each class that the model is fitted on, at most
CLEAN_SENTENCES = 8_000  # sentences without a toxic word among them, at most
STEPS = 30
CACHE_ROWS = 200_000
BATCH_TOKENS = 1 << 20  # bytes of text, or places of chains, worked on at a time


def word_features(word: str) -> list[int]:
    """The word, its length and its beginning, hashed."""
    parts = ["w" + word, f"l{min(len(word), 12)}", "p" + word[:5]]
    return [zlib.crc32(p.encode()) % FEATURES for p in parts]


@dataclass
class Model:
    """Weights of the toxic tag against the clean one, moves between tags, and how scores are calibrated."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, dtype=np.float32))
    bias: float = -20.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 1.0
    offset: float = 0.0
    known: bool = False

    def emission(self, word: str) -> float:
        return float(self.bias + self.weights[word_features(word)].sum())


class _Emissions(dict):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        value = float("nan") if word in STOPS else self.model.emission(word)
        if len(self) >= CACHE_ROWS:
            self.clear()
        self[word] = value
        return value


def chains(emissions: np.ndarray, starts: np.ndarray, moves: np.ndarray, counts: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the toxic tag's marginal at each place, and (with `counts`) the expected moves (2 x 2).

    Chains begin at `starts` in the flat array. Forward and backward steps run
    over all chains of like length side by side, one position at a time. With
    two tags each step only needs the ratio of toxic to clean.
    """
    lengths = np.diff(np.append(starts, len(emissions)))
    odds, expected = np.zeros(len(emissions)), np.zeros((2, 2))
    grown, (m00, m01), (m10, m11) = np.exp(np.clip(emissions, -40, 40)), *np.exp(np.clip(moves, -20, 20))
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        # Chains of up to twice the length of the shortest, and not too many.
        limit = max(2 * lengths[order[at]], 8)
        upto = int(np.searchsorted(lengths[order], limit, side="right"))
        upto = min(upto, at + max(1, BATCH_TOKENS // int(lengths[order[upto - 1]])))
        pick, at = order[at:upto], upto
        n, steps = lengths[pick], int(lengths[pick[-1]])
        first = starts[pick]
        forward = np.empty((steps, len(pick)))
        ratio = grown[first]
        forward[0] = ratio
        for t in range(1, steps):
            # Chains are sorted by length: the ones that are still going on stand last.
            live = int(np.searchsorted(n, t, side="right"))
            r = ratio[live:]
            ratio[live:] = grown[first[live:] + t] * (m01 + r * m11) / (m00 + r * m10)
            forward[t, live:] = ratio[live:]
        back = np.ones(len(pick))
        for t in range(steps - 1, -1, -1):
            live = int(np.searchsorted(n, t, side="right"))
            place = first[live:] + t
            odds[place] = np.log(forward[t, live:] * back[live:])
            if t:
                x = grown[place] * back[live:]
                back[live:] = (m10 + m11 * x) / (m00 + m01 * x)
                if counts:
                    r = forward[t - 1, live:]
                    parts = np.stack([np.full(len(x), m00), m01 * x, r * m10, r * m11 * x])
                    expected += (parts / parts.sum(axis=0)).sum(axis=1).reshape(2, 2)
    return odds, expected


def _split(values: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without the stops: emissions, chain starts, and the document of each chain."""
    stop = np.isnan(values)
    chain = np.cumsum(np.concatenate([[True], stop[:-1] | (docs[1:] != docs[:-1])])) if len(values) else np.zeros(0, dtype=int)
    e, chain, docs = values[~stop], chain[~stop], docs[~stop]
    starts = np.flatnonzero(np.concatenate([[True], chain[1:] != chain[:-1]])) if len(e) else np.zeros(0, dtype=int)
    return e, starts, docs[starts] if len(e) else np.zeros(0, dtype=int)


def log_odds(texts: list[str], model: Model, cache: _Emissions) -> np.ndarray:
    """Of each text: the log odds of the marginal of its most toxic word; -30 without words."""
    values = [np.array(list(map(cache.__getitem__, TOKEN.findall(t.lower()))), dtype=np.float64) for t in texts]
    sizes = [len(v) for v in values]
    e, starts, of = _split(np.concatenate([np.zeros(0), *values]), np.repeat(np.arange(len(texts)), sizes))
    out = np.full(len(texts), -30.0)
    if len(e):
        odds, _ = chains(e, starts, model.moves)
        np.maximum.at(out, of, np.clip(np.maximum.reduceat(odds, starts), -30, 30))
    return out


def spans(text: str, model: Model, cache: _Emissions, above: float = 0.5) -> list[tuple[int, int, float]]:
    """(start, end, marginal) of the words that are toxic rather than not; code points of the text, end exclusive."""
    found = list(TOKEN.finditer(text.lower() if len(text.lower()) == len(text) else text))
    values = np.array([cache[m.group().lower()] for m in found], dtype=np.float64)
    e, starts, _ = _split(values, np.zeros(len(values), dtype=int))
    if not len(e):
        return []
    marginal = 1 / (1 + np.exp(-chains(e, starts, model.moves)[0]))
    words = [m for m, v in zip(found, values, strict=True) if v == v]
    return [(m.start(), m.end(), round(float(p), 6)) for m, p in zip(words, marginal, strict=True) if p >= above]


def fit(texts: list[str], toxic: list[int], steps: int = STEPS) -> Model:
    """Fit on labelled texts. The tags of words come from the labels of documents.

    A word that toxic texts hold far more often than clean ones, and between
    enough different neighbours (in copies they are the same), is tagged toxic
    in toxic texts; all else is clean. The field is
    fitted to these tags by its exact gradient, and its scores are then
    calibrated on the labels. Without both classes every score is 0.
    """
    model, y = Model(), np.array(toxic)
    if not len(texts) or y.min() == y.max():
        return model
    model.known = True
    names: dict[str, int] = {}
    ids = [np.array([names.setdefault(w, len(names)) for w in TOKEN.findall(t.lower())], dtype=np.int32) for t in texts]
    stop = np.array([w in STOPS for w in names], dtype=bool)
    if stop.all():
        return model
    seen = np.zeros((2, len(names)))
    for row, label in zip(ids, y, strict=True):
        seen[label, np.unique(row)] += 1
    toxic_rows = [row.astype(np.int64) for row, label in zip(ids, y, strict=True) if label]
    pairs = np.unique(np.concatenate([row[:-1] * len(names) + row[1:] for row in toxic_rows if len(row)]))
    left, right = (np.bincount(side, minlength=len(names)) for side in np.divmod(pairs, len(names)))
    apart = np.minimum(left, right)
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    lift = np.log((seen[1] + 0.3) / (n1 + 0.6)) - np.log((seen[0] + 0.3) / (n0 + 0.6))
    marked = (lift >= 1.8) & (apart >= max(5, 0.015 * n1)) & (seen[1] / n1 >= 8 * seen[0] / n0) & ~stop

    flat = np.concatenate(ids)
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    keep = ~stop[flat]
    chain = np.cumsum(np.concatenate([[True], stop[flat][:-1] | (doc[1:] != doc[:-1])]))[keep]
    flat, doc = flat[keep], doc[keep]
    if not len(flat):
        return model
    tag = marked[flat] & (y[doc] == 1)
    hot = np.zeros(chain.max() + 1, dtype=bool)
    hot[chain[tag]] = True
    cold = np.unique(chain[~hot[chain]])
    used = hot.copy()
    used[cold[:: max(1, -(-len(cold) // CLEAN_SENTENCES))]] = True
    pick = used[chain]
    flat, chain, tag = flat[pick], chain[pick], tag[pick].astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], chain[1:] != chain[:-1]]))

    hashed = np.array([word_features(w) for w in names], dtype=np.int32)
    owner = np.repeat(np.arange(len(names)), hashed.shape[1])
    local, feature = np.unique(hashed.ravel(), return_inverse=True)
    w, bias, moves = np.zeros(len(local)), -3.0, np.zeros((2, 2))
    inner = np.ones(len(flat), dtype=bool)
    inner[starts] = False
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (tag[:-1][inner[1:]], tag[1:][inner[1:]]), 1)
    gold = np.bincount(flat, tag, len(names))
    theta, mean, square = np.concatenate([w, [bias], moves.ravel()]), 0.0, 0.0
    for step in range(1, steps + 1):
        w, bias, moves = theta[: len(local)], theta[len(local)], theta[len(local) + 1 :].reshape(2, 2)
        e = (bias + np.bincount(owner, w[feature], len(names)))[flat]
        odds, expected = chains(e, starts, moves, counts=True)
        marginal = 1 / (1 + np.exp(-odds))
        wrong = gold - np.bincount(flat, marginal, len(names))
        gradient = np.concatenate([np.bincount(feature, wrong[owner], len(local)) - 0.1 * w, [wrong.sum()], (seen_moves - expected).ravel() - moves.ravel()])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    model.weights[local] = theta[: len(local)]
    model.bias, model.moves = float(theta[len(local)]), theta[len(local) + 1 :].reshape(2, 2)
    cache = _Emissions(model)
    odds = np.concatenate([log_odds(texts[k : k + 100], model, cache) for k in range(0, len(texts), 100)])
    model.slope, model.offset = _calibrate(odds, y)
    return model


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the log odds, by Newton steps; both classes weigh the same."""
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    a = np.stack([x / 10, np.ones_like(x)])
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(b @ a, -30, 30)))
        h = (a * (weight * p * (1 - p))) @ a.T + 1e-3 * np.eye(2)
        b = b + np.linalg.solve(h, a @ (weight * (y - p)) - 1e-3 * b)
    return max(float(b[0]), 0.0) / 10, float(b[1])


def fit_on(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on up to `sample` labelled rows of each class, those with the smallest hashes of their key.

    Only these bounded rows come to the driver; whole texts, as they are.
    """
    rows = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).alias("y"))
    rows = rows.groupBy("k").agg(F.max("y").alias("y"))
    picked = [r for y in (0, 1) for r in rows.filter(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(sample).collect()]
    spark = docs.sparkSession
    few = spark.createDataFrame(picked, rows.schema)  # at most 2 * sample rows of two numbers
    found = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("text")).join(F.broadcast(few), "k").orderBy(F.xxhash64("k"), "text")
    found = found.limit(4 * sample).collect()
    return fit([r["text"] or "" for r in found], [int(r["y"]) for r in found])


def scorer(model: Model) -> Callable[[Column], Column]:
    """`score` as a function of a text column, for tables whose other columns need not leave the JVM."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = _Emissions(model)
        for batch in batches:
            yield pa.array(np.concatenate([np.zeros(0), *(_scores(part, model, cache) for _, part in _parts(batch))]))

    return lambda text: run(text.cast("string"))


def _parts(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Where each part begins, and its texts: about BATCH_TOKENS bytes, at least one text a part."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = 0
    while start < len(sizes):
        end, held = start, 0
        while end < len(sizes) and (end == start or held + sizes[end] <= BATCH_TOKENS):
            held += sizes[end]
            end += 1
        yield start, [x or "" for x in texts.slice(start, end - start).to_pylist()]
        start = end


def _scores(texts: list[str], model: Model, cache: _Emissions) -> np.ndarray:
    odds = log_odds(texts, model, cache)
    return 1 / (1 + np.exp(-np.clip(model.slope * odds + model.offset, -30, 30))) if model.known else np.zeros(len(texts))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", with_spans: bool = False) -> DataFrame:
    """key, score (0 to 1), and on demand spans (start, end, p): every whole text, one pass, no shuffle.

    Null and empty texts have no toxic word and get the lowest score.
    """

    def run(batches):
        cache = _Emissions(model)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            start = 0
            while start < len(sizes):
                end, held = start, 0
                while end < len(sizes) and (end == start or held + sizes[end] <= BATCH_TOKENS):
                    held += sizes[end]
                    end += 1
                part = [x or "" for x in batch.column(1).slice(start, end - start).to_pylist()]
                odds = log_odds(part, model, cache)
                p = 1 / (1 + np.exp(-np.clip(model.slope * odds + model.offset, -30, 30))) if model.known else np.zeros(len(part))
                columns = [batch.column(0).slice(start, end - start), pa.array(p)]
                names = ["key", "score"]
                if with_spans:
                    found = [
                        [dict(zip(("start", "end", "p"), s, strict=True)) for s in spans(t, model, cache)] if o > -3 else []
                        for t, o in zip(part, odds, strict=True)
                    ]
                    columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                start = end

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    extra = ", spans array<struct<start: int, end: int, p: double>>" if with_spans else ""
    return rows.mapInArrow(run, f"key {kind}, score double{extra}").withColumnRenamed("key", key)
