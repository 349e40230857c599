"""Language by compression: the language whose zstandard raw-content dictionary makes a text smallest."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE = 1_000  # different texts of each language that its dictionary is taken from, at most
PIECE = 512  # code points of a text that go into a dictionary together
DICT_BYTES = 128 << 10  # of each dictionary, at most
MAX_LANGUAGES = 256  # more are an error: the dictionaries are broadcast
LEVEL = 6
BLOCK = 8192  # bytes compressed at a time, so that a long text's own past doesn't replace the dictionary
SHARPNESS = 0.35  # how much of a saved bit counts as evidence
NARROW = 0.01  # a margin below this share of the second smallest size is narrow
UNDECIDED = "und"


@dataclass
class Model:
    """Dictionaries by language, the commonest language first."""

    dictionaries: dict[str, bytes] = field(default_factory=dict)
    level: int = LEVEL


def fit(
    docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", sample: int = SAMPLE, dict_bytes: int = DICT_BYTES
) -> Model:
    """Dictionaries from the rows where `learn` is true and text and language are not null.

    Of each language up to `sample` different texts, those with the smallest
    hashes, are cut into pieces, and of these so many as `dict_bytes` holds,
    again by hash, make its dictionary. So at most `dict_bytes` (four times
    that if all letters are of four bytes, cut back here) a language come to
    the driver. Languages without a letter in any text are not learned.
    Copies count once. An empty table gives a model without languages.
    """
    rows = docs.filter(F.coalesce(learn, F.lit(False))).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    )
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("text").alias("texts"))
    sizes = counted.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: their dictionaries are too many to broadcast")
    if not sizes:
        return Model()
    # Twice the share that is wanted passes by hash, so that the ordered pick sees few rows.
    chance = F.pmod(F.xxhash64(F.lit(5), F.col("text")), F.lit(1 << 30)) / float(1 << 30)
    few = F.lit(False)
    for row in sizes:
        few = few | ((F.col("lang") == row["lang"]) & (chance < 2.5 * sample / row["texts"]))
    by_hash = W.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    picked = rows.filter(few).groupBy("lang", "text").agg(F.lit(1).alias("_one"))
    picked = picked.withColumn("_at", F.row_number().over(by_hash)).filter(F.col("_at") <= sample)
    pieces = picked.select("lang", F.explode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), 0)).alias("piece"))
    by_piece = W.partitionBy("lang").orderBy(F.xxhash64("piece"), "piece")
    pieces = pieces.withColumn("_at", F.row_number().over(by_piece)).filter(F.col("_at") <= max(1, dict_bytes // PIECE))
    found: dict[str, list[str]] = {row["lang"]: [] for row in sizes}
    for row in pieces.orderBy("lang", "_at").collect():
        found[row["lang"]].append(row["piece"])
    made = {name: " ".join(parts).lower().encode()[:dict_bytes] for name, parts in found.items()}
    return Model({name: data for name, data in made.items() if data})


def _compressors(model: Model) -> list[zstandard.ZstdCompressor]:
    out = []
    for data in model.dictionaries.values():
        shared = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=model.level)
        out.append(
            zstandard.ZstdCompressor(
                level=model.level, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False
            )
        )
    return out


def sizes(text: str, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Compressed bytes of the whole lower-cased text with each dictionary, block by block."""
    data = memoryview(text.lower().encode())
    out = np.zeros(len(compressors))
    for start in range(0, len(data), BLOCK):
        block = data[start : start + BLOCK]
        for k, compressor in enumerate(compressors):
            out[k] += len(compressor.compress(block))
    return out


def decide(counted: np.ndarray) -> tuple[int, float, float]:
    """The smallest (the first of equals), its probability with sizes as code lengths, and its margin."""
    best = int(counted.argmin())
    weight = np.exp2(-8 * SHARPNESS * (counted - counted[best]))
    second = np.partition(counted, 1)[1] if len(counted) > 1 else np.inf
    margin = 1.0 if not np.isfinite(second) else float((second - counted[best]) / second)
    return best, float(1 / weight.sum()), margin


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", narrow: float = NARROW) -> DataFrame:
    """key, lang_pred, score (0 to 1), margin, rejected: every whole text, one pass, no shuffle.

    `rejected` marks texts whose margin between the two smallest sizes is below
    `narrow`; `lang_pred` still names the smallest. Of equal sizes the language
    commoner in learning wins. Null texts, texts without a letter and, with an
    empty model, all texts are `und` with score 0, margin 0 and rejected.
    Repeated rows get a row each.
    """
    names = list(model.dictionaries)

    def run(batches):
        compressors = _compressors(model)
        for batch in batches:
            found = []
            for value, letters in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                if not letters or not names:
                    found.append((UNDECIDED, 0.0, 0.0))
                    continue
                best, score, margin = decide(sizes(value.as_py(), compressors))
                found.append((names[best], score, margin))
            langs, scores, margins = zip(*found, strict=True) if found else ((), (), ())
            margins = np.array(margins, dtype=float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins), pa.array(margins < narrow)],
                names=["key", "lang_pred", "score", "margin", "rejected"],
            )

    value = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("key"), value.alias("text"), F.coalesce(value.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, lang_pred string, score double, margin double, rejected boolean")
    return out.withColumnRenamed("key", key)
