"""Texts split in Arrow pieces inside the tasks against the regular expression."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import text
from tokenloom.operators import vocabulary as V

SIGNS = ["a", "Z", "é", "ß", "中", "٣", "7", "½", "²", "\U0001d400", "\U0001f600", " ", "\t", "\n", "\r", "\x0b", "\x0c", "\xa0", " ", "́", "<", "|", "_", "\x00", "\U00031350", "⿿"]


def odd_texts():
    rng = random.Random(3)
    made = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(40))) for _ in range(200)]
    return [*made, *made[:50], None, "", " ", "ab", "cd", "1", "2", "plain words, 12 of them."]


def test_pieces_of_texts_have_the_tokens_of_the_pattern(spark):
    texts = odd_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    want = {r["k"]: r["w"] for r in rows.select("k", text.tokens(F.col("t")).alias("w")).collect()}
    whole = pa.array(["before", *texts]).slice(1)
    found, sizes = text.split_texts(whole, text.character_classes(spark))
    flat = found.to_pylist()
    at = 0
    for k, size in enumerate(sizes):
        assert flat[at : at + size] == (want[k] or []), texts[k]
        at += size
    assert at == len(flat)
    for odd in (pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        found, sizes = text.split_texts(odd, text.character_classes(spark))
        assert len(found) == 0 and list(sizes) == [0] * len(odd)


def test_bytes_that_are_no_text_are_replaced_as_by_the_pattern(spark):
    rows = spark.range(1).select(F.expr("cast(X'61C3FF6220E4B862C030EDA080F0908063' as string)").alias("t"))
    want = rows.select(text.tokens(F.col("t"))).first()[0]
    vocabulary = V.fit_text_vocabulary(rows, F.col("t"), size=30)
    assert sorted(r["token"] for r in vocabulary.table.filter("n > 0").collect()) == sorted(set(want))
    assert len(V.encode_texts(rows, [], F.col("t"), vocabulary).first()["ids"]) == len(want)


@pytest.mark.parametrize("limit, piece", [(1 << 20, 64), (1 << 20, 1 << 20), (0, 64)])
def test_texts_are_counted_and_coded_as_token_arrays_are(spark, monkeypatch, limit, piece):
    """Tasks are handed texts, never arrays of tokens, and no more of them at a time than a piece holds."""
    monkeypatch.setattr(V, "CODED_BYTES", piece)
    rows = spark.createDataFrame(list(enumerate(odd_texts())), "k long, t string").repartition(3)
    tokens = text.tokens(F.col("t"))
    one, other = V.fit_vocabulary(rows, tokens, size=24), V.fit_text_vocabulary(rows, F.col("t"), size=24)
    assert sorted(one.table.collect()) == sorted(other.table.collect())
    want = V.encode(rows, ["k"], tokens, one).collect()
    coded = V.encode_texts(rows, ["k"], F.col("t"), other, max_bytes=limit)
    assert sorted(coded.collect()) == sorted(want) and len(want) == len(odd_texts())
    if limit:
        assert "regexp_extract_all" not in coded._jdf.queryExecution().toString()
