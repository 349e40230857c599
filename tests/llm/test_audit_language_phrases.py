"""Language by compression, the filter audit and phrase collocations: brute force, held-out rows, odd rows, empty tables."""

import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import collocations, filter_audit, language
from tokenloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
# With names that clash with inner ones.
DOC = "doc_id long, text string, lang string, source string, key string, part string, mask string, n string, w1 string, words string, letters string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "k", "p", "m", "n", "w", "s", "l") for row in rows], DOC)


ODD = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (None, "a b, a b", "en", None),
    (4, "word " * 60_000, "en", ""),
    (5, "same text", "de", "b"),
    (5, "same text", "de", "b"),
    (5, "other", "de", "b"),
    (6, "\x00 é\n12 Ⅳ", None, None),
    (7, "1234 5678 ...", "en", "b"),
]


# --- language -------------------------------------------------------------


def test_held_out_languages_are_told(spark):
    got = QUERIES["op11_language_id"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", F.char_length("text").alias("size"))
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) and 0 <= row["score"] <= 1
    tested = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert len(tested) > 200 and sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.97 * len(tested)
    long = [r for r in tested if r["size"] > 200]
    assert sum(r["lang"] == r["lang_pred"] for r in long) >= 0.98 * len(long)


def test_nothing_is_learned_from_held_out_rows(spark):
    docs = frame(spark, [(k, "alpha beta gamma delta " * 5 if k % 2 else "uno dos tres cuatro " * 5, "x" if k % 2 else "y", "s") for k in range(40)])
    learn = F.col("doc_id") < 20
    wrong = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise("z"))
    model = language.fit(wrong, learn)
    assert set(model.dictionaries) == {"x", "y"} and language.fit(docs, learn).dictionaries == model.dictionaries
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()}
    assert found == {k: "x" if k % 2 else "y" for k in range(40)}


def test_language_of_odd_rows(spark):
    docs = frame(spark, ODD)
    model = language.fit(docs, F.lit(True))
    assert list(model.dictionaries) == ["de", "en"]  # the commoner first, and none from rows without letters
    rows = language.predict(docs, model).collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] != 5}
    assert all(by_id[k]["lang_pred"] == "und" and by_id[k]["score"] == 0 and by_id[k]["rejected"] for k in (1, 2, 7))
    assert by_id[6]["lang_pred"] in ("de", "en") and by_id[4]["lang_pred"] == "en"
    assert language.predict(docs.limit(0), model).count() == 0
    empty = language.fit(docs.limit(0), F.lit(True))
    assert empty.dictionaries == {} and {r["lang_pred"] for r in language.predict(docs, empty).collect()} == {"und"}


def test_whole_texts_are_compressed_and_ties_go_to_the_first():
    model = language.Model({"a": b"first words here " * 20, "b": b"quite other ones " * 20})
    compressors = language._compressors(model)
    text = "first words here " * 50 + "quite other ones " * 3000
    assert language.decide(language.sizes(text, compressors))[0] == 1
    assert language.decide(np.array([5.0, 5.0, 9.0]))[::2] == (0, 0.0)
    assert language.decide(np.array([7.0])) == (0, 1.0, 1.0)


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    docs = frame(spark, [(k, "some text", f"l{k}", "s") for k in range(5)])
    with pytest.raises(ValueError):
        language.fit(docs, F.lit(True))


# --- filter audit -----------------------------------------------------------


def test_carry_save_counts_equal_plain_ones():
    rng = np.random.default_rng(4)
    for sizes in ([], [0], [1], [2], [3], [5, 1, 700, 2], [4096]):
        counts, want = filter_audit.BitCounts(), np.zeros(32, dtype=int)
        for n in sizes:
            words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
            counts.add(words)
            want += ((words[:, None] >> np.arange(32, dtype=np.uint32)) & 1).sum(axis=0, dtype=int)
        assert (counts.counts() == want).all()
        assert all(len(level) < 3 for level in counts.levels)


def brute_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1} - {None}
    toxic = {d for d, _, t in labels if t == 1} - {None}
    first = {}
    for doc_id, text, _, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    rows = []
    for doc_id, text, _, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        rows.append((source or "", fails, doc_id in good, doc_id in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                here = [r for r in left if r[1][x]]
                redundant = sum(r[1][x] for r in gone)
                gone, left = gone + here, [r for r in left if not r[1][x]]
                alone = sum(r[1][x] and sum(r[1].values()) == 1 for r in gone + left)
                out[part, order, step] = [len(left), len(here), redundant, alone, sum(r[2] for r in here), sum(r[3] for r in here)]
        removed = Counter()
        for (p, order, step), v in out.items():
            if p == part:
                removed[order[step - 1]] += v[1]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(removed[order[step - 1]])
    return out


AUDIT = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["one", "Two", "III", "f#ur", "five", f"w{rng.randrange(99)}"]) for _ in range(rng.choice([3, 150, 260]))) for _ in range(40)]
    docs = [(k, rng.choice(texts), "en", rng.choice(["a", "b", None])) for k in range(150)] + ODD
    labels = [(k, rng.choice([0, 1]), rng.choice([0, 1])) for k in range(0, 150, 2)] + [(5, 0, 1), (5, 1, 0), (None, 1, 1), (4, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.corpus_audit(frame(spark, docs), table).collect()
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in AUDIT] for r in got} == brute_audit(docs, labels)
    assert len(got) == 3 * 600


def test_audit_of_empty_tables(spark):
    docs, labels = frame(spark, ODD), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.corpus_audit(docs.limit(0), labels).count() == 0
    rows = filter_audit.corpus_audit(docs, labels).collect()
    assert len(rows) == 3 * 600 and all(r["good_lost"] == 0 for r in rows)


def test_parts_beyond_what_a_task_holds(spark, monkeypatch):
    rows = spark.range(0, 900, 1, 1).select(F.concat(F.lit("p"), F.col("id") % 300).alias("part"), (F.col("id") % 2).alias("mask"))
    monkeypatch.setattr(filter_audit, "PARTS_HELD", 0)
    got = {(r["part"], r["subset"]): r["n"] for r in filter_audit.survivors(rows, "part", "mask", []).collect()}
    assert len(got) == 300 * 32 and got["p3", 0] == 3 and got["p3", 1] == 0 and got["p4", 1] == 3


# --- collocations -----------------------------------------------------------


def brute_phrases(docs, min_count, cover, top, max_words=5):
    out = []
    for lang in sorted({d[2] or "und" for d in docs}):
        counts, n = Counter(), 0
        for _, text, other, _ in docs:
            if (other or "und") != lang:
                continue
            lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for m in range(1, max_words + 1):
                    counts.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
        kept = {p: f for p, f in counts.items() if len(p) > 1 and f >= min_count}
        inner = Counter()
        for p, f in kept.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inner[p[i : i + m]] = max(inner[p[i : i + m]], f)
        rows = []
        for p, a in kept.items():
            if p in inner and 100 * inner[p] >= cover * a:
                continue
            score, _, left, right = min((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def phrase_docs():
    rng = random.Random(6)
    words = ["red", "Green", "blau", "é", "zz\x01", "zz", "long-er"]
    docs = [(k, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "\r"]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None]), "s") for k in range(200)]
    return docs + [(k, "to be or not to be then", "en", "s") for k in range(30)] + [(999, "solo " * 500 + "BIG OLD", "en", "s")] + ODD


@pytest.mark.parametrize(
    "cover, top, limits", [(100, 2000, {}), (70, 15, {"vocabulary_bytes": 0}), (70, 2000, {"pair_bytes": 0}), (100, 15, {"vocabulary_bytes": 0, "pair_bytes": 0})]
)
def test_phrases_equal_brute_force(spark, cover, top, limits):
    docs = phrase_docs()
    got = collocations.collocations(frame(spark, docs), min_count=20, cover=cover, top=top, **limits).collect()
    want = brute_phrases(docs, 20, cover, top)
    assert sorted(tuple(r) for r in got) == sorted(want) and len(want) > 30


def test_only_phrases_of_frequent_triples_are_counted():
    """Words 0 to 3 follow each other in many ways; 0 1 2 3 is all frequent, 3 0 1 2 has frequent pairs but a rare triple."""
    ids = np.array([0, 1, 2, 3, -1, 0, 1, 2, 3, 0, 1, -1, 3, 0, 1, 2, -1, 2, 3, 0, -1])
    pairs = np.array([0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 0])
    triples = np.array([0 * 4 + 2, 1 * 4 + 3])  # 0 1 2 and 1 2 3, by the place of their pair
    found = [(tuple(int(c[i]) for c in columns), int(n[i])) for columns, n in collocations.phrases_in(ids, 4, 3, 5, pairs, triples) for i in range(len(n))]
    assert found == [((0, 1, 2), 3), ((1, 2, 3), 2), ((0, 1, 2, 3), 2)]
    alone = [columns for columns, n in collocations.phrases_in(ids, 4, 4, 5, pairs, triples[:0]) if len(n)]
    assert alone == [] and not any(len(n) for _, n in collocations.phrases_in(ids[:0], 4, 4, 5, pairs, triples))


def test_tasks_hand_on_each_phrase_once_and_fives_only_of_frequent_fours(spark, monkeypatch):
    """0 1 2 3 4 has frequent triples, but 1 2 3 4 is no frequent four."""
    rows = [([0, 1, 2, 3, -1, 2, 3, 4, -1, 0, 1, 2, 3, 4, -1, 5, 6, 7, 8, 9, -1],)] * 6
    encoded = spark.createDataFrame(rows, "ids array<int>").coalesce(1)
    monkeypatch.setattr(collocations, "CHUNK", 16)  # some pieces a task
    met, real = [], collocations.phrase_counts

    def counted(*args):
        out = real(*args)
        met.append((len(out.columns) - 2, out.count()))
        return out

    monkeypatch.setattr(collocations, "phrase_counts", counted)
    got = {tuple(w for w in r[:5] if w >= 0): r["n"] for r in collocations.frequent_phrases(encoded, 10, 7, 5).collect()}
    assert got == {(0, 1): 12, (1, 2): 12, (2, 3): 18, (3, 4): 12, (0, 1, 2): 12, (1, 2, 3): 12, (2, 3, 4): 12, (0, 1, 2, 3): 12}
    assert met == [(2, 8), (3, 3), (4, 2), (5, 0)]  # fours and fives, three rows, in one go before
    parts = [([np.array([0, 2]), np.array([1, 3])], np.array([4, 1])), ([np.array([2, 2]), np.array([3, 9])], np.array([5, 6]))]
    columns, n = collocations.merged(parts, 10)
    assert [c.tolist() for c in columns] == [[0, 2, 2], [1, 3, 9]] and n.tolist() == [4, 6, 6]


def test_phrases_are_handed_on_as_arrays_and_put_together_by_part(spark, monkeypatch):
    """No row a phrase before it is counted to the end: with 8 parts, 3 tasks hand on 24 rows of each length at most."""
    monkeypatch.setattr(collocations, "PHRASES_HELD", 50_000)
    rng = np.random.default_rng(8)
    rows = [(rng.integers(0, 50, 400).tolist() + [-1],) for _ in range(60)]
    encoded = spark.createDataFrame(rows, "ids array<int>").repartition(3)
    want = {}
    for (ids,) in rows:
        for words in (2, 3, 4):
            for at in range(400 - words + 1):
                key = tuple(ids[at : at + words])
                want[key] = want.get(key, 0) + 1
    got = collocations.phrase_counts(encoded, 50, 2, 4)
    found = {tuple(w for w in r[:4] if w >= 0): (r["words"], r["n"]) for r in got.collect()}
    assert found == {p: (len(p), n) for p, n in want.items()} and len(found) > 20_000
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Aggregate" not in plan and plan.count("MapInArrow") == 2
    assert got.rdd.getNumPartitions() == 8
    monkeypatch.setattr(collocations, "PART_PLACES", 1000)  # 24,060 places
    assert collocations.phrase_counts(encoded, 50, 2, 2).rdd.getNumPartitions() == 25


def test_longest_phrases_go_on_from_the_place_of_their_listed_part():
    rng = np.random.default_rng(9)
    size, ids = 5, rng.integers(-1, 5, 4000)
    places, listed = {}, []
    for words in (2, 3, 4):
        seen = sorted({tuple(ids[i : i + words].tolist()) for i in range(len(ids) - words + 1) if (ids[i : i + words] >= 0).all()})
        kept = [p for p in seen if rng.random() < 0.8 and (words == 2 or {p[:-1], p[1:]} <= places[words - 1].keys())]
        listed.append(np.array([(p[0] if words == 2 else places[words - 1][p[:-1]]) * size + p[-1] for p in kept]))
        places[words] = {p: k for k, p in enumerate(kept)}
        want = {}
        for i in range(len(ids) - words):
            p = tuple(ids[i : i + words + 1].tolist())
            if p[:-1] in places[words] and p[1:] in places[words]:
                want[p] = want.get(p, 0) + 1
        ((columns, n),) = collocations.phrases_in(ids, size, words + 1, words + 1, *listed)
        assert {tuple(int(c[i]) for c in columns): int(n[i]) for i in range(len(n))} == want and want
    wide = 1 << 30  # codes of three words would not fit
    columns, n = collocations.merged([([np.array([wide - 1, 0])] * 3, np.array([1, 2])), ([np.array([wide - 1])] * 3, np.array([4]))], wide)
    assert [c.tolist() for c in columns] == [[0, wide - 1]] * 3 and n.tolist() == [2, 5]


def test_words_of_many_texts_are_split_as_those_of_each(monkeypatch):
    texts = ["Red blau, é\tzz\x01", "", "..", "solo", ", a b.c\n\nD ", "x" * 30 + " y", "to be\ror"]
    langs = ["en", "de", "en", "en", "de", "en", "de"]
    for step in (3, 1 << 20):
        monkeypatch.setattr(collocations, "STEP", step)
        for lang in ("en", "de"):
            want = []  # None where a phrase may not go on
            for one, text in zip(langs, texts):
                if one == lang:
                    want += [None if w == collocations.BREAK else w for part in collocations.pieces_of(text.encode()) for w in part] + [None]
            want = [w for i, w in enumerate(want) if w is not None or i and want[i - 1] is not None]
            got = []
            for one, words, broken in collocations.words_in(pa.array(langs), pa.array(texts)):
                if one == lang:
                    for word, cut in zip([*words.to_pylist(), None], broken):
                        got += [None] * bool(cut) + [word] * (word is not None)
            got = [w for i, w in enumerate(got) if w is not None or i and got[i - 1] is not None]
            assert got == want


def test_a_text_of_many_stretches_is_coded_without_a_break_between(monkeypatch):
    for name, value in (("STEP", 9), ("CHUNK", 4), ("ROW_IDS", 4)):
        monkeypatch.setattr(collocations, name, value)
    texts = ["a b c d a b, c d a b c d a rare b c d a", "d " * 40, "rare", "a b" * 5, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 5), pa.array(texts)], names=["lang", "text"])
    known = {"en": (pa.array([b"a", b"b", b"c", b"d"]), np.arange(4, dtype=np.int32))}
    rows = [r for b in collocations._coded([batch, batch], known) for r in b.column(0).to_pylist()]
    pieces = []
    for r in rows:
        assert r[-1] == -1  # no phrase goes on in the next row
        pieces += [p for p in "".join("abcd"[i] if i >= 0 else " " for i in r).split()]
    assert pieces == ["abcdab", "cdabcda", "bcda", "d" * 40, "a", "b", "d"] * 2


def test_parts_of_four_words_end_a_phrase():
    ids = np.array([0, 1, 2, 3, 4, 5, -1, 1, 2, 3, 4, -1])
    pairs = np.array([k * 6 + k + 1 for k in range(5)])
    triples = np.array([k * 6 + k + 2 for k in range(4)])
    fours = np.array([0 * 6 + 3, 1 * 6 + 4])  # 0 1 2 3 and 1 2 3 4, not 2 3 4 5
    found = [(tuple(int(c[i]) for c in columns), int(n[i])) for columns, n in collocations.phrases_in(ids, 6, 4, 6, pairs, triples, fours) for i in range(len(n))]
    assert found == [((0, 1, 2, 3), 1), ((1, 2, 3, 4), 2), ((0, 1, 2, 3, 4), 1)]


def test_stretches_of_a_text_are_joined_without_loss(spark, monkeypatch):
    docs = phrase_docs()
    for name, value in (("STEP", 7), ("CHUNK", 16), ("ROW_IDS", 4), ("WORDS_HELD", 3)):
        monkeypatch.setattr(collocations, name, value)
    got = collocations.collocations(frame(spark, docs), min_count=20, max_words=3, top=5).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_phrases(docs, 20, 100, 5, 3))


def test_scores_beyond_64_bits_are_exact(spark):
    big = 10**15 + 37
    phrases = spark.createDataFrame([(0, 1, -1, 2, big)], "w1 long, w2 long, w3 long, words int, n long")
    vocabulary = spark.createDataFrame([("en", "a", big + 1, 0), ("en", "b", big + 5, 1)], "lang string, word string, n long, id long")
    totals = spark.createDataFrame([("en", 9 * 10**15 + 1)], "lang string, total long")
    row = collocations.scored_phrases(phrases, vocabulary, totals, 3, 100).first()
    assert row["score"] == 1000 * big * (9 * 10**15 + 1) // ((big + 1) * (big + 5))


def test_no_phrases(spark):
    docs = frame(spark, ODD)
    for rows in (docs.limit(0), docs.filter("doc_id < 3"), docs):
        got = collocations.collocations(rows, min_count=100).collect()
        want = brute_phrases(ODD, 100, 100, 2000) if rows is docs else []
        assert sorted(tuple(r) for r in got) == sorted(want)
