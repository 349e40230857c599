"""The corpus operators against brute-force versions and planted cases; nulls, copies and empty tables."""

import base64
import hashlib
import random
import re
import textwrap
import time
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tokenloom.llm import bpe, decontamination, embedding_dedup, licenses, line_dedup, pii, simhash, toxicity, url_filter, warc
from tokenloom.llm.queries import ORACLES, QUERIES, RANKS, URL_RULES

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, key string, d string"  # with names that clash with inner ones
RUN = "Alpha beta gamma delta epsilon zeta eta. Theta iota kappa lambda mu nu xi, omicron pi rho sigma tau. Upsilon phi chi psi omega one two three. Four five six seven eight nine ten, eleven twelve thirteen fourteen fifteen. "


def frame(spark, texts):
    return spark.createDataFrame([(*row, "k", "d") for row in texts], DOC)


ODD = [(1, None), (2, ""), (None, "a b"), (4, "word " * 60_000), (5, "same text"), (5, "same text"), (5, "other"), (6, "\x00 é\n")]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    same, note = compare(spark, connect(FOLDER), QUERIES[name], ORACLES[name], FOLDER)
    assert same, note


def test_every_operator_takes_odd_and_empty_tables(spark):
    file = bpe.read_ranks(public_tokenizers.path(RANKS))
    items = spark.createDataFrame([(1, "same text"), (2, None), (3, "")], "item_id long, text string")
    model = toxicity.fit(["a bad word", "a good word"], [1, 0])
    operators = {
        "toxicity": lambda d: toxicity.score(d, model, with_spans=True),
        "decontamination": lambda d: decontamination.contamination(d, items),
        "pii": pii.find_spans,
        "licenses": licenses.scan,
        "lines": line_dedup.without_repeats,
        "bpe": lambda d: bpe.round_trip(d, file, public_tokenizers.PATTERN),
        "simhash": simhash.near_duplicates,
    }
    odd = frame(spark, ODD)
    for name, operator in operators.items():
        assert operator(odd).count() == len(ODD), name
        assert operator(odd.limit(0)).count() == 0, name


def test_toxic_words_are_scored_and_found(spark):
    rng = random.Random(3)
    plain = ["".join(rng.choice(["ka", "lo", "mi", "ne", "ru"]) for _ in range(3)) for _ in range(80)]
    make = lambda bad: " ".join(rng.choice(plain) for _ in range(40)) + (". " + " ".join([rng.choice(plain), "scum", rng.choice(plain)]) if bad else "")
    texts = [make(k % 4 == 0) for k in range(200)]
    model = toxicity.fit(texts, [int(k % 4 == 0) for k in range(200)])
    fresh = [make(k % 2 == 0) for k in range(40)]
    rows = toxicity.score(frame(spark, list(enumerate(fresh))), model, with_spans=True).collect()
    for row in rows:
        assert (row["score"] >= 0.5) == (row["doc_id"] % 2 == 0)
        found = {fresh[row["doc_id"]][s["start"] : s["end"]] for s in row["spans"]}
        assert found == ({"scum"} if row["doc_id"] % 2 == 0 else set())


def test_scores_of_a_column_equal_those_of_a_table(spark, monkeypatch):
    model = toxicity.fit(["a bad bad word", "a good word"] * 3, [1, 0] * 3)
    model.slope, model.offset, model.known = 0.3, 0.1, True
    monkeypatch.setattr(toxicity, "BATCH_TOKENS", 40)
    docs = frame(spark, [*ODD, *((k, f"a bad {k} word. good") for k in range(10, 40))])
    column = docs.select("doc_id", toxicity.scorer(model)(F.col("text")).alias("score"))
    assert sorted(map(str, column.collect())) == sorted(map(str, toxicity.score(docs, model).collect()))
    assert docs.limit(0).filter(toxicity.scorer(model)(F.col("text")) < 2).count() == 0


def test_the_tokenizer_forgets_at_the_end_of_a_task():
    coder = bpe.Tokenizer(bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["zyx wvu tsr"])], names=["key", "text"])
    run = bpe._encoded(coder, [batch])
    next(run)
    assert coder and coder.held
    assert list(run) == [] and not coder and not coder.older and coder.held == 0


def test_marginals_equal_all_paths():
    e, moves = np.array([0.3, -1.0, 2.0, 0.5]), np.array([[0.2, -0.4], [0.1, 0.9]])
    odds, expected = toxicity.chains(e, np.array([0]), moves, counts=True)
    weight, want, steps = 0.0, np.zeros(4), np.zeros((2, 2))
    for path in np.ndindex(2, 2, 2, 2):
        p = np.exp(sum(e[t] * path[t] for t in range(4)) + sum(moves[path[t], path[t + 1]] for t in range(3)))
        weight, want = weight + p, want + p * np.array(path)
        for t in range(3):
            steps[path[t], path[t + 1]] += p
    assert np.allclose(1 / (1 + np.exp(-odds)), want / weight) and np.allclose(expected, steps / weight)


def test_phrases_in_any_order_near(spark):
    docs = frame(spark, [(1, "red green blue"), (2, "blue x red y green"), (3, "red a b c d e f g blue green")])
    terms = spark.createDataFrame([("red",), ("green",), ("blue",)], "term string")
    index = decontamination.build_index(docs, "doc_id", "text", terms)
    phrases = spark.createDataFrame([("p", ["red", "green", "blue"])], "window_id string, terms array<string>")
    assert {r["id"] for r in decontamination.phrase_matches(index, phrases).collect()} == {1}
    assert {r["id"] for r in decontamination.proximity_matches(index, phrases, 4).collect()} == {1, 2}


def brute_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab1259.@-+ ()é%") for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["a@b.c%d@e.f@g.h", "1.2.3.4.5.6.7.8.300", "4111 1111-1111 1111 22", "+1 (459) 555-9246x", "0" * 4000 + ".1.2.3"]
    for text in texts:
        assert [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS] == brute_spans(text), text


def test_checksums_and_context_decide_added_spans():
    kinds = lambda t: [s[0] for s in pii.spans_of(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 is") == ["iban"] and kinds("IBAN DE88 3704 0044 0532 0130 00") == []
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == [] and kinds("call 415-555-0199") == ["local_phone"]


def test_licence_rules_want_their_order(spark):
    s = licenses.SENTENCES
    mit = f"{s[2]}.\n\nown words. {s[3]}. {s[4]}."
    rows = frame(spark, [(1, mit), (2, f"{s[4]}. {s[3]}. {s[2]}."), (3, f"x.\n{s[30].upper()}:\n{s[31]}. {s[32]}. {s[33]}."), (4, None)])
    found = {r["doc_id"]: r["licenses"] for r in licenses.scan(rows).collect()}
    assert found == {1: ["MIT"], 2: [], 3: ["BSD-3-Clause"], 4: []}


def test_licences_broken_over_lines(spark):
    def broken(ids, width, sign=""):
        paragraphs = ["\n".join(textwrap.wrap(f"{licenses.SENTENCES[i]}.", width, break_long_words=False, break_on_hyphens=False)) for i in ids]
        return "".join(f"{sign}{line}".rstrip() + "\n" for line in "\n\n".join(paragraphs).split("\n"))

    prose = "This is no licence\nReleased under the MIT License\nand more.\n"
    texts = [broken([2, 3, 4], 72), broken([30, 31, 32, 33], 40, " * "), "Copyright 2020 A\n" + broken([21, 22, 24], 72, "# "), broken([11, 12, 13], 30, "// "), broken([2, 3, 4], 72).replace("\n", "\r\n")]
    texts += [prose, "x\n" + broken([4, 3, 2], 72), broken([2], 72).replace("\n", "\n\n") + broken([3, 4], 72), "not " + broken([2, 3, 4], 72)]
    rows = frame(spark, list(enumerate(texts)))
    found = {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in licenses.scan(rows).collect()}
    want = [([2, 3, 4], ["MIT"]), ([30, 31, 32, 33], ["BSD-3-Clause"]), ([21, 22, 24], ["GPL-3.0-or-later"]), ([11, 12, 13], ["Apache-2.0"]), ([2, 3, 4], ["MIT"])]
    want += [([1], ["MIT"]), ([4, 3, 2], []), ([3, 4], []), ([3, 4], [])]
    assert found == dict(enumerate(want))


LONG_RUNS = ["7" * 1_000_000, "." * 1_000_000, " " * 1_000_000, "@" * 1_000_000, "+" * 1_000_000, "+1" + "(" * 1_000_000, "1." * 500_000, "1 " * 500_000, "\n" * 1_000_000 + "x", "\n" + " " * 1_000_000 + "x"]


def test_long_runs_are_read_once(spark):
    for text in [*LONG_RUNS, "a@b.co 212-555-0199 tel 212-555-0188 " * 30_000]:
        begun = time.process_time()
        pii.spans_of(text)
        assert time.process_time() - begun < 10, text[:40]
    assert pii.spans_of("7" * 100_000 + ".1.2.3") == [] and pii.spans_of("x1.2.3.4" + "7" * 100_000) == []
    begun = time.monotonic()
    rows = licenses.scan(frame(spark, list(enumerate(LONG_RUNS)))).collect()
    assert len(rows) == len(LONG_RUNS) and not any(r["licenses"] for r in rows)
    repeated = "".join(f"{licenses.SENTENCES[i]}.\n" for i in (30, 31, 32)) * 2_000  # no end of the longest rule
    (row,) = licenses.scan(frame(spark, [(1, repeated)])).collect()
    assert row["licenses"] == ["BSD-2-Clause"] and len(row["sentence_ids"]) == 6_000
    assert time.monotonic() - begun < 90


def test_sentence_ends_equal_the_plain_patterns(spark):
    """The plain forms, of quadratic time on long runs, cut the same way."""
    rng = random.Random(11)
    texts = ["".join(rng.choice(".!?;:  \n\r\tab") for _ in range(rng.randrange(40))) for _ in range(3000)]
    pairs = [
        (licenses.SENTENCE_END, r"[.!?;:]*\s*\n\s*|[.!?;:]+\s+|[.!?;:]+\z"),
        (licenses.HARD_END, r"[.!?;:]+\s+|[.!?;:]+\z|\n\s*\n\s*"),
    ]
    rows = frame(spark, list(enumerate(texts)))
    for quick, plain in pairs:
        assert rows.filter(F.regexp_replace("text", quick, "#") != F.regexp_replace("text", plain, "#")).count() == 0


def test_rules_in_order_equal_brute_force():
    rng = random.Random(12)
    for _ in range(3000):
        path, order = [rng.randrange(1, 14) for _ in range(rng.randrange(12))], [rng.randrange(1, 14) for _ in range(rng.randrange(1, 4))]
        rest = iter(path)
        held = all(i in rest for i in order)
        assert bool(re.search(licenses.in_order(order), "," + "".join(f"{i}," for i in path))) == held


def test_redacted_texts(spark):
    rows = frame(spark, [(1, "Write to a.b@c.de or +1 212 555 0199."), (2, None), (3, ""), (3, ""), (None, "none")])
    found = sorted((str(r["doc_id"]), r["text"]) for r in pii.redacted(rows).collect())
    assert found == sorted([("1", "Write to <email> or <phone>."), ("2", None), ("3", ""), ("3", ""), ("None", "none")], key=lambda x: x[0])


def test_later_runs_go_and_all_else_stays(spark):
    rows = [(1, "Own start here. " + RUN + "\nEnd of one."), (2, "Set into a line and " + RUN + "tail of two."), (3, "clean, short. text, of three.\n"), (4, "x\x00y. " + RUN + "\n\n")]
    found = {r["doc_id"]: r for r in line_dedup.without_repeats(frame(spark, rows)).collect()}
    assert found[1]["text"] == rows[0][1] and found[3]["text"] == rows[2][1] and found[1]["d"] == "d"
    assert found[2]["text"] == "Set into a line and Alpha beta gamma delta epsilon zeta eta. tail of two."
    assert found[4]["text"].startswith("x\x00y. ") and "Upsilon" not in found[4]["text"]


def test_runs_equal_brute_force(spark):
    rng = random.Random(11)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(60)) + "\n" for _ in range(30)]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(frame(spark, list(enumerate(texts)))).collect()}
    lines = [t.split("\n")[:-1] for t in texts]
    grams = lambda x: [(x[i], x[i + 1]) for i in range(len(x) - 1)]
    first = {}
    for d, x in enumerate(lines):
        for i, g in enumerate(grams(x)):
            first.setdefault(g, (d, i))
    for d, x in enumerate(lines):
        gone = set()
        for i, g in enumerate(grams(x)):
            e, j = first[g]
            if (e, j) != (d, i):  # a run of three lines or more has at least min_bytes
                a, b = i, i + 1
                while a and j - (i - a) > 0 and x[a - 1] == lines[e][j - (i - a) - 1]:
                    a -= 1
                while b + 1 < len(x) and j + b + 1 - i < len(lines[e]) and x[b + 1] == lines[e][j + b + 1 - i]:
                    b += 1
                if (b - a + 1) * 60 >= line_dedup.MIN_BYTES:
                    gone |= set(range(a, b + 1))
        want = "".join(f"{s}\n" for k, s in enumerate(x) if k not in gone)
        assert len(got[d]) >= len(want)  # nothing goes but what repeats the first place of a gram
        if all(len(list(run)) >= 4 for hit, run in groupby(k in gone for k in range(len(x))) if hit):
            assert got[d] == want  # windows of three grams see every run of four lines
    whole = {line for x in lines for line in x}
    assert {s for t in got.values() for s in t.split("\n")[:-1]} == whole  # nothing is lost everywhere


def test_runs_of_short_lines_go(spark):
    words = "".join(f"word{k}\n" for k in range(32))
    commas = ", ".join(f"item{k}" for k in range(40)) + ". "
    rows = [(1, "Own start.\n" + words * 3 + "End of one.\n"), (2, "Here: " + commas + "End of two.\n"), (3, "There are " + commas + "And three.\n")]
    found = {r["doc_id"]: (r["text"], r["__deleted"]) for r in line_dedup.without_repeats(frame(spark, rows)).collect()}
    assert found[1] == ("Own start.\n" + words + "End of one.\n", 64)
    assert found[2][1] == 0 and found[3] == ("There are item0, And three.\n", 39)


def test_a_stray_earlier_fragment_hides_no_repeat(spark):
    a, b, c, d = ("".join(x * 45) + "\n" for x in "abcd")
    rows = [(1, f"{a}{b}"[:-1]), (2, f"{c}{d}"[:-1]), (3, f"{b}{c}"[:-1])]  # every pair of lines, and nothing else
    rows += [(4, f"four\n{a}{b}{c}{d}end four\n"), (5, f"five\n{a}{b}{c}{d}end five\n")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(frame(spark, rows)).collect()}
    assert [got[i] for i in (1, 2, 3, 4)] == [t for _, t in rows[:4]] and got[5] == "five\nend five\n"


def test_all_repeated_runs_equal_brute_force(spark):
    rng = random.Random(12)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 8, 40, 70, 90, 120, 149, 150]))) + "\n" for _ in range(60)]
    texts = []
    for _ in range(120):
        own = lambda: "".join(rng.choice("xyz") for _ in range(30)) + "\n"
        old = rng.choice(texts).split("\n")[:-1] if texts else [""]
        at = rng.randrange(len(old))
        runs = [f"{x}\n" for x in old[at : at + rng.randrange(1, 5)]] + [own()] + rng.choices(pool, k=rng.randrange(1, 6))
        texts.append("".join(([own()] if rng.random() < 0.8 else []) + runs * rng.choice([1, 1, 1, 3])))
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(frame(spark, list(enumerate(texts)))).collect()}
    seen, want = set(), {}
    for k, text in enumerate(texts):
        x, gone = text.split("\n"), set()
        for i in range(len(x)):
            for j in range(i + 1, len(x) + 1):
                if sum(map(len, x[i:j])) >= line_dedup.MIN_BYTES:
                    if tuple(x[i:j]) in seen:
                        gone |= set(range(i, j))
                    seen.add(tuple(x[i:j]))
        want[k] = "".join(f"{s}\n" for i, s in enumerate(x[:-1]) if i not in gone)
    assert got == want and sum(map(len, want.values())) < 0.9 * sum(map(len, texts))


def test_archives_hold_every_payload(spark, tmp_path):
    magic = "WARC/1.1\r\n"
    pages = [(1, "http://a/", "x" * 5000), (2, "http://b/\r\nX: 1", "x" * 5000), (3, None, None), (4, "u", ""), (5, "u", magic + "a\r\n\r\n" + magic * 3), (6, "u", "é" * 900), (6, "u", "é" * 900)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    chunks = warc.chunk_table(rows, "page_id", "url", "html", chunk=700)
    path = f"{tmp_path}/a"
    warc.write_archives(chunks.cache(), path)
    got = sorted((int(r["key"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.verified(warc.read_chunks(spark, path)).collect())
    firsts, want = {}, []
    for page, _, html in pages:
        body = (html or "").encode()
        first = firsts.setdefault(body, page)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((page, len(body), digest, *(("response", None) if first == page else ("revisit", str(first)))))
    assert got == want
    data = warc.read_chunks(spark, path).filter("key = '5'").orderBy("chunk_no").collect()
    assert b"".join(r["data"] for r in data).decode() == pages[4][2]


def test_running_digests_follow_the_payload(spark):
    rows = spark.createDataFrame([(1, "u", "abc" * 1000)], "page_id long, url string, html string")
    last = warc.chunk_table(rows, "page_id", "url", "html", chunk=100).orderBy(F.desc("chunk_no")).first()
    assert last["running"] == last["digest"] and last["chunks"] == 30


def brute_components(n, linked):
    label = list(range(n))
    for _ in range(n):
        for i, j in linked:
            label[i] = label[j] = min(label[i], label[j])
    return label


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 32))
    v = np.concatenate([base, base[:20] + 0.15 * rng.standard_normal((20, 32)), base[:10] * 3, base[5:6].repeat(30, 0)])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(900, None), (901, [0.0] * 32), (902, [float("nan")] + [1.0] * 31), (903, []), (904, [1.0, 2.0])]
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = (u @ u.T >= 0.95) & ~np.eye(len(v), dtype=bool)
    label = brute_components(len(v), np.argwhere(near).tolist())
    for i in range(len(v)):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (near[i].sum(), label[i], label[i] == i)
    assert all(found[i]["n_links"] == 0 and found[i]["component_id"] == i for i, _ in odd)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    u = embedding_dedup.unit(rng.standard_normal((300, 64)))
    rotated, signs, factor = embedding_dedup.codes(u)
    guess, spread = embedding_dedup.estimates(signs, factor, rotated)
    off = guess - u @ u.T
    assert abs(off.mean()) < 0.01 and (np.abs(off) <= spread[:, None]).mean() > 0.999


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter("hash(key) % 7 = 0")
    cascade = url_filter.build_cascade(listed, keys)
    got = keys.filter(cascade.holds(F.col("key")))
    assert got.exceptAll(listed).count() == 0 and listed.exceptAll(got).count() == 0 and len(cascade.levels) > 1


def test_odd_urls(spark):
    urls = ["HTTP://A.Example.NET/en/x?y", "http://net", "http://net/", "ftp://x.org/fr/#a", "no scheme", None, "", "http://b.example.com/de/", "http://botnet/x"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(rows, URL_RULES).orderBy("page_id").collect()]
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[1] == ("net", "", None, "allow")
    assert got[2] == ("net", "/", "net/", "block") and got[3][2:] == ("org/fr/", "allow") and got[7][3] == "block"
    assert got[4] == got[5] == got[6] == ("", "", None, "allow") and got[8][2] is None


def scanned(piece, ranks):
    """The merges of a pre-token by looking through all pairs each time."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while known := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
        at = min(known)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


def test_queue_takes_merges_that_lower_the_rank():
    """A merge may make a pair of a lower rank than its own; random ranks have many such, and many stale entries."""
    rng = random.Random(4)
    for _ in range(200):
        tokens = {bytes([c]) for c in b"abc"} | {bytes(rng.choices(b"abc", k=rng.randrange(2, 6))) for _ in range(40)}
        order = sorted(tokens)
        rng.shuffle(order)
        ranks = {token: rank * 97 for rank, token in enumerate(order)}
        queue = bpe.RankQueue(ranks)
        for size in (0, 1, 2, 7, 60):
            piece = bytes(rng.choices(b"abc", k=size))
            assert queue.merge(piece) == scanned(piece, ranks)


def test_ids_equal_the_library(spark):
    file = bpe.read_ranks(public_tokenizers.path(RANKS))
    coder = bpe.Tokenizer(file, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["", "a" * 3000, "ab" * 2000, "  \n\n x's", "<|endoftext|>", "".join(chr(rng.randrange(32, 0x3000)) for _ in range(3000))]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(300))) for _ in range(50)]
    for text in texts:
        ids = np.frombuffer(coder.encode(text), "<i4").tolist()
        assert ids == library.encode_ordinary(text) and coder.decode(ids) == text.encode()
        piece = text.encode()[:400]
        assert coder.queue.merge(piece) == scanned(piece, coder.ranks)
    assert not coder.queue.waiting and not any(coder.queue.bits)
    rows = bpe.decode(bpe.encode(frame(spark, list(enumerate(texts))), file, public_tokenizers.PATTERN), file, public_tokenizers.PATTERN)
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in rows.collect()} == dict(enumerate(texts))


def brute_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints_and_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 50)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(9000 + k, t) for k, t in enumerate(["", " \t", "É a", "one two three four", docs[3][1], docs[3][1] + " x"])]
    found = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, docs)).collect()}
    prints = [brute_fingerprint(t) for _, t in docs]
    linked = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    label = brute_components(len(docs), linked)
    for i, (key, _) in enumerate(docs):
        assert found[key]["fp"] % (1 << 64) == prints[i] and found[key]["component"] == docs[label[i]][0]


@pytest.mark.parametrize("rows", [300, 1 << 22, 1 << 34])
def test_tries_find_every_close_pair(rows):
    rng = np.random.default_rng(rows)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    bits = np.unique(np.array([b ^ np.uint64(sum(1 << int(k) for k in set(rng.integers(0, 64, rng.integers(0, 5))))) for b in base for _ in range(4)]))
    want = {(i, j) for i in range(len(bits)) for j in range(i + 1, len(bits)) if (int(bits[i]) ^ int(bits[j])).bit_count() <= 4}
    got = {p for i, j in simhash.trie_links(np.zeros(len(bits), dtype=int), bits, 4) for p in zip(i.tolist(), j.tolist(), strict=True)}
    assert got == want
    orders, lead = simhash._tables(rows, 4)  # in some order the leading blocks of each close pair agree
    for i, j in want:
        differ = int(bits[i]) ^ int(bits[j])
        assert any(all(not differ >> s & ((1 << w) - 1) for s, w in order[:lead]) for order in orders)


def test_near_copies_are_told_by_id_and_text(spark):
    import corpus_pipeline

    rng = random.Random(8)
    one, two, three = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(3))
    rows = [(1, one), (2, two), (2, one), (2, three), (2, three), (None, one), (3, two)]
    kept = corpus_pipeline.one_of_each(spark, frame(spark, rows), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(1, one), (2, two), (2, three), (0, one)])


def test_pipeline_on_planted_documents(spark, tmp_path):
    import corpus_pipeline

    for name in ("benchmark", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    item = spark.read.parquet(f"{tmp_path}/benchmark.parquet").orderBy("item_id").first()["text"]
    more = [(90_001, "clean start. " + RUN), (90_002, "copy of it. " + RUN), (90_003, "leak: " + item), (90_004, ""), (90_005, None)]
    extra = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in more], docs.schema)
    docs.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {90_001, 90_002} <= kept and 90_003 not in kept and (90_004 in kept) != (90_005 in kept)
    assert 700 < len(kept) < 900


def test_a_queue_of_many_pretokens_and_lists_decoded_together():
    """Pre-tokens in one queue do not touch; ids of lists are decoded in one take, nulls and gaps in the ranks included."""
    rng = random.Random(9)
    tokens = {bytes([c]) for c in b"abc"} | {bytes(rng.choices(b"abc", k=rng.randrange(2, 5))) for _ in range(30)}
    order = sorted(tokens)
    rng.shuffle(order)
    for spacing in (1, 97):
        ranks = {token: rank * spacing for rank, token in enumerate(order)}
        queue = bpe.RankQueue(ranks)
        pieces = [bytes(rng.choices(b"abc", k=rng.randrange(9))) for _ in range(300)]
        packed = queue.merge_all(pieces)
        assert [np.frombuffer(p, "<i4").tolist() for p in packed] == [scanned(p, ranks) for p in pieces]
        assert not queue.waiting and not any(queue.bits) and queue.merge_all([]) == []
        file = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
        coder = bpe.Tokenizer(file, public_tokenizers.PATTERN)
        texts = [p.decode() for p in pieces]
        whole = [[ranks[p]] if p in ranks else scanned(p, ranks) for p in pieces]  # a pre-token that is a token is not merged
        assert [np.frombuffer(p, "<i4").tolist() for p in coder.encode_all(texts)] == whole
        lists = pa.array([scanned(pieces[0], ranks), None, [], *[scanned(p, ranks) for p in pieces]], pa.list_(pa.int32()))
        assert coder.decode_lists(lists).to_pylist() == [pieces[0], b"", b"", *pieces]
        assert coder.decode_lists(lists.slice(2, 9)).to_pylist() == [b"", *pieces[:8]]
        for wrong in ([-1], [None], [max(ranks.values()) + 1]):
            with pytest.raises(KeyError):
                coder.decode_lists(pa.array([wrong], pa.list_(pa.int32())))


def test_pre_tokens_of_many_texts_share_few_queues(monkeypatch):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"ba": 257, b" a": 258, b" ab": 259}
    file = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    coder, sizes = bpe.Tokenizer(file, r" ?\w+"), []
    merge_all = coder.queue.merge_all
    monkeypatch.setattr(coder.queue, "merge_all", lambda pieces: sizes.append(sum(map(len, pieces))) or merge_all(pieces))
    texts = ["".join(f" ab{i}ba{j}" for j in range(2_000)) for i in range(10)]
    assert sum(map(len, texts)) > 150_000
    packed = coder.encode_all(texts)
    assert max(sizes) < 20_000 and len(sizes) <= 20  # not one for every four thousand bytes
    assert [coder.decode(np.frombuffer(p, dtype=np.int32).tolist()) for p in packed] == [t.encode() for t in texts]
