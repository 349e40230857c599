"""The dealt queries, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from textwrap import dedent

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import bpe, collocations, decontamination, embedding_dedup, filter_audit, language, licenses, line_dedup, pii, simhash, toxicity, url_filter, warc
from tokenloom.session import materialize, scratch_path, ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_50k.tiktoken"
# The rules of the url query, as (action, host, path).
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(key: str = "doc_id"):
    """True for the fifth of the rows that no label is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.Model:
    labels = table(spark, folder, "labels").filter(~held_out())
    return toxicity.fit_on(table(spark, folder, "documents"), labels)


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(table(spark, folder, "documents"), toxicity_model(spark, folder))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


WORDS_SQL = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
LOWER_SQL = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op2_decontamination",
    f"""
    WITH d AS (SELECT doc_id, regexp_extract_all({LOWER_SQL.format('text')}, {WORDS_SQL}) AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all({LOWER_SQL.format('text')}, {WORDS_SQL}) AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS n
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM win),
    spot AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
    hit AS (SELECT spot.doc_id, spot.i, spot.n, win.item_id FROM spot JOIN win ON win.g = spot.g AND win.n = spot.n),
    covered AS (SELECT doc_id, count(*) AS n_hit FROM
                (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op3_pii")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents"))
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", name), ",").alias("spans"),
    )


def _known_sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({i}, {q(s)})" for i, s in licenses.SENTENCES.items())


def _rules_sql() -> str:
    return ", ".join(f"('{name}', '{',' + '(?:.*,)?'.join(f'{i},' for i in order)}')" for name, order in licenses.RULES)


def _sentences_sql(text: str) -> str:
    lowered = rf"lower(coalesce({text}, ''))"
    space = r"[ \t\n\x0b\f\r]"
    cut = rf"regexp_replace({lowered}, '[.!?;:]*{space}*\n{space}*|[.!?;:]+{space}+|[.!?;:]+$', chr(10), 'g')"
    return rf"string_split(regexp_replace({cut}, '[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), chr(10))"


@query(
    "op4_licenses",
    f"""
    WITH known AS (SELECT id, trim(unnest({_sentences_sql('raw')})) AS s FROM (VALUES {_known_sql()}) t(id, raw)),
    rules AS (SELECT * FROM (VALUES {_rules_sql()}) t(name, pattern)),
    parts AS (SELECT doc_id, {_sentences_sql('text')} AS s FROM documents),
    long AS (SELECT doc_id, trim(unnest(s)) AS s, generate_subscripts(s, 1) AS pos FROM parts),
    seq AS (SELECT doc_id, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY pos) AS ids
            FROM long JOIN known ON known.s = long.s AND known.s <> '' GROUP BY doc_id),
    found AS (SELECT DISTINCT doc_id, name FROM seq, rules WHERE regexp_matches(',' || ids || ',', pattern)),
    named AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS names FROM found f
              WHERE NOT (name = 'BSD-2-Clause' AND EXISTS (SELECT 1 FROM found g WHERE g.doc_id = f.doc_id AND g.name = 'BSD-3-Clause'))
              GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_known, coalesce(ids, '') AS sentence_ids, coalesce(names, '') AS licenses
    FROM documents d LEFT JOIN seq USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_known"),
        F.array_join(F.col("sentence_ids").cast("array<string>"), ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


@query("op5_line_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id",
        F.col("__deleted").alias("n_deleted"),
        F.char_length("text").cast("long").alias("n_chars_kept"),
        F.sha2("text", 256).alias("text_sha256"),
    )


BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"


@query(
    "op6_warc",
    f"""
    WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS h FROM pages),
    q AS (SELECT page_id, n, array_to_string(list_transform(range(32),
              lambda i: substr({BASE32}, (((('0x' || substr(h, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT) >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT + 1, 1)), '') AS digest
          FROM p)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN page_id = min(page_id) OVER (PARTITION BY digest, n) THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> min(page_id) OVER (PARTITION BY digest, n) THEN min(page_id) OVER (PARTITION BY digest, n) END AS refers_to
    FROM q
    """,
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    chunks = materialize(warc.chunk_table(pages, "page_id", "url", "html"), "warc_chunks")
    path = scratch_path(spark, "warc")
    warc.write_archives(chunks, path)
    read = warc.verified(warc.read_chunks(spark, path))
    return read.select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query(
    "op7_embedding_dedup",
    """
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
    least AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
    SELECT vec_id, (SELECT count(*) FROM link WHERE link.x = vec_id) AS n_links, c AS component_id, vec_id = c AS kept
    FROM v JOIN least ON least.x = vec_id
    """,
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query(
    "op8_url_filter",
    f"""
    WITH r AS (SELECT action, host, path FROM (VALUES {', '.join(str(r) for r in URL_RULES)}) t(action, host, path)),
    u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM u),
    p AS (SELECT page_id, {LOWER_SQL.format('raw')} AS host, regexp_extract(substr(coalesce(rest, ''), length(raw) + 1), '^[^?#]*') AS path FROM h),
    best AS (SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(action, length(r.host || r.path)) AS action
             FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY page_id)
    SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.action, 'allow') AS verdict FROM p LEFT JOIN best USING (page_id)
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)


@query("op9_byte_bpe")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    file = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.round_trip(table(spark, folder, "documents"), file, public_tokenizers.PATTERN)


@query("op10_simhash")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@query("op11_language_id")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fourth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = language.fit(docs, fourth != 2)
    found = language.predict(docs, model)
    return found.select("doc_id", F.coalesce(fourth == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "margin", "rejected")


AUDIT_WORDS_SQL = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"


@query(
    "op12_filter_audit",
    f"""
    WITH marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
                   FROM labels GROUP BY doc_id),
    d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, {AUDIT_WORDS_SQL} AS w FROM d),
    f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [len(w) < 200,
                 100 * len(list_distinct(w)) < 50 * len(w),
                 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(t),
                 regexp_matches(t, '[#$%&*|]'),
                 coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails
          FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id),
    kinds AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    perms AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    cases AS (SELECT *, list_transform(range(1, 6), lambda k: fails[strpos('ABCDE', o[k])]) AS by_step FROM kinds, perms),
    steps AS (SELECT *, list_position(by_step, true) AS first, len(list_filter(fails, lambda b: b)) AS n_fails,
                     unnest(range(1, 6)) AS step FROM cases),
    counted AS (SELECT part, o AS filter_order, step,
           sum(n) FILTER (first IS NULL OR first = 0 OR first > step) AS kept, sum(n) FILTER (first = step) AS removed,
           sum(n) FILTER (by_step[step] AND first < step) AS redundant, sum(n) FILTER (by_step[step] AND n_fails = 1) AS unique_fails,
           sum(n) FILTER (first = step AND good) AS good_lost, sum(n) FILTER (first = step AND toxic) AS toxic_lost
           FROM steps GROUP BY ALL)
    SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
           coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
           coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
           coalesce(sum(removed) OVER (PARTITION BY part, filter_order[step]), 0)::BIGINT AS shapley
    FROM counted
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.corpus_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op13_collocations",
    f"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL.format('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
    grams AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, count(*)::HUGEINT AS f FROM
              (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)
              GROUP BY ALL HAVING count(*) >= 100),
    c AS (SELECT lang, g, f, string_split(g, ' ') AS w FROM grams),
    cuts AS (SELECT lang, g, w, f, unnest(range(1, len(w))) AS k FROM c WHERE len(w) >= 2),
    scores AS (SELECT cuts.lang, cuts.g, cuts.f AS a, k, x.f AS l, y.f AS r, n, (1000 * cuts.f * n) // (x.f * y.f) AS score
               FROM cuts JOIN totals ON totals.lang = cuts.lang
               JOIN grams x ON x.lang = cuts.lang AND x.g = array_to_string(w[:k], ' ')
               JOIN grams y ON y.lang = cuts.lang AND y.g = array_to_string(w[k + 1:], ' ')),
    best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    inside AS (SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS g FROM
               (SELECT lang, w, f, m, unnest(range(1, len(w) - m + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE len(w) > m)),
    covered AS (SELECT lang, g, max(f) AS f FROM inside GROUP BY lang, g),
    ranked AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.g) AS rank, b.g AS phrase, a, l, r, n, score
               FROM best b LEFT JOIN covered v ON v.lang = b.lang AND v.g = b.g WHERE v.f IS NULL OR 100 * v.f < 100 * a)
    SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM ranked WHERE rank <= 2000
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
