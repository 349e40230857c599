"""Queries: batches, padding, packing, repetition and array work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import arrays, text
from tokenloom.operators import batching as B
from tokenloom.operators.packing import pack_sequences
from tokenloom.operators.vocabulary import decode, encode_texts, fit_text_vocabulary
from tokenloom.plans.preparation import PAIRS_SQL, _pairs
from tokenloom.plans.registry import DOC_IDS_SQL, PAD_ID, TOKENS_SQL, list_md5, query, r_sql, rounded, vector_marks, vector_marks_sql
from tokenloom.session import materialize
from tokenloom.sources.corpus import documents, table

BATCHED_SQL = "(SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // {n} AS batch_id FROM {source})"


def _doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", text.tokens(F.col("text")).alias("t"))


def _doc_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs, words = documents(spark, sf), F.col("text")
    return encode_texts(docs, ["doc_id"], words, fit_text_vocabulary(docs, words))


@query(
    "document_ids",
    f"""
    WITH {DOC_IDS_SQL}
    SELECT doc_id, len(ids) AS n_ids, len(list_filter(ids, lambda x: x = 100275)) AS n_unknown, {list_md5('ids')} AS ids_md5
    FROM ids
    """,
)
def document_ids(spark: SparkSession, sf: str) -> DataFrame:
    unknown = F.filter("ids", lambda x: x == 100_275)
    return _doc_ids(spark, sf).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        F.size(unknown).cast("bigint").alias("n_unknown"),
        F.md5(arrays.as_text(F.col("ids"))).alias("ids_md5"),
    )


@query(
    "detokenized_documents",
    f"""
    WITH {DOC_IDS_SQL},
    named AS (SELECT l.doc_id, l.pos, coalesce(v.token, '<|unknown|>') AS token FROM long l LEFT JOIN vocab v ON v.token = l.token),
    back AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text FROM named GROUP BY doc_id)
    SELECT doc_id, md5(coalesce(back.text, '')) AS text_md5 FROM docs LEFT JOIN back USING (doc_id)
    """,
)
def detokenized_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs, words = documents(spark, sf), F.col("text")
    vocabulary = fit_text_vocabulary(docs, words)
    back = decode(encode_texts(docs, ["doc_id"], words, vocabulary), ["doc_id"], F.col("ids"), vocabulary)
    return back.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "next_token_shift",
    f"""
    WITH {DOC_IDS_SQL}
    SELECT doc_id, greatest(len(ids) - 1, 0) AS n, {list_md5('ids[:len(ids) - 1]')} AS inputs_md5,
           {list_md5('ids[2:]')} AS targets_md5
    FROM ids
    """,
)
def next_token_shift(spark: SparkSession, sf: str) -> DataFrame:
    pair = _doc_ids(spark, sf).select("doc_id", arrays.shifted(F.col("ids")).alias("s"))
    return pair.select(
        "doc_id",
        F.size("s.inputs").cast("bigint").alias("n"),
        F.md5(arrays.as_text(F.col("s.inputs"))).alias("inputs_md5"),
        F.md5(arrays.as_text(F.col("s.targets"))).alias("targets_md5"),
    )


@query(
    "array_surgery",
    f"""
    WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    cut AS (SELECT vec_id, v, v[1:16] AS a, v[17:32] AS b, v[33:48] AS c, v[49:64] AS d FROM e),
    joined AS (SELECT vec_id, list_concat(list_concat(d, c), list_concat(b, a)) AS w, v[-1] AS final FROM cut)
    SELECT vec_id, {vector_marks_sql('w')}, {r_sql('final')} AS final FROM joined
    """,
)
def array_surgery(spark: SparkSession, sf: str) -> DataFrame:
    """Cut vectors in four, put the parts together in reverse order, and take the last entry."""
    v = F.col("embedding").cast("array<double>")
    parts = table(spark, sf, "embeddings").select("vec_id", arrays.chunks(v, 4).alias("p"), arrays.last(v).alias("final"))
    turned = parts.select("vec_id", F.flatten(F.reverse("p")).alias("w"), "final")
    return turned.select("vec_id", *vector_marks(F.col("w")), rounded(F.col("final")).alias("final"))


@query(
    "ordered_batches",
    f"""
    SELECT batch_id, count(*) AS n_rows, min(doc_id) AS first_id, max(doc_id) AS last_id,
           md5(string_agg(md5(text), ',' ORDER BY doc_id)) AS texts_md5
    FROM {BATCHED_SQL.format(n=32, source='documents')} GROUP BY batch_id
    """,
)
def ordered_batches(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))
    batches = B.to_columnar(B.with_batch(docs, "doc_id", 32), ["doc_id", "h"])
    return batches.select(
        "batch_id",
        F.size("doc_id").cast("bigint").alias("n_rows"),
        F.array_min("doc_id").alias("first_id"),
        F.array_max("doc_id").alias("last_id"),
        F.md5(F.array_join("h", ",")).alias("texts_md5"),
    )


@query(
    "first_batches",
    f"""
    SELECT doc_id, batch_id, md5(text) AS text_md5
    FROM {BATCHED_SQL.format(n=32, source='documents')} WHERE batch_id < 3
    """,
)
def first_batches(spark: SparkSession, sf: str) -> DataFrame:
    # Stopping after three batches is the operator itself.
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return B.first_batches(docs, "doc_id", 32, 3).select("doc_id", "batch_id", F.md5("text").alias("text_md5"))


@query(
    "repeated_epochs",
    """
    SELECT doc_id, epoch, epoch * n + idx AS step
    FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n FROM documents),
         (SELECT unnest([0, 1, 2]) AS epoch)
    """,
)
def repeated_epochs(spark: SparkSession, sf: str) -> DataFrame:
    return B.repeat_epochs(table(spark, sf, "documents").select("doc_id"), "doc_id", 3).select("doc_id", "epoch", "step")


@query(
    "accumulated_steps",
    f"""
    WITH r AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS step, n_chars::DOUBLE AS x FROM documents)
    SELECT step, count(*) AS n_rows, {r_sql('sum(x / 16)')} AS loss FROM r GROUP BY step HAVING count(*) = 16
    """,
)
def accumulated_steps(spark: SparkSession, sf: str) -> DataFrame:
    out = B.accumulate(table(spark, sf, "documents"), "doc_id", F.col("n_chars"), 16)
    return out.select("step", "n_rows", rounded(F.col("loss")).alias("loss"))


@query(
    "padded_batches",
    f"""
    WITH {DOC_IDS_SQL}, b AS {BATCHED_SQL.format(n=8, source='ids')},
    w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM b)
    SELECT doc_id, batch_id, width, len(ids) AS n_real,
           {list_md5(f"list_concat(ids, list_transform(range(width - len(ids)), lambda i: {PAD_ID}::BIGINT))")} AS padded_md5
    FROM w
    """,
)
def padded_batches(spark: SparkSession, sf: str) -> DataFrame:
    ids = _doc_ids(spark, sf).withColumn("n_real", F.size("ids").cast("bigint"))
    return B.padded_batches(ids, "doc_id", "ids", 8).select(
        "doc_id", "batch_id", F.col("width").cast("bigint").alias("width"), "n_real",
        F.md5(arrays.as_text(F.col("ids"))).alias("padded_md5"),
    )


@query(
    "batch_shapes",
    f"""
    WITH {DOC_IDS_SQL}, b AS {BATCHED_SQL.format(n=32, source='ids')}
    SELECT batch_id, count(*) AS n_rows, max(len(ids)) AS width, sum(len(ids))::BIGINT AS n_real,
           {r_sql('sum(len(ids)) / (count(*) * max(len(ids)))')} AS fill
    FROM b GROUP BY batch_id
    """,
)
def batch_shapes(spark: SparkSession, sf: str) -> DataFrame:
    report = B.shape_report(B.with_batch(_doc_ids(spark, sf), "doc_id", 32), "ids")
    return report.withColumn("fill", rounded(F.col("fill")))


BY_LENGTH_SQL = """(SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx,
        (row_number() OVER (ORDER BY len(ids) DESC, doc_id) - 1) // 8 AS batch_id,
        (row_number() OVER (ORDER BY len(ids) DESC, doc_id) - 1) % 8 AS slot FROM ids)"""


@query(
    "length_batches",
    f"""
    WITH {DOC_IDS_SQL}, b AS {BY_LENGTH_SQL}, w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM b)
    SELECT doc_id, idx, batch_id, slot, width,
           {list_md5(f"list_concat(ids, list_transform(range(width - len(ids)), lambda i: {PAD_ID}::BIGINT))")} AS padded_md5
    FROM w
    """,
)
def length_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of documents of like length, each row with its place in the order of documents."""
    return B.length_batches(_doc_ids(spark, sf), "doc_id", "ids", 8).select(
        "doc_id", "idx", "batch_id", "slot", F.col("width").cast("bigint").alias("width"),
        F.md5(arrays.as_text(F.col("ids"))).alias("padded_md5"),
    )


@query(
    "batch_fill",
    f"""
    WITH {DOC_IDS_SQL}, b AS (SELECT 'in order' AS plan, batch_id, len(ids) AS n FROM {BATCHED_SQL.format(n=8, source='ids')}
                              UNION ALL SELECT 'by length', batch_id, len(ids) FROM {BY_LENGTH_SQL}),
    w AS (SELECT plan, batch_id, count(*) AS n_rows, sum(n) AS n_real, count(*) * max(n) AS n_slots FROM b GROUP BY plan, batch_id)
    SELECT plan, count(*) AS n_batches, sum(n_rows)::BIGINT AS n_rows, sum(n_real)::BIGINT AS n_real,
           sum(n_slots)::BIGINT AS n_slots, {r_sql('sum(n_real) / sum(n_slots)')} AS fill
    FROM w GROUP BY plan
    """,
)
def batch_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How much of the padded batches is real, with rows in order and by length."""
    ids = _doc_ids(spark, sf).select("doc_id", F.size("ids").alias("n"))
    ids = materialize(ids.withColumn("shorter", -F.col("n")), "lengths")
    plans = [
        B.with_batch(ids, order, 8).withColumn("plan", F.lit(plan)).select("plan", "batch_id", "n")
        for plan, order in (("in order", ["doc_id"]), ("by length", ["shorter", "doc_id"]))
    ]
    batches = plans[0].unionByName(plans[1]).groupBy("plan", "batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n").alias("n_real"),
        (F.count(F.lit(1)) * F.max("n")).alias("n_slots"),
    )
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_real", "n_slots")]
    out = batches.groupBy("plan").agg(F.count(F.lit(1)).alias("n_batches"), *sums)
    return out.withColumn("fill", rounded(F.col("n_real") / F.col("n_slots")))


@query(
    "columnar_rows",
    f"""
    WITH {PAIRS_SQL}
    SELECT (row_number() OVER (ORDER BY conv_id, turn) - 1) // 32 AS batch_id,
           (row_number() OVER (ORDER BY conv_id, turn) - 1) % 32 AS slot,
           md5(instruction) AS instruction_md5, md5(input) AS input_md5, md5(output) AS output_md5
    FROM pairs
    """,
)
def columnar_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Instruction rows to columnar batches and back to rows."""
    columns = ["instruction", "input", "output"]
    batches = B.to_columnar(B.with_batch(_pairs(spark, sf), ["conv_id", "turn"], 32), columns)
    return B.to_rows(batches, columns).select("batch_id", "slot", *[F.md5(c).alias(f"{c}_md5") for c in columns])


@query(
    "packed_tokens",
    f"""
    WITH docs AS (SELECT doc_id, regexp_extract_all(text, {TOKENS_SQL}) AS t FROM documents),
    long AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM docs),
    placed AS (SELECT token, row_number() OVER (ORDER BY doc_id, pos) - 1 AS place FROM long)
    SELECT place // 512 AS pack_id, count(*) AS n_tokens, md5(string_agg(token, ' ' ORDER BY place)) AS tokens_md5
    FROM placed GROUP BY place // 512
    """,
)
def packed_tokens(spark: SparkSession, sf: str) -> DataFrame:
    packs = pack_sequences(_doc_tokens(spark, sf), "doc_id", "t", 512)
    return packs.select("pack_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))
