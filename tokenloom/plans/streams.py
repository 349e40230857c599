"""Queries: the same work on streams of files, equal to the result on tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import arrays, text
from tokenloom.operators import series as R
from tokenloom.operators.vocabulary import encode_texts, fit_text_vocabulary
from tokenloom.plans import sequences as Q
from tokenloom.plans.preparation import TURN_SQL, utf8_bytes
from tokenloom.plans.registry import DOC_IDS_SQL, PAD_ID, TOKENS_SQL, list_md5, query, r_sql, rounded
from tokenloom.session import materialize, scratch_path
from tokenloom.sources.corpus import documents, table, table_stream
from tokenloom.streaming import streams as S
from tokenloom.streaming.folds import fold_states, fold_stream


@query(
    "streamed_turns",
    f"""
    SELECT conv_id, turn, role, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
    FROM (SELECT conv_id, turn, role, regexp_extract_all({TURN_SQL}, {TOKENS_SQL}) AS t FROM conversations)
    """,
)
def streamed_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Role mapping, marker guard, rendering and tokenizing of turns as they arrive."""
    out = S.run_to_table(S.prepare_turns(table_stream(spark, sf, "conversations")), "turns")
    return out.select(
        "conv_id", "turn", "role",
        F.size("tokens").cast("bigint").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


def _in_two_arrivals(rows: DataFrame, second: Column, run: Callable[[DataFrame], None]) -> None:
    """Let `run` take the rows up as they arrive: first all but the `second` ones, then, restarted, these."""
    spark = rows.sparkSession
    folder = scratch_path(spark, "arriving")
    for part in (rows.filter(~second), rows.filter(second)):
        part.write.mode("append").parquet(folder)
        run(spark.readStream.schema(rows.schema).parquet(folder))


NESTED_SQL = f"""last AS (SELECT conv_id, max(turn) AS last_turn, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id),
    chats AS (SELECT c.conv_id, string_agg({TURN_SQL}, '' ORDER BY turn) AS whole,
                     coalesce(string_agg({TURN_SQL}, '' ORDER BY turn) FILTER (turn < last_turn), '') AS prompt
              FROM conversations c JOIN last l ON l.conv_id = c.conv_id WHERE last_role = 'assistant' GROUP BY c.conv_id)"""


@query(
    "streamed_examples",
    f"""
    WITH {NESTED_SQL}
    SELECT conv_id, octet_length(encode(whole))::BIGINT AS n_ids, octet_length(encode(prompt))::BIGINT AS n_masked,
           md5(whole) AS ids_md5
    FROM chats
    """,
)
def streamed_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Nested conversations in the from/value form, to examples as they arrive; half of them arrive later."""
    turns = table(spark, sf, "conversations")
    shared = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    entry = F.struct("turn", shared.alias("from"), F.col("text").alias("value"))
    entries = F.array_sort(F.collect_list(entry))
    nested = turns.groupBy("conv_id").agg(
        F.transform(entries, lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value"))).alias("conversations")
    )
    path = scratch_path(spark, "examples")

    def run(stream: DataFrame) -> None:
        S.run_to_table(S.prepare_examples(stream, text.batch_tokenizer(utf8_bytes), format_change=True), path=path)

    _in_two_arrivals(nested, F.col("conv_id") % 2 == 1, run)
    as_hex = F.array_join(F.transform("input_ids", lambda b: F.lpad(F.hex(b), 2, "0")), "")
    return spark.read.parquet(path).select(
        "conv_id",
        F.size("input_ids").cast("bigint").alias("n_ids"),
        (F.size("labels") - F.size(arrays.supervised(F.col("labels")))).cast("bigint").alias("n_masked"),
        F.md5(F.unhex(as_hex)).alias("ids_md5"),
    )


@query(
    "streamed_padding",
    f"""
    WITH {DOC_IDS_SQL},
    b AS (SELECT *, (row_number() OVER (PARTITION BY chunk ORDER BY doc_id) - 1) // 8 AS batch_id
          FROM (SELECT *, (doc_id % 3 = 0)::BIGINT AS chunk FROM ids)),
    w AS (SELECT *, max(len(ids)) OVER (PARTITION BY chunk, batch_id) AS width FROM b)
    SELECT doc_id, chunk, batch_id, width,
           {list_md5(f"list_concat(ids, list_transform(range(width - len(ids)), lambda i: {PAD_ID}::BIGINT))")} AS padded_md5
    FROM w
    """,
)
def streamed_padding(spark: SparkSession, sf: str) -> DataFrame:
    """Batch and pad the documents of each arriving chunk; every third document arrives later."""
    docs, words = documents(spark, sf), F.col("text")
    ids = materialize(encode_texts(docs, ["doc_id"], words, fit_text_vocabulary(docs, words)), "ids")
    path = scratch_path(spark, "padded")
    _in_two_arrivals(ids, F.col("doc_id") % 3 == 0, lambda stream: S.pad_arrivals(stream, "doc_id", "ids", 8, path))
    return spark.read.parquet(path).select(
        "doc_id", F.col("chunk").cast("bigint").alias("chunk"), "batch_id", F.col("width").cast("bigint").alias("width"),
        F.md5(arrays.as_text(F.col("ids"))).alias("padded_md5"),
    )


DAY = 86_400_000
WAIT = 5  # days that the fold waits for rows


@query(
    "streamed_fold",
    f"""
    WITH e AS (SELECT *, ts >= TIMESTAMP '2024-01-15' OR event_id % 5 = 0 AS later, (epoch_ms(ts) // {DAY} + 1) * {DAY} AS day_end,
                      [value / 100, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END]::DOUBLE[] AS x FROM events),
    passed AS (SELECT epoch_ms(max(ts) FILTER (NOT later)) - {WAIT * DAY} AS first, epoch_ms(max(ts)) - {WAIT * DAY} AS last FROM e),
    m AS (SELECT e.*, later AND day_end <= passed.first AS late, day_end > passed.last AS waits FROM e, passed),
    s AS (SELECT user_id, count(*) FILTER (NOT late AND NOT waits) AS n_steps, count(*) FILTER (late) AS n_late,
                 count(*) FILTER (waits) AS n_pending,
                 coalesce(list(x ORDER BY ts, event_id) FILTER (NOT late AND NOT waits), []) AS xs FROM m GROUP BY user_id),
    r AS (SELECT user_id, n_steps, n_late, n_pending, {Q.GATED_FOLD_SQL} AS h FROM s)
    SELECT user_id, n_steps, n_late, n_pending, {', '.join(f"{r_sql(f'h[{i + 1}]')} AS h{i}" for i in range(3))} FROM r
    """,
)
def streamed_fold(spark: SparkSession, sf: str) -> DataFrame:
    """The gated fold over two arrivals; of what the second brings, some belongs before waiting rows and some is too late."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    cell = R.gated_cell(Q.WX, Q.BX, Q.WH, Q.WXZ, Q.BZ, Q.WHZ)
    path = scratch_path(spark, "folded")
    later = (F.col("ts") >= F.to_timestamp(F.lit("2024-01-15 00:00:00"))) | (F.col("event_id") % 5 == 0)

    def run(stream: DataFrame) -> None:
        fold_stream(stream, "user_id", "ts", ["event_id"], Q.features(), cell, 3, path, f"{WAIT} DAYS", timedelta(days=1))

    _in_two_arrivals(events, later, run)
    out = fold_states(spark, "user_id", path)
    return out.select("user_id", "n_steps", "n_late", "n_pending", *[rounded(F.col("h")[i]).alias(f"h{i}") for i in range(3)])


# Every event is written three times: two copies in the first arrival, of which
# the later one in the table comes first by `write`, and one in the second, 15
# days later. Keys are remembered for 10 days of event time.
WRITES_SQL = f"""passed AS (SELECT (epoch_ms(max(ts)) - {10 * DAY}) * 1000 AS w FROM events),
    w AS (SELECT event_id, user_id, epoch_us(ts) + {15 * DAY * 1000} > w AND epoch_us(ts) + {10 * DAY * 1000} <= w AS again FROM events, passed)"""


@query(
    "streamed_first_writes",
    f"""
    WITH {WRITES_SQL}
    SELECT event_id, user_id, 1::BIGINT AS copy, 0::BIGINT AS chunk, 1::BIGINT AS n_dropped FROM w
    UNION ALL SELECT event_id, user_id, 2, 1, 0 FROM w WHERE again
    UNION ALL SELECT event_id, user_id, NULL, 1, 1 FROM w WHERE NOT again
    """,
)
def streamed_first_writes(spark: SparkSession, sf: str) -> DataFrame:
    """Which copy of every event won, and how many were dropped: known, forgotten and too late ones in the second arrival."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    copies = events.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint"))).alias("copy"))
    second = F.col("copy") == 2
    writes = copies.withColumn("write", F.when(second, 2).otherwise(1 - F.col("copy")))
    writes = writes.withColumn("ts", F.when(second, F.col("ts") + F.expr("INTERVAL 15 DAYS")).otherwise(F.col("ts")))
    path = scratch_path(spark, "firsts")
    _in_two_arrivals(
        writes,
        second,
        lambda stream: S.first_writes_arrivals(stream, ["event_id", "user_id"], "write", "ts", "10 DAYS", path),
    )
    firsts = spark.read.parquet(f"{path}/firsts")
    dropped = spark.read.parquet(f"{path}/dropped").withColumn("copy", F.lit(None).cast("bigint"))
    columns = ["event_id", "user_id", "copy", F.col("chunk").cast("bigint").alias("chunk"), "n_dropped"]
    return firsts.select(*columns).unionByName(dropped.select(*columns))
