"""The row-wise, batching, stateful and keyed operators on unbounded input."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions import arrays, text
from tokenloom.operators.batching import pad_batches, with_batch
from tokenloom.operators.conversations import build_examples, check_messages, guard_markers
from tokenloom.session import scratch_path


def prepare_turns(turns: DataFrame, marker_mode: str = "allow") -> DataFrame:
    """Role mapping, marker guard, rendering and tokenizing of single turns.

    Row by row throughout, so the same call serves tables and streams. Turns
    without a role or a text are left out; `rejected_turns` has them.
    """
    role = text.map_role(F.col("role"))
    out = guard_markers(turns.filter("role is not null and text is not null"), "text", marker_mode)
    rendered = text.render_turn(role, F.col("text"))
    return out.select("conv_id", "turn", role.alias("role"), text.tokens(rendered).alias("tokens"))


def rejected_turns(turns: DataFrame, marker_mode: str = "allow") -> DataFrame:
    """The turns that `prepare_turns` leaves out, with the `reason`."""
    missing = F.col("role").isNull() | F.col("text").isNull()
    reason = F.when(missing, "missing role or content")
    if marker_mode == "reject":
        reason = reason.when(F.size(text.found_markers(F.col("text"))) > 0, "special marker")
    return turns.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def prepare_examples(rows: DataFrame, tokenizer: Callable[[Column], Column], **flags: bool | str) -> DataFrame:
    """Nested conversations to `input_ids` and `labels`, row by row, on a table or a stream.

    Conversations that cannot be trained on are left out; `check_messages`
    gives them with the reason.
    """
    shown = F.col("conversations")
    checked = rows.withColumn("_checked", text.map_messages(shown) if flags.get("format_change") else shown)
    return build_examples(check_messages(checked, "_checked").kept.drop("_checked"), tokenizer, pre_conv=True, **flags)


def run_to_table(stream: DataFrame, name: str = "stream", mode: str = "append", path: str | None = None) -> DataFrame:
    """Run a stream over what has arrived, into a table, and read that back.

    The table is a new one unless `path` names one that an earlier run began.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _each_arrival(stream: DataFrame, path: str, one_chunk: Callable[[DataFrame, int], None]) -> None:
    """Hand every arriving chunk over with its number; a restart below the same `path` goes on where it ended."""
    query = (
        stream.writeStream.foreachBatch(one_chunk)
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def pad_arrivals(stream: DataFrame, order: str, ids: str, size: int, path: str, pad: int = arrays.PAD_ID) -> None:
    """Batch and pad each arriving chunk by itself.

    The chunk number is part of the batch key. A chunk is written to a folder
    of its own and replaced when it is run again, so a retry leaves no copies.
    """

    def one_chunk(chunk: DataFrame, number: int) -> None:
        padded = pad_batches(with_batch(chunk, order, size), ids, pad)
        padded.write.mode("overwrite").parquet(f"{path}/chunk={number}")

    _each_arrival(stream, path, one_chunk)


def _complete(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def first_writes_arrivals(
    stream: DataFrame, key: Sequence[str], order: str, time: str, delay: str, path: str
) -> None:
    """First write wins per key, across arrivals; Spark's own state remembers a key for `delay` of event time.

    Of an arrival's writes of a key the one with the smallest `order` (unique
    within a key) goes on, with the latest time of them all. A second stream
    takes these up, arrival by arrival, and lets a key through if its state
    does not know it. It forgets a key once `delay` has passed from that time
    to the watermark, which is the latest time of earlier arrivals less
    `delay`; the next write is a first one again. Writes not later than the
    watermark come too late and are dropped. Those without a time count as of
    the latest time of their arrival.

    Below `path`, `firsts` has the writes that won, by `chunk`, with
    `n_dropped` copies of the same arrival; `dropped` has the number of writes
    of each key that met a remembered one or came too late. Earlier results are
    never read again. A restart below the same `path` goes on; an arrival that
    was cut short is taken up where it stopped.
    """
    key, spark, columns = list(key), stream.sparkSession, stream.columns
    arrivals, firsts = f"{path}/arrivals", f"{path}/firsts"
    fields = T.StructType([*stream.schema.fields, T.StructField("n_dropped", T.LongType()), T.StructField("_time", T.TimestampType()), T.StructField("chunk", T.LongType())])

    def let_through() -> None:
        """What has arrived and is not known yet, with its state kept between calls."""
        rows = spark.readStream.schema(fields).parquet(f"{arrivals}/*")
        new = rows.withWatermark("_time", delay).dropDuplicatesWithinWatermark(key).drop("_time")
        query = (
            new.writeStream.format("parquet")
            .partitionBy("chunk")
            .option("path", firsts)
            .option("checkpointLocation", f"{firsts}-progress")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def one_chunk(chunk: DataFrame, number: int) -> None:
        folder = f"{arrivals}/{number:09d}"
        if not _complete(spark, folder):
            row = F.struct(*[F.col(f"`{c}`") for c in columns])
            best = chunk.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(
                F.min_by(row, F.col(order)).alias("_row"),
                (F.count(F.lit(1)) - 1).alias("n_dropped"),
                F.max(F.col(time).cast("timestamp")).alias("_time"),
            )
            latest = F.lit(chunk.agg(F.max(time)).first()[0]).cast("timestamp")
            placed = best.select("_row.*", "n_dropped", F.coalesce("_time", latest).alias("_time"))
            placed.withColumn("chunk", F.lit(number).cast("long")).write.mode("overwrite").parquet(folder)
        let_through()
        came = spark.read.schema(fields).parquet(folder)
        won = spark.read.schema(fields).parquet(firsts).filter(F.col("chunk") == number).select(*[F.col(k).alias(f"_{k}") for k in key])
        same = [came[k].eqNullSafe(won[f"_{k}"]) for k in key]
        lost = came.join(won, same, "left_anti").select(*key, (F.col("n_dropped") + 1).alias("n_dropped"))
        lost.write.mode("overwrite").parquet(f"{path}/dropped/chunk={number}")

    _each_arrival(stream, path, one_chunk)
