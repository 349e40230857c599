"""Conversations: validation, supervised-token counts and training examples.

Two layouts are served. Nested rows hold one conversation as an array of
messages; work on them is row by row and never shuffles. Flat rows hold one
turn each; there nothing gathers a conversation into one row, so its length
does not matter: what the whole conversation decides (its last turn, its token
offsets) comes from partial aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import arrays, text
from tokenloom.operators.joins import lookup
from tokenloom.operators.packing import pack, place_arrays
from tokenloom.session import materialize


class Split(NamedTuple):
    kept: DataFrame
    rejected: DataFrame


def _reason(last_role: Column, missing: Column, empty: Column) -> Column:
    return (
        F.when(empty, F.lit("no turns"))
        .when(missing, F.lit("missing role or content"))
        .when(last_role != "assistant", F.lit("last turn is not assistant"))
    )


def check_messages(df: DataFrame, messages: str = "messages", strict: bool = False) -> Split:
    """Keep nested conversations that end on an assistant turn.

    The others come back with a `reason`. With `strict` the first bad one
    stops the job instead.
    """
    m = F.col(messages)
    empty = m.isNull() | (F.size(m) == 0)
    missing = F.exists(m, lambda x: x["role"].isNull() | x["content"].isNull())
    marked = df.withColumn("reason", _reason(arrays.last(m)["role"], missing, empty))
    if strict:
        guard = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(F.raise_error(F.col("reason")))
        return Split(marked.filter(guard).drop("reason"), df.limit(0).withColumn("reason", F.lit(None).cast("string")))
    return Split(marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull()))


def last_turns(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text"
) -> DataFrame:
    """Per flat conversation: number of turns, last turn, its role, and the reason to reject it if any."""
    per = turns.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.max(turn).alias("last_turn"),
        F.max_by(F.col(role), F.col(turn)).alias("last_role"),
        F.max((F.col(role).isNull() | F.col(content).isNull()).cast("int")).alias("_missing"),
    )
    reason = _reason(F.col("last_role"), F.col("_missing") == 1, F.lit(False))
    return per.withColumn("reason", reason).drop("_missing")


def check_turns(turns: DataFrame, key: str = "conv_id", **columns: str) -> Split:
    """Keep the turns of conversations that end on an assistant turn."""
    verdict = materialize(last_turns(turns, key, **columns).select(key, "last_turn", "reason"), "last_turns")
    marked = lookup(turns, verdict, [key], "inner", null_safe=True)
    return Split(marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull()))


def supervised_tokens(turns: DataFrame, pattern: str = text.TOKEN_PATTERN) -> DataFrame:
    """How many tokens each kept conversation has, and how many are supervised.

    A rendered turn ends in a line break, which no token spans, so the counts
    of the turns add up to the count of the rendered conversation. One shuffle
    of partial sums; the texts stay where they are. As in `check_turns`, a
    conversation with a missing role or text is not kept.
    """
    n = F.size(text.tokens(text.render_turn(F.col("role"), F.col("text")), pattern)).cast("bigint")
    counted = turns.select("conv_id", "turn", (F.col("role") == "assistant").alias("answers"), n.alias("n"))
    per = counted.groupBy("conv_id").agg(
        F.sum("n").alias("n_tokens"),
        F.max_by("n", "turn").alias("n_supervised"),
        F.max_by("answers", "turn").alias("kept"),
        F.max(F.col("n").isNull()).alias("missing"),
    )
    return per.filter("kept and not missing").select(
        "conv_id", "n_tokens", (F.col("n_tokens") - F.col("n_supervised")).alias("n_prompt"), "n_supervised"
    )


def turn_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it, as an instruction row.

    An equi-join on conversation and turn number, so one long conversation
    spreads over all tasks.
    """
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    return asked.join(answered, ["conv_id", "turn"], "inner").select(
        "conv_id", "turn", "instruction", F.lit("").alias("input"), "output"
    )


def guard_markers(
    df: DataFrame, column: str, mode: str = "allow", markers: Sequence[str] = text.SPECIAL_MARKERS
) -> DataFrame:
    """`allow` lets special-token strings through as ordinary text; `reject` drops rows that contain one."""
    if mode == "allow":
        return df
    if mode == "reject":
        return df.filter(F.size(text.found_markers(F.col(column), markers)) == 0)
    raise ValueError(f"mode must be 'allow' or 'reject', not {mode!r}")


def message_columns(
    df: DataFrame, style: str = "conv", pre_conv: bool = False, format_change: bool = False, packing: bool = False
) -> DataFrame:
    """Add `prompt` and `full` message arrays to instruction or conversation rows.

    Impossible settings fail here, before any job. Conversations that do not
    end on an assistant turn stop the job, as `check_messages(strict=True)`
    does; filter with `check_messages` first to keep going.
    """
    if packing:
        raise NotImplementedError("examples are built one by one; pack them with tokenloom.operators.packing.pack")
    if not pre_conv:
        if style != "conv":
            raise NotImplementedError(f"style {style!r}: only 'conv' builds examples")
        cols = [F.col(c) for c in ("instruction", "input", "output")]
        return df.withColumn("prompt", text.instruction_prompt(*cols[:2])).withColumn("full", text.instruction_full(*cols))
    entry = set(df.schema["conversations"].dataType.elementType.names)
    need = {"from", "value"} if format_change else {"role", "content"}
    if not need <= entry:
        raise ValueError(f"conversations must have the fields {sorted(need)}, found {sorted(entry)}")
    full = F.col("conversations")
    df = df.withColumn("full", text.map_messages(full) if format_change else full)
    kept = check_messages(df, "full", strict=True).kept
    return kept.withColumn("prompt", arrays.all_but_last(F.col("full")))


def build_examples(
    df: DataFrame,
    tokenizer: Callable[[Column], Column],
    ignore: int = arrays.IGNORE_ID,
    mask_header: bool = False,
    **flags: bool | str,
) -> DataFrame:
    """Rows to `input_ids` and `labels`, with the prompt's labels ignored.

    `tokenizer` maps a text column to an id-array column. By default the
    header of the answering turn is supervised; `mask_header` hides it too.
    """
    out = message_columns(df, **flags)
    prompt = text.render_chat(F.col("prompt"), add_generation_prompt=mask_header)
    out = out.withColumn("input_ids", tokenizer(text.render_chat(F.col("full"))))
    out = out.withColumn("_n_prompt", F.size(tokenizer(prompt)))
    return out.withColumn("labels", arrays.masked_labels(F.col("input_ids"), F.col("_n_prompt"), ignore)).drop("_n_prompt")


def label_turns(encoded: DataFrame, ignore: int = arrays.IGNORE_ID) -> DataFrame:
    """Flat form of the label mask: per turn, `input_ids` and `labels`.

    `encoded` has conv_id, turn, last_turn and the ids of the rendered turn;
    `last_turn` comes from `check_turns`. All turns but the last are prompt.
    """
    ids = F.col("ids")
    hidden = F.transform(ids, lambda _: F.lit(ignore).cast("bigint"))
    labels = F.when(F.col("turn") < F.col("last_turn"), hidden).otherwise(ids)
    return encoded.select("conv_id", "turn", ids.alias("input_ids"), labels.alias("labels"))


def assemble_examples(labelled: DataFrame, chunk: int) -> DataFrame:
    """Turns to examples: `input_ids` and `labels` per conversation.

    A conversation of up to `chunk` tokens is one row; a longer one becomes
    consecutive rows `chunk_no` = 0, 1, ..., so no row grows without bound and
    no token is lost.
    """
    placed = place_arrays(labelled, ["conv_id", "turn"], "turn", "input_ids", group=["conv_id"])
    return pack(placed, ["input_ids", "labels"], chunk, start="_start", group=["conv_id"], name="chunk_no")
