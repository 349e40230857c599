"""Text columns: markers, templates, chat rendering and tokenizing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import lists

# Results depend on these exact characters.
START_MARKER = "<|fim_prefix|>"
END_MARKER = "<|fim_suffx|>"
UNKNOWN_MARKER = "<|unknown|>"
PAD_MARKER = "<|pad|>"
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
SYSTEM_TEXT = "You are an instruction following agent."
ROLE_MAP = {"human": "user", "gpt": "assistant", "system": "system"}
TOKEN_PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N} \t\n\r]"
SPECIAL_MARKERS = (START_MARKER, END_MARKER, TURN_START, TURN_END)

CODED_CHARACTERS = 1 << 18  # a batch tokenizer is given texts of about so many together

MESSAGES = "array<struct<role:string,content:string>>"


def wrap(text: Column, start: object = START_MARKER, end: object = END_MARKER) -> Column:
    """Text between a start and an end marker; numbers are written as digits."""
    return F.concat(F.lit(str(start)), text, F.lit(str(end)))


def plain_prompt(instruction: Column, input: Column) -> Column:
    return F.concat(F.lit("## Instruction "), instruction, F.lit(" \n ## Input "), input)


def plain_full(instruction: Column, input: Column, output: Column) -> Column:
    return F.concat(plain_prompt(instruction, input), F.lit(" \n ## Output "), output)


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.cast("string").alias("role"), content.cast("string").alias("content"))


def instruction_prompt(instruction: Column, input: Column, system: str = SYSTEM_TEXT) -> Column:
    """An instruction as chat messages: system, then user."""
    user = F.concat(F.lit("## Instruction: "), instruction, F.lit("\n ## Input: "), input)
    return F.array(message("system", F.lit(system)), message("user", user))


def instruction_full(instruction: Column, input: Column, output: Column, system: str = SYSTEM_TEXT) -> Column:
    """The prompt messages followed by the assistant's answer."""
    answer = message("assistant", F.concat(F.lit("## Output: "), output))
    return F.concat(instruction_prompt(instruction, input, system), F.array(answer))


def map_role(role: Column, mapping: dict[str, str] = ROLE_MAP) -> Column:
    """Rename known roles; others pass through."""
    out = role
    for old, new in mapping.items():
        out = F.when(role == old, F.lit(new)).otherwise(out)
    return out


def map_messages(conversation: Column, mapping: dict[str, str] = ROLE_MAP) -> Column:
    """Turn `{from, value}` entries into `{role, content}` messages."""
    return F.transform(conversation, lambda m: message(map_role(m["from"], mapping), m["value"]))


def render_turn(role: Column, content: Column) -> Column:
    """One chat turn in ChatML text."""
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), content, F.lit(TURN_END + "\n"))


def generation_header(role: str = "assistant") -> Column:
    return F.lit(f"{TURN_START}{role}\n")


def render_chat(messages: Column, add_generation_prompt: bool = False, default_system: str | None = None) -> Column:
    """All turns of a message array as ChatML text; null if a role or a content is missing.

    With `default_system`, that system turn opens every chat that has none.
    """
    text = F.array_join(F.transform(messages, lambda m: render_turn(m["role"], m["content"])), "")
    whole = F.forall(messages, lambda m: m["role"].isNotNull() & m["content"].isNotNull())
    text = F.when(whole, text)
    if default_system is not None:
        opening = render_turn(F.lit("system"), F.lit(default_system))
        has_system = F.coalesce(F.try_element_at(messages, F.lit(1))["role"] == "system", F.lit(False))
        text = F.when(has_system, text).otherwise(F.concat(opening, text))
    return F.concat(text, generation_header()) if add_generation_prompt else text


def tokens(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    """Split text into words, numbers and single signs."""
    return F.regexp_extract_all(text, F.lit(pattern), 0)


_CLASSES: dict[str, np.ndarray] = {}
_GAP, _LETTER, _NUMBER, _SIGN = range(4)


def character_classes(spark: SparkSession) -> np.ndarray:
    """What `TOKEN_PATTERN` takes each code point for, by Spark's own expressions; for `split_texts`."""
    app = spark.sparkContext.applicationId
    if app not in _CLASSES:
        size = 1 << 11  # surrogates, which no text holds, fill one block
        blocks = [b for b in range(0x110000 // size) if b != 0xD800 // size]
        texts = ["".join(map(chr, range(b * size, (b + 1) * size))) for b in blocks]
        marked = F.regexp_replace(F.regexp_replace("t", r"\p{L}", "a"), r"\p{N}", "0")
        rows = spark.createDataFrame(pa.table({"b": blocks, "t": texts})).select("b", marked).collect()
        found = np.full(0x110000, _SIGN, dtype=np.uint8)
        for block, marks in rows:
            codes = np.frombuffer(marks.encode("utf-32-le"), "<u4")
            part = found[block * size : (block + 1) * size]
            part[codes == ord("a")], part[codes == ord("0")] = _LETTER, _NUMBER
        found[[ord(c) for c in " \t\n\r"]] = _GAP
        _CLASSES[app] = found
    return _CLASSES[app]


def valid(text: Column) -> Column:
    """Bytes that are no text replaced as Spark's regular expressions see them."""
    return F.when(F.is_valid_utf8(text), text).otherwise(F.regexp_replace(text, "^", ""))


def split_texts(texts: pa.Array, classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all valid `texts` one after the other, as `tokens` finds them, and how many each has; a null has none."""
    bounds = np.concatenate([[0], np.cumsum(lists.binary_lengths(texts))])
    data = np.frombuffer(b"".join(pc.fill_null(texts.cast(pa.binary()), b"").to_pylist()), np.uint8)
    kind = classes[:256][data]
    wide = np.flatnonzero(data >= 0x80)  # bytes of characters of several
    codes = np.frombuffer(data[wide].tobytes().decode().encode("utf-32-le"), "<u4")
    first = np.flatnonzero(data[wide] >= 0xC0)
    kind[wide] = np.repeat(classes[codes], np.diff(first, append=len(wide)))
    kept = kind != _GAP
    opens = np.zeros(len(data) + 1, dtype=bool)
    opens[bounds] = True
    starts = kept.copy()
    starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _SIGN) | opens[1:-1]
    starts[wide[data[wide] < 0xC0]] = False
    starts = np.flatnonzero(starts)
    before = np.cumsum(kept, dtype=np.int32)
    offsets = np.append(before[starts] - 1, before[-1:]) if len(data) else np.zeros(1, np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[kept]))
    return found, np.diff(np.searchsorted(starts, bounds))


def found_markers(text: Column, markers: Sequence[str] = SPECIAL_MARKERS) -> Column:
    """The special-token strings that occur in the text."""
    return F.filter(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(text, m))


def batch_tokenizer(encode_batch: Callable[[list[str]], list[list[int]]]) -> Callable[[Column], Column]:
    """Make any batch tokenizer usable as a column function.

    `encode_batch` takes a list of texts and returns a list of id lists; Spark
    hands it Arrow batches inside the tasks, in pieces of so few characters
    that their ids take little memory. A null text has null ids.
    """

    @F.arrow_udf("array<bigint>")
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            sizes = pc.fill_null(pc.utf8_length(text), 0).to_numpy(zero_copy_only=False)
            for start, stop in lists.pieces(sizes, CODED_CHARACTERS):
                part = text.slice(start, stop - start)
                found = iter(encode_batch(part.drop_null().to_pylist()))
                yield pa.array((next(found) if has.as_py() else None for has in part.is_valid()), pa.list_(pa.int64()))

    return encode
