"""Queries: reading, validating, templating, tokenizing and masking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import arrays, text
from tokenloom.operators import conversations as C
from tokenloom.operators.order import every_nth, row_slice, with_row_index
from tokenloom.operators.vocabulary import encode, fit_vocabulary
from tokenloom.plans.registry import TOKENS_SQL, list_md5, query, vocabulary_sql
from tokenloom.sources.corpus import documents, read_corpus, table
from tokenloom.sources.positions import file_slice, with_file_position

TURN_SQL = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
LAST_SQL = "(SELECT conv_id, max(turn) AS last_turn, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id)"
PAIRS_SQL = """pairs AS (SELECT u.conv_id, u.turn, u.text AS instruction, '' AS input, a.text AS output
        FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant')"""
CHAT_SQL = """chats AS (SELECT conv_id, turn,
        '<|im_start|>system' || chr(10) || 'You are an instruction following agent.' || '<|im_end|>' || chr(10)
        || '<|im_start|>user' || chr(10) || '## Instruction: ' || instruction || chr(10) || ' ## Input: ' || input
        || '<|im_end|>' || chr(10) AS prompt,
        '<|im_start|>assistant' || chr(10) || '## Output: ' || output || '<|im_end|>' || chr(10) AS answer
        FROM pairs)"""


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return C.turn_pairs(table(spark, sf, "conversations"))


def _chats(spark: SparkSession, sf: str) -> DataFrame:
    return C.message_columns(_pairs(spark, sf))


def utf8_bytes(texts: list[str]) -> list[list[int]]:
    """A byte tokenizer: the ids of a text are its UTF-8 bytes."""
    return [list(t.encode("utf-8")) for t in texts]


@query(
    "supervised_tokens",
    f"""
    WITH t AS (SELECT conv_id, turn, role, len(regexp_extract_all({TURN_SQL}, {TOKENS_SQL})) AS n FROM conversations),
    c AS (SELECT conv_id, sum(n) AS n_tokens, arg_max(n, turn) AS last_n, arg_max(role, turn) AS last_role
          FROM t GROUP BY conv_id)
    SELECT conv_id, n_tokens::BIGINT AS n_tokens, (n_tokens - last_n)::BIGINT AS n_prompt,
           last_n::BIGINT AS n_supervised
    FROM c WHERE last_role = 'assistant'
    """,
)
def supervised_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return C.supervised_tokens(table(spark, sf, "conversations"))


# Both engines read a stored table in the order of its files and rows.
@query("file_row_positions", "SELECT doc_id, source, row_number() OVER () - 1 AS idx FROM documents")
def file_row_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's place in the stored table; no key, no shuffle."""
    return with_file_position(table(spark, sf, "documents").select("doc_id", "source"))


@query(
    "file_row_slice",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::DOUBLE AS l_quantity, idx
    FROM (SELECT *, row_number() OVER () - 1 AS idx FROM lineitem) WHERE idx >= 100 AND idx < 200
    """,
)
def file_row_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Rows 100 to 199 as stored, of a table without a key of one column."""
    rows = file_slice(spark, f"{sf}/lineitem.parquet", 100, 200, "idx")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("double").alias("l_quantity"), "idx")


@query("corpus_read", "SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM documents")
def corpus_read(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_corpus(spark, f"{sf}/documents.parquet")
    return docs.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


@query(
    "corpus_row_slice",
    "SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY doc_id LIMIT 100 OFFSET 100",
)
def corpus_row_slice(spark: SparkSession, sf: str) -> DataFrame:
    # The slice [100, 200) is the operator itself.
    return row_slice(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", 100, 200).select(
        "doc_id", F.md5("text").alias("text_md5")
    )


@query(
    "field_projection",
    """SELECT doc_id AS id, 'documents' AS origin, md5(text) AS text_md5 FROM documents
    UNION ALL SELECT conv_id * 1000000 + turn, 'conversations', md5(text) FROM conversations""",
)
def field_projection(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.lit("documents").alias("origin"), "text")
    turns = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("id"), F.lit("conversations").alias("origin"), "text"
    )
    return docs.unionByName(turns).select("id", "origin", F.md5("text").alias("text_md5"))


@query(
    "role_mapping",
    """
    SELECT conv_id, turn, role, md5(text) AS content_md5 FROM conversations
    """,
)
def role_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Turns are first put in the `{from, value}` form, then mapped back."""
    back = {"user": "human", "assistant": "gpt"}
    shared = table(spark, sf, "conversations").select(
        "conv_id", "turn", text.map_role(F.col("role"), back).alias("from"), F.col("text").alias("value")
    )
    entry = F.array(F.struct("from", "value"))
    mapped = shared.select("conv_id", "turn", F.inline(text.map_messages(entry)))
    return mapped.select("conv_id", "turn", "role", F.md5("content").alias("content_md5"))


@query(
    "last_turn_check",
    """
    SELECT conv_id, count(*) AS n_turns, max(turn) AS last_turn, arg_max(role, turn) AS last_role,
           CASE WHEN arg_max(role, turn) <> 'assistant' THEN 'last turn is not assistant' END AS reason
    FROM conversations GROUP BY conv_id
    """,
)
def last_turn_check(spark: SparkSession, sf: str) -> DataFrame:
    return C.last_turns(table(spark, sf, "conversations"))


@query(
    "checked_turns",
    f"""
    SELECT c.conv_id, c.turn, CASE WHEN last_role = 'assistant' THEN 'kept' ELSE 'rejected' END AS verdict,
           md5(c.text) AS text_md5
    FROM conversations c JOIN {LAST_SQL} l ON l.conv_id = c.conv_id
    """,
)
def checked_turns(spark: SparkSession, sf: str) -> DataFrame:
    kept, rejected = C.check_turns(table(spark, sf, "conversations"))
    columns = ["conv_id", "turn", "text"]
    both = kept.select(*columns, F.lit("kept").alias("verdict")).unionByName(
        rejected.select(*columns, F.lit("rejected").alias("verdict"))
    )
    return both.select("conv_id", "turn", "verdict", F.md5("text").alias("text_md5"))


MARKERS = ("<|im_start|>", "<|im_end|>", "<|fim_prefix|>", "<|fim_suffx|>")


@query(
    "marker_guard",
    f"""
    WITH rows AS (SELECT 'documents' AS origin, doc_id AS id, text FROM documents
                  UNION ALL SELECT 'conversations', conv_id * 1000000 + turn,
                  CASE WHEN role = 'system' THEN {TURN_SQL} ELSE text END FROM conversations)
    SELECT origin, id, md5(text) AS text_md5 FROM rows
    WHERE NOT ({' OR '.join(f"contains(text, '{m}')" for m in MARKERS)})
    """,
)
def marker_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Reject rows with marker text; rendered system turns are there to be rejected."""
    docs = table(spark, sf, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    shown = F.when(F.col("role") == "system", text.render_turn(F.col("role"), F.col("text"))).otherwise(F.col("text"))
    turns = table(spark, sf, "conversations").select(
        F.lit("conversations").alias("origin"), (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("id"), shown.alias("text")
    )
    kept = C.guard_markers(docs.unionByName(turns), "text", "reject", MARKERS)
    return kept.select("origin", "id", F.md5("text").alias("text_md5"))


@query(
    "example_builder",
    f"""
    WITH {PAIRS_SQL}, {CHAT_SQL}
    SELECT conv_id, turn, octet_length(encode(prompt || answer))::BIGINT AS n_ids,
           octet_length(encode(prompt))::BIGINT AS n_masked,
           md5(prompt || answer) AS ids_md5
    FROM chats
    """,
)
def example_builder(spark: SparkSession, sf: str) -> DataFrame:
    """Instruction rows to input ids and labels, with a byte tokenizer handed in."""
    built = C.build_examples(_pairs(spark, sf), text.batch_tokenizer(utf8_bytes), style="conv")
    as_hex = F.array_join(F.transform("input_ids", lambda b: F.lpad(F.hex(b), 2, "0")), "")
    return built.select(
        "conv_id",
        "turn",
        F.size("input_ids").cast("bigint").alias("n_ids"),
        (F.size("labels") - F.size(arrays.supervised(F.col("labels")))).cast("bigint").alias("n_masked"),
        F.md5(F.unhex(as_hex)).alias("ids_md5"),
    )


@query(
    "custom_tokenizer",
    "SELECT doc_id, octet_length(encode(text))::BIGINT AS n_ids FROM documents",
)
def custom_tokenizer(spark: SparkSession, sf: str) -> DataFrame:
    encode_bytes = text.batch_tokenizer(utf8_bytes)
    docs = documents(spark, sf).select("doc_id", encode_bytes(F.col("text")).alias("ids"))
    return docs.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"))


@query(
    "every_nth_row",
    """
    SELECT doc_id, idx, md5(text) AS text_md5
    FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
    WHERE (idx + 1) % 50 = 0
    """,
)
def every_nth_row(spark: SparkSession, sf: str) -> DataFrame:
    # Taking every 50th row is the operator itself. Positions are worked out
    # on the key alone; the texts are read only for the rows that are taken.
    docs = table(spark, sf, "documents")
    taken = every_nth(docs.select("doc_id"), "doc_id", 50)
    return docs.join(taken, "doc_id").select("doc_id", "idx", F.md5("text").alias("text_md5"))


@query(
    "wrapped_text",
    """SELECT doc_id, md5('<|fim_prefix|>' || text || '<|fim_suffx|>') AS wrapped_md5,
    md5('1' || text || '0') AS numbered_md5 FROM documents""",
)
def wrapped_text(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.wrap(t)).alias("wrapped_md5"), F.md5(text.wrap(t, 1, 0)).alias("numbered_md5")
    )


@query(
    "plain_template",
    f"""
    WITH {PAIRS_SQL}
    SELECT conv_id, turn, md5('## Instruction ' || instruction || ' ' || chr(10) || ' ## Input ' || input) AS prompt_md5,
           md5('## Instruction ' || instruction || ' ' || chr(10) || ' ## Input ' || input || ' ' || chr(10)
               || ' ## Output ' || output) AS full_md5
    FROM pairs
    """,
)
def plain_template(spark: SparkSession, sf: str) -> DataFrame:
    i, x, o = F.col("instruction"), F.col("input"), F.col("output")
    return _pairs(spark, sf).select(
        "conv_id", "turn", F.md5(text.plain_prompt(i, x)).alias("prompt_md5"), F.md5(text.plain_full(i, x, o)).alias("full_md5")
    )


@query(
    "instruction_messages",
    f"""
    WITH {PAIRS_SQL}, m AS (
        SELECT conv_id, turn, 0 AS place, 'system' AS role, 'You are an instruction following agent.' AS content FROM pairs
        UNION ALL SELECT conv_id, turn, 1, 'user',
            '## Instruction: ' || instruction || chr(10) || ' ## Input: ' || input FROM pairs
        UNION ALL SELECT conv_id, turn, 2, 'assistant', '## Output: ' || output FROM pairs)
    SELECT conv_id, turn, place, role, md5(content) AS content_md5 FROM m
    """,
)
def instruction_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = _chats(spark, sf).select("conv_id", "turn", F.posexplode("full").alias("place", "m"))
    return rows.select("conv_id", "turn", "place", "m.role", F.md5("m.content").alias("content_md5"))


@query(
    "chat_rendering",
    f"""
    WITH {PAIRS_SQL}, {CHAT_SQL}
    SELECT conv_id, turn, md5(prompt) AS prompt_md5, md5(prompt || answer) AS full_md5,
           md5(prompt || '<|im_start|>assistant' || chr(10)) AS asking_md5
    FROM chats
    """,
)
def chat_rendering(spark: SparkSession, sf: str) -> DataFrame:
    p, f = F.col("prompt"), F.col("full")
    return _chats(spark, sf).select(
        "conv_id",
        "turn",
        F.md5(text.render_chat(p)).alias("prompt_md5"),
        F.md5(text.render_chat(f)).alias("full_md5"),
        F.md5(text.render_chat(p, add_generation_prompt=True)).alias("asking_md5"),
    )


@query(
    "turn_rendering",
    f"SELECT conv_id, turn, md5({TURN_SQL}) AS rendered_md5 FROM conversations",
)
def turn_rendering(spark: SparkSession, sf: str) -> DataFrame:
    rendered = text.render_turn(F.col("role"), F.col("text"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(rendered).alias("rendered_md5"))


@query(
    "document_tokens",
    f"""
    SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
    FROM (SELECT doc_id, regexp_extract_all(text, {TOKENS_SQL}) AS t FROM documents)
    """,
)
def document_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", text.tokens(F.col("text")).alias("t"))
    return docs.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@query(
    "prompt_full_split",
    f"""
    WITH {PAIRS_SQL}
    SELECT conv_id, turn, 2::BIGINT AS n_prompt, 3::BIGINT AS n_full, 'user' AS last_prompt_role,
           md5('## Output: ' || output) AS answer_md5
    FROM pairs
    """,
)
def prompt_full_split(spark: SparkSession, sf: str) -> DataFrame:
    """All messages but the last, and all messages, of checked chats."""
    chats = _chats(spark, sf).select("conv_id", "turn", F.col("full").alias("conversations"))
    split = C.message_columns(chats, pre_conv=True)
    return split.select(
        "conv_id",
        "turn",
        F.size("prompt").cast("bigint").alias("n_prompt"),
        F.size("full").cast("bigint").alias("n_full"),
        arrays.last(F.col("prompt"))["role"].alias("last_prompt_role"),
        F.md5(arrays.last(F.col("full"))["content"]).alias("answer_md5"),
    )


# conv_id, turn, ids of the rendered turns; vocabulary from the same turns
TURN_IDS_SQL = f"""turns AS (SELECT conv_id, turn, regexp_extract_all({TURN_SQL}, {TOKENS_SQL}) AS t FROM conversations),
    {vocabulary_sql('turns')},
    long AS (SELECT conv_id, turn, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM turns),
    coded AS (SELECT long.conv_id, long.turn, long.pos, v.id FROM long JOIN vocab v ON v.token = long.token),
    labelled AS (SELECT coded.conv_id, coded.turn, pos, id, CASE WHEN coded.turn < last_turn THEN -100 ELSE id END AS label
                 FROM coded JOIN {LAST_SQL} l ON l.conv_id = coded.conv_id WHERE last_role = 'assistant')"""


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    tokens = text.tokens(text.render_turn(F.col("role"), F.col("text")))
    vocabulary = fit_vocabulary(turns, tokens)
    return C.label_turns(encode(C.check_turns(turns).kept, ["conv_id", "turn", "last_turn"], tokens, vocabulary))


@query(
    "label_mask",
    f"""
    WITH {TURN_IDS_SQL}
    SELECT conv_id, turn, count(*) AS n_ids, {list_md5('list(id ORDER BY pos)')} AS ids_md5,
           {list_md5('list(label ORDER BY pos)')} AS labels_md5
    FROM labelled GROUP BY conv_id, turn
    """,
)
def label_mask(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).select(
        "conv_id",
        "turn",
        F.size("input_ids").cast("bigint").alias("n_ids"),
        F.md5(arrays.as_text(F.col("input_ids"))).alias("ids_md5"),
        F.md5(arrays.as_text(F.col("labels"))).alias("labels_md5"),
    )


@query(
    "assembled_examples",
    f"""
    WITH {TURN_IDS_SQL},
    placed AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) - 1) AS place FROM labelled)
    SELECT conv_id, place // 512 AS chunk_no, count(*) AS n_ids, {list_md5('list(id ORDER BY place)')} AS ids_md5,
           {list_md5('list(label ORDER BY place)')} AS labels_md5
    FROM placed GROUP BY conv_id, place // 512
    """,
)
def assembled_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Whole conversations as input ids and labels, 512 tokens a row."""
    built = C.assemble_examples(_labelled(spark, sf), 512)
    return built.select(
        "conv_id",
        "chunk_no",
        F.size("input_ids").cast("bigint").alias("n_ids"),
        F.md5(arrays.as_text(F.col("input_ids"))).alias("ids_md5"),
        F.md5(arrays.as_text(F.col("labels"))).alias("labels_md5"),
    )


@query(
    "supervised_labels",
    f"""
    WITH {TURN_IDS_SQL}
    SELECT conv_id, count(*) AS n_labels, count(*) FILTER (label <> -100) AS n_supervised
    FROM labelled GROUP BY conv_id
    """,
)
def supervised_labels(spark: SparkSession, sf: str) -> DataFrame:
    kept = F.size(arrays.supervised(F.col("labels")))
    return _labelled(spark, sf).groupBy("conv_id").agg(
        F.sum(F.size("labels")).alias("n_labels"), F.sum(kept).alias("n_supervised")
    )


@query(
    "row_positions",
    """
    SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS user_idx
    FROM events
    """,
)
def row_positions(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    indexed = with_row_index(events, "event_id")
    by_user = with_row_index(indexed, ["ts", "event_id"], "user_id", "user_idx")
    return by_user.select("event_id", "idx", "user_idx")


@query(
    "token_positions",
    f"""
    SELECT doc_id, len(t) AS n, coalesce(list_sum(list_transform(t, lambda x, i: i - 1)), 0)::BIGINT AS position_sum
    FROM (SELECT doc_id, regexp_extract_all(text, {TOKENS_SQL}) AS t FROM documents)
    """,
)
def token_positions(spark: SparkSession, sf: str) -> DataFrame:
    at = documents(spark, sf).select("doc_id", arrays.positions(text.tokens(F.col("text"))).alias("at"))
    summed = F.aggregate("at", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return at.select("doc_id", F.size("at").cast("bigint").alias("n"), summed.alias("position_sum"))
