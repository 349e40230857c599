"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from textwrap import dedent

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text
from tokenloom.functions import vectors as V
from tokenloom.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows can be checked from outside."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return fn

    return add


# Rounding to six places makes sums independent of the order they were added
# in. It is spelled out because `round` treats halves differently in the two
# engines: decimal digits in one, binary fractions in the other.
def rounded(x: Column) -> Column:
    return F.floor(x * 1e6 + 0.5).cast("double") / 1e6


def r_sql(x: str) -> str:
    return f"floor(({x})::DOUBLE * 1e6 + 0.5) / 1e6"


def vector_marks(v: Column) -> list[Column]:
    """Flat columns that identify a vector: its length, and three sums over it."""
    v = V.doubles(v)
    weighted = V.total(F.transform(v, lambda x, i: x * (i + 1)))
    return [
        F.size(v).cast("bigint").alias("width"),
        rounded(V.total(v)).alias("v_sum"),
        rounded(weighted).alias("v_weighted"),
        rounded(V.sum_of_squares(v)).alias("v_square"),
    ]


def vector_marks_sql(v: str) -> str:
    return f"""len({v}) AS width,
        {r_sql(f'list_sum({v})')} AS v_sum,
        {r_sql(f'list_sum(list_transform({v}, lambda x, i: x * i))')} AS v_weighted,
        {r_sql(f'list_sum(list_transform({v}, lambda x: x * x))')} AS v_square"""


TOKENS_SQL = f"'{text.TOKEN_PATTERN}'"
# Ids of the reserved entries with the default vocabulary size.
START_ID, END_ID, UNKNOWN_ID, PAD_ID = 100_273, 100_274, 100_275, 100_276

# doc_id, t: the tokens of each document
DOC_TOKENS_SQL = f"docs AS (SELECT doc_id, regexp_extract_all(text, {TOKENS_SQL}) AS t FROM documents)"


def vocabulary_sql(source: str, name: str = "vocab") -> str:
    """token, id, n over the token lists `t` of `source`."""
    return f"""{name} AS (
        SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS id, n
        FROM (SELECT token, count(*) AS n FROM (SELECT unnest(t) AS token FROM {source}) GROUP BY token)
        ORDER BY n DESC, token LIMIT {START_ID})"""


# doc_id, ids: the documents in vocabulary ids
DOC_IDS_SQL = f"""{DOC_TOKENS_SQL},
    {vocabulary_sql('docs')},
    long AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM docs),
    coded AS (SELECT long.doc_id, long.pos, coalesce(v.id, {UNKNOWN_ID}) AS id
              FROM long LEFT JOIN vocab v ON v.token = long.token),
    ids AS (SELECT d.doc_id, coalesce(c.ids, []::BIGINT[]) AS ids
            FROM docs d LEFT JOIN (SELECT doc_id, list(id ORDER BY pos) AS ids FROM coded GROUP BY doc_id) c
            ON c.doc_id = d.doc_id)"""


def list_md5(v: str) -> str:
    return f"md5(array_to_string({v}, ','))"
