"""The driver contract."""

import __spark_entry__ as entry
from tokenloom.plans import QUERIES


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) == 93 and set(QUERIES) <= set(entry.queries())


def test_entry_gives_the_flagship_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["conv_id", "n_tokens", "n_prompt", "n_supervised"] and df.count() == 6
