"""Each registered query of the text operators over the smallest tables."""

import compare
import pytest

from shelfcast.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    df = queries.queries()[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    sql = queries.oracle_sql().get(name)
    if sql:
        assert compare.difference(compare.spark_rows(df), compare.sql_rows(compare.connect(SF), sql)) is None
    elif name != "op3_chat_format":
        assert df.count() == n
    else:
        got = {r.conv_id: r for r in df.collect()}
        assert got[-7].n_turns == 2 and got[-7].loss_chars == len(r"\### Assistant: </turn> ok")
