"""The queries of the training data: registered, and equal to their SQL where they have one."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from shelfline.llm.oracle import ORACLE
from shelfline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def test_all_are_registered():
    assert [int(name[2:].split('_')[0]) for name in QUERIES] == list(range(1, len(QUERIES) + 1)) and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_against_its_sql(spark, name):
    with duckdb.connect() as engine:
        for table in ("pages", "embeddings", "documents", "labels"):
            engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        result = engine.execute(ORACLE[name])
        types = {column[0]: str(column[1]) for column in result.description}
        expected = sorted(result.fetchall(), key=repr)
    df = QUERIES[name](spark, SF).select(*types)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    assert expected and sorted((tuple(row) for row in df.collect()), key=repr) == expected
