"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest scale factor so the suite stays quick."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tools.oracle_check import canon, duck  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402

from conftest import SF001  # noqa: E402

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


# Spark type name -> DuckDB type name of the same column
DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF001)
    sql = oracle_sql().get(name)
    if sql is not None:
        duck_types = {c[0]: str(c[1]) for c in con.execute(sql).description}
        for field in df.schema.fields:
            spark_type = field.dataType.simpleString()
            assert DUCK_TYPE.get(spark_type, spark_type.upper()) == duck_types.get(field.name), field.name
    got = df.toPandas()
    assert len(got.columns) == len(set(got.columns))
    if sql is None:
        assert len(got) >= 0
        return
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canon(got, 9) == canon(want, 9)
