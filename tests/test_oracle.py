"""Every registered query against its SQL, values and types."""

import pytest

import __spark_entry__ as contract
from tests.compare import compare, connect
from tests.conftest import SF_DIR
from tripweave.oracle import ORACLE
from tripweave.queries import QUERIES

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 60


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    sql = contract.oracle_sql()[name]
    ours, theirs = compare(df, duck, sql)
    assert ours == theirs
    types = {c[0]: str(c[1]) for c in duck.execute(sql).description}
    assert {c: SPARK_TO_DUCK[t] for c, t in df.dtypes} == types
