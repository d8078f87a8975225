"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows
from conftest import SF_DIR

from __spark_entry__ import entry
from tokenloom.plans.oracles import ORACLES
from tokenloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, con, name):
    ours, sql = QUERIES[name](spark, SF_DIR), ORACLES[name]
    types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
    assert {c: types[t] for c, t in ours.dtypes} == {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert spark_rows(ours) == duck_rows(con, sql)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["w1", "w2", "n"] and df.count() > 0
