"""Every registered query against its SQL, on the smallest tables."""

import inspect
from pathlib import Path

import pytest

import check_oracle
from __spark_entry__ import entry, oracle_sql, queries
from zonarium.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# No row at this size.
MAY_BE_EMPTY = {"q_retrieve_eio"}


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, name):
    ok, message = check_oracle.compare(spark, con, name, SF_DIR)
    assert ok or (name in MAY_BE_EMPTY and message.startswith("0 rows")), message


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["buildingid", "zonename", "variablename", "datetime", "value"]
    assert df.count() > 0


def test_no_python_functions_in_the_package():
    root = Path(inspect.getfile(check_oracle)).parent / "zonarium"
    for file in set(root.rglob("*.py")) - set(root.glob("llm/*.py")):
        text = file.read_text()
        for word in ("pandas_udf", "F.udf", "mapInPandas", ".rdd", "crossJoin", "localCheckpoint"):
            assert word not in text, (file, word)
