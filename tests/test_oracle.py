"""Every registered query against the same question in DuckDB SQL."""

import os

import pytest

import registry
from registry_sql import ORACLE
from tests.compare import duck_rows, spark_rows

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows(spark, name):
    got_names, got = spark_rows(registry.QUERIES[name](spark, FOLDER))
    if name not in ORACLE:
        assert got
        return
    want_names, want = duck_rows(ORACLE[name], FOLDER)
    assert got_names == want_names
    assert len(got) == len(want)
    assert got == want


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(registry.QUERIES)
