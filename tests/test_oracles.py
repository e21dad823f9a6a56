"""Every registered query with an oracle equals its DuckDB SQL on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, duck  # noqa: E402

from .conftest import SMALL  # noqa: E402

KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_oracle(spark, con, key):
    msg = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SMALL)
    assert ": OK " in msg or ": CLOSE " in msg, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 22


def test_every_key_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
