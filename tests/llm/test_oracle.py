"""The queries that SQL can express equal their DuckDB SQL on whole tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_check import compare  # noqa: E402

from cardsentry.llm.oracle_sql import ORACLE  # noqa: E402
from cardsentry.llm.queries import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(name, spark, "/root/testdata/sf0.01", QUERIES, ORACLE)
    assert r["ok"], r
