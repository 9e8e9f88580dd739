"""Every query with a SQL twin gives the same names, types, rows and values."""

import pytest

from parcelmood.checks import all_queries
from parcelmood.checks.compare import differences, spark_rows

QUERIES, ORACLES = all_queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, small, name):
    frame = QUERIES[name](spark, small)
    assert differences(frame, spark_rows(frame), duck, ORACLES[name]) == []


def test_names_are_queries():
    assert set(ORACLES) <= set(QUERIES)
