import pytest
from compare import check

from linkforge.llm import queries as q


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_query_equals_sql(spark, small, name):
    check(spark, q.QUERIES[name], q.SQL[name], small)


def test_one_query_per_operator():
    import __spark_entry__ as e

    assert sorted(int(n[2:].split("_")[0]) for n in q.QUERIES if n.startswith("op")) == list(range(1, 11))
    assert {*q.QUERIES, "pipeline"} <= {*e.queries()}
