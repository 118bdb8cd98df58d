import re

import __spark_entry__ as entry
from tonality.llm import queries


def test_one_query_an_operator_and_the_pipeline():
    names = entry.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.ORACLE) <= set(entry.oracle_sql())
