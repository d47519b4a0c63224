"""Every query of the subpackage that has SQL gives the rows of that SQL."""

import pytest

from lexquarry.llm import catalog
from oracle import DATA, compare


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    ours, theirs = compare(spark, name, catalog.queries()[name], catalog.oracle_sql()[name], f"{DATA}/sf0.001")
    assert ours == theirs
