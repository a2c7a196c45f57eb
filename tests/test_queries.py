"""Every registered query of the library against its SQL on the smallest tables."""

import pytest
from oracle import SF, duck, rows_of

from tideline.queries import ORACLES, QUERIES


#: Queries whose right answer at the smallest scale is no row.
EMPTY: set[str] = set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    names, rows = rows_of(QUERIES[name](spark, SF).toArrow())
    assert names and len(set(names)) == len(names)
    if name in ORACLES:
        expected_names, expected = duck(ORACLES[name])
        assert names == expected_names
        assert rows == expected
    assert rows or name in EMPTY


def test_entry_collects_queries():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
