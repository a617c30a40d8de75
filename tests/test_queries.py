"""Every registered query against its SQL twin on the smallest tables."""

import __spark_entry__ as entry
import pytest
from compare import difference


def test_every_query_has_a_twin():
    assert set(entry.registry.QUERIES) == set(entry.twins.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.registry.QUERIES))
def test_same_rows(spark, small, name):
    assert difference(spark, entry.queries()[name], entry.oracle_sql()[name], small) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "rid1", "rid2", "similarity"]
    assert df.count() > 0
