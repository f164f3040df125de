import pytest
from conftest import SMALL, same_rows

from folioflow.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    same_rows(catalog.queries()[name](spark, SMALL), catalog.oracle_sql()[name], SMALL)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalog.queries()[name](spark, SMALL).count() > 0


def test_entry():
    import __spark_entry__ as entry

    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
