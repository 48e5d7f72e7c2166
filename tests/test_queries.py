"""Every registered query: against its SQL where it has one, else that it gives rows."""

import pytest
from conftest import same

from strandline.plans import registry

registry.load_all()
SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf, duck):
    same(registry.queries()[name](spark, sf).toPandas(), duck.sql(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_runs(name, spark, sf):
    """Rows are there; what they should be is in test_learned.py and test_operators.py."""
    assert registry.queries()[name](spark, sf).toPandas().shape[0] > 0
