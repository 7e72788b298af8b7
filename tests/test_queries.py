"""Every registered query: against its SQL check, or for its rows."""

import pytest

from compare import differences
from corpusmill.plans.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(name, spark, sf_dir, duck_con):
    assert differences(QUERIES[name](spark, sf_dir), duck_con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0
