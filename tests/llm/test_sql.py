"""Every query that SQL can express, against its SQL."""

import pytest

from checks.compare import differences, views
from demandlens.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("key", ORACLE)
def test_matches_sql(spark, sf_dir, key):
    assert differences(QUERIES[key](spark, sf_dir), views(sf_dir), ORACLE[key]) == []
