"""Every registered query with an oracle equals DuckDB on the smallest tables."""

import pytest

from suite.compare import differences, oracle_frame
from suite.queries import QUERIES
from suite.sql import ORACLES


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got)
    assert differences(got, oracle_frame(sf, ORACLES[name])) is None
