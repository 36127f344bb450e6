"""Every registered query agrees with its SQL on whole tables."""

import pytest

from fleetmatch.plans.oracles import ORACLES
from fleetmatch.plans.queries import QUERIES
from tests.conftest import SF_DIR
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_entry_has_rows(spark):
    import __spark_entry__

    report = __spark_entry__.entry(spark)
    assert report.columns == ["hostname", "description", "in_a", "in_b", "coverage_status"]
    assert report.count() > 0
