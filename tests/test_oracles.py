"""Every registered query equals its DuckDB oracle (as the driver checks)."""
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from fleetscope.plans.registry import ORACLES, QUERIES
from oracle_util import compare

NAMES = sorted(ORACLES)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, SF_SMALL, E.oracle_sql()[name])
    assert ok, msg


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() == 47
    assert df.columns == ["device_id", "detected_at", "metric", "observed_value", "rolling_mean",
                          "rolling_std_dev", "z_score", "severity"]
