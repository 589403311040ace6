"""Every SQL-expressible registered query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from zonecast import plans
from tests.compare import canon, duck, run_duck
from tests.conftest import SF_SMALL

ORACLE = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = plans.queries()[key](spark, SF_SMALL)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    d_cols, d_rows = canon(*run_duck(con, ORACLE[key]))
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["window_start", "window_end", "pu_location_id"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_known_rows_only():
    rows_only = {"train_metrics", "predict_zones_gbt", "predict_trips"}
    assert set(plans.queries()) - set(ORACLE) == rows_only
