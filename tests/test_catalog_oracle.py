"""Every registered query against its DuckDB oracle (the driver's gate)."""

import pytest

from agora.plans import catalog
from tests.conftest import SF_CHECK
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_CHECK)
    if name not in catalog.ORACLE:
        assert df.count() >= 0
        pytest.skip("no SQL oracle for this query (rows-only)")
    n = compare(df, con, catalog.ORACLE[name])
    assert n > 0, "query returned no rows on the check tables"


def test_every_query_has_oracle_or_reason():
    missing = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert missing <= catalog.NO_ORACLE, missing


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["author_id", "user_num_active_in_week"]
    assert df.count() > 0
