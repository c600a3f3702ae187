"""Every registered query against its DuckDB oracle on the smallest tables,
plus the entry() smoke check."""

import pytest

from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].completed_orders > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")}
    assert not bad, bad
    from fixtures.catalog import QUERIES
    no_oracle = sorted(k for k, v in res.items() if v[0] == "NO_ORACLE" and k in QUERIES)
    assert no_oracle == []


@pytest.mark.parametrize("name", ["kpi_summary", "quarantine_audit", "order_journey"])
def test_whole_tables_no_row_caps(spark, name):
    """Registered queries run over whole tables: the lifecycle fact covers
    every order that is not quarantined."""
    import __spark_entry__ as E
    assert E.queries()[name](spark, SF).count() >= 1
