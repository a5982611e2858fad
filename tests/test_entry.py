"""Driver contract: entry() smoke run and registered pairs."""

import __spark_entry__ as E
from landfall.plans.file_jobs import NESTED_ORDER


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == NESTED_ORDER
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
