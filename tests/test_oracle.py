"""Registered queries beside their SQL at the smallest scale. ``verify.py`` runs all of them at any scale."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
import verify
from catalog import load

QUICK = [
    "recon_gaps", "unmatched_contributions", "prod_settlement", "prod_indodana", "issuer_linkaja_msme", "file_bank_mandiri",
    "bank_linkaja", "desc_route", "cutoff_shift", "join_reversal_fanout", "group_by_rate", "sum_of_rounded",
    "datetime_id", "mdr_percent", "time_btn", "fmt_mandiri", "fmt_bri", "fmt_bank_btn", "load_quarantine",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in verify.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    queries, oracles = load()
    assert set(queries) == set(oracles)
    assert set(queries) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_same_as_oracle(spark, con, name):
    text, _, ok = verify.compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, text
