"""The driver contract: entry, queries and oracle SQL."""

import duckdb

import __spark_entry__ as E
from bidmill.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"


def test_entry_rows(spark):
    df = E.entry(spark)
    assert df.columns == ["strategy_id", "site_domain_id", "multiplier", "baseline"]
    assert df.count() == 564


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracles_parse_in_duckdb():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.execute(f"explain {sql}")


def _same(spark, name):
    import pandas as pd
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    s = E.queries()[name](spark, SMALL).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    cols = sorted(s.columns)
    assert cols == sorted(d.columns)
    key = lambda df: sorted(map(repr, df[cols].astype(object).where(pd.notna(df[cols]), None)
                                .itertuples(index=False, name=None)))
    return key(s) == key(d)


def test_small_scale_matches(spark):
    for name in ("candidates", "price_dampen", "claim_next", "algos_to_run", "adj_recency",
                 "merged_baselines"):
        assert _same(spark, name), name
