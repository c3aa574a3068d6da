"""Every catalogue query against its DuckDB oracle (sf0.001, whole tables)."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from gasledger.plans.catalog import queries
from gasledger.plans.oracle import oracle_sql
from tools.compare import TABLES, rows_of

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = set(queries()) - set(oracle_sql())
    assert rows_only == {"metrics_report"}
    assert set(oracle_sql()) <= set(queries())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    got, gcols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(oracle_sql()[name])
    want, wcols = rows_of(rel.columns, rel.fetchall())
    assert gcols == wcols
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["date", "address", "gas_cost_wei", "gas_cost_eth", "ma7_wei", "ma7_gwei", "cum_eth"]


def test_report_rows(spark):
    df = queries()["metrics_report"](spark, SF_SMALL)
    rows = df.collect()
    assert len(rows) == df.select("address").distinct().count() > 0
    assert all(r.json.startswith('{"address":') for r in rows)


@pytest.mark.parametrize("name", ["combined_all_wallets", "transfers_flat", "stream_daily_gas", "month_partitions"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = queries()[name](spark, SF_SMALL)
        got, _ = rows_of(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    rel = duck.sql(oracle_sql()[name])
    want, _ = rows_of(rel.columns, rel.fetchall())
    assert got == want
