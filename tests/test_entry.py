"""Driver contract and plan shape of the flagship query."""

from conftest import plan_text
import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_contract_keys():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert df.columns[-3:] == ["v_supp__max_qty", "v_supp__n_lines", "v_ps__max_price"]


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.mark.parametrize("name", sorted(k for k in E.oracle_sql() if not k.startswith("op")))
def test_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    exp = con.execute(E.oracle_sql()[name]).fetchall()
    cols = [d[0] for d in con.description]
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    idx = [df.columns.index(c) for c in cols]
    got = [tuple(r[i] for i in idx) for r in df.collect()]
    # as multisets over the same column order
    assert sorted(got, key=repr) == sorted(exp, key=repr)


def test_scan_plan_shape(spark):
    df = E.queries()["pit_ttl_1d"](spark, SF)
    plan = plan_text(df)
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    assert "PushedFilters" in plan and "LessThanOrEqual(ts" in plan
