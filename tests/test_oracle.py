"""Every registered query against its DuckDB twin on the smallest tables."""

import math
import os

import duckdb
import pytest

from tillroll.plans.oracle import oracle_sql
from tillroll.plans.queries import QUERIES, registered
from tillroll.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(table_path(SF, t)):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


def norm(rows, order):
    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else float(f"{x:.9g}")
        return x.isoformat() if hasattr(x, "isoformat") else x
    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


SPARK_TO_SQL = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, con, name):
    df = registered()[name](spark, SF)
    cols = df.columns
    rel = con.sql(oracle_sql()[name])
    assert {c: SPARK_TO_SQL.get(t, t) for c, t in df.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    spark_rows = norm([tuple(r) for r in df.collect()], sorted(range(len(cols)), key=lambda i: cols[i]))
    duck_rows = norm(res.fetchall(), sorted(range(len(dcols)), key=lambda i: dcols[i]))
    assert spark_rows == duck_rows
