"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from trialframe.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def normal(rows):
    def value(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(map(value, r)) for r in rows), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    found = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    at = [names.index(c) for c in sorted(names)]
    assert sorted(names) == columns
    assert normal(rows) == normal([tuple(r[i] for i in at) for r in found.fetchall()])


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    for f in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = registry.QUERIES[name](spark, str(folder))
    columns = sorted(df.columns)
    found = con.execute(registry.ORACLE_SQL[name])
    at = [[d[0] for d in found.description].index(c) for c in columns]
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert normal(rows) == normal([tuple(r[i] for i in at) for r in found.fetchall()])
    return rows


@pytest.mark.parametrize("name", ["site_sheet", "west_sheet", "studies_json"])
def test_long_keys(spark, tmp_path, name):
    """Keys of which the ids have more than eight digits."""
    keys = "(1), (2), (3), (4), (103), (107), (998), (10300000), (123456789), (123456790), (1234567891)"
    duckdb.execute(f"COPY (SELECT k::BIGINT AS s_suppkey, 'S' || k AS s_name FROM (VALUES {keys}) t(k)) TO '{tmp_path}/supplier.parquet'")
    duckdb.execute(f"COPY (SELECT k::BIGINT AS p_partkey, 'P' || k AS p_name, 'B' || k % 2 AS p_brand, 7 AS p_size FROM (VALUES {keys}) t(k)) TO '{tmp_path}/part.parquet'")
    assert same_as_sql(spark, tmp_path, name)
