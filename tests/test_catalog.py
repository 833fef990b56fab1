"""Every query against its SQL on the smallest data, and the smoke entry."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from feedloom.plans import catalog, problems

Q = {**catalog.queries(), **problems.queries()}
S = catalog.oracle_sql()


def _cell(v):
    if v is None or (not isinstance(v, list) and pd.isna(v)):
        return ""
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, (int, float)) or type(v).__name__.startswith(("int", "float")):
        # sums of floats depend on their order in the last digits
        return f"{float(v):.12g}"
    if hasattr(v, "isoformat"):
        # the two engines give a day as date or as midnight
        return v.isoformat().removesuffix("T00:00:00")
    return str(v)


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_cell(v) for v in r) for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(Q))
def test_query(spark, small, duck, name):
    got = _rows(Q[name](spark, small).toPandas())
    if name in S:
        assert got == _rows(duck.sql(S[name]).df())


def test_same_rounds_far_apart(spark, tmp_path):
    rows = [(1, "Acme", "Series A", "$5M", "2026-01-01"), (2, "ACME", "Series A", "", "2026-06-01"), (3, "Acme", "", "$5M", "2026-09-01"), (4, "Acme", "Series B", "$5M", "2026-01-02"), (5, "Acme", "", "", "2026-09-03"), (6, "Acme", "", "", ""), (7, "Other", "Series A", "$5M", "2026-01-01")]
    spark.createDataFrame(rows, "pos bigint, company string, stage string, raise_amount string, event_date string").write.parquet(str(tmp_path / "funding_events.parquet"))
    got = sorted(tuple(r) for r in Q["same_rounds"](spark, str(tmp_path)).collect())
    assert got == [(1, 2), (1, 3), (1, 6), (2, 6), (3, 4), (3, 5), (3, 6), (4, 6), (5, 6)]
    c = duckdb.connect()
    c.sql(f"create view funding_events as select * from read_parquet('{tmp_path}/funding_events.parquet/*.parquet')")
    assert got == sorted(c.sql(S["same_rounds"]).fetchall())


def test_entry(spark, small):
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.entry(spark).columns) == 7
