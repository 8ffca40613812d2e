"""Every query against DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from tickframe.plans import registry

from .conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(frame: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if not isinstance(x, (list, str)) and pd.isna(x):
            return ""
        if isinstance(x, float):
            return f"{round(x, 9) + 0.0:g}" if abs(x) < 1e5 else f"{x:.6f}".rstrip("0").rstrip(".")
        return str(x)

    cols = sorted(frame.columns)
    return sorted(tuple(cell(v) for v in row) for row in frame[cols].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    got = registry.queries()[name](spark, SMALL).toPandas()
    want = duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
