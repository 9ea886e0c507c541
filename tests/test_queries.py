"""Every query with SQL gives DuckDB's rows on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from boxmill.queries import QUERIES, SQL

NAMES = list(SQL)


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    plain = frame.apply(lambda c: c.astype(float) if pd.api.types.is_numeric_dtype(c) and not pd.api.types.is_bool_dtype(c) else c)
    return sorted(map(tuple, plain.astype(str).replace({"<NA>": "nan", "None": "nan"}).to_numpy().tolist()))


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, sf_dir, db, name):
    got, expected = QUERIES[name](spark, sf_dir).toPandas(), db.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(expected) > 0
    assert rows(got) == rows(expected)
