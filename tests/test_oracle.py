"""Every registered query equals its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from cohortlens.plans.catalog import QUERIES
from cohortlens.sources.tables import TABLE_NAMES
from tools.compare import frame_rows

from .conftest import SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries())
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    import pandas as pd

    sdf = entry.queries()[name](spark, SMALL)
    got = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert frame_rows(got) == frame_rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "closed_month" in df.columns


def test_oracle_takes_nothing_from_the_engine():
    from pathlib import Path

    import cohortlens.plans.oracle as oracle

    for name in ("oracle.py", "oracle_inputs.py"):
        text = (Path(oracle.__file__).parent / name).read_text()
        assert "operators" not in text and "functions" not in text
