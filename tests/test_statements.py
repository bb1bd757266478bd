"""Registered queries against their DuckDB statements, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from loomline.plans import samples

TABLES = Path("/root/testdata/sf0.001")


def compared(rows: list[dict]) -> list[str]:
    """Rows as sorted texts, columns by name; numbers alike whatever their width."""
    return sorted(repr([(k, float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v) for k, v in sorted(row.items())]) for row in rows)


@pytest.fixture(scope="module")
def oracle():
    if not TABLES.is_dir():
        pytest.skip("no tables")
    db = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


@pytest.mark.parametrize("name", sorted(samples.QUERIES))
def test_statement(spark, oracle, name):
    found = compared([x.asDict(recursive=True) for x in samples.QUERIES[name](spark, str(TABLES)).collect()])
    wanted = oracle.execute(samples.ORACLE_SQL[name])
    columns = [x[0] for x in wanted.description]
    wanted = compared([dict(zip(columns, row, strict=True)) for row in wanted.fetchall()])
    assert found and found == wanted
