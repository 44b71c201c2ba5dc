"""Every registered query next to its SQL on the smallest driver tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from check_queries import TABLES, cell
from lotwise.plans.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(small_sf):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_sf}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark, small_sf):
    df = entry_points.entry(spark)
    assert df.columns == ["vehicle_brand", "listings", "median_price"] and df.count() == 8


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, small_sf, name):
    df = QUERIES[name](spark, small_sf)
    names = sorted(df.columns)
    got = sorted(tuple(cell(row[n]) for n in names) for row in df.collect())
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    want = [dict(zip(columns, row, strict=True)) for row in result.fetchall()]
    assert names == sorted(columns)
    assert got == sorted(tuple(cell(row[n]) for n in names) for row in want)


COUNTS = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("pipeline_stays", [True, False])
@pytest.mark.parametrize("left", [None, "folder", "package"])
def test_entry_without_the_llm_folders(tmp_path, left, pipeline_stays):
    """The listing queries do not need the subpackage, however it was taken away."""
    repo = Path(entry_points.__file__).parent
    copy = tmp_path / "copy"
    shutil.copytree(repo, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    if not pipeline_stays:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    if left is not None:
        (copy / "lotwise" / "llm").mkdir()
    if left == "package":
        (copy / "lotwise" / "llm" / "__init__.py").touch()
    ran = subprocess.run([sys.executable, "-c", COUNTS], cwd=copy, capture_output=True, text=True, check=True)
    assert ran.stdout.split() == [str(len(QUERIES)), str(len(SQL)), "False"]
