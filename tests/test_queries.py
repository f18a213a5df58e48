"""Every registered query of the screening engine against its SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from terrasift.plans import catalog

from .conftest import SMALL


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS FROM '{SMALL}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    want = db.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = catalog.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.fetchall())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES.keys() - catalog.ORACLE_SQL.keys()))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 25
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_rest_works_without_the_optional_part(tmp_path):
    """The registry and the engine import where terrasift/llm and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "terrasift", tmp_path / "terrasift", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') and k[2].isdigit() for k in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert out.stdout.split()[-1:] == ["False"], out.stderr
