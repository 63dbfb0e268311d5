"""The registered queries against their SQL on the smallest data, and the contract of the entry module."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from strandwise.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    r = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = Counter(tuple(plain(row[i]) for i in at) for row in r.fetchall())
    assert Counter(tuple(plain(v) for v in row) for row in df.select(*cols).collect()) == want


def test_every_sql_has_a_query_and_the_entry_runs(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["entity_id", "relation_count"]


def test_nothing_else_needs_the_training_data_folder():
    code = "import sys, importlib.abc\nclass No(importlib.abc.MetaPathFinder):\n    def find_spec(self, n, p=None, t=None):\n        if n.startswith('strandwise.llm'): raise ImportError(n)\nsys.meta_path.insert(0, No())\nimport __spark_entry__ as e, bench\nassert 'p1_found' in e.queries() and 'p2_found' not in e.queries()"
    root = Path(__file__).parent.parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_a_fault_inside_the_training_data_folder_is_raised(tmp_path):
    import shutil

    root = Path(__file__).parent.parent
    if not (root / "strandwise" / "llm").exists():
        pytest.skip("the folder is absent")
    shutil.copytree(root / "strandwise", tmp_path / "strandwise")
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "strandwise" / "llm" / "queries.py").write_text("import no_such_module_anywhere\n")
    code = "import __spark_entry__ as e\ntry:\n    e.queries()\nexcept ImportError:\n    print('raised')"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.stdout.strip() == "raised", done.stderr
    shutil.rmtree(tmp_path / "strandwise" / "llm")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print('p2_found' in e.queries(), 'p1_found' in e.queries())"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.stdout.strip() == "False True", done.stderr
