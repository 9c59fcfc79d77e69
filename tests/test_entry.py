import os
import shutil
import subprocess
import sys
import textwrap
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent
DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    return value.replace(tzinfo=None).isoformat() if hasattr(value, "tzinfo") else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


OWN = sorted(entry._own.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(plain(dict(zip(names, r))[c]) for c in columns) for r in cursor.fetchall())
    assert sorted(names) == columns and got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_everything_else_works_without_the_optional_parts(tmp_path):
    code = """
        import sys, importlib.abc
        class Gone(importlib.abc.MetaPathFinder):
            def find_spec(self, name, path=None, target=None):
                if name.startswith("gridloom.llm") or name == "corpus_pipeline":
                    raise ImportError(name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert len(e.queries()) > 50 and not [q for q in e.queries() if q.startswith("op") or q == "pipeline"], list(e.queries())
        assert set(e.oracle_sql()) <= set(e.queries())
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, check=True, timeout=120)


def test_a_copy_without_the_optional_folders_runs(tmp_path):
    """The folders deleted, the rest imports, lists its queries and answers one."""
    for part in ("gridloom", "__spark_entry__.py"):
        source = ROOT / part
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / part)
    code = f"""
        from pyspark.sql import SparkSession
        import __spark_entry__ as e
        assert len(e.queries()) > 50 and not [q for q in e.queries() if q.startswith("op") or q == "pipeline"]
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        assert e.queries()["upsert_full"](spark, {DIR!r}).count() > 0
        assert e.queries()["month_from_title"](spark, {DIR!r}).count() > 0
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, check=True, timeout=240)
