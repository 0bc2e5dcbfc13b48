"""The registration: with everything, and with the optional operators deleted."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as driver
from retentide.plans import catalog

REPO = Path(driver.__file__).parent


def test_queries_and_sql_belong_together():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(catalog.REGISTRY) <= set(driver.oracle_sql())


def test_the_rest_works_without_the_optional_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(catalog.REGISTRY))] * 2 + ["False"], done.stderr[-2000:]
