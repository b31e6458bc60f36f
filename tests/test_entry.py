import os
import shutil
import subprocess
import sys

import __spark_entry__ as E


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLES)
    assert set(E.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    assert all(sql.strip() for sql in E.oracle_sql().values())


def test_the_entry_works_without_the_llm_subpackage(tmp_path):
    """A copy of the library without ``shipyard/llm`` and ``corpus_pipeline.py``."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(f"{root}/shipyard", tmp_path / "shipyard", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as E; assert set(E.queries()) == set(E.QUERIES) and set(E.oracle_sql()) == set(E.ORACLES)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_entry_runs_on_the_smallest_tables(spark):
    df = E.entry(spark)
    assert df.columns == ["carrier_code", "resolved_parcels", "on_time_rate"]
    assert df.count() > 0
