import gzip
import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shipyard.session import build_session  # noqa: E402
from shipyard.warehouse import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        "shipyard-tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shipyard-test-ckpt-"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def wh(tmp_path):
    return Warehouse(str(tmp_path / "warehouse"))


def write_gz(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as fh:
        for line in lines:
            fh.write((line if isinstance(line, str) else json.dumps(line)) + "\n")


def write_jsonl(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")
