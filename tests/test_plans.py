"""Plan checks: the shapes the design relies on at scale."""

import pytest

import __spark_entry__ as E
from shipyard.operators.dedup import keep_first
from shipyard.sources.raw_files import scan_lines
from tests.conftest import write_gz

SF = "/root/testdata/sf0.001"
WRITES_FILES = {
    "line_numbers", "end_to_end_run", "reference_dims", "stream_bronze", "skip_ingested", "partition_replace", "load_totals",
    "incremental_after_failed_gate", "incremental_gold", "schema_evolution",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.QUERIES) - WRITES_FILES))
def test_no_python_evaluation(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, f"{name} evaluates Python: {node}"


def test_keep_first_combines_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o", "CAST(id AS STRING) AS v")
    plan = plan_of(keep_first(df, ["k"], ["o"]))
    assert "partial_min_by" in plan and plan.index("partial_min_by") > plan.index("Exchange")


def test_sla_lookup_is_broadcast(spark):
    plan = plan_of(E.queries()["shipments"](spark, SF))
    assert "BroadcastExchange" in plan and "LeftOuter" in plan


def test_line_numbering_reads_a_file_once(spark, tmp_path):
    write_gz(tmp_path / "a.json.gz", ["x", "y"])
    plan = plan_of(scan_lines(spark, [str(tmp_path / "a.json.gz")]))
    assert plan.count("FileScan text") == 1
    for node in ("Join", "Exchange", "Window", "Sort"):
        assert node not in plan


def test_the_bronze_gate_reads_no_bronze(spark, wh, tmp_path):
    from shipyard.plans import gates
    from shipyard.sources import bronze
    from shipyard.sources.feeds import CARRIER_A

    write_gz(tmp_path / "raw" / "a.json.gz", ["{}", "oops"])
    bronze.ingest(spark, wh, CARRIER_A, str(tmp_path / "raw"))
    counts = gates.bronze_counts(spark, wh, [CARRIER_A])
    assert [tuple(r) for r in counts.collect()] == [("bronze.carrier_a", 1, 1)]
    assert all("_loads/" in f for f in counts.inputFiles()) and counts.inputFiles()


def test_a_gate_is_one_query(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from shipyard.operators.quality import enforce_quarantine_rates, quarantine_rates

    collected = []
    plain = Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: collected.append(1) or plain(self))
    enforce_quarantine_rates(quarantine_rates([("t", spark.range(100), spark.range(2))]), ["t"])
    assert len(collected) == 1
