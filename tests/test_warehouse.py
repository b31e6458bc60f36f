from datetime import date

import pytest
from pyspark.sql import functions as F

from shipyard import warehouse
from shipyard.session import checkpoint_dir, is_local_master, one_file_per_task
from shipyard.warehouse import Warehouse


def test_overwrite_counts_rows_also_when_empty_and_partitioned(spark, wh):
    rows = spark.range(5).select(F.col("id"), (F.col("id") % 2).cast("string").alias("p"))
    assert wh.overwrite(rows, "silver.t", ["p"]) == 5
    assert wh.overwrite(rows.where("id < 0"), "silver.t", ["p"]) == 0
    assert wh.exists(spark, "silver.t")
    assert wh.read(spark, "silver.t", rows.schema).count() == 0


def test_partitions_are_listed_dropped_and_replaced(spark, wh):
    rows = spark.createDataFrame([(1, "a b+c/d=1"), (2, "x")], "id int, f string")
    wh.overwrite(rows, "bronze.t", ["f"])
    assert sorted(wh.partition_values(spark, "bronze.t", "f")) == ["a b+c/d=1", "x"]
    wh.drop_partitions(spark, "bronze.t", "f", ["a b+c/d=1", "absent"])
    assert [r.id for r in wh.read(spark, "bronze.t", rows.schema).collect()] == [2]
    wh.replace_partitions(spark.createDataFrame([(3, "x")], rows.schema), "bronze.t", "f")
    assert [r.id for r in wh.read(spark, "bronze.t", rows.schema).collect()] == [3]
    more = wh.read(spark, "bronze.t", rows.schema).selectExpr("id + 1 AS id", "'y' AS f")  # reads what it changes
    wh.replace_partitions(more, "bronze.t", "f", emptied=["x", "absent"])
    assert [tuple(r) for r in wh.read(spark, "bronze.t", rows.schema).collect()] == [(4, "y")]
    wh.drop(spark, "bronze.t")
    assert wh.partition_values(spark, "bronze.t", "f") == [] and not wh.exists(spark, "bronze.t")


def test_a_failed_overwrite_keeps_the_old_table(spark, wh):
    wh.overwrite(spark.range(3), "silver.t")
    with pytest.raises(Exception, match="(?i)zero"):
        wh.overwrite(spark.range(9).selectExpr("id / (id - id) AS id", "raise_error('zero') AS x"), "silver.t")
    assert wh.read(spark, "silver.t", spark.range(1).schema).count() == 3
    wh.overwrite(wh.read(spark, "silver.t", spark.range(1).schema).selectExpr("id + 1 AS id"), "silver.t")
    assert sorted(r.id for r in wh.read(spark, "silver.t", spark.range(1).schema).collect()) == [1, 2, 3]


@pytest.mark.parametrize("step", [1, 2])
def test_an_interrupted_overwrite_is_finished(spark, wh, monkeypatch, step):
    wh.overwrite(spark.range(3), "silver.t")
    plain, calls = warehouse._rename, []

    def dies(fs, a, b):
        calls.append(1)
        if len(calls) == step:
            raise RuntimeError("stopped")
        plain(fs, a, b)

    with monkeypatch.context() as m:
        m.setattr(warehouse, "_rename", dies)
        with pytest.raises(RuntimeError):
            wh.overwrite(spark.range(5), "silver.t")
    wh.recover(spark, "silver.t")
    assert wh.read(spark, "silver.t", spark.range(1).schema).count() == 5


def test_a_root_with_pattern_characters(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "w[1]{a,b}*?"))
    rows = spark.createDataFrame([(n, date(2025, 1, 1 + n)) for n in range(5)], "id int, d date")
    wh.overwrite(rows, "silver.days", ["d"])
    assert wh.read(spark, "silver.days", rows.schema).count() == 5
    assert wh.read(spark, "silver.absent", rows.schema).count() == 0


def test_a_read_that_fails_raises(spark, wh, tmp_path):
    path = tmp_path / "warehouse" / "silver" / "broken"
    path.mkdir(parents=True)
    (path / "part-0.parquet").write_text("this is no Parquet file")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic"):
        wh.read(spark, "silver.broken", spark.range(1).schema).collect()


class FakeContext:
    def __init__(self, master):
        self.master = master

    def getConf(self):  # noqa: N802
        return self

    def get(self, key, default=None):
        return default


class FakeSession:
    def __init__(self, master):
        self.sparkContext, self.conf = FakeContext(master), FakeContext(master)


def test_a_cluster_needs_a_shared_folder():
    assert is_local_master("local") and is_local_master("local[4]")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(FakeSession(master))


def test_session_copy_keeps_settings(spark):
    copy = one_file_per_task(spark)
    assert copy.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert copy.conf.get("spark.sql.files.openCostInBytes") != spark.conf.get("spark.sql.files.openCostInBytes")
