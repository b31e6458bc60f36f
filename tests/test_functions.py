import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shipyard.functions.codes import CARRIER_B_STATUS_BY_CODE, is_known_status, python_text, status_from_code
from shipyard.functions.reasons import missing_fields, percent_text, quarantine_rate, record_json
from shipyard.functions.timestamps import hours_between, parse_epoch_millis, parse_iso8601_utc, parse_naive_utc
from shipyard.functions.weights import weight_kg_from_dims


def _one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2026-05-01T10:00:00Z", datetime(2026, 5, 1, 10)),
        ("2026-05-01T10:00:00.123456Z", datetime(2026, 5, 1, 10, 0, 0, 123456)),
        ("2026-05-01T10:00:00.5+02:00", datetime(2026, 5, 1, 8, 0, 0, 500000)),
        ("2026-05-01T10:00:00-0530", datetime(2026, 5, 1, 15, 30)),
        ("2026-05-01T10:00:00+02", datetime(2026, 5, 1, 8)),
        ("2026-05-01 10:00:00", datetime(2026, 5, 1, 10)),
        ("2026-05-01T10:00", datetime(2026, 5, 1, 10)),
        ("2026-05-01T10Z", datetime(2026, 5, 1, 10)),
        ("2026-05-01", datetime(2026, 5, 1)),
        ("not-a-timestamp", None),
        ("2026-02-30T10:00:00Z", None),
        ("2026-05-01T24:00:00Z", None),
        ("2026-05-01T10:00:00Zjunk", None),
        (" 2026-05-01T10:00:00Z", None),
        ("2026-5-1T10:00:00Z", None),
        (None, None),
    ],
)
def test_parse_iso(spark, text, expected):
    assert _one(spark, parse_iso8601_utc, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2026-05-01 10:00:00", datetime(2026, 5, 1, 10)),
        ("2026-5-1 9:3:7", datetime(2026, 5, 1, 9, 3, 7)),
        ("2026-05-01   10:00:00", datetime(2026, 5, 1, 10)),
        ("2026-05-01T10:00:00", None),
        ("2026-05-01 10:00:00Z", None),
        ("2026-13-01 10:00:00", None),
        (None, None),
    ],
)
def test_parse_naive(spark, text, expected):
    assert _one(spark, parse_naive_utc, text) == expected


@pytest.mark.parametrize(
    "millis,expected",
    [
        (1777660336768, datetime(2026, 5, 1, 18, 32, 16, 768000)),
        (0, datetime(1970, 1, 1)),
        (-62135596800000, datetime(1, 1, 1)),
        (-62135596800001, None),
        (253402300799999, datetime(9999, 12, 31, 23, 59, 59, 999000)),
        (253402300800000, None),
        (10**17, None),
    ],
)
def test_parse_millis(spark, millis, expected):
    assert _one(spark, parse_epoch_millis, millis, "bigint") == expected


@pytest.mark.parametrize(
    "dims,expected",
    [
        ('{"weight": 1.56}', 1.56),
        ('{"weight": 2}', 2.0),
        ('{"weight": {"v": 1.92, "u": "kg"}}', 1.92),
        ('{"weight": {"v": 1920, "u": "g"}}', None),
        ('{"weight": {"v": "1.9", "u": "kg"}}', None),
        ('{"weight": "1.5"}', None),
        ('{"weight": null}', None),
        ('{"size": 3}', None),
        ("not json", None),
        (None, None),
    ],
)
def test_weight_from_dims(spark, dims, expected):
    assert _one(spark, weight_kg_from_dims, dims) == expected


def test_codes_and_texts(spark):
    df = spark.createDataFrame([(45, "DELIVERED", None), (77, "weird", "x"), (None, None, None)], "c int, s string, d string")
    rows = df.select(
        status_from_code(F.col("c"), CARRIER_B_STATUS_BY_CODE).alias("st"),
        is_known_status(F.col("s")).alias("known"),
        python_text(F.col("c")).alias("ct"),
        python_text(F.col("d")).alias("dt"),
    ).collect()
    assert [tuple(r) for r in rows] == [("DELIVERED", True, "45", "None"), (None, False, "77", "x"), (None, False, "None", "None")]


def test_missing_fields_and_record_json(spark):
    df = spark.createDataFrame([(None, 1, None), ("a", 2, "b")], "x string, y int, z string")
    rows = df.select(missing_fields(["x", "y", "z"]).alias("m"), record_json(["x", "y", "z"]).alias("j")).collect()
    assert rows[0].m == "x,z" and rows[1].m is None
    assert json.loads(rows[0].j) == {"x": None, "y": 1, "z": None}


def test_rates_and_hours(spark):
    df = spark.createDataFrame([(0, 0), (90, 10), (95, 5)], "l long, q long")
    rows = df.select(quarantine_rate(F.col("l"), F.col("q")).alias("r")).collect()
    assert [r.r for r in rows] == [0.0, 0.1, 0.05]
    assert df.select(percent_text(quarantine_rate(F.col("l"), F.col("q"))).alias("p")).collect()[1].p == "10.0%"
    h = spark.createDataFrame([(datetime(2026, 7, 1, 8, 30), datetime(2026, 7, 2, 8))], "a timestamp_ntz, b timestamp_ntz")
    assert h.select(hours_between(F.col("a"), F.col("b")).alias("h")).first().h == 23.5
