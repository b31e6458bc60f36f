from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shipyard import schemas
from shipyard.plans import gold
from shipyard.plans.sql_access import QueryNotAllowedError, describe_view, first_rows, gold_query_session, open_query_session, query_frame, run_query, schema_markdown, validate_sql



@pytest.fixture(scope="module")
def views(spark):
    """A query session whose views are empty."""
    shapes = {"shipments": schemas.SHIPMENTS, "dim_carriers": schemas.DIM_CARRIERS, "dim_organisations": schemas.DIM_ORGANISATIONS}
    return open_query_session(spark, {name: (lambda s, x=shape: s.createDataFrame([], x)) for name, shape in shapes.items()})


ALLOWED = """
SELECT sla_hours, avg(transit_hours) FROM shipments GROUP BY sla_hours HAVING count(*) > 2
SELECT * FROM (SELECT *, rank() OVER (PARTITION BY carrier_code ORDER BY transit_hours) AS r FROM shipments) WHERE r < 3
VALUES (1, ';'), (2, 'DROP VIEW shipments')
SELECT explode(countries_served) AS land FROM dim_carriers MINUS SELECT country FROM dim_organisations
SELECT o.plan FROM dim_organisations o LEFT ANTI JOIN shipments s USING (organisation_id)
WITH slow AS (SELECT * FROM shipments WHERE NOT is_on_time), worst AS (SELECT max(transit_hours) AS h FROM slow) SELECT slow.* FROM slow, worst WHERE transit_hours = h
WITH shipments AS (SELECT * FROM shipments WHERE is_lost) SELECT count(*) FROM shipments
SELECT (WITH c AS (SELECT 1 AS one) SELECT one FROM c) AS x, EXISTS (SELECT 1 FROM dim_carriers) AS y
WITH RECURSIVE up(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM up WHERE n < 4) SELECT * FROM up
"""

REFUSED = """
TRUNCATE TABLE shipments
MERGE INTO shipments USING dim_carriers ON true WHEN MATCHED THEN DELETE
CREATE OR REPLACE TEMPORARY VIEW shipments AS SELECT 1
CACHE TABLE shipments
SET spark.sql.runSQLOnFiles = true
ADD JAR '/tmp/x.jar'
FROM shipments INSERT OVERWRITE DIRECTORY '/tmp/out' USING csv SELECT *
EXPLAIN SELECT * FROM shipments
SHOW TABLES
SELECT try_reflect('java.lang.Runtime', 'getRuntime')
SELECT * FROM orc.`/etc`
SELECT * FROM staging.shipments
SELECT count(*) FROM shipments JOIN payroll USING (organisation_id)
SELECT 1 WHERE 1 IN (SELECT n FROM ledger)
WITH ledger AS (SELECT * FROM ledger) SELECT * FROM ledger
WITH a AS (SELECT * FROM b), b AS (SELECT 1 AS n) SELECT * FROM a
SELECT (WITH inside AS (SELECT 1 AS n) SELECT n FROM inside) AS n, i.* FROM inside i
WITH x AS (SELECT 1 AS n) SELECT * FROM x UNION ALL (WITH y AS (SELECT * FROM y) SELECT * FROM y)
"""


@pytest.mark.parametrize("sql", ALLOWED.strip().splitlines())
def test_queries_over_the_views_are_allowed(views, sql):
    validate_sql(views, sql)


@pytest.mark.parametrize("sql", REFUSED.strip().splitlines())
def test_other_statements_and_relations_are_refused(views, sql):
    with pytest.raises(QueryNotAllowedError):
        validate_sql(views, sql)


@pytest.mark.parametrize(("sql", "reason"), [("", "no statement"), (" \n ", "no statement"), ("VALUES 1; VALUES 2", "2 statements"), ("CHOOSE * OF shipments", "not valid SQL")])
def test_reasons(views, sql, reason):
    with pytest.raises(QueryNotAllowedError, match=reason):
        validate_sql(views, sql)


def test_a_refused_command_is_not_run(views):
    for sql in ("DROP VIEW dim_carriers", "CREATE TEMPORARY VIEW extra AS SELECT 1", "SET a.b = c"):
        with pytest.raises(QueryNotAllowedError):
            validate_sql(views, sql)
    assert views.table("dim_carriers").count() == 0 and views.conf.get("a.b", None) is None
    with pytest.raises(AnalysisException):
        views.table("extra")


def test_other_sessions_keep_their_functions(spark, views):
    assert spark.sql("SELECT reflect('java.lang.Math', 'abs', -3) AS x").first().x == "3"


def seed(spark, wh, n):
    filled = {"parcel_id": F.col("id").cast("int"), "tracking_number": F.concat(F.lit("N"), "id"), "organisation_id": F.lit(8), "carrier_code": F.lit("carrier_b")}
    filled |= {"is_delivered": F.lit(True), "_gold_loaded_at": F.lit(datetime(2025, 12, 1)).cast("timestamp_ntz")}
    columns = [filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in gold.SHIPMENTS_STORED.fields]
    wh.overwrite(spark.range(1, n + 1).select(*columns), gold.SHIPMENTS_TABLE, ["handed_over_month"])


def test_results_and_errors(spark, wh):
    seed(spark, wh, 3)
    wh.overwrite(spark.createDataFrame([("carrier_b", "Meridian", 60, ["BE"], 1)], gold.CARRIERS_STORED), gold.CARRIERS_TABLE)
    session = gold_query_session(spark, wh)
    got = run_query(session, "SELECT carrier_name, max(parcel_id) AS newest FROM shipments JOIN dim_carriers USING (carrier_code) GROUP BY carrier_name")
    assert (got.columns, got.rows, got.row_count, got.truncated) == (["carrier_name", "newest"], [("Meridian", 3)], 1, False)
    with pytest.raises(AnalysisException, match="no_such_column"):
        run_query(session, "SELECT no_such_column FROM shipments")
    with pytest.raises(QueryNotAllowedError):
        run_query(session, "SELECT * FROM dim_organisations")  # not built yet
    spark.range(3).write.mode("overwrite").saveAsTable("hidden_numbers")
    try:
        for sql in ("SELECT * FROM hidden_numbers", "WITH hidden_numbers AS (SELECT * FROM hidden_numbers) SELECT * FROM hidden_numbers"):
            with pytest.raises(QueryNotAllowedError):
                run_query(session, sql)
    finally:
        spark.sql("DROP TABLE hidden_numbers")


def test_a_limit_is_the_caller_s_and_says_so(spark, wh):
    seed(spark, wh, 230)
    session = gold_query_session(spark, wh)
    sql = "SELECT parcel_id FROM shipments ORDER BY parcel_id DESC"
    assert query_frame(session, sql).count() == 230
    for limit, truncated in ((229, True), (230, False), (231, False), (1, True)):
        got = run_query(session, sql, limit)
        assert got.rows == [(230 - k,) for k in range(min(limit, 230))] and got.truncated is truncated
        assert first_rows(session, sql, limit).columns == ["parcel_id", "truncated"]
    assert run_query(session, sql).row_count == 200  # the default of a reader
    assert run_query(session, "SELECT 1 AS x WHERE false").rows == []


def test_documentation(spark, wh):
    seed(spark, wh, 1)
    described = {name: text for name, _, text in describe_view(gold_query_session(spark, wh), "shipments")}
    assert described["transit_hours"].startswith("hours from hand-over")
    document = schema_markdown()
    for schema in (schemas.SHIPMENTS, schemas.DIM_CARRIERS, schemas.DIM_ORGANISATIONS):
        assert all(f"| {f.name} | {f.dataType.simpleString()} |" in document for f in schema.fields)
