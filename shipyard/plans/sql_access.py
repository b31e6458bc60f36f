"""Guarded, read-only Spark SQL over the three gold views.

Only ``shipments``, ``dim_carriers`` and ``dim_organisations`` are registered,
in a fresh session (``spark.newSession()``) that has no other temp views, cannot
read files by path and lacks the functions that run JVM code. Spark parses and
analyses a statement in that session without running it. The analysed plan,
subquery plans included, must consist of query operators down to its leaves, and
the only tables it may reach are the registered views.

``query_frame`` is the whole result. Where somebody reads the rows, the caller
names a row limit, and ``truncated`` tells whether there were more.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shipyard.plans import gold
from shipyard.warehouse import Warehouse

DEFAULT_ROW_LIMIT = 200

GOLD_VIEWS: dict[str, Callable] = {
    "shipments": gold.shipments,
    "dim_carriers": gold.dim_carriers,
    "dim_organisations": gold.dim_organisations,
}
GOLD_TABLES = {
    "shipments": gold.SHIPMENTS_TABLE,
    "dim_carriers": gold.CARRIERS_TABLE,
    "dim_organisations": gold.ORGANISATIONS_TABLE,
}

# Operators of an analysed read-only query, leaves last.
QUERY_NODES = frozenset(
    {
        "Project", "Filter", "Aggregate", "Join", "LateralJoin", "Union", "Intersect", "Except", "Distinct",
        "Deduplicate", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Tail", "Sample", "SubqueryAlias", "Window",
        "Generate", "Expand", "Pivot", "ResolvedHint", "RepartitionByExpression", "WithCTE", "CTERelationDef",
        "UnionLoop", "UnionLoopRef", "CTERelationRef", "OneRowRelation", "LocalRelation",
    }
)
# Functions that call into the JVM; a query session lacks them.
DENIED_FUNCTIONS = ("java_method", "reflect", "try_reflect")
# Conditions of a failed analysis that mean "not within these views".
OUT_OF_REACH = {"TABLE_OR_VIEW_NOT_FOUND": "there is no such view here", "UNRESOLVED_ROUTINE": "there is no such function here"}


class QueryNotAllowedError(Exception):
    """The SQL is not a single read-only query over the gold views."""


@dataclass
class QueryResult:
    columns: list[str]
    rows: list[tuple]
    row_count: int
    truncated: bool


# ------------------------------------------------------------------ session
def open_query_session(spark: SparkSession, views: dict[str, Callable[[SparkSession], DataFrame]]) -> SparkSession:
    """A new session holding only ``views`` (name -> builder taking the session)."""
    session = spark.newSession()
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    functions = session._jsparkSession.sessionState().functionRegistry()
    for name in DENIED_FUNCTIONS:
        functions.dropFunction(session._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier.apply(name))
    for name, build in views.items():
        build(session).createOrReplaceTempView(name)
    return session


def gold_query_session(spark: SparkSession, wh: Warehouse) -> SparkSession:
    """Register the gold tables that exist; a table not built yet is left out."""
    present = {
        name: (lambda s, f=fn: f(s, wh))
        for name, fn in GOLD_VIEWS.items()
        if wh.exists(spark, GOLD_TABLES[name])
    }
    return open_query_session(spark, present)


# -------------------------------------------------------------------- guard
def _parse(spark: SparkSession, sql: str):
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)


def _parses(spark: SparkSession, sql: str) -> bool:
    try:
        _parse(spark, sql)
        return True
    except Exception:  # noqa: BLE001 - any parser failure means "not a statement"
        return False


def count_statements(spark: SparkSession, sql: str) -> int | None:
    """Number of ';'-separated statements, using Spark's parser to find the
    boundaries (a ';' inside a literal never closes a parseable prefix).
    None when the text does not split into parseable statements."""
    rest, n = sql, 0
    while rest.strip():
        if _parses(spark, rest):
            return n + 1
        cut = None
        for i, ch in enumerate(rest):
            if ch == ";" and _parses(spark, rest[:i]):
                cut = i
                break
        if cut is None:
            return None
        n += 1
        rest = rest[cut + 1 :]
        while rest.strip().startswith(";"):
            rest = rest.strip()[1:]
    return n


def _analysed(session: SparkSession, parsed):
    """The analysed plan of a parsed statement; a command is not run."""
    skip = session._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()
    return session._jsparkSession.sessionState().executePlan(parsed, skip).analyzed()


def _check(plan, views: set[str]) -> None:
    """Raise unless all of ``plan`` above the registered views is a query."""
    kind = plan.getClass().getSimpleName()
    if kind == "View" and plan.isTempView():
        if plan.desc().identifier().table().lower() in views:
            return
        raise QueryNotAllowedError(f"there is no view {plan.desc().identifier().table()} here")
    if kind not in QUERY_NODES:
        raise QueryNotAllowedError(f"only queries of the views may run here, not {kind}")
    for below in (plan.children(), plan.subqueries()):
        for i in range(below.size()):
            _check(below.apply(i), views)


def validate_sql(session: SparkSession, sql: str) -> None:
    """Raise ``QueryNotAllowedError`` unless ``sql`` is one read-only query that
    reads only the views of ``session`` (``open_query_session``). A query that
    Spark cannot analyse for another reason (an unknown column, say) raises Spark's error."""
    if not (sql or "").strip():
        raise QueryNotAllowedError("there is no statement to run")
    try:
        parsed = _parse(session, sql)
    except Exception as exc:  # noqa: BLE001
        n = count_statements(session, sql)
        if n is not None and n > 1:
            raise QueryNotAllowedError(f"{n} statements given; send one at a time") from None
        message = str(exc).strip() or type(exc).__name__
        raise QueryNotAllowedError(f"not valid SQL: {message.splitlines()[0]}") from None
    kinds = session._jvm.java.lang.Class
    if any(kinds.forName(f"org.apache.spark.sql.catalyst.plans.logical.{kind}").isInstance(parsed) for kind in ("Command", "ParsedStatement")):
        raise QueryNotAllowedError(f"only queries of the views may run here, not {parsed.getClass().getSimpleName()}")
    try:
        plan = _analysed(session, parsed)
    except AnalysisException as exc:
        if exc.getCondition() in OUT_OF_REACH:
            raise QueryNotAllowedError(f"{OUT_OF_REACH[exc.getCondition()]}: {str(exc).splitlines()[0]}") from None
        raise
    _check(plan, {name.lower() for name in relations_of(session)})


# -------------------------------------------------------------------- query
def relations_of(session: SparkSession) -> set[str]:
    return {t.name for t in session.catalog.listTables() if t.isTemporary}


def query_frame(session: SparkSession, sql: str) -> DataFrame:
    """The validated query, complete."""
    validate_sql(session, sql)
    return session.sql(sql)


def first_rows(session: SparkSession, sql: str, row_limit: int) -> DataFrame:
    """At most ``row_limit`` rows of the query, in its order, each with
    ``truncated``: whether the query has more."""
    head = query_frame(session, sql).limit(row_limit + 1).withColumn("_place", F.monotonically_increasing_id())
    more = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = head.withColumns({"truncated": F.count("*").over(more) > row_limit, "_n": F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_place"))})
    return counted.where(F.col("_n") <= row_limit).orderBy("_place").drop("_place", "_n")


def run_query(session: SparkSession, sql: str, row_limit: int = DEFAULT_ROW_LIMIT) -> QueryResult:
    """The rows for a reader: the caller's limit, and whether it cut anything off."""
    shown = first_rows(session, sql, row_limit)
    found = shown.collect()
    return QueryResult(shown.columns[:-1], [tuple(r)[:-1] for r in found], len(found), bool(found) and found[0]["truncated"])


def describe_view(session: SparkSession, view: str) -> list[tuple[str, str, str]]:
    """(column, type, comment) of a registered view - the schema documentation."""
    return [(f.name, f.dataType.simpleString(), f.metadata.get("comment", "")) for f in session.table(view).schema.fields]


# Short notes shown with the schema document (the rules the reports follow).
SCHEMA_NOTES = (
    "`transit_hours` and `is_on_time` run from `handed_over_at` (carrier possession) to "
    "`delivered_at`; `accepted_at` is the carrier's own first scan and is informational only.",
    "Count shipments by `handed_over_at` or `created_at`. Parcels without carrier scans keep null "
    "transit and on-time values: count them for volume, filter `is_on_time IS NOT NULL` for rates.",
    "Lost and returned parcels never become on-time or late; report `is_lost` / `is_returned` "
    "rates beside the on-time rate.",
    "Join keys: `shipments.carrier_code = dim_carriers.carrier_code`, "
    "`shipments.organisation_id = dim_organisations.organisation_id`.",
)


def schema_markdown() -> str:
    """The gold views documented from their declared schemas (column, type,
    nullable, meaning), followed by the query notes."""
    from shipyard import schemas

    out = [f"# Gold views (read-only; {DEFAULT_ROW_LIMIT} rows shown unless the caller asks for more)", ""]
    for view, schema in (
        ("shipments", schemas.SHIPMENTS),
        ("dim_carriers", schemas.DIM_CARRIERS),
        ("dim_organisations", schemas.DIM_ORGANISATIONS),
    ):
        out += [f"## `{view}`", "", "| column | type | nullable | meaning |", "|---|---|---|---|"]
        for f in schema.fields:
            out.append(
                f"| {f.name} | {f.dataType.simpleString()} | {'yes' if f.nullable else 'no'} | {f.metadata.get('comment', '')} |"
            )
        out.append("")
    out += ["## Notes", ""] + [f"- {n}" for n in SCHEMA_NOTES]
    return "\n".join(out) + "\n"
