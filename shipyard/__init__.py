"""shipyard: parcel-tracking medallion data on Spark.

Raw carrier and lifecycle feeds (gzipped JSON lines) land in bronze, are
validated, unified and de-duplicated in silver, and become one shipment row per
parcel in gold. Quality gates run between the layers; the gold tables answer
business questions through DataFrame reports or guarded read-only Spark SQL.

Every transform is a DataFrame -> DataFrame function built from Spark SQL
expressions (no Python UDFs), so Catalyst prunes, pushes down and codegens it.
"""

__all__ = ["session", "schemas", "warehouse"]
