"""Declared table schemas. Schemas are never inferred.

Timestamps are UTC wall-clock values without zone (``TIMESTAMP_NTZ``). Gold
columns carry their documentation as field comments, readable with
``DESCRIBE`` on the registered views.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _f(name, dtype, nullable=True, comment=None):
    meta = {"comment": comment} if comment else {}
    return StructField(name, dtype, nullable, meta)


TS = TimestampNTZType()

# ---------------------------------------------------------------- bronze
# Lineage columns appended to every bronze row.
BRONZE_LINEAGE = [
    _f("source_file", StringType(), False),
    _f("source_line_no", IntegerType(), False),
    _f("_bronze_loaded_at", TS, False),
]

CARRIER_A_FIELDS = StructType(
    [
        _f("tracking_no", StringType()),
        _f("status", StringType()),
        _f("ts", StringType()),
        _f("weight_kg", DoubleType()),
        _f("hub", StringType()),
        _f("source_ingested_at", StringType()),
    ]
)

CARRIER_B_EVENT = StructType([_f("code", IntegerType()), _f("desc", StringType())])
CARRIER_B_FIELDS = StructType(
    [
        _f("barcode", StringType()),
        _f("event", CARRIER_B_EVENT),
        _f("event_time", StringType()),
        _f("weight_g", DoubleType()),
        _f("depot", StringType()),
        _f("source_ingested_at", StringType()),
    ]
)

CARRIER_C_FIELDS = StructType(
    [
        _f("ref", StringType()),
        _f("st", IntegerType()),
        _f("t", LongType()),
        _f("dims", StringType(), comment="raw JSON text"),
        _f("source_ingested_at", StringType()),
    ]
)

PARCEL_EVENTS_FIELDS = StructType(
    [
        _f("event_id", StringType()),
        _f("event_type", StringType()),
        _f("parcel_id", IntegerType()),
        _f("tracking_number", StringType()),
        _f("organisation_id", IntegerType()),
        _f("carrier_code", StringType()),
        _f("service_level", StringType()),
        _f("destination_country", StringType()),
        _f("destination_postcode", StringType()),
        _f("recipient_email", StringType()),
        _f("occurred_at", StringType()),
        _f("source_ingested_at", StringType()),
    ]
)

BRONZE_QUARANTINE = StructType(
    [
        _f("source_file", StringType(), False),
        _f("source_line_no", IntegerType(), False),
        _f("raw_line", StringType(), False),
        _f("error", StringType(), False),
        _f("_bronze_loaded_at", TS, False),
    ]
)


def bronze_record(fields: StructType) -> StructType:
    """Public bronze table: payload fields then lineage."""
    return StructType(list(fields.fields) + BRONZE_LINEAGE)


def bronze_physical(fields: StructType) -> StructType:
    """Stored bronze table: good and bad lines of a file side by side.

    ``error`` is null on a good line; ``raw_line`` is kept only for bad lines.
    ``source_file`` is the partition column and comes last, as Spark stores it.
    """
    return StructType(
        list(fields.fields)
        + [
            _f("source_line_no", IntegerType(), False),
            _f("_bronze_loaded_at", TS, False),
            _f("raw_line", StringType()),
            _f("error", StringType()),
            _f("source_file", StringType(), False),
        ]
    )


# ---------------------------------------------------------------- silver
TRACKING_EVENTS = StructType(
    [
        _f("tracking_number", StringType(), False),
        _f("carrier_code", StringType(), False),
        _f("status", StringType(), False),
        _f("event_time", TS, False),
        _f("weight_kg", DoubleType()),
        _f("facility_code", StringType()),
        _f("raw_status", StringType(), False),
        _f("source_file", StringType(), False),
        _f("source_line_no", IntegerType(), False),
        _f("_silver_loaded_at", TS, False),
    ]
)

TRACKING_EVENTS_QUARANTINE = StructType(
    [
        _f("carrier_code", StringType(), False),
        _f("source_file", StringType(), False),
        _f("source_line_no", IntegerType(), False),
        _f("reason", StringType(), False),
        _f("raw_record", StringType(), False),
        _f("_silver_loaded_at", TS, False),
    ]
)

PARCEL_EVENTS = StructType(
    [
        _f("event_id", StringType(), False),
        _f("event_type", StringType(), False),
        _f("parcel_id", IntegerType(), False),
        _f("tracking_number", StringType(), False),
        _f("organisation_id", IntegerType(), False),
        _f("carrier_code", StringType(), False),
        _f("service_level", StringType()),
        _f("destination_country", StringType()),
        _f("destination_postcode", StringType()),
        _f("occurred_at", TS, False),
        _f("source_file", StringType(), False),
        _f("source_line_no", IntegerType(), False),
        _f("_silver_loaded_at", TS, False),
    ]
)

PARCEL_EVENTS_QUARANTINE = StructType(
    [
        _f("source_file", StringType(), False),
        _f("source_line_no", IntegerType(), False),
        _f("reason", StringType(), False),
        _f("raw_record", StringType(), False),
        _f("_silver_loaded_at", TS, False),
    ]
)

# ---------------------------------------------------------------- bookkeeping
LOADS = StructType(
    [
        _f("source_file", StringType()),
        _f("rows_loaded", LongType()),
        _f("rows_quarantined", LongType()),
        _f("load_no", LongType()),
        _f("loaded_at", TS),
    ]
)

# Partial rows of ``operators.milestones``, partitioned by their day.
DAY_MILESTONES = StructType(
    [
        _f("carrier_code", StringType()),
        _f("tracking_number", StringType()),
        _f("accepted_at", TS),
        _f("delivered_at", TS),
        _f(
            "weighed",
            StructType([_f("event_time", TS), _f("source_file", StringType()), _f("source_line_no", IntegerType()), _f("weight_kg", DoubleType())]),
        ),
        _f(
            "newest",
            StructType(
                [
                    _f("t", LongType()),
                    _f("source_file", StringType()),
                    _f("source_line_no", IntegerType()),
                    _f("status", StringType()),
                    _f("facility_code", StringType()),
                ]
            ),
        ),
        _f("event_day", DateType()),
    ]
)

DAY_PARCELS = StructType(
    [
        _f("parcel_id", IntegerType()),
        _f(
            "first",
            StructType(
                [
                    _f("occurred_at", TS),
                    _f("source_file", StringType()),
                    _f("source_line_no", IntegerType()),
                    _f("tracking_number", StringType()),
                    _f("organisation_id", IntegerType()),
                    _f("carrier_code", StringType()),
                    _f("service_level", StringType()),
                    _f("destination_country", StringType()),
                    _f("destination_postcode", StringType()),
                ]
            ),
        ),
        _f("created_at", TS),
        _f("handed_over_at", TS),
        _f("occurred_day", DateType()),
    ]
)

GOLD_STATE = StructType([_f("applied_at", TS), _f("carrier_code", StringType()), _f("sla_hours", IntegerType())])

APPLIED_FILES = StructType([_f("feed", StringType()), _f("source_file", StringType())])

# ---------------------------------------------------------------- gold
DIM_CARRIERS = StructType(
    [
        _f("carrier_code", StringType(), False, "short name of the carrier, unique here; shipments refer to it"),
        _f("carrier_name", StringType(), False),
        _f("sla_hours", IntegerType(), False, "hours the carrier promises from hand-over to delivery; shipments repeat it"),
        _f("countries_served", ArrayType(StringType())),
    ]
)

DIM_ORGANISATIONS = StructType(
    [
        _f("organisation_id", IntegerType(), False, "number of the sender; shipments refer to it"),
        _f("name", StringType()),
        _f("country", StringType()),
        _f("plan", StringType(), comment="contract the organisation has with us"),
        _f("created_at", TS),
    ]
)

SHIPMENTS = StructType(
    [
        _f("parcel_id", IntegerType(), False, "our number of the parcel, one row each"),
        _f("tracking_number", StringType(), False, "number under which the carrier reports scans"),
        _f("organisation_id", IntegerType(), False, "who sends the parcel, see dim_organisations"),
        _f("carrier_code", StringType(), False, "who carries the parcel, see dim_carriers"),
        _f("service_level", StringType(), comment="service that the sender booked"),
        _f("destination_country", StringType()),
        _f("destination_postcode", StringType()),
        _f("created_at", TS, comment="time of the parcel_created event, null if none arrived"),
        _f("handed_over_at", TS, comment="time of the parcel_handed_over event: the carrier has the parcel from here on"),
        _f("accepted_at", TS, comment="time of the earliest scan with status ACCEPTED"),
        _f("delivered_at", TS, comment="time of the earliest scan with status DELIVERED"),
        _f("latest_carrier_status", StringType(), comment="status of the newest scan"),
        _f("weight_kg", DoubleType()),
        _f("facility_code", StringType(), comment="place of the newest scan"),
        _f("sla_hours", IntegerType(), comment="promised hours of the parcel's carrier"),
        _f("transit_hours", DoubleType(), comment="hours from hand-over to delivery, null until both are known"),
        _f("is_delivered", BooleanType(), False, "true once a DELIVERED scan arrived"),
        _f("is_on_time", BooleanType(), comment="true or false for delivered parcels with a promise, else null"),
        _f("_gold_loaded_at", TS, False, "when this row was built; not for reports"),
        _f("is_lost", BooleanType(), comment="true if the newest scan says LOST"),
        _f("is_returned", BooleanType(), comment="true if the newest scan says RETURNED"),
    ]
)


def with_column(schema: StructType, name: str, dtype, nullable=True) -> StructType:
    return StructType(list(schema.fields) + [_f(name, dtype, nullable)])
