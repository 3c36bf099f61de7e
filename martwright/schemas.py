"""Declared table layouts. Readers take these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def layout(text: str) -> T.StructType:
    """A flat layout from ``"name type, name type"``; unlike a DDL it needs no session."""
    struct = T.StructType()
    for column in text.split(","):
        struct.add(*column.split())
    return struct


# Staged trip columns, each with the raw column it comes from.
TRIP_INTEGERS = {
    "vendor_id": "VENDORID",
    "passenger_count": "PASSENGER_COUNT",
    "pickup_location_id": "PULOCATIONID",
    "dropoff_location_id": "DOLOCATIONID",
    "rate_code_id": "RATECODEID",
    "payment_type": "PAYMENT_TYPE",
}
TRIP_MEASURES = {
    "trip_distance": "TRIP_DISTANCE",
    "fare_amount": "FARE_AMOUNT",
    "extra": "EXTRA",
    "mta_tax": "MTA_TAX",
    "tip_amount": "TIP_AMOUNT",
    "tolls_amount": "TOLLS_AMOUNT",
    "improvement_surcharge": "IMPROVEMENT_SURCHARGE",
    "total_amount": "TOTAL_AMOUNT",
    "congestion_surcharge": "CONGESTION_SURCHARGE",
    "airport_fee": "AIRPORT_FEE",
    "cbd_congestion_fee": "CBD_CONGESTION_FEE",
}
TRIP_TIMES = {
    "pickup_datetime": "TPEP_PICKUP_DATETIME",
    "dropoff_datetime": "TPEP_DROPOFF_DATETIME",
}
TRIP_TEXTS = {
    "store_and_fwd_flag": "STORE_AND_FWD_FLAG",
    "source_month": "SOURCE_MONTH",
}

# The raw trip table's exact column set.
RAW_TRIP_COLUMNS = [
    "VENDORID",
    "TPEP_PICKUP_DATETIME",
    "TPEP_DROPOFF_DATETIME",
    "PASSENGER_COUNT",
    "TRIP_DISTANCE",
    "RATECODEID",
    "STORE_AND_FWD_FLAG",
    "PULOCATIONID",
    "DOLOCATIONID",
    "PAYMENT_TYPE",
    "FARE_AMOUNT",
    "EXTRA",
    "MTA_TAX",
    "TIP_AMOUNT",
    "TOLLS_AMOUNT",
    "IMPROVEMENT_SURCHARGE",
    "TOTAL_AMOUNT",
    "CONGESTION_SURCHARGE",
    "AIRPORT_FEE",
    "CBD_CONGESTION_FEE",
    "SOURCE_MONTH",
]

RAW_TRIPS = T.StructType([T.StructField(name, T.StringType()) for name in RAW_TRIP_COLUMNS])
ZONES_CSV = layout("LocationID string, Borough string, Zone string, service_zone string")

# Monthly trip files as delivered: typed columns, no month.
TRIP_FILE = layout(
    "VendorID integer, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
    " passenger_count double, trip_distance double, RatecodeID double,"
    " store_and_fwd_flag string, PULocationID integer, DOLocationID integer, payment_type long,"
    " fare_amount double, extra double, mta_tax double, tip_amount double,"
    " tolls_amount double, improvement_surcharge double, total_amount double,"
    " congestion_surcharge double, Airport_fee double, cbd_congestion_fee double"
)

STAGED_TRIPS = layout(
    "vendor_id integer, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz,"
    " passenger_count integer, trip_distance double, pickup_location_id integer,"
    " dropoff_location_id integer, rate_code_id integer, payment_type integer, fare_amount double,"
    " extra double, mta_tax double, tip_amount double, tolls_amount double,"
    " improvement_surcharge double, total_amount double, congestion_surcharge double,"
    " airport_fee double, cbd_congestion_fee double, store_and_fwd_flag string,"
    " source_month string, trip_duration_minutes long, pickup_date date"
)

# Series tables of the indicator and the snapshot job.
RAW_SERIES = layout(
    "date date, value double, indicator_name string, series_id string, loaded_at timestamp"
)
RAW_SERIES_NAMED = layout(
    "series_id string, series_name string, date date, value double, loaded_at timestamp"
)
RAW_COUNTRY = layout(
    "country_code string, country_name string, indicator_id string, indicator_name string,"
    " year integer, value double, loaded_at timestamp"
)

RUN_LOG = layout(
    "run_id string, month_processed string, status string, task_name string, message string"
)

AUDIT_LOG = layout(
    "model string, check_kind string, column_name string, n_failing long, passed boolean,"
    " audited_at timestamp"
)
REJECTED = layout("source_id string, file_path string, reason string, n_chars integer")

SERIES_DOCUMENT = "observations array<struct<date: string, value: string>>, corrupt string"
COUNTRY_ROWS = (
    "array<struct<countryiso3code: string, country: struct<id: string, value: string>,"
    " date: string, value: double>>"
)
