"""The given tables in the roles of the pipelines' inputs.

Lineitems with their order play the trips, nations the zones, events the short
trips and the daily series, orders the monthly and the country series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright import schemas
from martwright.functions.calendar import month_label, month_start
from martwright.operators.staging import with_trip_times
from martwright.schemas import STAGED_TRIPS

LAYOUTS = {
    "region": "r_regionkey integer, r_name string",
    "nation": "n_nationkey integer, n_name string, n_regionkey integer",
    "customer": "c_custkey long, c_name string, c_nationkey integer, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey integer, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size integer,"
    " p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber integer,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string,"
    " value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality integer, toxic integer",
}
UNKNOWN_NATION = 24
ZONE_COUNT = 25


def layout(name: str) -> T.StructType:
    return schemas.layout(LAYOUTS[name])


def table_path(sf: str, name: str) -> str:
    return f"{sf}/{name}.parquet"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(layout(name)).parquet(table_path(sf, name))


def cents(col: Column) -> Column:
    return F.floor(col * 100 + 0.5)


def zones(spark: SparkSession, sf: str) -> DataFrame:
    """Nations but the last, with their region as borough."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    key = F.col("n_nationkey")
    return (
        nation.where(key != UNKNOWN_NATION)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("location_id"),
            F.col("r_name").alias("borough"),
            F.col("n_name").alias("zone"),
            F.when(key % 5 == 0, "core").otherwise("outer").alias("service_zone"),
        )
    )


def raw_zones(spark: SparkSession, sf: str) -> DataFrame:
    return zones(spark, sf).select(
        F.concat(F.col("location_id").cast("string"), F.lit(".0")).alias("LOCATIONID"),
        F.col("borough").alias("BOROUGH"),
        F.col("zone").alias("ZONE"),
        F.col("service_zone").alias("SERVICE_ZONE"),
    )


def trips(
    spark: SparkSession, sf: str, *, dropoff: bool = False, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Lineitems as staged trips, before the validity filter.

    Orders meet customers first, so the lineitems are shuffled once. The dropoff
    zone costs a join to the suppliers and is NULL unless asked for. ``keys``
    names lineitem columns to keep.
    """
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders").drop("o_orderstatus", "o_totalprice")
    rows = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    )
    to = F.lit(None).cast("int")
    if dropoff:
        supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        to = F.col("s_nationkey")
    fare, off, tax = cents(F.col("l_extendedprice")), cents(F.col("l_discount")), cents(F.col("l_tax"))
    tip = F.floor((fare * off + 50) / 100)
    total = F.floor((fare * (100 - off) * (100 + tax) + 5000) / 10000)
    typed = rows.select(
        *keys,
        F.col("l_linenumber").alias("vendor_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        (F.col("l_quantity").cast("int") % 8).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("c_nationkey").alias("pickup_location_id"),
        to.alias("dropoff_location_id"),
        (F.col("l_suppkey") % 8).cast("int").alias("rate_code_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
        (fare / 100).alias("fare_amount"),
        (tax / 100).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (tip / 100).alias("tip_amount"),
        (off / 100).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (total / 100).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.when(F.col("l_linestatus") == "O", 1.75).otherwise(0.0).alias("airport_fee"),
        F.lit(0.75).alias("cbd_congestion_fee"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("store_and_fwd_flag"),
        month_label(F.col("o_orderdate")).alias("source_month"),
    )
    return with_trip_times(typed).select(*keys, *STAGED_TRIPS.names)


def landed_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Trips in the column names and types of the monthly files, with the lineitem's order key."""
    names = {
        "VendorID": "vendor_id",
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        "passenger_count": "passenger_count",
        "trip_distance": "trip_distance",
        "RatecodeID": "rate_code_id",
        "store_and_fwd_flag": "store_and_fwd_flag",
        "PULocationID": "pickup_location_id",
        "DOLocationID": "dropoff_location_id",
        "payment_type": "payment_type",
        "fare_amount": "fare_amount",
        "extra": "extra",
        "mta_tax": "mta_tax",
        "tip_amount": "tip_amount",
        "tolls_amount": "tolls_amount",
        "improvement_surcharge": "improvement_surcharge",
        "total_amount": "total_amount",
        "congestion_surcharge": "congestion_surcharge",
        "Airport_fee": "airport_fee",
        "cbd_congestion_fee": "cbd_congestion_fee",
    }
    as_double = {"passenger_count", "RatecodeID"}
    staged = trips(spark, sf, dropoff=True, keys=("l_orderkey",))
    return staged.select(
        [
            (F.col(source).cast("double") if name in as_double else F.col(source)).alias(name)
            for name, source in names.items()
        ]
        + [F.col("l_orderkey"), F.col("source_month")]
    )


def raw_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Landed trips as text, some cells of some orders being missing or junk."""
    landed = landed_trips(spark, sf)
    key = F.col("l_orderkey")
    columns = []
    for name in landed.columns:
        if name in ("l_orderkey", "source_month"):
            continue
        text = F.col(name).cast("string")
        if name in ("VendorID", "PULocationID", "DOLocationID", "payment_type"):
            text = F.concat(text, F.lit(".0"))
        if name == "VendorID":
            text = F.when(key % 47 == 0, "x").otherwise(text)
        elif name == "passenger_count":
            text = F.when(key % 43 != 0, text)
        elif name == "RatecodeID":
            text = F.when(key % 37 == 0, "1.5").otherwise(text)
        elif name == "tpep_pickup_datetime":
            text = F.when(key % 53 == 0, "not a time").otherwise(text)
        elif name == "fare_amount":
            text = F.when(key % 41 == 0, "nan").when(key % 59 == 0, "-1.5").otherwise(text)
        elif name == "trip_distance":
            text = F.when(key % 61 == 0, " 0.0 ").otherwise(text)
        columns.append(text.alias(name.upper()))
    return landed.select(*columns, F.col("source_month").alias("SOURCE_MONTH"))


def event_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Events as short trips over all hours of the day, with their event id."""
    events = table(spark, sf, "events")
    key = F.col("event_id")
    fare = cents(F.col("value"))
    tip = F.floor((fare * (key % 30) + 50) / 100)
    typed = events.select(
        "event_id",
        F.col("ts").alias("pickup_datetime"),
        F.timestamp_add("SECOND", (key * 37 % 14400).cast("int"), F.col("ts")).alias(
            "dropoff_datetime"
        ),
        (key % 8).cast("int").alias("passenger_count"),
        ((key % 300) / 10).alias("trip_distance"),
        (F.col("user_id") % ZONE_COUNT).cast("int").alias("pickup_location_id"),
        F.when(key % 101 != 0, F.col("user_id") * 7 % 27).cast("int").alias("dropoff_location_id"),
        F.when(key % 10 < 9, key % 10).cast("int").alias("payment_type"),
        (fare / 100).alias("fare_amount"),
        (tip / 100).alias("tip_amount"),
        ((fare + tip) / 100).alias("total_amount"),
        month_label(F.col("ts")).alias("source_month"),
    )
    return with_trip_times(typed)


def raw_series(spark: SparkSession, sf: str) -> DataFrame:
    """Events summed per day and type, in the raw series layout."""
    return (
        table(spark, sf, "events")
        .groupBy(F.col("ts").cast("date").alias("date"), "event_type")
        .agg(
            (F.sum(cents(F.col("value"))) / 100).alias("value"),
            F.max("ts").cast("timestamp").alias("loaded_at"),
        )
        .select(
            "date",
            "value",
            F.col("event_type").alias("indicator_name"),
            F.col("event_type").alias("series_id"),
            "loaded_at",
        )
    )


def gappy_series(spark: SparkSession, sf: str) -> DataFrame:
    """The raw series with missing values every seventh and missing dates every eleventh day."""
    day = F.dayofmonth("date")
    return raw_series(spark, sf).select(
        F.when(day % 11 != 0, F.col("date")).alias("date"),
        F.when(day % 7 != 0, F.col("value")).alias("value"),
        "indicator_name",
        "series_id",
        "loaded_at",
    )


def series(spark: SparkSession, sf: str) -> DataFrame:
    """The gappy series with its dates: values may be NULL in mid-series."""
    day = F.dayofmonth("date")
    return raw_series(spark, sf).select(
        F.col("date").alias("observation_date"),
        "indicator_name",
        "series_id",
        F.when(day % 7 != 0, F.col("value")).alias("value"),
    )


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as one observation of its type."""
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("observed_at"), "event_type", "value"
    )


def monthly_series(spark: SparkSession, sf: str) -> DataFrame:
    """Orders summed per month and priority, staged."""
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("series_id"),
            month_start(F.col("o_orderdate").cast("date")).alias("observation_date"),
        )
        .agg((F.sum(cents(F.col("o_totalprice"))) / 100).alias("indicator_value"))
    )


def country_long(spark: SparkSession, sf: str) -> DataFrame:
    """Orders summed per nation, status and year, staged."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice"
    )
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            "c_nationkey",
            F.col("o_orderstatus").alias("indicator_id"),
            F.year("o_orderdate").alias("observation_year"),
        )
        .agg((F.sum(cents(F.col("o_totalprice"))) / 100).alias("indicator_value"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_nationkey").cast("string").alias("country_code"),
            F.col("n_name").alias("country_name"),
            "indicator_id",
            "observation_year",
            "indicator_value",
        )
    )
