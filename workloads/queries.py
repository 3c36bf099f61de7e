"""Every operator as a query over the given tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions import calendar, labels
from martwright.operators import (
    incremental,
    joins,
    profiling,
    quality,
    quantiles,
    reshape,
    serving,
    sketches,
    staging,
    windows,
)
from martwright.plans import contracts, indicators, marts, snapshot
from martwright.plans import trips as trip_job
from martwright.plans.audit import AuditFailed
from martwright.schemas import RAW_COUNTRY, RAW_SERIES, RAW_TRIPS
from martwright.session import tune, work_path
from martwright.sources import documents, files, landing, sinks
from martwright.streaming import marts as streamed_marts
from martwright.streaming.landing import land_new_files
from workloads import roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_DAY, END_DAY = date(1995, 1, 1), date(2002, 1, 1)
BAND = (1, 2_000_000)
CUT_MONTH = "1998-06"
CUT_DAY = date(1998, 6, 30)
LAST_DELIVERY = "2001-08"
AS_OF = date(2024, 3, 10)
RATES = ["error", "view"]
INVERSE = ["click", "view"]
NEUTRAL = ["error"]
COUNTRY_COLUMNS = {"gdp_usd": "F", "inflation_rate": "O", "unemployment_rate": "P"}
US_COLUMNS = {
    "us_unemployment_fred": "1-URGENT",
    "us_cpi_fred": "2-HIGH",
    "us_real_gnp_fred": "3-MEDIUM",
}
SNAPSHOT_YEAR = 1997
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ITEM_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
RAW_ROWS = (1, 1_000_000_000_000)


def query(function: Query) -> Query:
    @wraps(function)
    def tuned(spark: SparkSession, sf: str) -> DataFrame:
        tune(spark)
        return function(spark, sf)

    QUERIES[function.__name__] = tuned
    return tuned


# --- inputs shared by several queries ---


def _valid(spark, sf, **options):
    return staging.valid_trips(roles.trips(spark, sf, **options), FIRST_DAY, END_DAY)


def _with_pickup(spark, sf, **options):
    return joins.with_zones(_valid(spark, sf, **options), roles.zones(spark, sf), ["pickup"])


def _short_trips(spark, sf):
    trips = staging.valid_trips(roles.event_trips(spark, sf), date(2024, 1, 1), date(2024, 2, 1))
    return joins.with_zones(trips, roles.zones(spark, sf), ["pickup"])


def _zone_hours(spark, sf):
    return marts.pickup_zones(_short_trips(spark, sf))


def _durations(spark, sf):
    return marts.trip_duration(_with_pickup(spark, sf), *BAND)


def _changes(spark, sf):
    return marts.indicator_change(roles.series(spark, sf), RATES)


def _checked(spark, sf):
    return trip_job.coerce_for_checks(roles.raw_trips(spark, sf))


def _country_years(spark, sf):
    return snapshot.country_years(
        roles.country_long(spark, sf), roles.monthly_series(spark, sf), COUNTRY_COLUMNS, US_COLUMNS
    )


# --- scans, sources and sinks ---


@query
def scan_fact(spark, sf):
    facts = files.read_facts(spark, roles.table_path(sf, "lineitem"), roles.layout("lineitem"))
    return facts.select(*ITEM_KEYS, "l_shipdate", "l_quantity", "l_extendedprice")


@query
def rows_per_file(spark, sf):
    counts = [
        files.rows_per_file(roles.table(spark, sf, name))
        for name in ("customer", "orders", "lineitem", "events")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query
def profile_files(spark, sf):
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"]
    return files.profile_files(spark, roles.table_path(sf, "lineitem"), roles.layout("lineitem"), columns)


@query
def scan_csv_dim(spark, sf):
    key = F.col("location_id")
    path = work_path(spark, "zones_csv")
    roles.zones(spark, sf).select(
        key.alias("LocationID"),
        F.when(key % 7 == 0, "N/A").otherwise(F.col("borough")).alias("Borough"),
        F.concat(F.col("zone"), F.lit(", airport")).alias("Zone"),
        F.when(key % 3 == 0, "").otherwise(F.col("service_zone")).alias("service_zone"),
    ).write.option("header", True).csv(path)
    return files.read_zones_csv(spark, path)


def _series_documents(spark, sf, text):
    """Lands one document per series and month, as the API would page it."""
    path = work_path(spark, "series_documents")
    (
        roles.raw_series(spark, sf)
        .groupBy("series_id", calendar.month_label(F.col("date")).alias("month"))
        .agg(
            F.collect_list(
                F.struct(F.col("date").cast("string").alias("date"), text.alias("value"))
            ).alias("observations")
        )
        .select("series_id", F.to_json(F.struct("observations")).alias("value"))
        .write.partitionBy("series_id")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )
    return path


def _value_text(junk):
    day = F.dayofmonth("date")
    text = F.when(day % 7 == 0, ".")
    if junk:
        text = text.when(day % 13 == 0, "withheld")
    return text.otherwise(F.col("value").cast("string"))


SERIES_NAMES = {name: f"{name} total" for name in ("click", "error", "purchase", "signup", "view")}


@query
def ingest_series_json(spark, sf):
    landed = _series_documents(spark, sf, _value_text(junk=True))
    return documents.read_series(spark, landed, SERIES_NAMES)


@query
def ingest_series_json_strict(spark, sf):
    landed = _series_documents(spark, sf, _value_text(junk=False))
    return documents.read_series_strict(spark, landed, SERIES_NAMES)


@query
def rejected_documents(spark, sf):
    """Pages of five days, some cut off, some error answers, some empty."""
    path = work_path(spark, "series_documents")
    page = F.floor((F.dayofmonth("date") - 1) / 5).cast("int")
    observation = F.struct(F.col("date").cast("string").alias("date"), F.col("value").cast("string").alias("value"))
    body = F.to_json(F.struct(F.collect_list(observation).alias("observations")))
    (
        roles.raw_series(spark, sf)
        .groupBy("series_id", page.alias("page"))
        .agg(body.alias("body"))
        .select(
            "series_id",
            "page",
            F.when(F.col("page") == 1, F.substr("body", F.lit(1), F.floor(F.length("body") / 2).cast("int")))
            .when(F.col("page") == 3, '{"error_code": 400, "error_message": "Bad Request"}')
            .when(F.col("page") == 5, "")
            .otherwise(F.col("body"))
            .alias("value"),
        )
        .write.partitionBy("series_id", "page")
        .text(path)
    )
    told = documents.rejected(documents.series_documents(spark, path))
    return told.select(
        "source_id", F.regexp_extract("file_path", "/page=([0-9]+)/", 1).cast("int").alias("page"), "reason"
    )


INDICATOR_NAMES = {"F": "finished", "O": "open", "P": "pending"}


def _country_documents(spark, sf):
    """Lands one document per country and indicator: rows, an error answer or a null."""
    path = work_path(spark, "country_documents")
    year, code = F.col("observation_year"), F.col("country_code").cast("int")
    row = F.struct(
        F.col("country_code").alias("countryiso3code"),
        F.struct(F.lit("-").alias("id"), F.col("country_name").alias("value")).alias("country"),
        year.cast("string").alias("date"),
        F.when(year % 5 != 0, F.col("indicator_value")).alias("value"),
    )
    rows = F.to_json(F.col("rows"), {"ignoreNullFields": "false"})
    (
        roles.country_long(spark, sf)
        .groupBy("indicator_id", "country_code")
        .agg(F.collect_list(row).alias("rows"))
        .select(
            "indicator_id",
            F.when(code == 7, '[{"message": "not found"}]')
            .when(code == 8, '[{"page": 1}, null]')
            .otherwise(F.concat(F.lit('[{"page": 1},\n'), rows, F.lit("]")))
            .alias("value"),
        )
        .write.partitionBy("indicator_id")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )
    return path


@query
def ingest_country_json(spark, sf):
    landed = _country_documents(spark, sf)
    return documents.read_country_indicators(spark, landed, INDICATOR_NAMES)


@query
def raw_stringify(spark, sf):
    landed = roles.landed_trips(spark, sf).drop("l_orderkey", "source_month")
    return landing.stringify(landed, calendar.month_label(F.col("tpep_pickup_datetime")))


@query
def load_skip_existing(spark, sf):
    orders = roles.table(spark, sf, "orders").select(
        "o_orderkey", calendar.month_label(F.col("o_orderdate")).alias("source_month")
    )
    return incremental.unloaded_months(orders, orders.where(F.col("source_month") <= CUT_MONTH))


@query
def append_sink(spark, sf):
    path = work_path(spark, "raw_trips")
    raw = roles.raw_trips(spark, sf)
    sinks.append_partitioned(raw.where(F.col("SOURCE_MONTH") <= CUT_MONTH), path)
    sinks.append_partitioned(raw.where(F.col("SOURCE_MONTH") > CUT_MONTH), path)
    stored = spark.read.schema(RAW_TRIPS).parquet(path)
    return stored.groupBy("SOURCE_MONTH").agg(F.count("*").alias("n_rows"))


@query
def overwrite_sink(spark, sf):
    path = work_path(spark, "zones")
    zones = roles.zones(spark, sf)
    sinks.overwrite(zones.where(F.col("service_zone") == "core"), path)
    sinks.overwrite(zones, path)
    return spark.read.parquet(path)


@query
def full_refresh_sink(spark, sf):
    path = work_path(spark, "series")
    raw = roles.raw_series(spark, sf).drop("loaded_at")
    sinks.full_refresh(raw.withColumn("value", F.col("value") + 1), path)
    sinks.full_refresh(raw, path)
    return sinks.read_refreshed(spark, path)


@query
def hwm_by_series(spark, sf):
    delivered = roles.raw_series(spark, sf).drop("loaded_at")
    loaded = delivered.where(
        (F.col("date") <= date(2024, 1, 15)) & (F.col("series_id") != "purchase")
    )
    return incremental.after_watermark(
        delivered, loaded, ["series_id"], "date", F.lit(snapshot.FIRST_DATE), inclusive=True
    )


@query
def hwm_by_key_pair(spark, sf):
    delivered = roles.country_long(spark, sf)
    loaded = delivered.where((F.col("observation_year") <= 1998) & (F.col("indicator_id") != "P"))
    keys = ["indicator_id", "country_code"]
    return incremental.after_watermark(
        delivered, loaded, keys, "observation_year", F.lit(1999), inclusive=False
    )


@query
def typed_raw(spark, sf):
    rows = roles.raw_series(spark, sf).select(
        F.col("date").cast("string").alias("date"),
        F.col("value").cast("string").alias("value"),
        "indicator_name",
        "series_id",
    )
    return landing.typed_raw(rows, RAW_SERIES).select(
        "date", "value", "indicator_name", "series_id", F.col("loaded_at").isNotNull().alias("stamped")
    )


@query
def verify_load(spark, sf):
    return profiling.load_report(roles.trips(spark, sf), roles.zones(spark, sf))


@query
def sample_month(spark, sf):
    return files.sample_month(roles.raw_trips(spark, sf), "1997-06", 500, seed=7)


@query
def materialize_layers(spark, sf):
    folder = work_path(spark, "layers")
    staged = sinks.publish(roles.event_trips(spark, sf), "short_trips", "staging", folder)
    paid = staged.groupBy("payment_type").agg(F.count("*").alias("total_trips"))
    return sinks.publish(paid, "trips_per_payment", "mart", folder)


def _delivery_of(month, fare):
    """Name of the delivery a trip comes with: late rows of the first's months come with the second."""
    first = (month <= CUT_MONTH) & ~fare.cast("string").endswith("7")
    return F.when(first, CUT_MONTH).otherwise(LAST_DELIVERY)


def _drop_files(spark, sf, drop):
    """Writes both deliveries as named files and returns their paths and layout."""
    landed = roles.landed_trips(spark, sf)
    named = landed.withColumn("delivery", _delivery_of(F.col("source_month"), F.col("fare_amount")))
    paths = {month: f"{drop}/yellow_tripdata_{month}.parquet" for month in (CUT_MONTH, LAST_DELIVERY)}
    rows = joins.hold(named.drop("l_orderkey", "source_month"))
    return {
        month: (path, rows.where(F.col("delivery") == month).drop("delivery")) for month, path in paths.items()
    }


@query
def stream_landing(spark, sf):
    drop, table, state = (work_path(spark, name) for name in ("drop", "raw_trips", "state"))
    for path, rows in _drop_files(spark, sf, drop).values():
        rows.write.parquet(path)
        land_new_files(spark, drop, table, state, rows.schema)
    stored = spark.read.parquet(table)
    return stored.groupBy("SOURCE_MONTH").agg(F.count("*").alias("n_rows"))


@query
def land_month_file(spark, sf):
    drop, folder, zones_csv = (work_path(spark, name) for name in ("drop", "trips", "zones_csv"))
    for path, rows in _drop_files(spark, sf, drop).values():
        rows.write.parquet(path)
        for _ in range(2):
            trip_job.land_month_file(spark, path, folder, schema=rows.schema)
    zones = roles.zones(spark, sf)
    zones.select(
        F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
        F.col("zone").alias("Zone"), "service_zone",
    ).write.option("header", True).csv(zones_csv)
    trip_job.land_zone_file(spark, zones_csv, folder)
    return trip_job.landed_report(spark, folder)


# --- projections, filters, predicates ---


@query
def stg_trips_cast(spark, sf):
    return staging.cast_trips(roles.raw_trips(spark, sf))


@query
def duration_minutes(spark, sf):
    start, end = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return roles.event_trips(spark, sf).select(
        "event_id",
        calendar.minutes_crossed(start, end).alias("minutes"),
        calendar.minutes_crossed(end, start).alias("reversed_minutes"),
    )


@query
def stg_trips_valid(spark, sf):
    return staging.valid_trips(staging.cast_trips(roles.raw_trips(spark, sf)), FIRST_DAY, END_DAY)


@query
def stg_zones(spark, sf):
    return staging.stage_zones(roles.raw_zones(spark, sf))


@query
def stg_series_keep_null(spark, sf):
    return staging.stage_series(roles.gappy_series(spark, sf)).drop("loaded_at")


@query
def stg_series_drop_null(spark, sf):
    raw = roles.gappy_series(spark, sf).withColumnRenamed("indicator_name", "series_name")
    return staging.stage_series_with_value(raw).drop("loaded_at")


@query
def stg_country(spark, sf):
    year = F.col("observation_year")
    raw = roles.country_long(spark, sf).select(
        "country_code",
        "country_name",
        "indicator_id",
        F.lower("indicator_id").alias("indicator_name"),
        year.alias("year"),
        F.when(year % 4 != 0, F.col("indicator_value")).alias("value"),
    )
    return staging.stage_country(landing.typed_raw(raw, RAW_COUNTRY)).drop("loaded_at")


@query
def payment_label(spark, sf):
    return roles.event_trips(spark, sf).select(
        "event_id", "payment_type", labels.payment_label(F.col("payment_type")).alias("payment_label")
    )


@query
def anomaly_counts(spark, sf):
    return profiling.anomaly_counts(staging.cast_trips(roles.raw_trips(spark, sf)))


@query
def serve_filter_multi(spark, sf):
    report = serving.serve(marts.daily_revenue(_with_pickup(spark, sf)), serving.DAILY_REVENUE)
    return serving.choose(report, "pickup_borough", ["ASIA", "EUROPE"])


@query
def lookback_years(spark, sf):
    monthly = roles.monthly_series(spark, sf).withColumn("indicator_name", F.col("series_id"))
    return serving.last_years(monthly, "2-HIGH", 3, date(2001, 8, 1))


# --- joins ---


@query
def trips_joined(spark, sf):
    trips = _valid(spark, sf, dropoff=True)
    return joins.with_zones(trips, roles.zones(spark, sf))


@query
def country_with_us(spark, sf):
    return _country_years(spark, sf)


@query
def ri_violations(spark, sf):
    child = roles.table(spark, sf, "documents").select("doc_id", "lang")
    return joins.orphan_keys(child, "doc_id", roles.table(spark, sf, "labels"), "doc_id")


@query
def ri_profile(spark, sf):
    keys = ["pickup_location_id", "dropoff_location_id"]
    trips, zones = roles.event_trips(spark, sf), roles.zones(spark, sf)
    return joins.count_unknown_keys(trips, keys, zones, "location_id")


@query
def heatmap_top_zones(spark, sf):
    zone_hours = _zone_hours(spark, sf)
    return serving.only_top_zones(reshape.hour_grid(zone_hours), zone_hours)


# --- marts and aggregations ---


@query
def mart_daily_revenue(spark, sf):
    return marts.daily_revenue(_with_pickup(spark, sf))


@query
def mart_pickup_zones(spark, sf):
    return _zone_hours(spark, sf)


@query
def mart_payment_summary(spark, sf):
    return marts.payment_summary(_valid(spark, sf))


@query
def avg_tip_rate(spark, sf):
    trips = roles.event_trips(spark, sf)
    return trips.groupBy("payment_type").agg(marts.mean_tip_rate().alias("avg_tip_rate_pct"))


@query
def mart_trip_duration(spark, sf):
    return _durations(spark, sf)


@query
def median_duration(spark, sf):
    keys = ["pickup_date", "pickup_borough"]
    return quantiles.exact_quantiles(
        _short_trips(spark, sf), keys, "trip_duration_minutes", {"median_minutes": 0.5}
    )


def _sketched_profile(spark, sf):
    """Sketches of two deliveries, the second one delivered twice, merged."""
    folder, trips = work_path(spark, "sketches"), joins.hold(_with_pickup(spark, sf, dropoff=True))
    early = F.col("pickup_date") <= CUT_DAY
    for label, rows in ((CUT_MONTH, trips.where(early)), (LAST_DELIVERY, trips), (LAST_DELIVERY, trips.where(~early))):
        trip_job.keep_sketches(spark, rows, folder, label)
    return trips, joins.hold(trip_job.trip_profile(spark, folder))


@query
def sketch_quantiles(spark, sf):
    """Whether each approximate quantile has a rank within the stated error."""
    trips, profile = _sketched_profile(spark, sf)
    wanted = {"median_fare": ("fare_amount", 0.5), "high_fare": ("fare_amount", 0.9), "median_distance": ("trip_distance", 0.5)}
    told = profile.select(F.col("pickup_borough").alias("borough"), *wanted)
    rows = trips.select("pickup_borough", "fare_amount", "trip_distance")
    joined = rows.join(told, F.col("pickup_borough").eqNullSafe(F.col("borough")))
    ranks = joined.groupBy("pickup_borough").agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(m) < F.col(name)).alias(f"below_{name}") for name, (m, _) in wanted.items()],
        *[F.count_if(F.col(m) <= F.col(name)).alias(f"up_to_{name}") for name, (m, _) in wanted.items()],
    )
    lines = []
    for name, (_, p) in wanted.items():
        low, high = F.col(f"below_{name}") / F.col("n_rows"), F.col(f"up_to_{name}") / F.col("n_rows")
        within = (low <= p + sketches.RANK_ERROR) & (high >= p - sketches.RANK_ERROR)
        lines.append(F.struct(F.lit(name).alias("quantile"), within.alias("within")))
    return ranks.select("pickup_borough", "n_rows", F.inline(F.array(*lines)))


@query
def sketch_distinct(spark, sf):
    """Whether each approximate count of distinct values is within the stated error."""
    trips, profile = _sketched_profile(spark, sf)
    exact = trips.groupBy("pickup_borough").agg(
        F.count_distinct("dropoff_location_id").alias("n_zones"), F.count_distinct("pickup_date").alias("n_dates")
    )
    told = profile.select(F.col("pickup_borough").alias("borough"), "n_dropoff_zones", "n_days")

    def within(estimate, count):
        return F.abs(F.col(estimate) - F.col(count)) <= sketches.DISTINCT_ERROR * F.col(count)

    return exact.join(told, F.col("pickup_borough").eqNullSafe(F.col("borough"))).select(
        "pickup_borough", "n_zones", "n_dates",
        within("n_dropoff_zones", "n_zones").alias("zones_within"), within("n_days", "n_dates").alias("days_within"),
    )


@query
def country_pivot(spark, sf):
    keys = ["country_code", "country_name", "observation_year"]
    country = roles.country_long(spark, sf)
    return reshape.widen(country, keys, "indicator_id", "indicator_value", COUNTRY_COLUMNS)


@query
def series_annual_pivot(spark, sf):
    return reshape.annual(roles.monthly_series(spark, sf), US_COLUMNS)


@query
def mart_country_snapshot(spark, sf):
    return marts.country_snapshot(_country_years(spark, sf), SNAPSHOT_YEAR)


@query
def duration_by_borough(spark, sf):
    return serving.duration_by_borough(_durations(spark, sf))


@query
def latest_per_indicator(spark, sf):
    return serving.latest(_changes(spark, sf))


@query
def value_counts(spark, sf):
    trips = staging.cast_trips(roles.raw_trips(spark, sf))
    return profiling.value_counts(trips, ["payment_type", "rate_code_id", "store_and_fwd_flag"])


@query
def describe_measure(spark, sf):
    items = roles.table(spark, sf, "lineitem")
    return profiling.describe(items, ["l_extendedprice", "l_quantity", "l_tax"])


@query
def null_profile(spark, sf):
    return profiling.null_shares(roles.raw_trips(spark, sf))


@query
def range_profile(spark, sf):
    columns = ["pickup_datetime", "dropoff_datetime", "pickup_location_id"]
    return profiling.ranges(roles.event_trips(spark, sf), columns)


@query
def distinct_profile(spark, sf):
    return profiling.shape(roles.table(spark, sf, "orders"), "o_custkey")


@query
def top_zones(spark, sf):
    return serving.top_zones(_zone_hours(spark, sf))


# --- windows ---


@query
def prev_value(spark, sf):
    observed = roles.observations(spark, sf)
    lagged = windows.previous_value(observed, "event_type", ["observed_at", "event_id"], "value")
    return lagged.select("event_id", "event_type", "value", "prev_value")


@query
def mart_indicator_change(spark, sf):
    return _changes(spark, sf)


# --- samples, stacking, reshaping ---


@query
def sample_rows(spark, sf):
    return profiling.first_rows(roles.table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 5)


@query
def union_tagged(spark, sf):
    def monthly(name, at, amount):
        month = calendar.month_start(F.col(at).cast("date")).alias("observation_date")
        total = (F.sum(roles.cents(F.col(amount))) / 100).alias("value")
        return roles.table(spark, sf, name).groupBy(month).agg(total)

    extracts = {
        "Orders": monthly("orders", "o_orderdate", "o_totalprice"),
        "Shipments": monthly("lineitem", "l_shipdate", "l_extendedprice"),
        "Events": monthly("events", "ts", "value"),
    }
    return files.union_tagged(extracts)


@query
def heatmap_pivot(spark, sf):
    return reshape.hour_grid(serving.choose(_zone_hours(spark, sf), "pickup_borough", ["ASIA"]))


@query
def heatmap_borough_top(spark, sf):
    zone_hours = serving.choose(_zone_hours(spark, sf), "pickup_borough", ["ASIA"])
    return serving.only_top_zones(reshape.hour_grid(zone_hours), zone_hours, 3)


@query
def heatmap_long(spark, sf):
    return reshape.hour_cells(reshape.hour_grid(_zone_hours(spark, sf)))


@query
def duration_melt(spark, sf):
    metrics = {"avg_duration_minutes": "Average", "median_duration_minutes": "Median"}
    by_borough = serving.duration_by_borough(_durations(spark, sf))
    return reshape.metrics_long(by_borough, "pickup_borough", metrics)


@query
def kpi_cards(spark, sf):
    return indicators.headline(_changes(spark, sf), RATES, INVERSE, NEUTRAL)


# --- reports ---


@query
def serve_daily_revenue(spark, sf):
    return serving.serve(marts.daily_revenue(_with_pickup(spark, sf)), serving.DAILY_REVENUE)


@query
def serve_pickup_zones(spark, sf):
    return serving.serve(_zone_hours(spark, sf), serving.PICKUP_ZONES)


@query
def serve_payment(spark, sf):
    return serving.serve(marts.payment_summary(_valid(spark, sf)), serving.PAYMENT_SUMMARY)


@query
def serve_duration(spark, sf):
    return serving.serve(_durations(spark, sf), serving.TRIP_DURATION)


@query
def serve_indicators(spark, sf):
    return serving.serve(_changes(spark, sf), serving.INDICATORS)


# --- incremental upkeep ---


@query
def incremental_new_months(spark, sf):
    trips = _with_pickup(spark, sf)
    built = marts.daily_revenue(trips.where(F.col("pickup_date") <= CUT_DAY))
    fresh = incremental.newer_months(trips, "pickup_date", built, "pickup_date")
    return marts.daily_revenue(fresh)


@query
def upsert_by_key(spark, sf):
    mart = marts.daily_revenue(_with_pickup(spark, sf)).select(
        "pickup_date", "pickup_borough", "total_trips", "total_revenue"
    )
    built = mart.where(F.col("pickup_date") <= CUT_DAY)
    changes = mart.where(F.col("pickup_date") >= date(1998, 6, 1)).withColumn(
        "total_trips", F.col("total_trips") + 1000
    )
    return incremental.upsert(built, changes, ["pickup_date", "pickup_borough"])


@query
def incremental_recompute(spark, sf):
    trips = _with_pickup(spark, sf, keys=("l_orderkey",))
    arrived = (F.col("pickup_date") > CUT_DAY) | (F.col("l_orderkey") % 50 == 0)
    keys = ["pickup_date", "pickup_borough"]
    built = marts.daily_revenue(trips.where(~arrived))
    touched = joins.hold(trips.where(arrived).select(*keys).distinct())
    fresh = incremental.recompute_touched(touched, trips, keys, marts.daily_revenue)
    return incremental.upsert(built, joins.hold(fresh), keys)


# --- data quality ---


@query
def dq_not_null(spark, sf):
    checks = [quality.not_null(column) for column in contracts.RAW_NOT_NULL]
    return quality.run_suite(_checked(spark, sf), checks)


@query
def dq_unique(spark, sf):
    return quality.repeated_values(roles.table(spark, sf, "orders"), "o_custkey")


@query
def dq_accepted_values(spark, sf):
    trips = staging.cast_trips(roles.raw_trips(spark, sf))
    return quality.unaccepted_values(trips, "rate_code_id", contracts.RATE_CODES)


@query
def dq_pair_greater(spark, sf):
    check = quality.greater("TPEP_DROPOFF_DATETIME", "TPEP_PICKUP_DATETIME", mostly=0.97)
    return quality.run_suite(_checked(spark, sf), [check])


@query
def dq_range_mostly(spark, sf):
    checks = [
        quality.between("FARE_AMOUNT", low=0, mostly=0.88),
        quality.between("TRIP_DISTANCE", low=0, high=40, mostly=0.95),
    ]
    return quality.run_suite(_checked(spark, sf), checks)


@query
def dq_in_set_mostly(spark, sf):
    check = quality.in_set("RATECODEID", contracts.RATE_CODE_TEXTS, mostly=0.97)
    return quality.run_suite(_checked(spark, sf), [check])


@query
def dq_row_count(spark, sf):
    bounds = [quality.row_count(*contracts.SAMPLE_ROWS), quality.row_count(*contracts.MONTH_ROWS)]
    return quality.run_suite(roles.table(spark, sf, "lineitem"), bounds)


@query
def expect_columns(spark, sf):
    lineitem = roles.table(spark, sf, "lineitem")
    expected = [lineitem.columns, [*lineitem.columns[1:], "l_comment"]]
    return quality.run_suite(lineitem, [quality.column_set(names) for names in expected])


@query
def dq_order_violations(spark, sf):
    trips = roles.trips(spark, sf, keys=ITEM_KEYS)
    columns = [*ITEM_KEYS, "pickup_datetime", "dropoff_datetime"]
    return quality.out_of_order(trips).select(columns)


@query
def dq_value_range(spark, sf):
    return quality.out_of_range(roles.series(spark, sf), "error", 0.0, 700.0)


@query
def dq_change_limit(spark, sf):
    return quality.large_changes(_changes(spark, sf), 10.0).select(
        "observation_date", "indicator_name", "mom_change"
    )


@query
def dq_suite_report(spark, sf):
    return quality.run_suite(_checked(spark, sf), contracts.raw_trip_suite())


@query
def dq_suite_verdict(spark, sf):
    return quality.suite_verdict(dq_suite_report(spark, sf))


@query
def dq_contract(spark, sf):
    trips = _valid(spark, sf, dropoff=True)
    months = [f"{year}-{month:02d}" for year in range(1995, 2002) for month in range(1, 13)]
    return quality.run_contract(
        trips, contracts.staged_trips_contract(months), {"zones": roles.zones(spark, sf)}
    )


@query
def dq_mart_contracts(spark, sf):
    models = {
        "mart_daily_revenue": (mart_daily_revenue(spark, sf), contracts.DAILY_REVENUE),
        "mart_pickup_zones": (mart_pickup_zones(spark, sf), contracts.PICKUP_ZONES),
        "mart_payment_summary": (mart_payment_summary(spark, sf), contracts.PAYMENT_SUMMARY),
        "mart_trip_duration": (mart_trip_duration(spark, sf), contracts.TRIP_DURATION),
    }
    return quality.run_contracts(models, {})


@query
def dq_indicator_contracts(spark, sf):
    limits = indicators.IndicatorLimits("error", 0.0, 700.0, 10.0)
    return indicators.audit(
        roles.raw_series(spark, sf),
        roles.series(spark, sf),
        _changes(spark, sf),
        ["click", "error", "purchase", "signup"],
        limits,
        AS_OF,
    )


@query
def dq_snapshot_contracts(spark, sf):
    mart = marts.country_snapshot(_country_years(spark, sf), SNAPSHOT_YEAR)
    return snapshot.audit(
        roles.monthly_series(spark, sf),
        roles.country_long(spark, sf),
        marts.stamped(mart),
        PRIORITIES[:2],
        [str(code) for code in range(10)],
        ["F", "O"],
    )


@query
def dq_freshness(spark, sf):
    return quality.freshness(roles.raw_series(spark, sf), AS_OF).withColumn(
        "newest", F.col("newest").cast("timestamp_ntz")
    )


# --- end to end ---


def _delivered(spark, sf):
    """Raw trips in two deliveries; the second brings late rows of the first's months."""
    raw = roles.raw_trips(spark, sf)
    label = _delivery_of(F.col("SOURCE_MONTH"), F.col("FARE_AMOUNT"))
    return raw.withColumn("SOURCE_MONTH", label).select(RAW_TRIPS.names)


def _recoded(raw):
    """Unknown codes recoded and times given in reverse swapped."""
    code, vendor = F.col("RATECODEID"), F.col("VENDORID")
    times = ("TPEP_PICKUP_DATETIME", "TPEP_DROPOFF_DATETIME")
    unusual = (code == "1.5") & (F.col("STORE_AND_FWD_FLAG") != "Y")
    return raw.withColumns(
        {
            "RATECODEID": F.when(code == "0.0", "99.0").when(code == "7.0", "6.0").when(unusual, "2.0").otherwise(code),
            "VENDORID": F.coalesce(labels.recode(vendor, {"3.0": "1.0", "4.0": "2.0", "5.0": "6.0"}), vendor),
            "TPEP_PICKUP_DATETIME": F.least(*times),
            "TPEP_DROPOFF_DATETIME": F.greatest(*times),
        }
    )


def _repaired(raw):
    """A delivery as it passes the gate and the contract, junk left out."""
    sound = (
        (F.col("VENDORID") != "x")
        & (F.col("TPEP_PICKUP_DATETIME") != "not a time")
        & (F.col("FARE_AMOUNT") != "nan")
        & (F.col("PULOCATIONID") != "24.0")
        & (F.col("DOLOCATIONID") != "24.0")
    )
    return _recoded(raw.where(sound))


def _mended(raw):
    """A delivery as it passes the gate and the contract, with every row it was sent with.

    A trip without a readable time lasts no time and one without a readable fare costs
    nothing, so the job's own rule for valid trips judges them.
    """
    vendor, pickup, fare = F.col("VENDORID"), F.col("TPEP_PICKUP_DATETIME"), F.col("FARE_AMOUNT")
    readable = raw.withColumns(
        {
            "VENDORID": F.when(vendor == "x", "6.0").otherwise(vendor),
            "TPEP_PICKUP_DATETIME": F.when(pickup == "not a time", F.col("TPEP_DROPOFF_DATETIME")).otherwise(pickup),
            "FARE_AMOUNT": F.when(fare == "nan", "0.0").otherwise(fare),
        }
    )
    return _recoded(readable)


def _as_sent(raw):
    return raw


def _all_zones(spark, sf):
    """The zones, and the one that has no borough."""
    zones = roles.raw_zones(spark, sf)
    outside = [(f"{roles.UNKNOWN_NATION}.0", None, None, None)]
    return zones.unionByName(spark.createDataFrame(outside, ", ".join(f"{c} string" for c in zones.columns)))


SETTINGS = trip_job.TripSettings(FIRST_DAY, END_DAY, *BAND)
GATE = contracts.raw_trip_suite(RAW_ROWS, RAW_TRIPS.names)
CONTRACT = contracts.staged_trips_contract([CUT_MONTH, LAST_DELIVERY])


def _run_months(spark, sf, folder, deliveries, zones=None):
    """One run for each ``(month, repair)`` behind all 16 checks and the contract."""
    raw, zones = _delivered(spark, sf), roles.raw_zones(spark, sf) if zones is None else zones
    for number, (month, repair) in enumerate(deliveries):
        delivery = raw.where(F.col("SOURCE_MONTH") == month)
        trip_job.run_month(
            spark,
            repair(delivery),
            zones,
            folder,
            month,
            f"run-{number}",
            GATE,
            SETTINGS,
            CONTRACT,
        )


_jobs: dict[tuple[str, str], str] = {}


def _trips_job(spark, sf):
    """Folder of the marts after both deliveries; built once for the queries that read it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _jobs:
        folder = work_path(spark, "trips")
        _run_months(spark, sf, folder, [(CUT_MONTH, _repaired), (LAST_DELIVERY, _repaired)])
        _jobs[key] = folder
    return _jobs[key]


@query
def trips_end_to_end(spark, sf):
    """Both deliveries with all their rows."""
    folder = work_path(spark, "trips")
    deliveries = [(CUT_MONTH, _mended), (LAST_DELIVERY, _mended)]
    _run_months(spark, sf, folder, deliveries, _all_zones(spark, sf))
    return spark.read.parquet(f"{folder}/mart_daily_revenue").drop("mart_month")


@query
def trips_end_to_end_duration(spark, sf):
    return spark.read.parquet(f"{_trips_job(spark, sf)}/mart_trip_duration").drop("mart_month")


@query
def trips_end_to_end_zones(spark, sf):
    return sinks.read_refreshed(spark, f"{_trips_job(spark, sf)}/mart_pickup_zones")


@query
def trips_end_to_end_payment(spark, sf):
    return sinks.read_refreshed(spark, f"{_trips_job(spark, sf)}/mart_payment_summary")


@query
def gated_publish(spark, sf):
    folder = work_path(spark, "trips")
    _run_months(spark, sf, folder, [(CUT_MONTH, _repaired), (LAST_DELIVERY, _as_sent)])
    published = spark.read.parquet(f"{folder}/mart_daily_revenue")
    return published.agg(F.sum("total_trips").alias("published_trips"))


@query
def run_log(spark, sf):
    folder = work_path(spark, "trips")
    _run_months(spark, sf, folder, [(CUT_MONTH, _as_sent), (CUT_MONTH, _repaired)])
    return spark.read.parquet(f"{folder}/run_log")


@query
def stream_to_marts(spark, sf):
    """Two deliveries; the run of the second dies between two marts and is repeated."""
    drop, folder, state = (work_path(spark, name) for name in ("drop", "marts", "state"))
    zones = roles.zones(spark, sf)

    def dies(spark, tables, prepared, label):
        trip_job.publish_marts(spark, tables, prepared[:2], label)
        raise RuntimeError("killed")

    def caught_up(schema, **options):
        streamed_marts.stream_to_marts(spark, drop, folder, state, zones, SETTINGS, schema=schema, **options)

    first, second = _drop_files(spark, sf, drop).values()
    first[1].write.parquet(first[0])
    caught_up(first[1].schema)
    second[1].write.parquet(second[0])
    try:
        caught_up(second[1].schema, publish=dies)
    except StreamingQueryException as error:
        if "killed" not in str(error):
            raise
    caught_up(second[1].schema)
    return spark.read.parquet(f"{folder}/mart_daily_revenue").drop("mart_month")


ANY_CHANGE = indicators.IndicatorLimits("click", 0.0, 1e15, 1e15)


@query
def indicators_end_to_end(spark, sf):
    landed = _series_documents(spark, sf, _value_text(junk=True))
    names = {name: name for name in SERIES_NAMES}
    mart = indicators.refresh(spark, landed, work_path(spark, "indicators"), names, RATES, ANY_CHANGE)
    return mart.drop("updated_at")


@query
def indicators_gated(spark, sf):
    """A second delivery with impossible values is not published."""
    names = {name: name for name in SERIES_NAMES}
    folder, text = work_path(spark, "indicators"), _value_text(junk=True)
    indicators.refresh(spark, _series_documents(spark, sf, text), folder, names, RATES, ANY_CHANGE)
    negative = F.concat(F.lit("-"), F.col("value").cast("string"))
    broken = _series_documents(spark, sf, F.when(F.col("series_id") == "click", negative).otherwise(text))
    try:
        indicators.refresh(spark, broken, folder, names, RATES, ANY_CHANGE)
    except AuditFailed:
        return sinks.read_refreshed(spark, f"{folder}/mart_economic_indicators").drop("updated_at")
    raise AssertionError("a mart outside its limits was published")


@query
def snapshot_end_to_end(spark, sf):
    series = work_path(spark, "series_documents")
    (
        roles.monthly_series(spark, sf)
        .groupBy("series_id", F.year("observation_date").alias("year"))
        .agg(
            F.collect_list(
                F.struct(
                    F.col("observation_date").cast("string").alias("date"),
                    F.col("indicator_value").cast("string").alias("value"),
                )
            ).alias("observations")
        )
        .select("series_id", F.to_json(F.struct("observations")).alias("value"))
        .write.partitionBy("series_id")
        .option("maxRecordsPerFile", 1)
        .text(series)
    )
    country = _country_documents(spark, sf)
    names = {identifier: identifier for identifier in PRIORITIES}
    folder = work_path(spark, "snapshot")
    for _ in range(2):
        mart = snapshot.refresh(
            spark,
            series,
            country,
            folder,
            series_names=names,
            indicator_names=INDICATOR_NAMES,
            country_codes=[str(code) for code in range(roles.ZONE_COUNT)],
            country_columns=COUNTRY_COLUMNS,
            us_columns=US_COLUMNS,
            load_after_year=1994,
            first_year=SNAPSHOT_YEAR,
        )
    return mart.drop("updated_at")
