"""Reference SQL (DuckDB) for the queries, over the same tables."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}


# --- expression builders ---


def rounded(value: str, digits: int) -> str:
    scale = f"1e{digits}"
    return f"(sign({value}) * floor(abs({value}) * {scale} + 0.5) / {scale} + 0e0)"


def total(column: str) -> str:
    return f"CAST(round(sum(CAST({column} AS DECIMAL(18, 4))), 2) AS DOUBLE)"


def mean(column: str, digits: int = 2) -> str:
    exact = f"CAST(sum(CAST({column} AS DECIMAL(18, 4))) AS DOUBLE) / count({column})"
    return rounded(exact, digits)


def whole_mean(column: str) -> str:
    return rounded(f"CAST(sum({column}) AS DOUBLE) / count({column})", 1)


def safe_double(text: str) -> str:
    number = f"try_cast({text} AS DOUBLE)"
    return f"CASE WHEN isfinite({number}) THEN {number} END"


def safe_int(text: str) -> str:
    return f"try_cast(round({safe_double(text)}) AS INTEGER)"


# --- common table expressions ---

CTES = {
    "zones": """
        SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
               CASE WHEN n_nationkey % 5 = 0 THEN 'core' ELSE 'outer' END AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24""",
    "items": """
        SELECT l.*, o_orderdate, o_orderpriority, c_nationkey, s_nationkey,
               CAST(floor(l_extendedprice * 100 + 0.5e0) AS BIGINT) AS fare_c,
               CAST(floor(l_discount * 100 + 0.5e0) AS BIGINT) AS off_c,
               CAST(floor(l_tax * 100 + 0.5e0) AS BIGINT) AS tax_c
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "trips": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               l_linenumber AS vendor_id, o_orderdate AS pickup_datetime,
               l_shipdate AS dropoff_datetime,
               CAST(CAST(l_quantity AS INTEGER) % 8 AS INTEGER) AS passenger_count,
               l_quantity AS trip_distance, c_nationkey AS pickup_location_id,
               s_nationkey AS dropoff_location_id,
               CAST(l_suppkey % 8 AS INTEGER) AS rate_code_id,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
               fare_c / 100 AS fare_amount, tax_c / 100 AS extra, 0.5e0 AS mta_tax,
               ((fare_c * off_c + 50) // 100) / 100 AS tip_amount, off_c / 100 AS tolls_amount,
               1e0 AS improvement_surcharge,
               ((fare_c * (100 - off_c) * (100 + tax_c) + 5000) // 10000) / 100 AS total_amount,
               2.5e0 AS congestion_surcharge,
               CASE WHEN l_linestatus = 'O' THEN 1.75e0 ELSE 0e0 END AS airport_fee,
               0.75e0 AS cbd_congestion_fee,
               CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
               strftime(o_orderdate, '%Y-%m') AS source_month,
               date_diff('minute', o_orderdate, l_shipdate) AS trip_duration_minutes,
               CAST(o_orderdate AS DATE) AS pickup_date
        FROM items""",
    "valid": """
        SELECT * FROM trips WHERE pickup_datetime < dropoff_datetime
          AND pickup_datetime >= TIMESTAMP '1995-01-01' AND pickup_datetime < TIMESTAMP '2002-01-01'
          AND fare_amount > 0 AND trip_distance > 0""",
    "joined": """
        SELECT t.*, p.borough AS pickup_borough, p.zone AS pickup_zone,
               p.service_zone AS pickup_service_zone, d.borough AS dropoff_borough,
               d.zone AS dropoff_zone, d.service_zone AS dropoff_service_zone
        FROM valid t LEFT JOIN zones p ON t.pickup_location_id = p.location_id
        LEFT JOIN zones d ON t.dropoff_location_id = d.location_id""",
    "raw": """
        SELECT l_orderkey,
          CASE WHEN l_orderkey % 47 = 0 THEN 'x' ELSE vendor_id || '.0' END AS VENDORID,
          CASE WHEN l_orderkey % 53 = 0 THEN 'not a time'
               ELSE CAST(pickup_datetime AS VARCHAR) END AS TPEP_PICKUP_DATETIME,
          CAST(dropoff_datetime AS VARCHAR) AS TPEP_DROPOFF_DATETIME,
          CASE WHEN l_orderkey % 43 <> 0 THEN passenger_count || '.0' END AS PASSENGER_COUNT,
          CASE WHEN l_orderkey % 61 = 0 THEN ' 0.0 '
               ELSE CAST(trip_distance AS VARCHAR) END AS TRIP_DISTANCE,
          CASE WHEN l_orderkey % 37 = 0 THEN '1.5' ELSE rate_code_id || '.0' END AS RATECODEID,
          store_and_fwd_flag AS STORE_AND_FWD_FLAG,
          pickup_location_id || '.0' AS PULOCATIONID, dropoff_location_id || '.0' AS DOLOCATIONID,
          payment_type || '.0' AS PAYMENT_TYPE,
          CASE WHEN l_orderkey % 41 = 0 THEN 'nan' WHEN l_orderkey % 59 = 0 THEN '-1.5'
               ELSE CAST(fare_amount AS VARCHAR) END AS FARE_AMOUNT,
          CAST(extra AS VARCHAR) AS EXTRA, CAST(mta_tax AS VARCHAR) AS MTA_TAX,
          CAST(tip_amount AS VARCHAR) AS TIP_AMOUNT, CAST(tolls_amount AS VARCHAR) AS TOLLS_AMOUNT,
          CAST(improvement_surcharge AS VARCHAR) AS IMPROVEMENT_SURCHARGE,
          CAST(total_amount AS VARCHAR) AS TOTAL_AMOUNT,
          CAST(congestion_surcharge AS VARCHAR) AS CONGESTION_SURCHARGE,
          CAST(airport_fee AS VARCHAR) AS AIRPORT_FEE,
          CAST(cbd_congestion_fee AS VARCHAR) AS CBD_CONGESTION_FEE,
          source_month AS SOURCE_MONTH
        FROM trips""",
    "typed": """
        SELECT {ints}, {doubles},
          try_cast(TPEP_PICKUP_DATETIME AS TIMESTAMP) AS pickup_datetime,
          try_cast(TPEP_DROPOFF_DATETIME AS TIMESTAMP) AS dropoff_datetime,
          STORE_AND_FWD_FLAG AS store_and_fwd_flag, SOURCE_MONTH AS source_month,
          date_diff('minute', try_cast(TPEP_PICKUP_DATETIME AS TIMESTAMP),
                    try_cast(TPEP_DROPOFF_DATETIME AS TIMESTAMP)) AS trip_duration_minutes,
          CAST(try_cast(TPEP_PICKUP_DATETIME AS TIMESTAMP) AS DATE) AS pickup_date
        FROM raw""".format(
        ints=", ".join(
            f"{safe_int(source)} AS {name}"
            for source, name in [
                ("VENDORID", "vendor_id"),
                ("PASSENGER_COUNT", "passenger_count"),
                ("PULOCATIONID", "pickup_location_id"),
                ("DOLOCATIONID", "dropoff_location_id"),
                ("RATECODEID", "rate_code_id"),
                ("PAYMENT_TYPE", "payment_type"),
            ]
        ),
        doubles=", ".join(
            f"{safe_double(name.upper())} AS {name}"
            for name in [
                "trip_distance",
                "fare_amount",
                "extra",
                "mta_tax",
                "tip_amount",
                "tolls_amount",
                "improvement_surcharge",
                "total_amount",
                "congestion_surcharge",
                "airport_fee",
                "cbd_congestion_fee",
            ]
        ),
    ),
    "typed_valid": """
        SELECT * FROM typed WHERE pickup_datetime < dropoff_datetime
          AND pickup_datetime >= TIMESTAMP '1995-01-01' AND pickup_datetime < TIMESTAMP '2002-01-01'
          AND fare_amount > 0 AND trip_distance > 0""",
    "short_all": """
        SELECT *, date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
               CAST(pickup_datetime AS DATE) AS pickup_date,
               fare_c / 100 AS fare_amount, tip_c / 100 AS tip_amount,
               (fare_c + tip_c) / 100 AS total_amount
        FROM (
          SELECT *, (fare_c * (event_id % 30) + 50) // 100 AS tip_c FROM (
            SELECT event_id, ts AS pickup_datetime,
                   ts + to_seconds(CAST(event_id * 37 % 14400 AS BIGINT)) AS dropoff_datetime,
                   (event_id % 300) / 10 AS trip_distance,
                   CAST(user_id % 25 AS INTEGER) AS pickup_location_id,
                   CASE WHEN event_id % 101 <> 0
                        THEN CAST(user_id * 7 % 27 AS INTEGER) END AS dropoff_location_id,
                   CASE WHEN event_id % 10 < 9
                        THEN CAST(event_id % 10 AS INTEGER) END AS payment_type,
                   CAST(floor(value * 100 + 0.5e0) AS BIGINT) AS fare_c
            FROM events))""",
    "short": """
        SELECT t.*, borough AS pickup_borough, zone AS pickup_zone
        FROM short_all t LEFT JOIN zones ON pickup_location_id = location_id
        WHERE pickup_datetime < dropoff_datetime
          AND pickup_datetime >= TIMESTAMP '2024-01-01' AND pickup_datetime < TIMESTAMP '2024-02-01'
          AND fare_amount > 0 AND trip_distance > 0""",
    "daily": """
        SELECT CAST(ts AS DATE) AS date, event_type AS series_id, event_type AS indicator_name,
               CAST(sum(CAST(floor(value * 100 + 0.5e0) AS BIGINT)) AS BIGINT) / 100 AS value,
               max(ts) AS loaded_at
        FROM events GROUP BY ALL""",
    "gappy": """
        SELECT CASE WHEN day(date) % 11 <> 0 THEN date END AS date,
               CASE WHEN day(date) % 7 <> 0 THEN value END AS value, indicator_name, series_id
        FROM daily""",
    "series": """
        SELECT date AS observation_date, indicator_name, series_id,
               CASE WHEN day(date) % 7 <> 0 THEN value END AS value
        FROM daily""",
    "lagged": """
        SELECT *, lag(value) OVER (PARTITION BY indicator_name ORDER BY observation_date)
               AS prev_value FROM series""",
    "changes": f"""
        SELECT *, CASE
            WHEN series_id IN ('error', 'view') THEN {rounded("(value - prev_value)", 2)}
            WHEN prev_value = 0 THEN NULL
            ELSE {rounded("((value - prev_value) / prev_value * 100)", 2)} END AS mom_change
        FROM lagged""",
    "monthly": """
        SELECT o_orderpriority AS series_id,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date,
               CAST(sum(CAST(floor(o_totalprice * 100 + 0.5e0) AS BIGINT)) AS BIGINT) / 100
                 AS indicator_value
        FROM orders GROUP BY ALL""",
    "country": """
        SELECT CAST(c_nationkey AS VARCHAR) AS country_code, n_name AS country_name,
               o_orderstatus AS indicator_id, CAST(year(o_orderdate) AS INTEGER) AS observation_year,
               CAST(sum(CAST(floor(o_totalprice * 100 + 0.5e0) AS BIGINT)) AS BIGINT) / 100
                 AS indicator_value
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    "wide": """
        SELECT country_code, country_name, observation_year,
               max(CASE WHEN indicator_id = 'F' THEN indicator_value END) AS gdp_usd,
               max(CASE WHEN indicator_id = 'O' THEN indicator_value END) AS inflation_rate,
               max(CASE WHEN indicator_id = 'P' THEN indicator_value END) AS unemployment_rate
        FROM country GROUP BY ALL""",
    "annual": """
        SELECT CAST(year(observation_date) AS INTEGER) AS observation_year,
               max(CASE WHEN series_id = '1-URGENT' THEN indicator_value END)
                 AS us_unemployment_fred,
               max(CASE WHEN series_id = '2-HIGH' THEN indicator_value END) AS us_cpi_fred,
               max(CASE WHEN series_id = '3-MEDIUM' THEN indicator_value END) AS us_real_gnp_fred
        FROM monthly GROUP BY ALL""",
    "country_us": "SELECT * FROM wide LEFT JOIN annual USING (observation_year)",
}
REVENUE = f"""
    count(*) AS total_trips, {total("fare_amount")} AS total_fare_revenue,
    {total("tip_amount")} AS total_tips, {total("total_amount")} AS total_revenue,
    {mean("fare_amount")} AS avg_fare, {mean("tip_amount")} AS avg_tip,
    {mean("trip_distance")} AS avg_distance_miles,
    {whole_mean("trip_duration_minutes")} AS avg_duration_minutes"""


def revenue_from(source: str, where: str = "true") -> str:
    return f"""SELECT pickup_date, pickup_borough, {REVENUE} FROM {source}
        WHERE pickup_borough IS NOT NULL AND {where} GROUP BY pickup_date, pickup_borough"""


PAYMENT_LABEL = """CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash'
    WHEN 3 THEN 'No Charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided Trip'
    ELSE 'Other' END"""
TIP_RATE = rounded("avg(CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 END)", 2)

CTES |= {
    "revenue": revenue_from("joined"),
    "zone_hours": f"""
        SELECT pickup_borough, pickup_zone, CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day,
               count(*) AS total_trips, {mean("fare_amount")} AS avg_fare,
               {mean("trip_distance")} AS avg_distance_miles,
               {whole_mean("trip_duration_minutes")} AS avg_duration_minutes
        FROM short WHERE pickup_borough IS NOT NULL AND pickup_zone IS NOT NULL
        GROUP BY pickup_borough, pickup_zone, hour(pickup_datetime)""",
    "payments": f"""
        SELECT payment_type, {PAYMENT_LABEL} AS payment_label, count(*) AS total_trips,
               {total("total_amount")} AS total_revenue, {mean("fare_amount")} AS avg_fare,
               {mean("tip_amount")} AS avg_tip, {TIP_RATE} AS avg_tip_rate_pct,
               {mean("trip_distance")} AS avg_distance_miles,
               {whole_mean("trip_duration_minutes")} AS avg_duration_minutes
        FROM valid GROUP BY payment_type""",
    "durations": f"""
        SELECT pickup_date AS trip_date, pickup_borough, count(*) AS total_trips,
               {whole_mean("trip_duration_minutes")} AS avg_duration_minutes,
               {rounded("quantile_cont(trip_duration_minutes, 0.5)", 1)} AS median_duration_minutes,
               {mean("trip_distance")} AS avg_distance_miles,
               min(trip_duration_minutes) AS min_duration_minutes,
               max(trip_duration_minutes) AS max_duration_minutes
        FROM joined
        WHERE pickup_borough IS NOT NULL AND trip_duration_minutes BETWEEN 1 AND 2000000
        GROUP BY pickup_date, pickup_borough""",
    "by_borough": """
        SELECT pickup_borough,
               CAST(sum(CAST(avg_duration_minutes AS DECIMAL(18, 4))) AS DOUBLE) / count(*)
                 AS avg_duration_minutes,
               CAST(sum(CAST(median_duration_minutes AS DECIMAL(18, 4))) AS DOUBLE) / count(*)
                 AS median_duration_minutes,
               CAST(sum(total_trips) AS BIGINT) AS total_trips
        FROM durations GROUP BY pickup_borough""",
    "top": """
        SELECT pickup_zone, CAST(sum(total_trips) AS BIGINT) AS total_trips FROM zone_hours
        GROUP BY pickup_zone ORDER BY total_trips DESC, pickup_zone LIMIT 20""",
    "grid": "SELECT pickup_zone, "
    + ", ".join(
        f"coalesce(avg(CASE WHEN hour_of_day = {h} THEN total_trips END), 0) AS h{h:02d}"
        for h in range(24)
    )
    + " FROM zone_hours GROUP BY pickup_zone",
}

# Which other expressions each one reads.
USES = {
    "trips": ["items"],
    "valid": ["trips"],
    "joined": ["valid", "zones"],
    "raw": ["trips"],
    "typed": ["raw"],
    "typed_valid": ["typed"],
    "short": ["short_all", "zones"],
    "gappy": ["daily"],
    "series": ["daily"],
    "lagged": ["series"],
    "changes": ["lagged"],
    "wide": ["country"],
    "annual": ["monthly"],
    "country_us": ["wide", "annual"],
    "revenue": ["joined"],
    "zone_hours": ["short"],
    "payments": ["valid"],
    "durations": ["joined"],
    "by_borough": ["durations"],
    "top": ["zone_hours"],
    "grid": ["zone_hours"],
}


def sql(body: str, *names: str) -> str:
    """``body`` with the named expressions, and those they read, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in USES.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    heads = ", ".join(f"{name} AS ({CTES[name].strip()})" for name in order)
    return f"WITH {heads} {body}" if heads else body


O = ORACLE_SQL

O["scan_fact"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
    l_extendedprice FROM lineitem"""
O["profile_files"] = "SELECT count(*) AS n_rows, " + ", ".join(
    f"min({c}) AS min_{c}, max({c}) AS max_{c}"
    for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
) + " FROM lineitem"
O["rows_per_file"] = " UNION ALL ".join(
    f"SELECT '{name}.parquet' AS file_name, count(*) AS n_rows FROM {name}"
    for name in ("customer", "orders", "lineitem", "events")
)
O["scan_csv_dim"] = sql(
    """SELECT CAST(location_id AS VARCHAR) AS LOCATIONID,
       CASE WHEN location_id % 7 <> 0 THEN borough END AS BOROUGH, zone || ', airport' AS ZONE,
       CASE WHEN location_id % 3 <> 0 THEN service_zone END AS SERVICE_ZONE FROM zones""",
    "zones",
)
O["ingest_series_json"] = sql(
    """SELECT date, CASE WHEN day(date) % 7 <> 0 AND day(date) % 13 <> 0 THEN value END AS value,
       series_id || ' total' AS indicator_name, series_id FROM daily""",
    "daily",
)
O["ingest_series_json_strict"] = sql(
    """SELECT series_id, series_id || ' total' AS series_name, date,
       CASE WHEN day(date) % 7 <> 0 THEN value END AS value FROM daily""",
    "daily",
)
INDICATOR_NAME = "CASE indicator_id WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'pending' END"
DELIVERED = "country_code NOT IN ('7', '8') AND observation_year % 5 <> 0"
O["ingest_country_json"] = sql(
    f"""SELECT country_code, country_name, indicator_id, {INDICATOR_NAME} AS indicator_name,
        observation_year AS year, indicator_value AS value FROM country WHERE {DELIVERED}""",
    "country",
)
O["raw_stringify"] = sql(
    """SELECT CAST(vendor_id AS VARCHAR) AS VENDORID,
       CAST(pickup_datetime AS VARCHAR) AS TPEP_PICKUP_DATETIME,
       CAST(dropoff_datetime AS VARCHAR) AS TPEP_DROPOFF_DATETIME,
       passenger_count || '.0' AS PASSENGER_COUNT, CAST(trip_distance AS VARCHAR) AS TRIP_DISTANCE,
       rate_code_id || '.0' AS RATECODEID, store_and_fwd_flag AS STORE_AND_FWD_FLAG,
       CAST(pickup_location_id AS VARCHAR) AS PULOCATIONID,
       CAST(dropoff_location_id AS VARCHAR) AS DOLOCATIONID,
       CAST(payment_type AS VARCHAR) AS PAYMENT_TYPE, CAST(fare_amount AS VARCHAR) AS FARE_AMOUNT,
       CAST(extra AS VARCHAR) AS EXTRA, CAST(mta_tax AS VARCHAR) AS MTA_TAX,
       CAST(tip_amount AS VARCHAR) AS TIP_AMOUNT, CAST(tolls_amount AS VARCHAR) AS TOLLS_AMOUNT,
       CAST(improvement_surcharge AS VARCHAR) AS IMPROVEMENT_SURCHARGE,
       CAST(total_amount AS VARCHAR) AS TOTAL_AMOUNT,
       CAST(congestion_surcharge AS VARCHAR) AS CONGESTION_SURCHARGE,
       CAST(airport_fee AS VARCHAR) AS AIRPORT_FEE,
       CAST(cbd_congestion_fee AS VARCHAR) AS CBD_CONGESTION_FEE,
       source_month AS SOURCE_MONTH FROM trips""",
    "trips",
)
O["load_skip_existing"] = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS source_month
    FROM orders WHERE strftime(o_orderdate, '%Y-%m') > '1998-06'"""
O["append_sink"] = """
    SELECT strftime(o_orderdate, '%Y-%m') AS SOURCE_MONTH, count(*) AS n_rows
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""
O["overwrite_sink"] = sql("SELECT * FROM zones", "zones")
O["full_refresh_sink"] = sql("SELECT date, value, indicator_name, series_id FROM daily", "daily")
O["hwm_by_series"] = sql(
    """SELECT d.date, d.value, d.indicator_name, d.series_id FROM daily d
       LEFT JOIN (SELECT series_id, max(date) AS newest FROM daily
                  WHERE date <= DATE '2024-01-15' AND series_id <> 'purchase' GROUP BY 1) n
         ON d.series_id = n.series_id
       WHERE d.date >= coalesce(newest, DATE '2000-01-01')""",
    "daily",
)
O["hwm_by_key_pair"] = sql(
    """SELECT c.* FROM country c
       LEFT JOIN (SELECT indicator_id, country_code, max(observation_year) AS newest FROM country
                  WHERE observation_year <= 1998 AND indicator_id <> 'P' GROUP BY 1, 2) n
         ON c.indicator_id = n.indicator_id AND c.country_code = n.country_code
       WHERE c.observation_year > coalesce(newest, 1999)""",
    "country",
)
O["typed_raw"] = sql(
    "SELECT date, value, indicator_name, series_id, true AS stamped FROM daily", "daily"
)
O["verify_load"] = sql(
    """SELECT 'total' AS section, 'trips' AS item, count(*) AS n_rows FROM trips
       UNION ALL SELECT 'month', source_month, count(*) FROM trips GROUP BY source_month
       UNION ALL SELECT 'dimension', 'zones', count(*) FROM zones""",
    "trips",
    "zones",
)
O["materialize_layers"] = sql(
    "SELECT payment_type, count(*) AS total_trips FROM short_all GROUP BY 1", "short_all"
)

STAGED = """vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
    pickup_location_id, dropoff_location_id, rate_code_id, payment_type, fare_amount, extra,
    mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
    airport_fee, cbd_congestion_fee, store_and_fwd_flag, source_month, trip_duration_minutes,
    pickup_date"""
O["stg_trips_cast"] = sql(f"SELECT {STAGED} FROM typed", "typed")
O["duration_minutes"] = sql(
    """SELECT event_id, trip_duration_minutes AS minutes,
       date_diff('minute', dropoff_datetime, pickup_datetime) AS reversed_minutes FROM short_all""",
    "short_all",
)
O["stg_trips_valid"] = sql(f"SELECT {STAGED} FROM typed_valid", "typed_valid")
O["stg_zones"] = sql("SELECT * FROM zones", "zones")
O["stg_series_keep_null"] = sql(
    """SELECT date AS observation_date, indicator_name, series_id, value FROM gappy
       WHERE date IS NOT NULL""",
    "gappy",
)
O["stg_series_drop_null"] = sql(
    """SELECT series_id, indicator_name AS series_name, date AS observation_date,
       value AS indicator_value FROM gappy WHERE value IS NOT NULL""",
    "gappy",
)
O["stg_country"] = sql(
    """SELECT country_code, country_name, indicator_id, lower(indicator_id) AS indicator_name,
       observation_year, indicator_value FROM country WHERE observation_year % 4 <> 0""",
    "country",
)
O["payment_label"] = sql(
    f"SELECT event_id, payment_type, {PAYMENT_LABEL} AS payment_label FROM short_all", "short_all"
)
O["anomaly_counts"] = sql(
    """SELECT count(*) FILTER (pickup_datetime >= dropoff_datetime) AS bad_times,
       count(*) FILTER (fare_amount <= 0) AS bad_fares,
       count(*) FILTER (trip_distance <= 0) AS bad_distances,
       count(*) FILTER (passenger_count <= 0 OR passenger_count > 6) AS bad_passengers FROM typed""",
    "typed",
)
SERVED = "pickup_date, pickup_borough, total_trips, total_revenue, avg_fare, avg_tip"
O["serve_filter_multi"] = sql(
    f"SELECT {SERVED} FROM revenue WHERE pickup_borough IN ('ASIA', 'EUROPE')", "revenue"
)
O["lookback_years"] = sql(
    """SELECT *, series_id AS indicator_name FROM monthly
       WHERE series_id = '2-HIGH' AND observation_date >= DATE '1998-08-01'""",
    "monthly",
)
O["trips_joined"] = sql(
    f"""SELECT {STAGED}, pickup_borough, pickup_zone, pickup_service_zone, dropoff_borough,
        dropoff_zone, dropoff_service_zone FROM joined""",
    "joined",
)
O["country_with_us"] = sql("SELECT * FROM country_us", "country_us")
O["ri_violations"] = """SELECT doc_id, lang FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"""
O["ri_profile"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{key}' AS column_name, count(*) AS n_unknown FROM short_all t
            WHERE NOT EXISTS (SELECT 1 FROM zones WHERE location_id = t.{key})"""
        for key in ("pickup_location_id", "dropoff_location_id")
    ),
    "short_all",
    "zones",
)
O["heatmap_top_zones"] = sql(
    "SELECT * FROM grid WHERE pickup_zone IN (SELECT pickup_zone FROM top)", "grid", "top"
)
O["mart_daily_revenue"] = sql("SELECT * FROM revenue", "revenue")
O["mart_pickup_zones"] = sql("SELECT * FROM zone_hours", "zone_hours")
O["mart_payment_summary"] = sql("SELECT * FROM payments", "payments")
O["avg_tip_rate"] = sql(
    f"SELECT payment_type, {TIP_RATE} AS avg_tip_rate_pct FROM short_all GROUP BY payment_type",
    "short_all",
)
O["mart_trip_duration"] = sql("SELECT * FROM durations", "durations")
O["median_duration"] = sql(
    """SELECT pickup_date, pickup_borough, quantile_cont(trip_duration_minutes, 0.5)
       AS median_minutes FROM short GROUP BY ALL""",
    "short",
)
O["country_pivot"] = sql("SELECT * FROM wide", "wide")
O["series_annual_pivot"] = sql("SELECT * FROM annual", "annual")
O["mart_country_snapshot"] = sql(
    f"""SELECT country_code, country_name, observation_year,
        {rounded("gdp_usd / 1e9", 2)} AS gdp_billions_usd,
        {rounded("inflation_rate", 2)} AS inflation_rate_pct,
        {rounded("unemployment_rate", 2)} AS unemployment_rate_pct,
        {rounded("us_unemployment_fred", 2)} AS us_unemployment_fred_pct,
        {rounded("us_cpi_fred", 2)} AS us_cpi_index,
        {rounded("us_real_gnp_fred / 1e3", 2)} AS us_real_gnp_trillions,
        {rounded("(unemployment_rate - us_unemployment_fred)", 2)} AS unemployment_vs_us_delta
        FROM country_us WHERE observation_year >= 1997""",
    "country_us",
)
O["duration_by_borough"] = sql("SELECT * FROM by_borough", "by_borough")
O["latest_per_indicator"] = sql(
    "SELECT indicator_name, "
    + ", ".join(
        f"arg_max({c}, observation_date) FILTER ({c} IS NOT NULL) AS {c}"
        for c in ("observation_date", "series_id", "value", "prev_value", "mom_change")
    )
    + " FROM changes GROUP BY indicator_name",
    "changes",
)
O["value_counts"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows
            FROM typed WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in ("payment_type", "rate_code_id", "store_and_fwd_flag")
    ),
    "typed",
)
O["describe_measure"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS measure, count({c}) AS n_rows, {mean(c, 4)} AS mean,
        {rounded(f"stddev_samp({c})", 4)} AS std, min({c}) AS min,
        {rounded(f"quantile_cont({c}, 0.25)", 4)} AS q25,
        {rounded(f"quantile_cont({c}, 0.5)", 4)} AS q50,
        {rounded(f"quantile_cont({c}, 0.75)", 4)} AS q75, max({c}) AS max FROM lineitem"""
    for c in ("l_extendedprice", "l_quantity", "l_tax")
)
RAW_COLUMNS = """VENDORID TPEP_PICKUP_DATETIME TPEP_DROPOFF_DATETIME PASSENGER_COUNT TRIP_DISTANCE
    RATECODEID STORE_AND_FWD_FLAG PULOCATIONID DOLOCATIONID PAYMENT_TYPE FARE_AMOUNT EXTRA MTA_TAX
    TIP_AMOUNT TOLLS_AMOUNT IMPROVEMENT_SURCHARGE TOTAL_AMOUNT CONGESTION_SURCHARGE AIRPORT_FEE
    CBD_CONGESTION_FEE SOURCE_MONTH""".split()
O["null_profile"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, 'string' AS column_type,
            {rounded(f"((count(*) - count({c})) * 100 / count(*))", 2)} AS null_percentage FROM raw"""
        for c in RAW_COLUMNS
    ),
    "raw",
)
O["range_profile"] = sql(
    "SELECT "
    + ", ".join(
        f"min({c}) AS min_{c}, max({c}) AS max_{c}"
        for c in ("pickup_datetime", "dropoff_datetime", "pickup_location_id")
    )
    + " FROM short_all",
    "short_all",
)
O["distinct_profile"] = """SELECT count(*) AS n_rows, 6 AS n_columns,
    count(DISTINCT o_custkey) AS n_distinct,
    bool_or(o_orderkey IS NULL OR o_custkey IS NULL OR o_orderstatus IS NULL
            OR o_totalprice IS NULL OR o_orderdate IS NULL OR o_orderpriority IS NULL) AS any_null
    FROM orders"""
O["top_zones"] = sql("SELECT * FROM top", "top")
O["prev_value"] = """SELECT event_id, event_type, value,
    lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev_value FROM events"""
CHANGE_COLUMNS = "observation_date, indicator_name, series_id, value, prev_value, mom_change"
O["mart_indicator_change"] = sql(f"SELECT {CHANGE_COLUMNS} FROM changes", "changes")
O["sample_rows"] = "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5"
O["union_tagged"] = " UNION ALL ".join(
    f"""SELECT CAST(date_trunc('month', {at}) AS DATE) AS observation_date,
        CAST(sum(CAST(floor({amount} * 100 + 0.5e0) AS BIGINT)) AS BIGINT) / 100 AS value,
        '{name}' AS indicator_name FROM {source} GROUP BY 1"""
    for name, source, at, amount in (
        ("Orders", "orders", "o_orderdate", "o_totalprice"),
        ("Shipments", "lineitem", "l_shipdate", "l_extendedprice"),
        ("Events", "events", "ts", "value"),
    )
)
O["heatmap_pivot"] = sql(
    CTES["grid"].replace("GROUP BY", "WHERE pickup_borough = 'ASIA' GROUP BY"), "zone_hours"
)
O["heatmap_long"] = sql(
    " UNION ALL ".join(
        f"SELECT pickup_zone, '{h:02d}:00' AS hour_label, h{h:02d} AS trips FROM grid"
        for h in range(24)
    ),
    "grid",
)
O["duration_melt"] = sql(
    """SELECT pickup_borough, 'Average' AS metric, avg_duration_minutes AS minutes FROM by_borough
       UNION ALL SELECT pickup_borough, 'Median', median_duration_minutes FROM by_borough""",
    "by_borough",
)
O["kpi_cards"] = sql(
    """SELECT indicator_name,
       CASE WHEN value IS NULL THEN 'N/A'
            WHEN indicator_name IN ('error', 'view') THEN format('{:.2f}%', value)
            ELSE format('{:,.2f}', value) END AS value_text,
       CASE WHEN change IS NULL THEN 'N/A'
            WHEN indicator_name IN ('error', 'view') THEN format('{:+.2f} pp', change)
            ELSE format('{:+.2f}%', change) END AS delta_text,
       CASE WHEN indicator_name IN ('click', 'view') THEN 'inverse'
            WHEN indicator_name = 'error' THEN 'off' ELSE 'normal' END AS delta_color
       FROM (SELECT indicator_name,
                    arg_max(value, observation_date) FILTER (value IS NOT NULL) AS value,
                    arg_max(mom_change, observation_date) FILTER (mom_change IS NOT NULL) AS change
             FROM changes GROUP BY indicator_name)""",
    "changes",
)
O["serve_daily_revenue"] = sql(f"SELECT {SERVED} FROM revenue", "revenue")
O["serve_pickup_zones"] = sql(
    "SELECT pickup_borough, pickup_zone, hour_of_day, total_trips FROM zone_hours", "zone_hours"
)
O["serve_payment"] = sql(
    "SELECT payment_label, total_trips, total_revenue, avg_tip_rate_pct FROM payments", "payments"
)
O["serve_duration"] = sql(
    """SELECT trip_date, pickup_borough, avg_duration_minutes, median_duration_minutes,
       total_trips FROM durations""",
    "durations",
)
O["serve_indicators"] = O["mart_indicator_change"]
O["incremental_new_months"] = sql(
    revenue_from("joined", "pickup_date >= DATE '1998-07-01'"), "joined"
)
O["upsert_by_key"] = sql(
    """SELECT pickup_date, pickup_borough, total_revenue,
       total_trips + CASE WHEN pickup_date >= DATE '1998-06-01' THEN 1000 ELSE 0 END AS total_trips
       FROM revenue""",
    "revenue",
)
O["incremental_recompute"] = O["mart_daily_revenue"]


# --- data quality reports ---


def report(number: int, kind: str, column: str, seen: str, bad: str, threshold: float) -> str:
    share = f"coalesce(CAST({seen} - {bad} AS DOUBLE) / nullif({seen}, 0), 1e0)"
    return f"""SELECT {number} AS check_no, '{kind}' AS check_kind, '{column}' AS column_name,
        {seen} AS n_evaluated, {bad} AS n_failing, {share} AS passing_share,
        CAST({threshold} AS DOUBLE) AS threshold, {share} >= {threshold}e0 AS passed FROM checked"""


def table_report(number: int, kind: str, seen: str, bad: str, passed: str) -> str:
    return f"""SELECT {number} AS check_no, '{kind}' AS check_kind, '' AS column_name,
        {seen} AS n_evaluated, {bad} AS n_failing,
        CASE WHEN {passed} THEN 1e0 ELSE 0e0 END AS passing_share, 1e0 AS threshold,
        {passed} AS passed FROM checked"""


def not_null_report(number: int, column: str) -> str:
    return report(
        number, "not_null", column, "count(*)", f"count(*) FILTER ({column} IS NULL)", 1.0
    )


def greater_report(number: int) -> str:
    a, b = "TPEP_DROPOFF_DATETIME", "TPEP_PICKUP_DATETIME"
    seen = f"count(*) FILTER ({a} IS NOT NULL OR {b} IS NOT NULL)"
    good = f"count(*) FILTER ({a} > {b})"
    return report(number, "greater", a, seen, f"({seen} - {good})", 0.97)


def filtered_report(number: int, kind: str, column: str, bad: str, threshold: float) -> str:
    return report(number, kind, column, f"count({column})", f"count(*) FILTER ({bad})", threshold)


CTES["checked"] = """
    SELECT raw.* REPLACE ({doubles},
        try_cast(TPEP_PICKUP_DATETIME AS TIMESTAMP) AS TPEP_PICKUP_DATETIME,
        try_cast(TPEP_DROPOFF_DATETIME AS TIMESTAMP) AS TPEP_DROPOFF_DATETIME) FROM raw""".format(
    doubles=", ".join(
        f"{safe_double(c)} AS {c}" for c in ("FARE_AMOUNT", "TRIP_DISTANCE", "TOTAL_AMOUNT")
    )
)
USES["checked"] = ["raw"]
NOT_NULL = """VENDORID TPEP_PICKUP_DATETIME TPEP_DROPOFF_DATETIME TRIP_DISTANCE PULOCATIONID
    DOLOCATIONID PAYMENT_TYPE FARE_AMOUNT TOTAL_AMOUNT SOURCE_MONTH""".split()
CODES = "('1.0', '2.0', '3.0', '4.0', '5.0', '6.0', '99.0')"
BAD_FARE, BAD_DISTANCE = "FARE_AMOUNT < 0", "TRIP_DISTANCE < 0"
BAD_CODE = f"RATECODEID NOT IN {CODES}"
ROWS_OK = "count(*) BETWEEN {} AND {}"

O["dq_not_null"] = sql(
    " UNION ALL ".join(not_null_report(i, c) for i, c in enumerate(NOT_NULL, 1)), "checked"
)
O["dq_unique"] = """SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey IS NOT NULL
    GROUP BY o_custkey HAVING count(*) > 1"""
O["dq_accepted_values"] = sql(
    """SELECT rate_code_id, count(*) AS n_rows FROM typed
       WHERE rate_code_id NOT IN (1, 2, 3, 4, 5, 6, 99) GROUP BY 1""",
    "typed",
)
O["dq_pair_greater"] = sql(greater_report(1), "checked")
O["dq_range_mostly"] = sql(
    filtered_report(1, "between", "FARE_AMOUNT", BAD_FARE, 0.88)
    + " UNION ALL "
    + filtered_report(2, "between", "TRIP_DISTANCE", "NOT TRIP_DISTANCE BETWEEN 0 AND 40", 0.95),
    "checked",
)
O["dq_in_set_mostly"] = sql(filtered_report(1, "in_set", "RATECODEID", BAD_CODE, 0.97), "checked")
O["dq_row_count"] = "WITH checked AS (SELECT * FROM lineitem) " + " UNION ALL ".join(
    table_report(i, "row_count", "count(*)", "CAST(0 AS BIGINT)", ROWS_OK.format(*bounds))
    for i, bounds in enumerate(((200000, 600000), (2000000, 6000000)), 1)
)
O["expect_columns"] = """
    WITH held AS (SELECT list(column_name) AS names FROM (DESCRIBE lineitem)),
    expected AS (SELECT 1 AS check_no, names AS wanted FROM held
                 UNION ALL SELECT 2, list_append(names[2:], 'l_comment') FROM held),
    compared AS (SELECT check_no, CAST(len(names) AS BIGINT) AS n_evaluated,
        CAST(len(list_filter(names, lambda n: NOT list_contains(wanted, n)))
           + len(list_filter(wanted, lambda n: NOT list_contains(names, n))) AS BIGINT) AS n_failing
        FROM expected, held)
    SELECT check_no, 'column_set' AS check_kind, '' AS column_name, n_evaluated, n_failing,
        CASE WHEN n_failing = 0 THEN 1e0 ELSE 0e0 END AS passing_share, 1e0 AS threshold,
        n_failing = 0 AS passed FROM compared"""
O["dq_order_violations"] = sql(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, pickup_datetime, dropoff_datetime
       FROM trips WHERE pickup_datetime >= dropoff_datetime""",
    "trips",
)
O["dq_value_range"] = sql(
    "SELECT * FROM series WHERE series_id = 'error' AND (value < 0 OR value > 700)", "series"
)
O["dq_change_limit"] = sql(
    """SELECT observation_date, indicator_name, mom_change FROM changes
       WHERE mom_change IS NOT NULL AND abs(mom_change) > 10""",
    "changes",
)
SUITE = " UNION ALL ".join(
    [
        *[not_null_report(i, c) for i, c in enumerate(NOT_NULL, 1)],
        greater_report(11),
        filtered_report(12, "between", "FARE_AMOUNT", BAD_FARE, 0.88),
        filtered_report(13, "between", "TRIP_DISTANCE", BAD_DISTANCE, 0.95),
        filtered_report(14, "in_set", "RATECODEID", BAD_CODE, 0.97),
        table_report(
            15, "row_count", "count(*)", "CAST(0 AS BIGINT)", ROWS_OK.format(200000, 600000)
        ),
        table_report(16, "column_set", "CAST(21 AS BIGINT)", "CAST(0 AS BIGINT)", "count(*) >= 0"),
    ]
)
O["dq_suite_report"] = sql(SUITE, "checked")
O["dq_suite_verdict"] = sql(
    f"""SELECT count(*) AS n_checks, count(*) FILTER (passed) AS n_passed,
        count(*) FILTER (NOT passed) AS n_failed, bool_and(passed) AS success FROM ({SUITE})""",
    "checked",
)
REQUIRED = """vendor_id pickup_datetime dropoff_datetime trip_distance pickup_location_id
    dropoff_location_id payment_type fare_amount total_amount source_month trip_duration_minutes
    pickup_date""".split()
VIOLATIONS = [("not_null", c, f"{c} IS NULL") for c in REQUIRED] + [
    ("in_set", "vendor_id", "vendor_id NOT IN (1, 2, 6, 7)"),
    ("in_set", "rate_code_id", "rate_code_id NOT IN (1, 2, 3, 4, 5, 6, 99)"),
    ("in_set", "payment_type", "payment_type NOT IN (0, 1, 2, 3, 4, 5, 6)"),
    ("in_set", "source_month", "source_month NOT BETWEEN '1995-01' AND '2001-12'"),
    *[
        ("relationship", f"{side}_location_id", f"{side}_location_id NOT IN (FROM known)")
        for side in ("pickup", "dropoff")
    ],
]
CTES["known"] = "SELECT location_id FROM zones"
USES["known"] = ["zones"]
O["dq_contract"] = sql(
    " UNION ALL ".join(
        f"""SELECT '{kind}' AS check_kind, '{column}' AS column_name, count(*) AS n_failing,
            count(*) = 0 AS passed FROM valid WHERE {bad}"""
        for kind, column, bad in VIOLATIONS
    ),
    "valid",
    "known",
)
MART_CHECKS = [
    *[
        (mart, cte, "not_null", c, f"{c} IS NULL")
        for mart, cte, columns in (
            ("daily_revenue", "revenue", "pickup_date pickup_borough total_trips total_revenue"),
            ("pickup_zones", "zone_hours", "pickup_borough pickup_zone hour_of_day total_trips"),
            ("payment_summary", "payments", "payment_type payment_label total_trips"),
            ("trip_duration", "durations", "trip_date pickup_borough total_trips"),
        )
        for c in columns.split()
    ],
    ("pickup_zones", "zone_hours", "in_set", "hour_of_day", "hour_of_day NOT BETWEEN 0 AND 23"),
    (
        "payment_summary",
        "payments",
        "unique",
        "payment_type",
        "payment_type IN (SELECT payment_type FROM payments GROUP BY 1 HAVING count(*) > 1)",
    ),
]
O["dq_mart_contracts"] = sql(
    " UNION ALL ".join(
        f"""SELECT 'mart_{mart}' AS model, '{kind}' AS check_kind, '{column}' AS column_name,
            count(*) AS n_failing, count(*) = 0 AS passed FROM {cte} WHERE {bad}"""
        for mart, cte, kind, column, bad in MART_CHECKS
    ),
    "revenue",
    "zone_hours",
    "payments",
    "durations",
)
O["dq_freshness"] = """SELECT newest, CAST(age AS INTEGER) AS age_days,
    CASE WHEN age > 60 THEN 'error' WHEN age > 45 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(ts) AS newest,
                 date_diff('day', CAST(max(ts) AS DATE), DATE '2024-03-10') AS age FROM events)"""

def contract_lines(*checks: tuple[str, str, str, str, str]) -> str:
    """Report lines of ``(model, source, kind, column, failing condition)``."""
    return " UNION ALL ".join(
        f"""SELECT '{model}' AS model, '{kind}' AS check_kind, '{column}' AS column_name,
            count(*) AS n_failing, count(*) = 0 AS passed FROM {source} WHERE {bad}"""
        for model, source, kind, column, bad in checks
    )


FRED, WORLD = "stg_fred_observations", "stg_worldbank_indicators"
CHANGES, SNAPSHOT = "mart_economic_indicators", "mart_global_economic_snapshot"
O["dq_indicator_contracts"] = sql(
    contract_lines(
        *[(FRED, "series", "not_null", c, f"{c} IS NULL") for c in ("observation_date", "indicator_name", "series_id")],
        (FRED, "series", "in_set", "indicator_name", "indicator_name NOT IN ('click', 'error', 'purchase', 'signup')"),
        *[(CHANGES, "changes", "not_null", c, f"{c} IS NULL") for c in ("observation_date", "indicator_name")],
        (CHANGES, "changes", "value_range", "value", "series_id = 'error' AND (value < 0 OR value > 700)"),
        (CHANGES, "changes", "change_limit", "mom_change", "abs(mom_change) > 10"),
        (
            "fred_observations",
            "(SELECT max(ts) AS newest FROM events)",
            "freshness",
            "loaded_at",
            "date_diff('day', CAST(newest AS DATE), DATE '2024-03-10') > 60",
        ),
    ),
    "changes",
)
O["dq_snapshot_contracts"] = sql(
    contract_lines(
        (FRED, "monthly", "not_null", "series_id", "series_id IS NULL"),
        (FRED, "monthly", "in_set", "series_id", "series_id NOT IN ('1-URGENT', '2-HIGH')"),
        *[(FRED, "monthly", "not_null", c, f"{c} IS NULL") for c in ("observation_date", "indicator_value")],
        (WORLD, "country", "not_null", "country_code", "country_code IS NULL"),
        (WORLD, "country", "in_set", "country_code", "length(country_code) <> 1"),
        (WORLD, "country", "not_null", "indicator_id", "indicator_id IS NULL"),
        (WORLD, "country", "in_set", "indicator_id", "indicator_id NOT IN ('F', 'O')"),
        *[(WORLD, "country", "not_null", c, f"{c} IS NULL") for c in ("observation_year", "indicator_value")],
        *[
            (SNAPSHOT, "country_us", "not_null", c, f"{c} IS NULL")
            for c in ("country_code", "country_name", "observation_year")
        ],
        (SNAPSHOT, "country_us", "not_null", "updated_at", "false"),
    ),
    "country_us",
)
O["rejected_documents"] = sql(
    """SELECT source_id, page, CASE page WHEN 1 THEN 'not a whole JSON document'
           WHEN 3 THEN 'no observations' ELSE 'empty' END AS reason
       FROM (SELECT DISTINCT series_id AS source_id, CAST((day(date) - 1) // 5 AS INTEGER) AS page FROM daily)
       WHERE page IN (1, 3, 5)""",
    "daily",
)

O["sketch_quantiles"] = sql(
    """SELECT pickup_borough, count(*) AS n_rows, unnest(['median_fare', 'high_fare', 'median_distance']) AS quantile,
       true AS within FROM joined GROUP BY pickup_borough""",
    "joined",
)
O["sketch_distinct"] = sql(
    """SELECT pickup_borough, count(DISTINCT dropoff_location_id) AS n_zones,
       count(DISTINCT pickup_date) AS n_dates, true AS zones_within, true AS days_within
       FROM joined GROUP BY pickup_borough""",
    "joined",
)

# --- end to end ---

CTES["repaired"] = """SELECT * REPLACE (
      CASE RATECODEID WHEN '0.0' THEN '99.0' WHEN '7.0' THEN '6.0' ELSE RATECODEID END AS RATECODEID,
      CASE VENDORID WHEN '3.0' THEN '1.0' WHEN '4.0' THEN '2.0' WHEN '5.0' THEN '6.0'
           ELSE VENDORID END AS VENDORID,
      least(TPEP_PICKUP_DATETIME, TPEP_DROPOFF_DATETIME) AS TPEP_PICKUP_DATETIME,
      greatest(TPEP_PICKUP_DATETIME, TPEP_DROPOFF_DATETIME) AS TPEP_DROPOFF_DATETIME)
    FROM raw WHERE VENDORID <> 'x' AND TPEP_PICKUP_DATETIME <> 'not a time'
      AND FARE_AMOUNT <> 'nan' AND PULOCATIONID <> '24.0' AND DOLOCATIONID <> '24.0'"""
USES["repaired"] = ["raw"]
CTES["job_typed"] = CTES["typed"].replace("FROM raw", "FROM repaired")
USES["job_typed"] = ["repaired"]
CTES["job_valid"] = CTES["typed_valid"].replace("FROM typed", "FROM job_typed")
USES["job_valid"] = ["job_typed"]
CTES["job_joined"] = """SELECT t.*, borough AS pickup_borough, zone AS pickup_zone FROM job_valid t
    LEFT JOIN zones ON pickup_location_id = location_id"""
USES["job_joined"] = ["job_valid", "zones"]
CTES["mended"] = CTES["repaired"].split(" WHERE ")[0]
USES["mended"] = ["raw"]
CTES["whole_typed"] = CTES["typed"].replace("FROM raw", "FROM mended")
USES["whole_typed"] = ["mended"]
CTES["whole_valid"] = CTES["typed_valid"].replace("FROM typed", "FROM whole_typed")
USES["whole_valid"] = ["whole_typed"]
CTES["whole_joined"] = CTES["job_joined"].replace("FROM job_valid", "FROM whole_valid")
USES["whole_joined"] = ["whole_valid", "zones"]
O["trips_end_to_end"] = sql(revenue_from("whole_joined"), "whole_joined")
O["trips_end_to_end_duration"] = sql(CTES["durations"].replace("FROM joined", "FROM job_joined"), "job_joined")
O["trips_end_to_end_zones"] = sql(CTES["zone_hours"].replace("FROM short", "FROM job_joined"), "job_joined")
O["trips_end_to_end_payment"] = sql(CTES["payments"].replace("FROM valid", "FROM job_valid"), "job_valid")
O["gated_publish"] = sql(
    f"""SELECT count(*) AS published_trips FROM job_joined
        WHERE source_month <= '1998-06' AND NOT CAST(fare_amount AS VARCHAR) LIKE '%7'""",
    "job_joined",
)
O["stream_to_marts"] = sql(revenue_from("joined"), "joined")
BY_DELIVERY = """SELECT CASE WHEN source_month <= '1998-06' AND CAST(fare_amount AS VARCHAR) NOT LIKE '%7'
    THEN '1998-06' ELSE '2001-08' END AS delivery FROM trips"""
O["stream_landing"] = sql(
    f"SELECT delivery AS SOURCE_MONTH, count(*) AS n_rows FROM ({BY_DELIVERY}) GROUP BY 1", "trips"
)
O["land_month_file"] = sql(
    f"""SELECT 'total' AS section, 'trips' AS item, count(*) AS n_rows FROM trips
       UNION ALL SELECT 'month', delivery, count(*) FROM ({BY_DELIVERY}) GROUP BY delivery
       UNION ALL SELECT 'dimension', 'zones', count(*) FROM zones""",
    "trips",
    "zones",
)
O["run_log"] = """
    SELECT * FROM (VALUES
      ('run-0', '1998-06', 'FAILED', 'quality_gate',
       'quality_gate failed for 1998-06; marts not built.'),
      ('run-0', '1998-06', 'FAILED', 'run_complete', 'Run complete for 1998-06: FAILED'),
      ('run-1', '1998-06', 'SUCCESS', 'run_complete', 'Run complete for 1998-06: SUCCESS')
    ) AS log(run_id, month_processed, status, task_name, message)"""
CTES["landed_series"] = """SELECT date AS observation_date, indicator_name, series_id,
    CASE WHEN day(date) % 7 <> 0 AND day(date) % 13 <> 0 THEN value END AS value FROM daily"""
USES["landed_series"] = ["daily"]
CTES["landed_lagged"] = CTES["lagged"].replace("FROM series", "FROM landed_series")
USES["landed_lagged"] = ["landed_series"]
O["indicators_end_to_end"] = sql(
    f"SELECT {CHANGE_COLUMNS} FROM (" + CTES["changes"].replace("FROM lagged", "FROM landed_lagged") + ")",
    "landed_lagged",
)
O["indicators_gated"] = O["indicators_end_to_end"]
CTES["landed_wide"] = CTES["wide"].replace("FROM country", f"FROM country WHERE {DELIVERED}")
USES["landed_wide"] = ["country"]
CTES["landed_annual"] = CTES["annual"].replace(
    "FROM monthly", "FROM monthly WHERE observation_date >= DATE '2000-01-01'"
)
USES["landed_annual"] = ["monthly"]
O["snapshot_end_to_end"] = sql(
    O["mart_country_snapshot"][O["mart_country_snapshot"].rindex("SELECT country_code") :].replace(
        "FROM country_us", "FROM landed_wide LEFT JOIN landed_annual USING (observation_year)"
    ),
    "landed_wide",
    "landed_annual",
)

_CELLS = ", ".join(f"coalesce({name}, '')" for name in RAW_COLUMNS)
O["sample_month"] = sql(
    f"""SELECT {", ".join(RAW_COLUMNS)} FROM raw WHERE SOURCE_MONTH = '1997-06'
    ORDER BY md5(concat_ws('|', '7', {_CELLS})) LIMIT 500""",
    "raw",
)

_TOP_OF_BOROUGH = """WHERE pickup_borough = 'ASIA' AND pickup_zone IN (
    SELECT pickup_zone FROM zone_hours WHERE pickup_borough = 'ASIA' GROUP BY pickup_zone
    ORDER BY sum(total_trips) DESC, pickup_zone LIMIT 3) GROUP BY"""
O["heatmap_borough_top"] = sql(CTES["grid"].replace("GROUP BY", _TOP_OF_BOROUGH), "zone_hours")
