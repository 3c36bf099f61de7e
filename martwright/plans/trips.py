"""Monthly trip job: land, gate, stage, join, marts, log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.calendar import month_start
from martwright.functions.casts import parse_columns
from martwright.operators.incremental import merge_into, recompute_touched
from martwright.operators.joins import hold, with_zones
from martwright.operators.profiling import load_report
from martwright.operators.quality import (
    Check,
    Contract,
    run_contract,
    run_contracts,
    run_suite,
    suite_passed,
)
from martwright.operators.sketches import sketch_parts, sketch_report
from martwright.operators.staging import TRIP_WINDOW, cast_trips, stage_zones, valid_trips
from martwright.plans import contracts, marts
from martwright.schemas import RAW_TRIPS, RUN_LOG, STAGED_TRIPS, TRIP_FILE
from martwright.session import tune, work_scope
from martwright.sources.files import read_facts, read_zones_csv
from martwright.sources.landing import month_named, stringify
from martwright.sources.sinks import load_month, log_run, read_if_exists, replace_partition
from martwright.sources.versions import Candidate, commit, discard, full_refresh, read_refreshed, stage


def coerce_for_checks(raw: DataFrame) -> DataFrame:
    """Raw trips with times and the checked measures typed; the rest stays text."""
    measures = ["FARE_AMOUNT", "TRIP_DISTANCE", "TOTAL_AMOUNT"]
    times = ["TPEP_PICKUP_DATETIME", "TPEP_DROPOFF_DATETIME"]
    texts = [name for name in raw.columns if name not in (*measures, *times)]
    typed = parse_columns(
        raw,
        measures={name: name for name in measures},
        times={name: name for name in times},
        keep={name: name for name in texts},
    )
    return typed.select(raw.columns)


@dataclass(frozen=True)
class TripSettings:
    """Limits that depend on the data: pickup window and duration band."""

    first_day: date = TRIP_WINDOW[0]
    end_day: date = TRIP_WINDOW[1]
    shortest: int = marts.DURATION_BAND[0]
    longest: int = marts.DURATION_BAND[1]


@dataclass(frozen=True)
class TripTables:
    """Where the job keeps its tables."""

    folder: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.folder}/{name}"


def staged_trips(raw: DataFrame, settings: TripSettings) -> DataFrame:
    return valid_trips(cast_trips(raw), settings.first_day, settings.end_day)


def land_month_file(
    spark: SparkSession,
    path: str,
    folder: str,
    *,
    month: str | None = None,
    schema: T.StructType = TRIP_FILE,
    replace: bool = False,
) -> bool:
    """Land one delivered trip file as text under its own month; False if that was there.

    The month is the one in the file's name unless given. All rows go there, stray
    pickups of other months too. A month that is there is kept unless ``replace`` is set.
    """
    named = month_named(path) if month is None else month
    raw = stringify(read_facts(spark, path, schema), named)
    return load_month(raw, TripTables(folder).raw_trips, named, replace=replace)


def land_zone_file(spark: SparkSession, path: str, folder: str) -> None:
    """Replace the zone table by a delivered CSV file."""
    full_refresh(read_zones_csv(spark, path), TripTables(folder).raw_zones)


def landed_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows landed: in total, per month and in the zone table."""
    tables = TripTables(folder)
    raw = spark.read.schema(RAW_TRIPS).parquet(tables.raw_trips)
    return load_report(raw, read_refreshed(spark, tables.raw_zones), month="SOURCE_MONTH")


def run_delivery(
    spark: SparkSession,
    trip_file: str,
    zone_file: str,
    folder: str,
    run_id: str,
    checks: Sequence[Check],
    *,
    month: str | None = None,
    schema: T.StructType = TRIP_FILE,
    **options,
) -> bool:
    """``run_month`` on files as they were delivered: one month of trips and the zones."""
    named = month_named(trip_file) if month is None else month
    raw = stringify(read_facts(spark, trip_file, schema), named)
    zones = read_zones_csv(spark, zone_file)
    return run_month(spark, raw, zones, folder, named, run_id, checks, **options)


def stage_month(
    landed: DataFrame, tables: TripTables, month: str, settings: TripSettings, replace: bool = False
) -> None:
    """Store a landed month typed and filtered: filters on text cannot skip row groups."""
    staged = staged_trips(landed, settings)
    load_month(staged, tables.staged_trips, month, by="source_month", replace=replace)


@dataclass(frozen=True)
class Rollup:
    """A mart kept from stored parts.

    ``day`` names the date column of a dated mart; ``zoned`` says whether the
    parts need the pickup zone, since Spark keeps a join nobody reads.
    """

    mart: str
    parts: Callable[..., DataFrame]
    finish: Callable[[DataFrame], DataFrame]
    day: str | None = None
    zoned: bool = True


def rollups(settings: TripSettings) -> list[Rollup]:
    durations = partial(
        marts.trip_duration_parts, shortest=settings.shortest, longest=settings.longest
    )
    return [
        Rollup(
            "mart_daily_revenue", marts.daily_revenue_parts, marts.daily_revenue_of, "pickup_date"
        ),
        Rollup("mart_trip_duration", durations, marts.trip_duration_of, "trip_date"),
        Rollup("mart_pickup_zones", marts.pickup_zones_parts, marts.pickup_zones_of),
        Rollup(
            "mart_payment_summary",
            marts.payment_summary_parts,
            marts.payment_summary_of,
            zoned=False,
        ),
    ]


def keep_sketches(spark: SparkSession, trips: DataFrame, folder: str, label: str) -> None:
    """Store the sketches of one delivery of staged trips with their pickup zone.

    A delivery that is repeated replaces its own; no other one is read.
    """
    parts = sketch_parts(trips, ["pickup_borough"], ["fare_amount", "trip_distance"], ["dropoff_location_id", "pickup_date"])
    labelled = parts.withColumn("source_month", F.lit(label))
    replace_partition(labelled, f"{folder}/parts/trip_sketches", "source_month", label)


def trip_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Approximate fare and distance quantiles and distinct counts per borough over all deliveries."""
    return sketch_report(
        spark.read.parquet(f"{folder}/parts/trip_sketches"),
        ["pickup_borough"],
        {
            "median_fare": ("fare_amount", 0.5),
            "high_fare": ("fare_amount", 0.9),
            "median_distance": ("trip_distance", 0.5),
        },
        {"n_dropoff_zones": "dropoff_location_id", "n_days": "pickup_date"},
    )


@dataclass(frozen=True)
class Prepared:
    """What a delivery changes in one mart, complete and not readable yet."""

    rollup: Rollup
    parts: DataFrame
    rows: DataFrame
    candidate: Candidate | None = None
    touched: DataFrame | None = None


def _parts_path(tables: TripTables, rollup: Rollup) -> str:
    return f"{tables.folder}/parts/{rollup.mart}"


def prepare_marts(
    spark: SparkSession, tables: TripTables, arrived: DataFrame, zones: DataFrame, label: str, settings: TripSettings
) -> list[Prepared]:
    """Read only a delivery's trips and work out what they change in each mart.

    ``label`` names the delivery in ``source_month``. A dated mart gets the rows of the
    days the delivery touches, or touched when it was built before: late and stray ones
    included. The others are rebuilt from the small parts.
    """
    zoned = with_zones(arrived, zones, ["pickup"])
    prepared = []
    for rollup in rollups(settings):
        fresh = hold(rollup.parts(zoned if rollup.zoned else arrived, "source_month"))
        before = read_if_exists(spark, _parts_path(tables, rollup), fresh.schema)
        stored = fresh
        if before is not None:
            stored = fresh.unionByName(before.where(F.col("source_month") != label))
        if rollup.day is None:
            candidate = stage(rollup.finish(stored), getattr(tables, rollup.mart))
            prepared.append(Prepared(rollup, fresh, candidate.rows, candidate))
            continue
        keys = [rollup.day, "pickup_borough"]
        touched = _touched_keys(spark, tables, rollup, fresh, before, keys, label)
        changed = hold(recompute_touched(touched, stored, keys, rollup.finish))
        prepared.append(Prepared(rollup, fresh, changed, touched=touched))
    return prepared


def publish_marts(spark: SparkSession, tables: TripTables, prepared: Sequence[Prepared], label: str) -> None:
    """Store the delivery's parts and bring the marts up to date.

    The parts of a delivery replace themselves, so one that is repeated counts nothing
    twice. Its keys are noted before that and until its mart has them, so a job that
    dies in between is finished by the next one with the same label.
    """
    for one in prepared:
        rollup, path = one.rollup, _parts_path(tables, one.rollup)
        if one.candidate is not None:
            replace_partition(one.parts, path, "source_month", label)
            commit(one.candidate)
            continue
        keys = [rollup.day, "pickup_borough"]
        noted = one.touched.select(F.lit(label).alias("source_month"), *keys)
        replace_partition(noted, _pending(tables, rollup), "source_month", label)
        replace_partition(one.parts, path, "source_month", label)
        in_month = month_start(F.col(rollup.day))
        merge_into(
            one.rows.withColumn("mart_month", in_month),
            getattr(tables, rollup.mart),
            keys,
            "mart_month",
            f"{tables.folder}/merging/{rollup.mart}",
            one.touched.withColumn("mart_month", in_month),
        )
        replace_partition(noted.limit(0), _pending(tables, rollup), "source_month", label)


def drop_prepared(prepared: Sequence[Prepared]) -> None:
    for one in prepared:
        if one.candidate is not None:
            discard(one.candidate)


def _pending(tables: TripTables, rollup: Rollup) -> str:
    return f"{tables.folder}/pending/{rollup.mart}"


def _touched_keys(
    spark: SparkSession,
    tables: TripTables,
    rollup: Rollup,
    fresh: DataFrame,
    before: DataFrame | None,
    keys: Sequence[str],
    label: str,
) -> DataFrame:
    """Keys of a delivery, now and before, and those noted by a run of it that died."""
    schema = fresh.select("source_month", *keys).schema
    found = fresh.select(*keys)
    noted = read_if_exists(spark, _pending(tables, rollup), schema)
    for earlier in (before, noted):
        if earlier is not None:
            found = found.unionByName(earlier.where(F.col("source_month") == label).select(*keys))
    return hold(found.distinct())


MART_CONTRACTS = {
    "mart_daily_revenue": contracts.DAILY_REVENUE,
    "mart_trip_duration": contracts.TRIP_DURATION,
    "mart_pickup_zones": contracts.PICKUP_ZONES,
    "mart_payment_summary": contracts.PAYMENT_SUMMARY,
}


def mart_report(prepared: Sequence[Prepared]) -> DataFrame:
    """The contract checks of what is about to be published; dated marts by their changed rows."""
    return run_contracts({p.rollup.mart: (p.rows, MART_CONTRACTS[p.rollup.mart]) for p in prepared}, {})


def _was_built(spark: SparkSession, tables: TripTables, month: str) -> bool:
    log = read_if_exists(spark, tables.run_log, RUN_LOG)
    done = (F.col("task_name") == "run_complete") & (F.col("status") == "SUCCESS")
    return log is not None and not log.where(done & (F.col("month_processed") == month)).isEmpty()


def run_month(
    spark: SparkSession,
    raw: DataFrame,
    raw_zones: DataFrame,
    folder: str,
    month: str,
    run_id: str,
    checks: Sequence[Check],
    settings: TripSettings | None = None,
    contract: Contract | None = None,
    replace: bool = False,
) -> bool:
    """One monthly run; True when every gate passed and the marts were built.

    A month that was built before keeps its delivery unless ``replace`` is set. One that
    never passed takes the new delivery, so it can be repaired and run again.

    ``checks`` guard the landed month and ``contract`` the staged one. A failing
    gate logs and leaves the marts alone; later months do not bring the failed one
    in. Marts are checked against their own contracts before they are published. The
    final row is logged whatever happens.
    """
    with work_scope(spark):
        return _run_month(
            spark, raw, raw_zones, folder, month, run_id, checks, settings, contract, replace
        )


def _run_month(
    spark: SparkSession,
    raw: DataFrame,
    raw_zones: DataFrame,
    folder: str,
    month: str,
    run_id: str,
    checks: Sequence[Check],
    settings: TripSettings | None,
    contract: Contract | None,
    replace: bool,
) -> bool:
    tune(spark)
    settings = settings or TripSettings()
    tables = TripTables(folder)
    log = partial(log_run, spark, tables.run_log, run_id=run_id, month=month)
    built = False

    def passes(report: DataFrame, task: str, consequence: str) -> bool:
        passed = suite_passed(report)
        if not passed:
            message = f"{task} failed for {month}; {consequence}."
            log(status="FAILED", task=task, message=message)
        return passed

    try:
        anew = replace or not _was_built(spark, tables, month)
        load_month(raw, tables.raw_trips, month, replace=anew)
        full_refresh(raw_zones, tables.raw_zones)
        zones = stage_zones(read_refreshed(spark, tables.raw_zones))
        stored = spark.read.schema(raw.schema).parquet(tables.raw_trips)
        landed = stored.where(F.col("SOURCE_MONTH") == month)
        gate = run_suite(coerce_for_checks(landed), checks)
        if not passes(gate, "quality_gate", "marts not built"):
            return False
        stage_month(landed, tables, month, settings, replace=anew)
        if contract is not None:
            staged = spark.read.schema(STAGED_TRIPS).parquet(tables.staged_trips)
            this_month = staged.where(F.col("source_month") == month)
            report = run_contract(this_month, contract, {"zones": zones})
            if not passes(report, "staged_contract", "marts not built"):
                return False
        staged = spark.read.schema(STAGED_TRIPS).parquet(tables.staged_trips)
        arrived = staged.where(F.col("source_month") == month)
        prepared = prepare_marts(spark, tables, arrived, zones, month, settings)
        if not passes(mart_report(prepared), "mart_contracts", "marts left as they were"):
            drop_prepared(prepared)
            return False
        publish_marts(spark, tables, prepared, month)
        built = True
    finally:
        status = "SUCCESS" if built else "FAILED"
        log(status=status, task="run_complete", message=f"Run complete for {month}: {status}")
    return built
