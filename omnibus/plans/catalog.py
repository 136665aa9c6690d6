"""Every implemented query by name, over the analog views of a data folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omnibus import params
from omnibus.functions import clock
from omnibus.operators.access import Slicer, Viewer, visible
from omnibus.plans import activity, checks, gold, loads, questions, silver
from omnibus.plans import observations as obs
from omnibus.plans.analogs import Analogs
from omnibus.plans.report import VISUALS, report_query
from omnibus.sources import files, quarantine, tables
from omnibus.sources.shared import fresh_folder
from omnibus.streaming import observations as intake_stream
from omnibus.streaming import positions as realtime
from omnibus.streaming import spacing as spaced_stream

CUTOFF = dt.date(2024, 1, 10)
AS_OF = dt.datetime(2024, 1, 31)
MANAGER = Viewer("Depot Manager", "user7")

Query = Callable[[Analogs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types, so that two engines' rows can be compared."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Averages to fixed digits; the offset settles exact halves upwards."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c) + 1e-9, digits) for c in doubles})


def model(a: Analogs) -> dict[str, DataFrame]:
    return gold.build_model(a.star(), CUTOFF)


# --- Gold views --------------------------------------------------------------

@query("g1_route_schedule_summary")
def g1(a):
    return gold.route_schedule_summary(a.fact_schedule(), a.dim_trip(), a.dim_route())


@query("g2_top_routes")
def g2(a):
    return gold.top_routes(a.fact_schedule(), a.dim_trip(), a.dim_route())


@query("g3_hourly_distribution")
def g3(a):
    return gold.hourly_distribution(a.fact_schedule())


@query("g4_vehicle_activity")
def g4(a):
    return gold.vehicle_activity(a.fact_vehicle_positions(), a.dim_route(), CUTOFF)


def _stored_pings(a: Analogs) -> DataFrame:
    """Silver pings as the loads store them, by ingestion day and ping date."""
    schema, root = _scratch_schema(), fresh_folder(a.spark, "silver")
    loads.load_positions(a.spark, silver.with_wall_clock(a.fact_vehicle_positions()), schema, root)
    return a.spark.table(f"{schema}.{loads.POSITIONS}")


@query("g4_from_stored_silver")
def g4_stored(a):
    return gold.vehicle_activity(_stored_pings(a), a.dim_route(), CUTOFF)


@query("g6_from_stored_silver")
def g6_stored(a):
    return gold.weather_vs_activity(a.weather(), _stored_pings(a))


@query("g5_weather_summary")
def g5(a):
    return gold.weather_summary(a.weather())


@query("g6_weather_vs_activity")
def g6(a):
    return gold.weather_vs_activity(a.weather(), a.fact_vehicle_positions())


# --- Report visuals ------------------------------------------------------------

for _id in VISUALS:
    QUERIES[_id] = lambda a, v=_id: rounded(report_query(model(a), v))
for _id in ("v11", "v13", "v15", "v18", "v19", "v20", "v45", "v46", "v48", "v49"):
    QUERIES[f"{_id}_saved_slicer"] = lambda a, v=_id: rounded(report_query(model(a), v, saved_state=True))


# --- Semantic model --------------------------------------------------------------

@query("m1_not_stopped")
def m1(a):
    return model(a)["vehicle_activity"].agg(gold.not_stopped_pings().alias("not_stopped_pings"))


@query("m2_filter_propagation")
def m2(a):
    """A filter on routes reaches stop events through trips."""
    blank = Slicer("dim_route", "route_short_name", "in", ("",))
    return visible(model(a), "fact_schedule", [blank]).groupBy("departure_hour").agg(F.count("*").alias("events"))


@query("m3_slicers")
def m3(a):
    """In-list on a dimension, range on an own column, not-null on a dimension."""
    slicers = [
        Slicer("vehicle_activity", "activity_hour", "between", (6, 18)),
        Slicer("dim_route", "route_type", "in", (3, 4)),
        Slicer("dim_route", "route_long_name", "not_null"),
    ]
    return rounded(report_query(model(a), "v24", slicers))


@query("m4_rls_route_summary")
def m4_summary(a):
    return visible(model(a), "route_schedule_summary", viewer=MANAGER)


@query("m4_rls_top_routes")
def m4_top(a):
    return visible(model(a), "top_routes", viewer=MANAGER)


@query("m4_rls_schedule")
def m4_schedule(a):
    seen = visible(model(a), "fact_schedule", viewer=MANAGER)
    return seen.groupBy("departure_hour").agg(F.count("*").alias("events"))


@query("m4_rls_positions")
def m4_positions(a):
    return rounded(report_query(model(a), "v33", viewer=MANAGER))


@query("m4_rls_activity")
def m4_activity(a):
    return rounded(report_query(model(a), "v30", viewer=MANAGER))


@query("m4_rls_access_table")
def m4_access(a):
    return visible(model(a), "user_route_access", viewer=MANAGER)


@query("m4_rls_unmapped_user")
def m4_unmapped(a):
    """Another letter case is another user; no mapping, no rows."""
    viewer = Viewer("Depot Manager", "USER7")
    return visible(model(a), "dim_trip", viewer=viewer).agg(F.count("*").alias("trips"))


@query("m4_rls_unreached_table")
def m4_unreached(a):
    """No relationship leads here, so the role filter does not either."""
    return visible(model(a), "hourly_distribution", viewer=MANAGER)


@query("m5_open_role")
def m5(a):
    return rounded(report_query(model(a), "v30", viewer=Viewer("Route Planning Manager", "user7")))


# --- Silver ------------------------------------------------------------------------

@query("t01_dim_route")
def t01(a):
    return silver.dim_route(a.routes())


@query("t02_dim_stop")
def t02(a):
    return silver.dim_stop(a.stops())


@query("t03_dim_trip")
def t03(a):
    return silver.dim_trip(a.trips(), a.calendar())


@query("t04_dim_date")
def t04(a):
    return silver.dim_date(a.date_bounds(), a.holidays())


@query("t04_dim_date_iso")
def t04_iso(a):
    return silver.dim_date(a.date_bounds(), iso_weekday=True).select("date_key", "day_of_week", "is_public_holiday")


@query("t05_gtfs_seconds")
def t05(a):
    rows = silver.fact_schedule(a.stop_times())
    keys = ["arrival_time", "arrival_secs", "departure_secs", "departure_hour"]
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


@query("t05_wrapped_hours")
def t05_wrapped(a):
    rows = silver.fact_schedule(a.stop_times(), wrap_hours=True)
    return rows.groupBy("departure_hour").agg(F.count("*").alias("n"))


@query("t06_peak_flag")
def t06(a):
    rows = silver.fact_schedule(a.stop_times())
    return rows.groupBy("departure_hour", "is_peak_hour").agg(F.count("*").alias("n"))


@query("t07_weather_features")
def t07(a):
    raw = a.weather().drop("temp_avg_c", "weather_label", "is_rainy_day")
    return silver.weather_daily(raw)


@query("t08_inside_city")
def t08(a):
    return silver.inside_city(a.raw_positions()).select("entity_id", "latitude", "longitude")


@query("t09_one_per_instant")
def t09(a):
    return silver.one_per_instant(a.raw_positions())


@query("t10_derived_speed")
def t10(a):
    pings = silver.one_per_instant(silver.inside_city(a.raw_positions()))
    speeds = silver.with_speed(pings, limit=None)
    return rounded(speeds.select("entity_id", "vehicle_id", "timestamp", "derived_speed_kmh"), 3)


@query("t11_clamped_speed")
def t11(a):
    rows = silver.vehicle_positions(a.raw_positions())
    return rounded(rows.select("entity_id", "derived_speed_kmh"), 3)


@query("t12_instants")
def t12(a):
    local = F.col("timestamp")
    return a.raw_positions().select(
        "entity_id", clock.instant(local).alias("instant"), clock.wall_hour(local).alias("local_hour")
    )


@query("t13_newer_rows")
def t13(a):
    """Silver rows that a rebuild from the watermark on would read."""
    return silver.newer_than(a.raw_positions(), dt.datetime(2024, 1, 15)).select("entity_id", "ingested_at")


def _exported(a: Analogs) -> DataFrame:
    """Observations written by the export and read back as text."""
    path = files.export_observations(a.observations(), fresh_folder(a.spark, "export"), AS_OF, days=0)
    return files.read_observations(a.spark, path)


@query("t14_typed_observations")
def t14(a):
    return silver.typed_observations(_exported(a)).drop("ingested_at")


# --- Sources and sinks -------------------------------------------------------------

def _landed_gtfs(a: Analogs) -> dict[str, DataFrame]:
    folder = fresh_folder(a.spark, "gtfs")
    for name, df in a.gtfs().items():
        df.write.csv(f"{folder}/{name}.txt", header=True, escape='"')
    return files.read_gtfs(a.spark, folder)


@query("s1_gtfs_scan")
def s1(a):
    keys = {
        "routes": "route_id", "stops": "stop_id", "trips": "trip_id", "stop_times": "departure_time",
        "calendar": "service_id", "agency": "agency_id",
    }
    counted = [
        df.agg(F.count("*").alias("n_rows"), F.count_distinct(keys[name]).alias("n_keys")).select(
            F.lit(name).alias("file"), "n_rows", "n_keys"
        )
        for name, df in _landed_gtfs(a).items()
    ]
    return checks.q.together(counted)


@query("s1_files_to_gold")
def s1_gold(a):
    """Schedule files through silver to the route summary."""
    raw = _landed_gtfs(a)
    return gold.route_schedule_summary(
        silver.fact_schedule(raw["stop_times"]),
        silver.dim_trip(raw["trips"], raw["calendar"]),
        silver.dim_route(raw["routes"]),
    )


def _snapshots(a: Analogs) -> str:
    """The feed as JSON snapshots, one line each."""
    folder = fresh_folder(a.spark, "snapshots")
    vehicle = F.struct(
        "vehicle_id", "trip_id", "route_id", "latitude", "longitude", "speed", "timestamp", "status"
    )
    entity = F.struct(F.col("entity_id").alias("id"), vehicle.alias("vehicle"))
    a.raw_positions().select(F.array(entity).alias("entity")).write.json(folder)
    return folder


@query("s2_position_landing")
def s2(a):
    bronze = fresh_folder(a.spark, "bronze")
    realtime.land(a.spark, _snapshots(a), bronze, fresh_folder(a.spark, "progress"))
    return a.spark.read.parquet(bronze).drop("ingested_at")


@query("s3_weather_scan")
def s3(a):
    """One document per day through the JSON scan and the weather features."""
    folder = fresh_folder(a.spark, "weather")
    one = lambda c, name: F.array(c).alias(name)
    daily = F.struct(
        F.array(F.col("date").cast("string")).alias("time"),
        one("temp_max_c", "temperature_2m_max"), one("temp_min_c", "temperature_2m_min"),
        one("precipitation_mm", "precipitation_sum"), one("windspeed_max_kmh", "windspeed_10m_max"),
        one("weather_code", "weathercode"),
    )
    a.weather().select(daily.alias("daily")).write.json(folder)
    return silver.weather_daily(files.read_weather(a.spark, folder, one_per_line=True))


@query("s4_fuel_seed")
def s4(a):
    folder = fresh_folder(a.spark, "fuel")
    a.fuel().write.csv(folder, header=True)
    return files.read_fuel(a.spark, folder)


@query("s5_observation_scan")
def s5(a):
    return _exported(a)


@query("s6_observation_export")
def s6(a):
    """The default export: last days, newest first."""
    path = files.export_observations(a.observations(), fresh_folder(a.spark, "export"), AS_OF)
    return files.read_observations(a.spark, path).select("id", "route_id", "description", "created_at")


def _scratch_schema() -> str:
    return f"omnibus_{uuid.uuid4().hex[:12]}"


def _two_loads(a: Analogs) -> DataFrame:
    """A first load creates the table, the second one updates it by id."""
    schema, root = _scratch_schema(), fresh_folder(a.spark, "tables")
    raw = _exported(a)
    loads.load_observations(a.spark, raw.where("created_at < '2024-01-20'"), schema, root)
    later = raw.where("created_at >= '2024-01-12'").withColumn("status", F.lit("RESOLVED"))
    loads.load_observations(a.spark, later, schema, root)
    return a.spark.table(f"{schema}.{loads.OBSERVATIONS}")


def _write_lines(lines: DataFrame, folder: str, header: str | None = None) -> None:
    """Text files of ready lines, each file with the header."""
    if header is None:
        return lines.write.text(folder)
    return lines.toDF(header).write.csv(folder, header=True, sep="\u0001", quote="\u0000", escape="\u0000")


@query("s_broken_records")
def s_broken(a):
    """Faulty schedule, price and weather files: by source, the rows that load and the records in quarantine."""
    folder, schema = fresh_folder(a.spark, "faulty"), _scratch_schema()
    k = F.col("c_custkey")
    customers = a.table("customer")
    stop = F.concat_ws(",", k, F.concat(F.lit('"'), "c_name", F.lit('"')), F.lit("28.5"))
    stops = F.when(k % 5 == 0, stop).when(k % 7 == 0, F.concat(stop, F.lit(",77.1,x"))).otherwise(F.concat(stop, F.lit(",77.1")))
    _write_lines(customers.select(stops.alias("value")), f"{folder}/stops", "stop_id,stop_name,stop_lat,stop_lon")
    price = F.when(k % 3 == 0, F.lit("soon")).otherwise((k % 90).cast("string"))
    _write_lines(
        customers.select(F.concat_ws(",", F.lit("2024-01-01"), F.lit("90.0"), price, F.lit("s")).alias("value")), f"{folder}/fuel",
        "date,petrol_delhi_inr,diesel_delhi_inr,source_note",
    )
    measures = "".join(f', "{m}": [1.5]' for m in ("temperature_2m_max", "temperature_2m_min", "precipitation_sum", "windspeed_10m_max"))
    document = F.concat(F.lit('{"daily": {"time": ["2024-01-01"]' + measures + ', "weathercode": ['), k % 50, F.lit("]}"))
    _write_lines(customers.select(F.when(k % 4 == 0, document).otherwise(F.concat(document, F.lit("}"))).alias("value")), f"{folder}/weather")
    landed = {
        "stops": quarantine.read_csv(a.spark, f"{folder}/stops", "stops"),
        "fuel": quarantine.read_fuel(a.spark, f"{folder}/fuel"),
        "weather": quarantine.read_weather(a.spark, f"{folder}/weather", one_per_line=True),
    }
    for _ in range(2):  # a repeated load adds nothing
        quarantine.store([found.broken for found in landed.values()], f"{schema}.broken", folder)
    broken = quarantine.counts(a.spark, f"{schema}.broken").groupBy("source").agg(F.sum("n_broken").alias("n_broken"))
    loaded = checks.q.together([
        found.good.agg(F.count("*").alias("n_loaded")).select(F.lit(source).alias("source"), "n_loaded")
        for source, found in landed.items()
    ])
    return loaded.join(broken, "source")


@query("s7_create_or_merge")
def s7(a):
    return _two_loads(a).groupBy("status").agg(F.count("*").alias("n"))


@query("s8_tables_across_schemas")
def s8(a):
    silver_schema, gold_schema = _scratch_schema(), _scratch_schema()
    root = fresh_folder(a.spark, "tables")
    tables.publish(a.dim_trip(), f"{silver_schema}.dim_trip", root)
    tables.publish(a.dim_route(), f"{gold_schema}.dim_route", root)
    trips, routes = a.spark.table(f"{silver_schema}.dim_trip"), a.spark.table(f"{gold_schema}.dim_route")
    return trips.groupBy("route_id").agg(F.count("*").alias("trips")).join(
        routes.select("route_id", "route_long_name"), "route_id"
    )


# --- Loads -----------------------------------------------------------------------------

@query("l1_star_reload")
def l1(a):
    """Loaded twice; the second load replaces the first."""
    schema, root = _scratch_schema(), fresh_folder(a.spark, "star")
    sources = a.star()
    day = F.col("date").cast("string")
    sources["fact_weather_daily"] = a.weather().withColumn(
        "date", F.when(F.dayofmonth("date") == 5, "soon").otherwise(day)
    )
    for _ in range(2):
        loads.load_star(sources, schema, root)
    counts = [
        a.spark.table(f"{schema}.{name}").agg(
            F.count("*").alias("n_rows"), F.count(F.col(names[0])).alias("n_first")
        ).select(F.lit(name).alias("table_name"), "n_rows", "n_first")
        for name, names in ((n, loads.schemas.names(d)) for n, d in loads.STAR.items())
    ]
    return checks.q.together(counts)


@query("l1_access_reload")
def l1_access(a):
    """Grants offered twice are stored once; the role reads the stored table."""
    schema, root = _scratch_schema(), fresh_folder(a.spark, "access")
    loads.load_access(a.user_route_access().unionByName(a.user_route_access()), schema, root)
    stored = {**model(a), "user_route_access": a.spark.table(f"{schema}.user_route_access")}
    return visible(stored, "user_route_access", viewer=MANAGER)


def _loaded_positions(a: Analogs, full_reload: bool) -> DataFrame:
    schema, root = _scratch_schema(), fresh_folder(a.spark, "positions")
    source = silver.with_wall_clock(a.fact_vehicle_positions())
    early = source.where(clock.ingest_second(F.col("ingested_at")) <= F.lit(AS_OF - dt.timedelta(days=16)))
    loads.load_positions(a.spark, early, schema, root)
    loads.load_positions(a.spark, source, schema, root, full_reload)
    return a.spark.table(f"{schema}.{loads.POSITIONS}").select("entity_id", "ingested_at", "derived_speed_kmh")


@query("l2_incremental_positions")
def l2(a):
    return _loaded_positions(a, full_reload=False)


@query("l3_full_reload")
def l3(a):
    return _loaded_positions(a, full_reload=True)


@query("l4_upsert_observations")
def l4(a):
    return _two_loads(a).select("id", "status", "route_id", "description")


@query("l5_realtime_cycle")
def l5(a):
    """Snapshots to the warehouse table, by the streaming jobs."""
    schema, root = _scratch_schema(), fresh_folder(a.spark, "cycle")
    realtime.realtime_cycle(a.spark, _snapshots(a), root, schema)
    rows = a.spark.table(f"{schema}.{loads.POSITIONS}")
    return rounded(rows.select("entity_id", "vehicle_id", "timestamp", "derived_speed_kmh", "ping_hour"), 3)


@query("l5_late_cycle")
def l5_late(a):
    """The same pings in four batches that mix early and late ones."""
    schema, root, incoming = _scratch_schema(), fresh_folder(a.spark, "cycle"), fresh_folder(a.spark, "mixed")
    entity = F.explode("entity").alias("e")
    mixed = a.spark.read.schema(realtime.schemas.POSITION_SNAPSHOT).json(_snapshots(a)).select(entity)
    # Copies of a ping share a batch, so the copy to keep does not depend on the batches' order.
    part = F.pmod(F.xxhash64("e.vehicle.vehicle_id", "e.vehicle.timestamp"), F.lit(4))
    builder = realtime.SilverBuilder(a.spark, schema, f"{root}/silver")
    for rows in _sliced(mixed, part, 4, f"{root}/slices"):
        rows.select(F.array("e").alias("entity")).write.mode("append").json(incoming)
        realtime.land(a.spark, incoming, f"{root}/bronze_positions", f"{root}/checkpoints/land")
        realtime.build_silver(a.spark, f"{root}/bronze_positions", builder, f"{root}/checkpoints/silver")
    realtime.realtime_cycle(a.spark, incoming, root, schema)
    rows = a.spark.table(f"{schema}.{loads.POSITIONS}")
    return rounded(rows.select("entity_id", "vehicle_id", "timestamp", "derived_speed_kmh", "ping_hour"), 3)


def _kept_activity(a: Analogs) -> DataFrame:
    """Partials after two loads, the second of which refreshes the days it touched."""
    schema, root = _scratch_schema(), fresh_folder(a.spark, "activity")
    source, read = silver.with_wall_clock(a.fact_vehicle_positions()), clock.ingest_second(F.col("ingested_at"))
    # An incremental load leaves out what has no readable ingestion time, so that gets a late one here.
    source = source.withColumn("ingested_at", F.when(read.isNull(), F.lit("2024-12-01T00:00:00")).otherwise(F.col("ingested_at")))
    early = source.where(clock.ingest_second(F.col("ingested_at")) <= F.lit(AS_OF - dt.timedelta(days=16)))
    for rows in (early, source):
        new = loads.pending_positions(a.spark, rows, schema)
        activity.touch(a.spark, schema, activity.versioned.parts_of(new, activity.DAY))
        loads.load_positions(a.spark, rows, schema, root)
        activity.refresh(a.spark, schema, root)
    return a.spark.table(f"{schema}.{activity.PARTIALS}")


@query("g4_kept_up_to_date")
def g4_kept(a):
    return activity.vehicle_activity(_kept_activity(a), a.dim_route(), CUTOFF)


@query("g6_kept_up_to_date")
def g6_kept(a):
    return activity.weather_vs_activity(a.weather(), _kept_activity(a))


# --- Observations ------------------------------------------------------------------------

@query("o1_classify")
def o1(a):
    return obs.classify(a.submissions(), a.qr_codes()).select("id", "verdict")


@query("o2_greedy_dedupe")
def o2(a):
    """The spacing rule alone, over all submissions."""
    rows = a.submissions().select(
        "id", F.pmod(F.col("id") * 31, F.lit(7)).alias("qr_code_id"),
        F.coalesce("anonymous_identifier", F.lit("")).alias("anonymous_identifier"), "created_at",
    )
    kept = obs.keep_spaced(rows, obs.SPACING_KEYS, "created_at", "id", params.DUPLICATE_WINDOW_MINUTES * 60)
    return kept.select("id", "qr_code_id", "anonymous_identifier")


def _sliced(rows: DataFrame, by: Column, slices: int, folder: str) -> list[DataFrame]:
    """The rows stored once, in slices by ``by`` (a number), each as many files as Spark writes."""
    bounds = rows.agg(F.min(by).alias("low"), F.max(by).alias("high")).first()
    step = 1 if bounds["low"] is None else (bounds["high"] - bounds["low"]) // slices + 1
    at = F.coalesce(F.floor((by - F.lit(bounds["low"])) / step), F.lit(0)).cast("int")
    rows.withColumn("_slice", at).write.partitionBy("_slice").parquet(folder)
    stored = rows.sparkSession.read.schema(rows.withColumn("_slice", at).schema).parquet(folder)
    return [stored.where(F.col("_slice") == k).drop("_slice") for k in range(slices)]


def _submitted(a: Analogs) -> DataFrame:
    return a.submissions().select(*[c.split()[0] for c in intake_stream.SUBMISSION.split(", ")])


@query("o2_stream_intake")
def o2_stream(a):
    """The intake stream over all submissions, landed in four slices that follow each other in time."""
    folder, schema = fresh_folder(a.spark, "intake"), _scratch_schema()
    intake = intake_stream.Intake(a.spark, a.qr_codes(), f"{schema}.submissions", f"{folder}/out")
    for part in _sliced(_submitted(a), F.unix_seconds("created_at"), 4, f"{folder}/slices"):
        part.write.mode("append").parquet(f"{folder}/in")
        intake_stream.run_intake(a.spark, f"{folder}/in", intake, f"{folder}/checkpoint")
    return intake.classified(a.spark).select("id", "verdict")


@query("o2_stream_out_of_order")
def o2_out_of_order(a):
    """The keyed stream over all submissions, each up to half a day late, in three slices by arrival."""
    folder = fresh_folder(a.spark, "spaced")
    late = F.pmod(F.col("id") * 7919, F.lit(43_200))
    parts = _sliced(_submitted(a), F.unix_seconds("created_at") + late, 3, f"{folder}/slices")
    last = F.timestamp_seconds(F.lit(_submitted(a).agg(F.max(F.unix_seconds("created_at"))).first()[0] or 0))
    end = spaced_stream.heartbeat(a.spark, last + F.make_dt_interval(days=F.lit(10)))
    for part in (*parts, end):
        part.write.mode("append").parquet(f"{folder}/in")
        spaced_stream.run_spaced_intake(a.spark, f"{folder}/in", a.qr_codes(), f"{folder}/out", f"{folder}/checkpoint")
    return a.spark.read.schema(spaced_stream.VERDICTS).parquet(f"{folder}/out").select("id", "verdict")


@query("o3_enrich")
def o3(a):
    accepted = obs.accept(obs.classify(a.submissions(), a.qr_codes()))
    return accepted.select("id", "qr_code_id", "bus_number", "route_id", "status")


@query("o3_enrich_as_of")
def o3_as_of(a):
    return obs.assignment_as_of(a.submissions(), a.assignments()).select("id", "bus_number", "route_id")


@query("o4_filter_and_page")
def o4(a):
    page = obs.listing(a.observations(), AS_OF, severity="HIGH", status="NEW", days=20, skip=30, limit=100)
    return page.select("id", "problem_type", "route_id")


@query("o5_status_update")
def o5(a):
    return obs.change_status(a.observations(), a.status_changes()).select("id", "status", "problem_type")


@query("o6_by_route")
def o6(a):
    return obs.by_route(a.observations(), AS_OF, days=20, limit=50)


@query("o7_by_type")
def o7(a):
    return obs.by_type(a.observations(), AS_OF, days=20)


@query("o8_summary")
def o8(a):
    return obs.summary(a.observations())


@query("o8_top_problem_types")
def o8_top(a):
    return obs.top_problem_types(a.observations())


@query("o9_route_rollup")
def o9(a):
    return obs.route_rollup(a.observations(), AS_OF, days=20)


@query("o9_route_rollup_exact")
def o9_exact(a):
    return obs.route_rollup(a.observations(), AS_OF, days=20, top=12)


@query("o10_type_rollup")
def o10(a):
    return obs.type_rollup(a.observations(), AS_OF, days=20)


@query("o11_severity_pivot")
def o11(a):
    return obs.severity_distribution(a.observations(), AS_OF, days=20)


@query("o12_recent")
def o12(a):
    return obs.recent(a.observations(), AS_OF).select("id", "status")


@query("o13_registry_load")
def o13(a):
    """Codes offered twice, the earlier offer without a flag; active codes are registered already."""
    codes = a.qr_codes()
    earlier = codes.withColumns({
        "id": F.col("id") + 1_000_000,
        "is_active": F.lit(None).cast("boolean"),
        "created_at": F.col("created_at") - F.make_dt_interval(hours=F.lit(1)),
    })
    registered = codes.where("is_active")
    return obs.register_codes(registered, codes.unionByName(earlier)).select("id", "qr_token", "is_active")


@query("o14_local_display")
def o14(a):
    return obs.display(a.observations()).select("id", "observed_local", "problem_label")


@query("o14_pick_list")
def o14_pick(a):
    return obs.pick_list(a.observations(), "problem_type")


# --- Quality ---------------------------------------------------------------------------------

@query("q1_speed_bound")
def q1(a):
    return checks.speed_bound(a.fact_vehicle_positions())


@query("q2_gate_on_silver")
def q2(a):
    """Checks that fail a run, on silver built from the raw feed."""
    pings = silver.vehicle_positions(a.raw_positions())
    return checks.q.together([checks.speed_bound(pings), checks.position_rules(pings)])


@query("q2_gate_on_faulty_pings")
def q2_faulty(a):
    """The checks that gate new pings, where pings break each of them."""
    return checks.ping_rules(a.faulty_star()["fact_vehicle_positions"])


@query("q2_gate_in_the_write")
def q2_write(a):
    """What the load of pings that break the row-level checks counts, and is stopped by before it shows a row."""
    schema, root = _scratch_schema(), fresh_folder(a.spark, "gated")
    pings = silver.with_wall_clock(a.faulty_star()["fact_vehicle_positions"])
    rules, found = checks.ping_row_rules(), {}
    try:
        loads.load_positions(a.spark, pings, schema, root, rules=rules)
    except checks.q.QualityGateFailed as failed:
        found = failed.violations
        if tables.exists(a.spark, f"{schema}.{loads.POSITIONS}"):
            raise
    rows = [F.struct(F.lit(n).alias("check"), F.lit(found.get(n, 0)).cast("bigint").alias("violations")) for n in rules]
    return a.spark.range(1).select(F.inline(F.array(*rows)))


@query("q3_not_null")
def q3(a):
    return checks.not_null(a.star())


@query("q3_missing_keys")
def q3_missing(a):
    return checks.not_null(a.faulty_star())


@query("q4_unique_keys")
def q4(a):
    """On raw tables, where keys do repeat."""
    raw = {
        "dim_route": a.routes(), "dim_stop": a.stops(), "dim_trip": a.trips(),
        "dim_date": a.holidays(),
    }
    return checks.unique_keys(raw)


@query("q5_orphans")
def q5(a):
    return checks.orphan_facts(a.star())


@query("q6_position_rules")
def q6(a):
    return checks.position_rules(a.raw_positions())


@query("q7_domains")
def q7(a):
    return checks.domains(a.star(), a.submissions().withColumn("status", F.lit("OPEN")))


@query("q7_overlong_texts")
def q7_overlong(a):
    reports = a.submissions().withColumns({
        "severity": F.when(F.col("id") % 4 == 3, "WORST").otherwise(F.col("severity")),
        "status": F.when(F.col("id") % 3 == 0, "OPEN").otherwise("NEW"),
    })
    return checks.domains(a.faulty_star(), reports)


@query("q8_calendar_cover")
def q8(a):
    star = a.star()
    star["dim_date"] = a.holidays()
    return checks.calendar_cover(star)


@query("q_all")
def q_all(a):
    return checks.all_checks(a.star(), a.observations())


# --- Documented questions ------------------------------------------------------------------------

@query("a1_busiest_morning_routes")
def a1(a):
    return questions.busiest_morning_routes(a.fact_schedule(), a.dim_trip(), a.dim_route())


@query("a2_rain_and_stoppage")
def a2(a):
    return rounded(questions.rain_and_stoppage(g6(a)))


@query("a2_rain_correlation")
def a2_corr(a):
    return rounded(questions.rain_correlation(g6(a)))


@query("a3_peak_split")
def a3(a):
    return questions.peak_split(g1(a))


@query("a4_route_coverage")
def a4(a):
    return questions.route_coverage(g1(a))


@query("a5_fuel_baseline")
def a5(a):
    return rounded(questions.fuel_against_baseline(a.fuel()))
