"""Column lists and types of the star schema and of the landed inputs."""

from __future__ import annotations

from omnibus.params import WEEKDAYS

_DAY_FLAGS = ", ".join(f"{d} int" for d in WEEKDAYS)

DIM_ROUTE = "route_id string, route_short_name string, route_long_name string, route_type int"
DIM_STOP = "stop_id string, stop_name string, stop_lat double, stop_lon double"
DIM_TRIP = (
    "trip_id string, route_id string, service_id string, shape_id string, "
    f"{_DAY_FLAGS}, start_date string, end_date string"
)
DIM_DATE = (
    "date_key int, date date, year int, quarter int, month int, month_name string, "
    "week_of_year int, day_of_month int, day_of_week int, day_name string, "
    "is_weekend int, is_public_holiday int"
)
FACT_SCHEDULE = (
    "trip_id string, stop_id string, stop_sequence int, arrival_time string, "
    "departure_time string, arrival_secs int, departure_secs int, departure_hour int, "
    "is_peak_hour int"
)
FACT_POSITIONS = (
    "entity_id string, vehicle_id string, trip_id string, route_id string, "
    "latitude double, longitude double, speed double, timestamp string, status int, "
    "ingested_at string, derived_speed_kmh double"
)
FACT_WEATHER = (
    "date date, temp_max_c double, temp_min_c double, temp_avg_c double, "
    "precipitation_mm double, windspeed_max_kmh double, weather_code int, "
    "weather_label string, is_rainy_day int"
)
FACT_FUEL = "date date, petrol_delhi_inr double, diesel_delhi_inr double, source_note string"
USER_ROUTE_ACCESS = "user_email string, route_id string"
QR_CODES = (
    "id int, qr_token string, bus_number string, route_id string, location string, "
    "is_active boolean, created_at timestamp"
)

# Landed files: text columns stay text until the silver layer types them.
GTFS_FILES = {
    "routes": "route_id string, route_short_name string, route_long_name string, route_type string",
    "stops": "stop_id string, stop_name string, stop_lat string, stop_lon string",
    "trips": "trip_id string, route_id string, service_id string, shape_id string",
    "stop_times": (
        "trip_id string, stop_id string, stop_sequence string, "
        "arrival_time string, departure_time string"
    ),
    "calendar": (
        "service_id string, " + ", ".join(f"{d} string" for d in WEEKDAYS)
        + ", start_date string, end_date string"
    ),
    "agency": "agency_id string, agency_name string, agency_url string, agency_timezone string",
}
POSITION_SNAPSHOT = (
    "entity array<struct<id: string, vehicle: struct<vehicle_id: string, trip_id: string, "
    "route_id: string, latitude: double, longitude: double, speed: double, "
    "timestamp: string, status: int>>>"
)
BRONZE_POSITIONS = (
    "entity_id string, vehicle_id string, trip_id string, route_id string, "
    "latitude double, longitude double, speed double, timestamp string, status int, "
    "ingested_at string"
)
WEATHER_DOCUMENT = (
    "daily struct<time: array<string>, temperature_2m_max: array<double>, "
    "temperature_2m_min: array<double>, precipitation_sum: array<double>, "
    "windspeed_10m_max: array<double>, weathercode: array<int>>"
)
FUEL_CSV = "date string, petrol_delhi_inr double, diesel_delhi_inr double, source_note string"

# Longest text each column may hold (fixed values).
LENGTHS = {
    "dim_route": {"route_id": 50, "route_short_name": 20, "route_long_name": 255},
    "dim_stop": {"stop_id": 50, "stop_name": 255},
    "dim_trip": {
        "trip_id": 100, "route_id": 50, "service_id": 50, "shape_id": 50,
        "start_date": 20, "end_date": 20,
    },
    "dim_date": {"month_name": 20, "day_name": 20},
    "fact_schedule": {"trip_id": 100, "stop_id": 50, "arrival_time": 10, "departure_time": 10},
    "fact_vehicle_positions": {
        "entity_id": 50, "vehicle_id": 50, "trip_id": 100, "route_id": 50,
        "timestamp": 40, "ingested_at": 40,
    },
    "fact_weather_daily": {"weather_label": 50},
    "fact_fuel_prices": {"source_note": 100},
    "user_route_access": {"user_email": 256, "route_id": 50},
}


def names(ddl: str) -> list[str]:
    """Column names of a flat DDL string, in order."""
    return [part.split()[0] for part in ddl.split(", ")]
