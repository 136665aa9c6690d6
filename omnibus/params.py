"""Fixed values and named parameters.

The first block must equal the published data contract for results to be
right.  The second block holds choices the contract leaves open; every
function that uses one takes it as an argument with the default below.
"""

from __future__ import annotations

import datetime as dt

# --- Fixed values -----------------------------------------------------------

PROBLEM_TYPES = (
    "BUS_DELAY",
    "BUS_NOT_ARRIVED",
    "BUS_BUNCHING",
    "LONG_SERVICE_GAP",
    "OVER_CROWDING",
    "UNDER_UTILIZATION",
    "VEHICLE_CONDITION",
    "VEHICLE_BREAKDOWN",
    "MAINTENANCE_ISSUE",
    "FUEL_CONSUMPTION",
    "SAFETY_ISSUE",
    "ROUTE_ISSUE",
    "STOP_INFRASTRUCTURE",
    "WEATHER_DISRUPTION",
    "TRAFFIC_DISRUPTION",
    "OTHER",
)
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
STATUSES = ("NEW", "REVIEWED", "RESOLVED")

# (first hour, last hour, label); every other hour, also NULL, is EARLY_SLOT.
TIME_SLOTS = (
    (7, 9, "Morning Peak"),
    (17, 19, "Evening Peak"),
    (10, 16, "Mid-day"),
    (20, 23, "Night"),
)
EARLY_SLOT = "Early Morning"

MAX_SPEED_KMH = 120.0
MOVING_SPEED_KMH = 2.0
ACTIVITY_CUTOFF = dt.date(2026, 9, 17)
TOP_ROUTES = 50
DUPLICATE_WINDOW_MINUTES = 60
EXPORT_DAYS = 7
DISPLAY_ZONE = "Asia/Kolkata"
CALENDAR_END = dt.date(2027, 12, 31)
DEFAULT_LABEL_FILTER = "Drizzle/Rain"

EXPORT_COLUMNS = (
    "id",
    "route_id",
    "bus_number",
    "problem_type",
    "severity",
    "status",
    "description",
    "latitude",
    "longitude",
    "observed_at",
    "created_at",
)

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

# --- Open choices, each one an argument with this default ---------------------

CALENDAR_START = dt.date(2024, 1, 1)
BOX_LAT = (28.0, 29.1)
BOX_LON = (76.5, 78.0)
EARTH_RADIUS_KM = 6371.0088
RAIN_THRESHOLD_MM = 0.0
PEAK_HOURS = ((7, 9), (17, 19))
# WMO weather code ranges -> label.
WEATHER_LABELS = (
    (0, 0, "Clear"),
    (1, 3, "Cloudy"),
    (45, 48, "Fog"),
    (51, 67, "Drizzle/Rain"),
    (71, 77, "Snow"),
    (80, 82, "Drizzle/Rain"),
    (85, 86, "Snow"),
    (95, 99, "Thunderstorm"),
)
