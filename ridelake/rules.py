"""Thresholds, labels and code lists that decide the results.

Each ladder is a list of (bound, label) in the order it is tried, plus the label
of whatever is left, nulls included. ``functions.bands`` turns them into columns.
"""

EARTH_RADIUS_KM = 6371
PI = 3.14159265359
MIN_VALID_EPOCH = 1577836800  # 2020-01-01T00:00:00Z
POLL_SECONDS = 300
POLLS_PER_DAY = 288

# Stands for null inside a hashed key.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
UNKNOWN_STATION_ID = "-1"

# --- supply: station health, rebalancing, coverage -------------------------
HEALTH_SCORE = ([(0.95, 100), (0.90, 90), (0.80, 80), (0.70, 70), (0.50, 50)], 0)  # >=
REBALANCING = ([(0.5, "high"), (0.3, "medium")], "low")  # >
COVERAGE_GRADE = ([(0.5, "poor"), (0.8, "fair"), (0.95, "good")], "excellent")  # <

# --- demand: hours of the day, both ends included --------------------------
MORNING_RUSH = (6, 9)
MIDDAY = (10, 15)
EVENING_RUSH = (16, 19)
FLOW_MARGIN = 10

# --- weather, station-day layer --------------------------------------------
WMO_CONDITIONS = {
    "clear": [0],
    "partly_cloudy": [1, 2, 3],
    "foggy": [45, 48],
    "drizzle": [51, 53, 55, 56, 57],
    "rain": [61, 63, 65, 66, 67, 80, 81, 82],
    "snow": [71, 73, 75, 77, 85, 86],
    "thunderstorm": [95, 96, 99],
}
TEMPERATURE_RANGE = ([(0, "freezing"), (10, "cold"), (18, "mild"), (27, "warm")], "hot")  # <
PRECIPITATION_INTENSITY = ([(0.1, "light"), (0.3, "moderate")], "heavy")  # <, 0 is "none"
HEAT_LIMIT = 32
WIND_LIMIT = 32
SEVERITY_POINTS = {"rain": 20, "snow": 30, "frost": 25, "heat": 15, "wind": 10}
SEVERITY_CAP = 100
IDEAL_CODES = [0, 1, 2, 3]
IDEAL_TEMPERATURE = (13, 24)
IDEAL_WIND_BELOW = 24
POOR_RAIN_ABOVE = 0.3
POOR_WIND_ABOVE = 40

# --- trends -----------------------------------------------------------------
TREND_UP = [(1.2, "surge"), (1.1, "above_average")]
TREND_DOWN = [(0.8, "decline"), (0.9, "below_average")]

# --- dimensions ---------------------------------------------------------------
CALENDAR_LOOKAHEAD_DAYS = 365
SEASON_OF_MONTH = {
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
    "Winter": [12, 1, 2],
}
BOROUGH_BY_LATITUDE = [
    (40.8, "Bronx"),
    (40.75, "Upper Manhattan"),
    (40.7, "Midtown Manhattan"),
    (40.65, "Lower Manhattan"),
]  # >
BROOKLYN_WEST_OF = -74.0
STATION_SIZE = ([(50, "large"), (30, "medium"), (15, "small")], "micro")  # >=
# First and last hour of each bucket.
TIME_BUCKETS = {
    "late_night": (0, 5),
    "morning_rush": (6, 9),
    "midday": (10, 15),
    "evening_rush": (16, 19),
    "evening": (20, 23),
}
SHIFTS = {"morning": (6, 13), "afternoon": (14, 19), "evening": (20, 23)}  # rest: night
RUSH_HOURS = [(7, 9), (16, 19)]
BUSINESS_HOURS = (9, 17)
PEAK_BIKING_HOURS = (7, 22)
PEAK_BIKING_MONTHS = (5, 9)
# (id, name, description, has_subscription); keys follow the order of the ids.
USER_TYPES = [
    ("casual", "Casual Rider", "Pay-per-ride user without subscription", False),
    ("member", "Member", "Annual or monthly subscription holder with unlimited rides", True),
    ("unknown", "Unknown", "User type not specified or missing", None),
]

# --- dashboard views ------------------------------------------------------------
PRIORITY = {"high": "🔴 High Priority", "medium": "🟡 Medium Priority"}
PRIORITY_REST = "🟢 Low Priority"
ACTIVITY = ([(100, "Very High"), (50, "High"), (20, "Medium"), (5, "Low")], "Very Low")  # >=
DURATION_CUTS = [5, 15, 30, 60]
ROUTE_POPULARITY = (
    [(1000, "Very Popular"), (500, "Popular"), (100, "Moderate"), (20, "Low")],
    "Very Low",
)  # >=
TRIP_VOLUME = (
    [(50000, "Very High"), (30000, "High"), (15000, "Medium"), (5000, "Low")],
    "Very Low",
)  # >=
VIEW_TEMPERATURE = ([(0, "Freezing"), (10, "Cold"), (20, "Mild"), (30, "Warm")], "Hot")  # <
VIEW_PRECIPITATION = ([(2.5, "Light Rain"), (10, "Moderate Rain")], "Heavy Rain")  # <, 0: No Rain
LIVE_STATION_TYPE = ([(50, "Large"), (30, "Medium"), (15, "Small")], "Micro")  # >=
LIVE_STATION_SIZE = (
    [(50, "extra_large"), (35, "large"), (25, "medium"), (15, "small")],
    "unknown",
)  # >=
LIVE_BOROUGHS = {
    "Manhattan": "Manhattan",
    "Brooklyn": "Brooklyn",
    "Queens": "Queens",
    "Bronx": "Bronx",
    "Staten": "Staten Island",
}
LOW_STOCK = 3
FRESHNESS = ([(10, "Fresh"), (30, "Recent"), (60, "Stale")], "Very Stale")  # <=

# --- monitoring -------------------------------------------------------------------
SOURCE_WARN_HOURS = 24
SOURCE_ERROR_HOURS = 48
STREAM_AGE_MINUTES = ([(10, "good"), (30, "warning")], "error")  # <
ACTIVE_STATIONS = ([(1500, "good"), (1000, "warning")], "error")  # >
WEATHER_AGE_DAYS = ([(2, "good"), (7, "warning")], "error")  # <
STALE_AFTER_MINUTES = 30
