"""Fixed values.

These labels, codes, weights and bounds are part of the output contract and must hold exactly as they are.
"""

# Weather condition -> numeric code.
CONDITION_CODES = {"clear": 1.0, "cloudy": 2.0, "rain": 3.0, "snow": 4.0, "fog": 5.0}
BAD_WEATHER = ("rain", "snow", "fog")

# Zone type -> numeric code; every other type gets ZONE_TYPE_OTHER.
ZONE_TYPE_CODES = {"airport": 3.0, "neighborhood": 1.0}
ZONE_TYPE_OTHER = 2.0
AIRPORT = "airport"

# Borough -> numeric code; every other borough gets 0.
BOROUGH_CODES = {"Manhattan": 1.0, "Brooklyn": 2.0, "Queens": 3.0, "Bronx": 4.0, "Staten Island": 5.0}

# Weather score of a zone-hour.
ZONE_SCORE = {"rain": 1.2, "snow": 1.2, "fog": 1.1}

# Weather factor on demand; temperature decides only where the condition does not.
DEMAND_FACTOR = {"rain": 1.3, "snow": 1.3, "fog": 1.1}
COLD_BELOW, COLD_FACTOR = 0.0, 1.2
HOT_ABOVE, HOT_FACTOR = 30.0, 1.1

# Daily impact score: trips x multiplier, capped; other conditions keep the plain count.
IMPACT_MULTIPLIER = {"rain": 1.3, "snow": 1.5, "cloudy": 1.1}
IMPACT_CAP = 100.0

# Surge: the group count against the zone mean.
SURGE_HIGH_OVER, SURGE_HIGH = 1.5, 1.2
SURGE_LOW_UNDER, SURGE_LOW = 0.5, 0.8

# Hours of the day, inclusive.
MORNING_RUSH = (7, 9)
EVENING_RUSH = (17, 19)

# Planar distance: degrees to length.
KM_PER_DEGREE = 111.0
MILES_PER_DEGREE = 69.0

# Defaults for rows without a dimension match.
DEFAULT_TEMPERATURE = 20.0
DEFAULT_HUMIDITY = 50.0
DEFAULT_WIND = 5.0
DEFAULT_POPULARITY = 5.0
DEFAULT_CONDITION_CODE = 1.0
DEFAULT_STDDEV = 1.0
UNKNOWN = "unknown"
UNKNOWN_ZONE = "Unknown Zone"
UNKNOWN_NAME = "Unknown"

# Zone attributes by name.
TOURIST_ZONES = ("Times Square", "Central Park", "Greenwich Village", "Union Square")
BUSINESS_ZONES = ("Financial District", "Midtown East", "Midtown West")

# Lags and frames, in hours.
LAG_HOURS = (1, 2, 3, 24, 168)
WEEK_HOURS = 168
MONTH_HOURS = 720

# Raw trip columns -> curated columns (columns not listed keep their name).
RAW_TRIP_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

# Change operations: create, update, delete, snapshot read.
CREATE, UPDATE, DELETE, READ = "c", "u", "d", "r"
ALL_OPS = (CREATE, UPDATE, DELETE, READ)
ROW_OPS = (CREATE, UPDATE, READ)

# Topic routing, in the order it is applied: capture side, then sink side.
TOPIC_ROUTES = (
    (r"([^.]+)\.([^.]+)\.([^.]+)", "lakehouse.$3"),
    (r"lakehouse\.([^.]+)", "taxi_cdc.$1"),
)

# Bounds of the serving parameters, inclusive.
BOUNDS = {
    "limit": (1, 1000),
    "hours_back": (1, 168),
    "zone_limit": (1, 500),
    "days_back": (1, 30),
    "hours_ahead": (1, 168),
    "top_zones": (1, 100),
    "minutes_back": (5, 240),
}
METRICS = {"trip_count": "count", "revenue": "currency", "avg_fare": "currency"}
EXPORT_FORMATS = ("json", "csv")
FORECAST_CAP = 1000
FORECAST_DAY_HOURS = 24
