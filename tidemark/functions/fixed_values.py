"""Labels, sets, seed rows and limits that results depend on."""

# Weather code -> label; any other code, and NULL, is UNKNOWN_LABEL.
WEATHER_LABELS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    56: "Light freezing drizzle",
    57: "Dense freezing drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    66: "Light freezing rain",
    67: "Heavy freezing rain",
    71: "Slight snowfall",
    73: "Moderate snowfall",
    75: "Heavy snowfall",
    77: "Snow grains",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with slight hail",
    99: "Thunderstorm with heavy hail",
}
UNKNOWN_LABEL = "Unknown"

# Flare classes from weakest to strongest; the rank is the position.
FLARE_CLASSES = "ABCMX"

# Event types and finding severities (most urgent first).
EVENT_TYPES = ("CME", "GST", "FLR")
SEVERITIES = ("critical", "warning", "info")

# Seeded locations (location_id, name, lat, lon, timezone).
SEED_LOCATIONS = [
    (1, "London", "51.50740", "-0.12780", "Europe/London"),
    (2, "New York", "40.71280", "-74.00600", "America/New_York"),
    (3, "Tokyo", "35.67620", "139.65030", "Asia/Tokyo"),
    (4, "Sydney", "-33.86880", "151.20930", "Australia/Sydney"),
    (5, "Nairobi", "-1.28640", "36.81720", "Africa/Nairobi"),
]

# Formats of file names and payload instants.
STAMP_FORMAT = "yyyyMMdd'T'HHmmssX"
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss]XXX"

# Backfill span, window lengths (inclusive days), alert limits.
BACKFILL_LAG_DAYS = 5
BACKFILL_MONTHS = 24
FORECAST_DAYS = 16
ANOMALY_DAYS = 7
ANOMALY_SIGMAS = 3
SUCCESS_RATE_FLOOR = 0.9

# Names of the audit checks and the severity of their findings.
CHECKS = {
    "absence_weather_daily": "warning",
    "anomaly_temp_max": "warning",
    "xtable_weather_run_id": "warning",
    "xtable_asteroid_dimension_coverage": "warning",
    "xtable_location_dimension_coverage": "warning",
    "trend_api_success_rate": "critical",
}
