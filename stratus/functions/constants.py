"""Fixed values that must equal the original warehouse's for identical results.

These are domain data (compass bands, WMO weather codes, variable lists, thresholds),
stated plainly and in their natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — compass bands: (id, degree_from, degree_to, short, full).
# Inclusive integer bounds, as seeded by the original warehouse.
# ---------------------------------------------------------------------------
WIND_BANDS = [
    (1, 0, 11, "N", "North"),
    (2, 12, 33, "NNE", "North-Northeast"),
    (3, 34, 56, "NE", "Northeast"),
    (4, 57, 78, "ENE", "East-Northeast"),
    (5, 79, 101, "E", "East"),
    (6, 102, 123, "ESE", "East-Southeast"),
    (7, 124, 146, "SE", "Southeast"),
    (8, 147, 168, "SSE", "South-Southeast"),
    (9, 169, 191, "S", "South"),
    (10, 192, 213, "SSW", "South-Southwest"),
    (11, 214, 236, "SW", "Southwest"),
    (12, 237, 258, "WSW", "West-Southwest"),
    (13, 259, 281, "W", "West"),
    (14, 282, 303, "WNW", "West-Northwest"),
    (15, 304, 326, "NW", "Northwest"),
    (16, 327, 360, "NNW", "North-Northwest"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — WMO weather interpretation codes: (id, description, severity, precipitation_type).
# ---------------------------------------------------------------------------
WMO_CODES = [
    (0, "Clear sky", "None", None),
    (1, "Mainly clear", "None", None),
    (2, "Partly cloudy", "None", None),
    (3, "Overcast", "None", None),
    (45, "Fog", "Low", None),
    (48, "Depositing rime fog", "Low", None),
    (51, "Drizzle: light", "Low", "Rain"),
    (53, "Drizzle: moderate", "Low", "Rain"),
    (55, "Drizzle: dense", "Low", "Rain"),
    (56, "Freezing drizzle: light", "Medium", "Mixed"),
    (57, "Freezing drizzle: dense", "Medium", "Mixed"),
    (61, "Rain: slight", "Low", "Rain"),
    (63, "Rain: moderate", "Medium", "Rain"),
    (65, "Rain: heavy", "High", "Rain"),
    (66, "Freezing rain: light", "Medium", "Mixed"),
    (67, "Freezing rain: heavy", "High", "Mixed"),
    (71, "Snowfall: slight", "Low", "Snow"),
    (73, "Snowfall: moderate", "Medium", "Snow"),
    (75, "Snowfall: heavy", "High", "Snow"),
    (77, "Snow grains", "Low", "Snow"),
    (80, "Rain showers: slight", "Low", "Rain"),
    (81, "Rain showers: moderate", "Medium", "Rain"),
    (82, "Rain showers: violent", "High", "Rain"),
    (85, "Snow showers: slight", "Low", "Snow"),
    (86, "Snow showers: heavy", "High", "Snow"),
    (95, "Thunderstorm: slight or moderate", "High", "Rain"),
    (96, "Thunderstorm with slight hail", "High", "Mixed"),
    (99, "Thunderstorm with heavy hail", "High", "Mixed"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — hourly variables requested from the weather API, in request order.
# All are doubles except weather_code (small int) and is_day (0/1 → boolean).
# ---------------------------------------------------------------------------
HOURLY_VARS = [
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature",
    "vapour_pressure_deficit", "precipitation", "rain", "snowfall", "snow_depth",
    "pressure_msl", "surface_pressure", "cloud_cover", "cloud_cover_low", "cloud_cover_mid",
    "cloud_cover_high", "wind_speed_10m", "wind_speed_100m", "wind_direction_10m",
    "wind_direction_100m", "wind_gusts_10m", "shortwave_radiation", "direct_radiation",
    "diffuse_radiation", "direct_normal_irradiance", "sunshine_duration",
    "et0_fao_evapotranspiration", "soil_temperature_0_to_7cm", "soil_temperature_7_to_28cm",
    "soil_temperature_28_to_100cm", "soil_temperature_100_to_255cm", "soil_moisture_0_to_7cm",
    "soil_moisture_7_to_28cm", "soil_moisture_28_to_100cm", "soil_moisture_100_to_255cm",
    "weather_code", "boundary_layer_height", "wet_bulb_temperature_2m",
    "total_column_integrated_water_vapour", "is_day",
]
NON_DOUBLE_VARS = ("weather_code", "is_day")
WIND_DIRECTION_VARS = ("wind_direction_10m", "wind_direction_100m")

# ---------------------------------------------------------------------------
# FIXED VALUES — daily thresholds for the day flags (evaluated on unrounded aggregates).
# ---------------------------------------------------------------------------
FROST_BELOW = 0      # min temperature < 0
HOT_FROM = 30        # max temperature >= 30
RAINY_FROM = 1       # precipitation sum >= 1
SNOWY_ABOVE = 0      # snowfall sum > 0

# ---------------------------------------------------------------------------
# FIXED VALUES — forecast configuration.
# ---------------------------------------------------------------------------
HORIZON_DAYS = 7
HISTORY_DAYS = 2 * 365
MIN_HISTORY_POINTS = 60
INTERVAL_Z80 = 1.2815515655446004   # two-sided 80 % normal quantile
FORECAST_METRICS = [
    "temp_avg", "temp_min", "temp_max", "precipitation_sum",
    "sunshine_hours", "humidity_avg", "pressure_avg", "wind_speed_avg",
]
METRICS_WITH_INTERVAL = ("temp_avg", "precipitation_sum")
NON_NEGATIVE_METRICS = ("precipitation_sum", "sunshine_hours")

# ---------------------------------------------------------------------------
# FIXED VALUES — control plane.
# ---------------------------------------------------------------------------
LAYERS = ["stage", "core"]
STATUSES = ["success", "failed"]
EXPECTED_ROWS_PER_DAY = 24
HISTORY_START = "2010-01-01"

# ---------------------------------------------------------------------------
# FIXED VALUES — quota classifier words.
# ---------------------------------------------------------------------------
DAILY_WORD = "daily"
LIMIT_WORDS = ("limit", "exceeded")

# ---------------------------------------------------------------------------
# Our decision (not in the original): Köppen code → six climate groups.
# ---------------------------------------------------------------------------
CLIMATE_GROUPS = {
    "ET": "Polar",
    "DFC": "Subarctic",
    "DFA": "Continental",
    "DFB": "Continental",
    "CFA": "Temperate",
    "CFB": "Temperate",
    "CSA": "Mediterranean",
    "CSB": "Mediterranean",
    "BSK": "Arid",
    "BWH": "Arid",
}
