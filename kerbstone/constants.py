"""Vocabularies, code lists, weights and presets.

Every value in this file is part of the data contract. Results are only
comparable when these are exactly as given, so they are written out plainly.
"""

# --- Record contract -------------------------------------------------------

RECORD_COLUMNS = [
    "accident_id", "date", "hour", "city", "latitude", "longitude",
    "road_type", "junction_type", "weather", "light_condition",
    "road_surface", "speed_limit", "num_vehicles_involved", "severity",
]

SEVERITIES = ["Minor", "Serious", "Fatal"]
SEVERITY_INDEX = {"Minor": 0, "Serious": 1, "Fatal": 2}
FATAL_INDEX = 2
UNKNOWN = "Unknown"

# --- Code lists of the raw record -----------------------------------------

SEVERITY_CODES = {1: "Fatal", 2: "Serious", 3: "Minor"}

ROAD_TYPE_CODES = {
    1: "Roundabout",
    2: "One way street",
    3: "Dual carriageway",
    6: "Single carriageway",
    7: "Slip road",
    9: "Unknown",
    12: "One way street / Slip road",
    -1: "Unknown",
}

JUNCTION_CODES = {
    0: "Not at or within 20 metres of junction",
    13: "T or staggered junction",
    16: "Crossroads",
    17: "Junction with more than four arms",
    18: "Private drive or entrance",
    19: "Other junction",
    99: "Unknown",
    -1: "Unknown",
}

WEATHER_CODES = {
    1: "Fine no high winds",
    2: "Raining no high winds",
    3: "Snowing no high winds",
    4: "Fine high winds",
    5: "Raining high winds",
    6: "Snowing high winds",
    7: "Fog or mist",
    8: "Other",
    9: "Unknown",
    -1: "Unknown",
}

LIGHT_CODES = {
    1: "Daylight",
    4: "Darkness - lights lit",
    5: "Darkness - lights unlit",
    6: "Darkness - no lighting",
    7: "Darkness - lighting unknown",
    -1: "Unknown",
}

SURFACE_CODES = {
    1: "Dry",
    2: "Wet or damp",
    3: "Snow",
    4: "Frost or ice",
    5: "Flood",
    6: "Oil or diesel",
    7: "Mud",
    9: "Unknown",
    -1: "Unknown",
}

DISTRICT_FIELD = "local_authority_ons_district"
SPEED_SENTINELS = [-1, 99]

# --- Vocabularies ----------------------------------------------------------

ROAD_TYPES = [
    "Roundabout", "One way street", "Dual carriageway",
    "Single carriageway", "Slip road", "Unknown",
]

JUNCTION_TYPES = [
    "Not at or within 20 metres of junction", "T or staggered junction",
    "Crossroads", "Junction with more than four arms",
    "Private drive or entrance", "Other junction", "Unknown",
]

WEATHER_CONDITIONS = [
    "Fine no high winds", "Raining no high winds", "Snowing no high winds",
    "Fine high winds", "Raining high winds", "Snowing high winds",
    "Fog or mist", "Other", "Unknown",
]

LIGHT_CONDITIONS = [
    "Daylight", "Darkness - lights lit", "Darkness - lights unlit",
    "Darkness - no lighting", "Darkness - lighting unknown", "Unknown",
]

# --- Feature weights -------------------------------------------------------

RUSH_HOURS = [7, 8, 9, 16, 17, 18]

# (label, first hour, last hour), both inclusive
HOUR_BUCKETS = [
    ("Night (00-05)", 0, 5),
    ("Morning (06-11)", 6, 11),
    ("Afternoon (12-16)", 12, 16),
    ("Evening (17-21)", 17, 21),
    ("Late Night (22-23)", 22, 23),
]

WEATHER_WEIGHTS = {
    "Fine no high winds": 0,
    "Fine high winds": 1,
    "Raining no high winds": 2,
    "Raining high winds": 3,
    "Snowing no high winds": 3,
    "Snowing high winds": 4,
    "Fog or mist": 3,
    "Other": 1,
    "Unknown": 1,
}

LIGHT_WEIGHTS = {
    "Daylight": 0,
    "Darkness - lights lit": 1,
    "Darkness - lights unlit": 2,
    "Darkness - no lighting": 2,
    "Darkness - lighting unknown": 2,
    "Unknown": 1,
}

SURFACE_WEIGHTS = {
    "Dry": 0,
    "Wet or damp": 1,
    "Snow": 2,
    "Frost or ice": 2,
    "Flood": 3,
    "Oil or diesel": 2,
    "Mud": 2,
    "Unknown": 1,
}

# --- Model table -----------------------------------------------------------

CATEGORICAL_FEATURES = [
    "road_type", "junction_type", "weather", "light_condition",
    "road_surface", "hour_bucket", "city",
]

NUMERIC_FEATURES = [
    "speed_limit", "num_vehicles_involved", "hour", "is_weekend",
    "is_rush_hour", "is_night", "weather_severity_index",
]

FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES

# --- Risk ------------------------------------------------------------------

SEGMENT_KEYS = ["road_type", "junction_type", "weather", "hour_bucket", "is_weekend"]
RISK_WEIGHTS = {"Minor": 1, "Serious": 3, "Fatal": 6}
RISK_SMOOTHING = 8
# (band, lower bound inclusive, upper bound exclusive)
RISK_BANDS = [("Low", 0, 25), ("Medium", 25, 50), ("High", 50, 75), ("Critical", 75, 101)]

# --- Spatial ---------------------------------------------------------------

EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE_LON = 111.320
KM_PER_DEGREE_LAT = 110.574
KMEANS_K = 12
KMEANS_STARTS = 10
DBSCAN_EPS_KM = 1.5
DBSCAN_MIN_SAMPLES = 8
KDE_BANDWIDTH_KM = 2.0
KDE_GRID_SIZE = 60
TOP_HOTSPOTS = 25
SILHOUETTE_SAMPLE = 5000

# --- Training --------------------------------------------------------------

SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
FATAL_THRESHOLD = 0.15
SMOTE_NEIGHBOURS = 5
BACKGROUND_ROWS = 200
BACKGROUND_TABLE_ROWS = 300
