"""Column roles and fixed values.

Operators take column names as parameters; ``Roles`` bundles the defaults for
the lap / interval pipeline so a job can be configured in one place.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    race: str = "RaceId"
    driver: str = "Driver"
    lap: str = "LapNumber"
    start: str = "LapStartTime"
    lap_time: str = "LapTime"          # seconds (double)
    event_time: str = "Time"
    status: str = "Status"
    session_type: str = "SessionType"
    is_accurate: str = "IsAccurate"
    event_name: str = "EventName"
    track: str = "TrackId"
    target: str = "sc_next_lap"
    flag: str = "SafetyCar"
    year: str = "Year"


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------

# Track status codes and the boolean column each sets (code '1', track clear,
# and any other code set nothing).
STATUS_FLAGS = {"2": "YellowFlag", "4": "SafetyCar", "5": "RedFlag", "6": "VirtualSafetyCar"}

# Interval end when neither a next-lap start nor a lap time exists.
DEFAULT_INTERVAL_SECONDS = 120

# Weather columns copied by the as-of join, and those filled with race medians.
WEATHER_COLUMNS = ["AirTemp", "Humidity", "Pressure", "Rainfall", "TrackTemp",
                   "WindDirection", "WindSpeed"]
WEATHER_MEDIAN_COLUMNS = ["AirTemp", "Humidity", "Pressure", "Rainfall", "TrackTemp", "WindSpeed"]

# Duration columns converted to <col>_seconds.
DURATION_COLUMNS = ["LapTime", "Sector1Time", "Sector2Time", "Sector3Time", "PitDuration"]

# Track dimension: key, TrackLength, TrackType, Corners (in this order; the
# last matching key wins). Unmatched tracks get TRACK_DEFAULTS.
TRACKS = [
    ("Albert_Park", 5.278, "Street", 14),
    ("Bahrain", 5.412, "Permanent", 15),
    ("Miami", 5.412, "Street", 19),
    ("Imola", 4.909, "Permanent", 19),
    ("Monaco", 3.337, "Street", 19),
    ("Barcelona", 4.675, "Permanent", 16),
    ("Montréal", 4.361, "Street", 14),
    ("Silverstone", 5.891, "Permanent", 18),
    ("Red_Bull_Ring", 4.318, "Permanent", 10),
    ("Hungaroring", 4.381, "Permanent", 14),
    ("Spa-Francorchamps", 7.004, "Permanent", 19),
    ("Zandvoort", 4.259, "Permanent", 14),
    ("Monza", 5.793, "Permanent", 11),
    ("Baku", 6.003, "Street", 20),
    ("Marina_Bay", 4.940, "Street", 19),
    ("Suzuka", 5.807, "Permanent", 18),
    ("Losail", 5.380, "Permanent", 16),
    ("Austin", 5.513, "Permanent", 20),
    ("Mexico", 4.304, "Permanent", 17),
    ("Interlagos", 4.309, "Permanent", 15),
    ("Las_Vegas", 6.201, "Street", 17),
    ("Lusail", 5.380, "Permanent", 16),
    ("Yas_Marina", 5.281, "Permanent", 16),
    ("Jeddah", 6.174, "Street", 27),
    ("Istanbul", 5.338, "Permanent", 14),
    ("Portimão", 4.653, "Permanent", 15),
    ("Mugello", 5.245, "Permanent", 15),
    ("Sochi", 5.848, "Street", 18),
    ("Nürburgring", 5.148, "Permanent", 15),
]
TRACK_DEFAULTS = {"TrackLength": 5.0, "TrackType": "Unknown", "Corners": 15}

BOOLEAN_FILL_COLUMNS = ["SafetyCar", "VirtualSafetyCar", "YellowFlag", "RedFlag", "FreshTyre"]
TRACK_MEDIAN_COLUMNS = ["SpeedI1", "SpeedI2", "SpeedFL", "SpeedST", "TyreLife", "Stint",
                        "LapDeltaToFastest", "LapDeltaToLeader"]
CATEGORY_FILL_COLUMNS = ["Compound", "Driver", "Team"]

# Feature roles. Each column has exactly one role (the reference lists some
# columns under two roles; see README).
CATEGORICAL_FEATURES = ["Driver", "Team", "Compound"]
NUMERIC_FEATURES = ["TrackLength", "Corners", "LapNumber", "LapDeltaToFastest",
                    "LapDeltaToLeader", "Position", "TyreLife", "Stint", "SpeedI1",
                    "SpeedI2", "SpeedFL", "SpeedST", "AirTemp", "Humidity", "Rainfall",
                    "TrackTemp", "WindSpeed"]
BOOLEAN_FEATURES = ["FreshTyre", "VirtualSafetyCar", "YellowFlag"]
INTERACTIONS = [("TyreLife", "TrackTemp"), ("TrackLength", "SpeedST"), ("Rainfall", "Corners")]

# Boosted-tree settings (trees, depth, learning rate, row / column sampling, seed).
GBT_PARAMS = {"maxIter": 600, "maxDepth": 6, "stepSize": 0.02,
              "subsamplingRate": 0.9, "featureSubsetStrategy": "0.8", "seed": 42}
CV_FOLDS = 5
SEED = 42
TEST_FRACTION = 0.2
HOLDOUT_YEARS = (2024,)
FALLBACK_FRACTIONS = (0.7, 0.2, 0.1)
CALIBRATION_BINS = 10
AUC_GATE = 0.80
DEFAULT_THRESHOLD = 0.5

# Request defaults for optional lap fields (batch-scoring profile).
REQUEST_DEFAULTS = {
    "Driver": "Unknown", "Team": "Unknown", "Compound": "Unknown",
    "TyreLife": 10, "FreshTyre": False, "Stint": 1,
    "SpeedI1": 250, "SpeedI2": 250, "SpeedFL": 250, "SpeedST": 250,
    "LapDeltaToFastest": 0, "LapDeltaToLeader": 0, "Position": 10,
    "AirTemp": 25, "Humidity": 50, "Rainfall": 0, "TrackTemp": 30, "WindSpeed": 10,
    "VirtualSafetyCar": False, "YellowFlag": False, "TrackLength": 5.0, "Corners": 15,
}
# Request defaults of the service profile.
API_DEFAULTS = {
    "TrackLength": 5.412, "Corners": 15, "Driver": "Driver1", "Team": "Red Bull",
    "Compound": "MEDIUM", "TyreLife": 10, "FreshTyre": False, "SpeedST": 300.0,
}
REQUEST_FALLBACK_YEAR = 2024
REQUEST_FALLBACK_TRACK = "Unknown"


@dataclass(frozen=True)
class FeatureRoles:
    categorical: tuple = tuple(CATEGORICAL_FEATURES)
    numeric: tuple = tuple(NUMERIC_FEATURES)
    boolean: tuple = tuple(BOOLEAN_FEATURES)
    interactions: tuple = tuple(INTERACTIONS)
    include_interactions: bool = True
    extra: dict = field(default_factory=dict)
