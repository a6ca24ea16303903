"""Fixed values of the domain: keys, columns, track table, physical constants."""

# One lap of one driver in one race of one season.
LAP_KEY = ["Year", "Race", "DriverNumber", "LapNumber"]
DRIVER_KEY = ["Year", "Race", "DriverNumber"]
# Order of samples inside a lap; SampleId makes it total.
SAMPLE_ORDER = ["Time_s", "SampleId"]

# Event name, lap length in km, race length in km.
TRACKS = [
    ("Bahrain Grand Prix", 5.412, 308.238),
    ("Saudi Arabian Grand Prix", 6.174, 308.450),
    ("Australian Grand Prix", 5.278, 306.124),
    ("Azerbaijan Grand Prix", 6.003, 306.049),
    ("Miami Grand Prix", 5.412, 308.326),
    ("Monaco Grand Prix", 3.337, 260.286),
    ("Spanish Grand Prix", 4.675, 308.424),
    ("Canadian Grand Prix", 4.361, 305.270),
    ("Austrian Grand Prix", 4.318, 306.452),
    ("British Grand Prix", 5.891, 306.198),
    ("Hungarian Grand Prix", 4.381, 306.670),
    ("Belgian Grand Prix", 7.004, 308.052),
    ("Dutch Grand Prix", 4.259, 306.587),
    ("Italian Grand Prix", 5.793, 306.720),
    ("Singapore Grand Prix", 4.940, 308.706),
    ("Japanese Grand Prix", 5.807, 307.471),
    ("Qatar Grand Prix", 5.419, 308.611),
    ("United States Grand Prix", 5.513, 308.405),
    ("Mexico City Grand Prix", 4.304, 305.354),
    ("São Paulo Grand Prix", 4.309, 305.879),
    ("Las Vegas Grand Prix", 6.201, 305.880),
    ("Abu Dhabi Grand Prix", 5.281, 305.355),
]

# Names under which a provider files some events.
EVENT_ALIASES = {
    "Saudi Arabia": "Saudi",
    "Great Britain": "Great Britain",
    "United States": "USA",
    "Abu Dhabi": "Abu Dhabi",
}

# DRS channel codes that mean "flap open".
DRS_OPEN = [10, 12, 14]

# Fuel model (percent of start load, seconds per percent).
FUEL_START = 100.0
FUEL_END = 1.0
FUEL_PENALTY_S = 0.03

# Kinematics.
KMH_PER_MPS = 3.6
GRAVITY = 9.81
ACC_LIMIT_G = 7.5
EPSILON = 1e-9

# Columns of the processed lap table, in contract order.
SESSION_COLUMNS = [
    "LapNumber", "Driver", "Compound", "TyreLife", "StartFuel", "FCL", "LapTime",
    "SpeedI1", "SpeedI2", "SpeedFL", "SumLonAcc", "SumLatAcc", "MeanLapSpeed",
]

# Columns shown for a single driver.
DRIVER_VIEW_COLUMNS = [
    "LapNumber", "Driver", "Compound", "TyreLife", "FCL", "LapTime_s", "SumLonAcc", "SumLatAcc",
]

# Regression features of the lap-time models.
MODEL_FEATURES = [
    "Compound", "TyreLife", "StartFuel", "SpeedI1", "SpeedI2", "SpeedFL",
    "SumLonAcc", "SumLatAcc", "MeanLapSpeed", "LonDistanceDTW", "LatDistanceDTW",
]
