"""Fixed values. Results agree with earlier reports only while these stay as they are."""

# Base station, degrees.
BASE_LATITUDE = 35.080532
BASE_LONGITUDE = 129.077486
EARTH_RADIUS_KM = 6371.0

# Distance bands: id, lower edge (inside), upper edge (outside), label, colour.
BANDS = (
    (0, 0.0, 10.0, "0~10 km", "#e74c3c"),
    (1, 10.0, 20.0, "10~20 km", "#f1c40f"),
    (2, 20.0, 30.0, "20~30 km", "#2ecc71"),
    (3, 30.0, 40.0, "30~40 km", "#3498db"),
    (4, 40.0, float("inf"), "40 km+", "#9b59b6"),
)
NO_BAND_COLOUR = "#aaaaaa"

# TDMA slots: one frame, and the nominal increment below each speed in knots.
SLOTS_PER_FRAME = 2250
SLOT_TOLERANCE = 0.2
INCREMENT_BELOW_KNOTS = ((14.0, 375), (23.0, 225))
INCREMENT_FAST = 75
SPEED_UNITS_PER_KNOT = 10.0

# Raw positions are in 1/600000 degree.
POSITION_UNITS_PER_DEGREE = 600000.0

# Charts' datasets.
HISTOGRAM_BINS = 25
WHISKER_IQR = 1.5
SERIES_STEP = "30 seconds"
PREVIEW_ROWS = 50
CONTEXT_ROWS = 2

# Source layout and run cadence.
SOURCE_ROOT = "/datalake/ais"
BUCKET_FOLDER_FORMAT = "yyyy/MM/dd/HH/mm"
BUCKET_MINUTES = 10
SETTLE_MINUTES = 5
RUN_ZONE = "Asia/Seoul"
RUN_ID_FORMAT = "yyyyMMdd_HHmm"

# Columns of the canonical table, with their types.
RECORD_SCHEMA = (
    ("mmsi", "string"),
    ("date_bucket", "timestamp_ntz"),
    ("received_at", "timestamp_ntz"),
    ("msg_type", "int"),
    ("cog", "double"),
    ("integrity_flag", "int"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("nav_status", "int"),
    ("raim_flag", "boolean"),
    ("rot", "double"),
    ("sog", "double"),
    ("timestamp_sec", "int"),
    ("true_heading", "int"),
    ("rssi", "double"),
    ("slot_num", "int"),
    ("snr", "double"),
)
RECORD_COLUMNS = tuple(name for name, _ in RECORD_SCHEMA)

# Columns the analyses read.
SCAN_COLUMNS = (
    "mmsi", "date_bucket", "received_at", "msg_type", "sog", "cog",
    "nav_status", "longitude", "latitude", "rssi", "slot_num", "snr",
)
