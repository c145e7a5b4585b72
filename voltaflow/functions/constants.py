"""Fixed values of the control model.

These numbers must equal the behaviour being reproduced, so they are kept
together, in natural order, as plain text.
"""

# --- fixed values: validation -------------------------------------------
MAX_POWER_KW = 10000.0
REQUIRED_INGEST_FIELDS = ("solar_power", "wind_power", "location")
MSG_MISSING = "Missing required field: {}"
MSG_NOT_NUMERIC = "Not numeric: {}"
MSG_BAD_TIME = "Unreadable timestamp"
MSG_SOLAR_NEGATIVE = "Solar power cannot be negative"
MSG_SOLAR_OVER = "Solar power exceeds maximum capacity"
MSG_WIND_NEGATIVE = "Wind power cannot be negative"
MSG_WIND_OVER = "Wind power exceeds maximum capacity"

# --- fixed values: anomaly rules -----------------------------------------
NIGHT_FROM_HOUR = 20          # hour >= 20 ...
NIGHT_TO_HOUR = 5             # ... or hour <= 5
NIGHT_SOLAR_KW = 10.0         # solar > 10 kW at night
LOW_WIND_SPEED = 3.0          # wind speed < 3 m/s ...
HIGH_WIND_POWER_KW = 100.0    # ... with wind power > 100 kW
ANOMALY_NIGHT = "solar_night_generation"
ANOMALY_WIND = "wind_power_mismatch"
QUALITY_PENALTY = 0.1

# --- fixed values: efficiencies ------------------------------------------
SOLAR_REF_TEMP_C = 25.0
SOLAR_LOSS_PER_C = 0.005
SOLAR_EFF_FLOOR = 0.5
WIND_CUT_IN = 3.0
WIND_RATED = 15.0
WIND_DECAY_PER_MS = 0.1
WIND_EFF_FLOOR = 0.3

# --- fixed values: tariff (price per kWh by hour; first band wins) -------
PEAK_PRICE = 150.0            # hours 9-11 and 17-21
MID_PRICE = 100.0             # hours 7-9 and 11-17
OFF_PEAK_PRICE = 60.0         # all other hours
PEAK_BANDS = ((9, 11), (17, 21))
MID_BANDS = ((7, 9), (11, 17))

# --- fixed values: load profile means (kW) -------------------------------
# location -> list of (first_hour, last_hour, mean_kw), else the last value
LOAD_PROFILE_BANDS = {
    "MicroGrid-01": (((9, 18), 2000.0),),
    "MicroGrid-02": (),
    "MicroGrid-03": (((7, 9), 1500.0), ((18, 22), 1500.0), ((10, 17), 600.0)),
}
LOAD_PROFILE_ELSE = {"MicroGrid-01": 800.0, "MicroGrid-02": 3000.0, "MicroGrid-03": 400.0}
# standard deviations in the order of the bands, the last for all other hours
LOAD_PROFILE_SIGMA = {"MicroGrid-01": (100.0, 50.0), "MicroGrid-02": (200.0,),
                      "MicroGrid-03": (100.0, 100.0, 50.0, 30.0)}
DEFAULT_LOAD_KW = 1000.0
# weekend factor, tested by substring in this order
WEEKEND_FACTORS = (("MicroGrid-01", 0.3), ("MicroGrid-02", 0.5), ("MicroGrid-03", 1.2))

# --- fixed values: battery -----------------------------------------------
BATTERY_CAPACITY_KWH = 5000.0
BATTERY_INITIAL_SOC = 0.5
BATTERY_MAX_CHARGE_KW = 1000.0
BATTERY_MAX_DISCHARGE_KW = 1000.0
BATTERY_EFFICIENCY = 0.95
CHARGE_SOC_BELOW = 0.9
CHARGE_PRICE_BELOW = 100.0
DISCHARGE_SOC_ABOVE = 0.2
DISCHARGE_PRICE_ABOVE = 100.0
DISCHARGE_DEFICIT_ABOVE = 500.0

# --- fixed values: grid and demand response ------------------------------
EXPORT_PRICE_ABOVE = 80.0
SHED_IMPORT_ABOVE = 2000.0
SHED_LOAD_FRACTION = 0.2
EXPORT_LIMIT_KW = 3000.0
EXPORT_PRICE_FACTOR = 0.9

# --- fixed values: rollups -----------------------------------------------
HOURLY_INTERVAL_H = 1 / 12     # 5-minute readings, hourly table
DAILY_INTERVAL_H = 0.0833      # 5-minute readings, daily table


# --- fixed values: alert rules -------------------------------------------
LOW_EFFICIENCY_BELOW = 0.5
HIGH_DEPENDENCY_ABOVE = 0.7
LOW_BATTERY_PCT_BELOW = 20.0
FULL_BATTERY_PCT_ABOVE = 95.0

# --- fixed values: microgrid dimension seed ------------------------------
MICROGRID_SEED = (
    ("MicroGrid-01", "서울 상업지구 마이크로그리드", 5000.0, 37.5665, 126.9780),
    ("MicroGrid-02", "대전 산업단지 마이크로그리드", 8000.0, 36.3504, 127.3845),
    ("MicroGrid-03", "부산 주거지구 마이크로그리드", 3000.0, 35.1796, 129.0756),
)
MICROGRID_DEFAULTS = {"battery_max_charge": 1000.0, "battery_max_discharge": 1000.0,
                      "grid_max_import": 3000.0, "grid_max_export": 3000.0, "peak_load": 5000.0}

# --- fixed values: solar half --------------------------------------------
# wire names of the public solar record, and our ASCII names
SOLAR_SOURCE_FIELDS = (
    ("거래일자", "transaction_date"),
    ("거래시간", "transaction_hour"),
    ("지역", "region"),
    ("태양광 발전량(MWh)", "solar_generation_mwh"),
)
DAYLIGHT_FROM_HOUR = 6
DAYLIGHT_TO_HOUR = 18
HOUR_CATEGORIES = ((6, "dawn"), (12, "morning"), (18, "afternoon"))  # hour < bound
HOUR_CATEGORY_ELSE = "night"
ENVELOPE_DATA_SOURCE = "solar_api"
UNKNOWN_KEY = "unknown"
CONTROL_KEY = "control"

# --- fixed values: streaming ---------------------------------------------
SLIDING_WINDOW = "5 minutes"
SLIDING_SLIDE = "1 minute"
WATERMARK_DELAY = "10 minutes"
STREAM_TRIGGER = "30 seconds"

# --- fixed values: topics ------------------------------------------------
TOPIC_READINGS = "power_generation_data"
TOPIC_REQUESTS = "control_optimization_request"
TOPIC_RESULTS = "control_result"

# --- fixed values: forecast models ---------------------------------------
FEATURE_COLUMNS = ("transaction_hour", "month", "day", "weekday", "is_weekend", "is_daylight")
TRAIN_FRACTION = 0.8
SPLIT_SEED = 42
LR_PARAMS = {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.8}
RF_PARAMS = {"numTrees": 100, "maxDepth": 10, "seed": 42}
