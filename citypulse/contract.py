"""Incident contract: column names, domain constants and default weights.

The domain values below are fixed values that must equal the behaviour
being re-implemented (code sets, status map, bounding box, weights,
bins). They are stated plainly, in their natural order.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Raw column name -> contract column name (28 entries).
RAW_TO_CONTRACT = {
    "DR_NO": "dr_no",
    "Date Rptd": "date_reported",
    "DATE OCC": "date_occurred",
    "TIME OCC": "time_occurred",
    "AREA": "area_id",
    "AREA NAME": "area_name",
    "Rpt Dist No": "report_district",
    "Part 1-2": "part_class",
    "Crm Cd": "crime_code",
    "Crm Cd Desc": "crime_desc",
    "Mocodes": "mo_codes",
    "Vict Age": "victim_age",
    "Vict Sex": "victim_sex",
    "Vict Descent": "victim_descent",
    "Premis Cd": "premise_code",
    "Premis Desc": "premise_desc",
    "Weapon Used Cd": "weapon_code",
    "Weapon Desc": "weapon_desc",
    "Status": "status_code",
    "Status Desc": "status_desc",
    "Crm Cd 1": "crime_code_1",
    "Crm Cd 2": "crime_code_2",
    "Crm Cd 3": "crime_code_3",
    "Crm Cd 4": "crime_code_4",
    "LOCATION": "address",
    "Cross Street": "cross_street",
    "LAT": "lat",
    "LON": "lon",
}

# Raw CSV types (Spark DDL); dates are read as strings and parsed.
RAW_TYPES = {
    "DR_NO": "bigint",
    "Date Rptd": "string",
    "DATE OCC": "string",
    "TIME OCC": "int",
    "AREA": "int",
    "AREA NAME": "string",
    "Rpt Dist No": "string",
    "Part 1-2": "int",
    "Crm Cd": "int",
    "Crm Cd Desc": "string",
    "Mocodes": "string",
    "Vict Age": "int",
    "Vict Sex": "string",
    "Vict Descent": "string",
    "Premis Cd": "int",
    "Premis Desc": "string",
    "Weapon Used Cd": "int",
    "Weapon Desc": "string",
    "Status": "string",
    "Status Desc": "string",
    "Crm Cd 1": "int",
    "Crm Cd 2": "int",
    "Crm Cd 3": "int",
    "Crm Cd 4": "int",
    "LOCATION": "string",
    "Cross Street": "string",
    "LAT": "double",
    "LON": "double",
}

# Raw date text format (month/day/year 12-hour clock).
RAW_DATE_FORMAT = "MM/dd/yyyy hh:mm:ss a"

# Violent crime codes (24 codes).
VIOLENT_CRIME_CODES = (
    110, 113,
    121, 122, 815, 820, 821, 860,
    210, 220,
    230, 231, 235, 236, 250, 251,
    237,
    761, 762, 763,
    627, 647, 928, 930,
)

# Status code -> status group label.
STATUS_MAP = {
    "AA": "Adult Arrest",
    "AO": "Adult Other",
    "JA": "Juvenile Arrest",
    "JO": "Juvenile Other",
    "IC": "Investigation Continued",
    "CC": "Closed",
}
ARREST_STATUSES = ("AA", "JA")

# Bounding box (inclusive).
BBOX = {"lat_min": 33.60, "lat_max": 34.40, "lon_min": -118.80, "lon_max": -117.95}

# Part-of-day bins, right-closed on hour: (-1,5] (5,11] (11,17] (17,21] (21,23].
PART_OF_DAY = (
    (5, "Late Night"),
    (11, "Morning"),
    (17, "Afternoon"),
    (21, "Evening"),
    (23, "Night"),
)

# Risk weights.
RISK_WEIGHTS = {"intensity": 0.35, "trend": 0.20, "violence": 0.20, "forecast": 0.25}

# Risk tiers, lowest quartile first.
RISK_TIERS = ("Low", "Medium", "High", "Critical")

SEED = 42
EARTH_RADIUS_KM = 6371.0088
# --- end of fixed values ----------------------------------------------------

CONTRACT_COLUMNS = list(RAW_TO_CONTRACT.values())

DERIVED_COLUMNS = [
    "hour", "dow", "month", "year", "week", "is_weekend", "report_lag_days",
    "part_of_day", "has_coords", "is_violent", "is_arrest", "status_group",
    "weapon_used",
]

CLEAN_COLUMNS = CONTRACT_COLUMNS + DERIVED_COLUMNS

INCIDENT_FEATURE_COLUMNS = [
    "area_id", "area_name", "hour", "dow", "month", "year",
    "is_weekend", "part_of_day",
    "victim_age", "victim_sex", "victim_descent",
    "premise_code", "weapon_used",
    "lat", "lon", "report_lag_days",
    "crime_code", "crime_desc", "part_class",
    "is_violent", "is_arrest",
]

# Classifier inputs.
NUMERIC_FEATURES = [
    "hour", "dow", "month", "victim_age", "report_lag_days",
    "weapon_used", "lat", "lon",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "month_sin", "month_cos",
]
CATEGORICAL_FEATURES = ["area_name", "victim_sex", "victim_descent", "part_of_day"]

# Daily forecaster inputs (16).
DAILY_FORECAST_FEATURES = [
    "lag_1", "lag_7", "lag_14", "lag_28",
    "roll_mean_7", "roll_std_7", "roll_mean_28", "roll_std_28",
    "roll_mean_90", "roll_std_90",
    "dow", "month", "weekofyear", "doy", "is_weekend",
    "area_code",
]
# Weekly forecaster inputs (11).
WEEKLY_FORECAST_FEATURES = [
    "lag_1", "lag_2", "lag_4", "lag_8",
    "roll_mean_4", "roll_mean_12", "roll_std_4",
    "weekofyear", "month", "year", "area_code",
]

PANEL_KEYS = ["date", "area_id", "area_name"]
AREA_KEYS = ["area_id", "area_name"]
