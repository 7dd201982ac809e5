"""Names, types and fixed values of the tables the library reads and writes."""

from __future__ import annotations

# Columns of a station-day record, in file order.
RAW_COLUMNS = [
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME",
    "TEMP", "TEMP_ATTRIBUTES", "DEWP", "DEWP_ATTRIBUTES", "SLP", "SLP_ATTRIBUTES",
    "STP", "STP_ATTRIBUTES", "VISIB", "VISIB_ATTRIBUTES", "WDSP", "WDSP_ATTRIBUTES",
    "MXSPD", "GUST", "MAX", "MAX_ATTRIBUTES", "MIN", "MIN_ATTRIBUTES",
    "PRCP", "PRCP_ATTRIBUTES", "SNDP", "FRSHTT",
]

# The averaged measures, in output order. FRSHTT is a six-digit flag code.
MEASURES = [
    "LATITUDE", "LONGITUDE", "ELEVATION", "TEMP", "DEWP", "SLP", "STP", "VISIB",
    "WDSP", "MXSPD", "GUST", "MAX", "MIN", "PRCP", "SNDP", "FRSHTT",
]
NUMERIC_MEASURES = [m for m in MEASURES if m != "FRSHTT"]

# Markers for a missing measure.
SENTINELS = {
    "DEWP": 9999.9, "SLP": 9999.9, "MAX": 9999.9, "MIN": 9999.9,
    "STP": 999.9, "VISIB": 999.9, "WDSP": 999.9, "MXSPD": 999.9, "GUST": 999.9,
    "SNDP": 999.9, "PRCP": 99.99,
}
# Measures whose *_ATTRIBUTES column holds the number of readings (0 = missing).
COUNTED_MEASURES = ["DEWP", "SLP", "STP", "VISIB", "WDSP"]

# Meaning of the FRSHTT digits, left to right.
FLAGS = ["fog", "rain", "snow", "hail", "thunder", "tornado"]

# Model inputs, in vector order.
FEATURES = [
    "year", "weekofyear", "avg_TEMP", "avg_PRCP", "avg_DEWP",
    "lag_cases", "lag_cases_2", "lag_cases_3",
    "sin_week", "cos_week", "temp_prcp_interaction",
]
LABEL = "log_total_cases"

# A record as it arrives: text only, so that station codes keep their leading zeros.
RAW_DDL = ", ".join(f"{c} STRING" for c in RAW_COLUMNS)
# Beside the record: the text of a line whose number of fields is not that of a record, else null.
DAMAGED = "damaged_line"
READ_DDL = f"{RAW_DDL}, {DAMAGED} STRING"
CASES_DDL = "city STRING, year INT, weekofyear INT, total_cases INT"
CASE_KEY = ["city", "year", "weekofyear"]
WEEK_KEY = ["Weather_Year", "Weather_Week"]
LEDGER_DDL = "path STRING, processed_at TIMESTAMP"


def avg_columns(measures=MEASURES) -> list[str]:
    return [f"avg_{m}" for m in measures]


def count_columns(measures=MEASURES) -> list[str]:
    return [f"n_{m}" for m in measures]


def sum_columns(measures=MEASURES) -> list[str]:
    return [f"s_{m}" for m in measures]


def weekly_ddl(measures=MEASURES, keys: str = "") -> str:
    """DDL of the weekly table: keys, rows per week; mean, reading count and sum per measure."""
    head = (keys + ", " if keys else "") + "Weather_Year INT, Weather_Week INT, record_count BIGINT"
    means = ", ".join(f"{c} DOUBLE" for c in avg_columns(measures))
    counts = ", ".join(f"{c} BIGINT" for c in count_columns(measures))
    sums = ", ".join(f"{c} DOUBLE" for c in sum_columns(measures))
    return f"{head}, {means}, {counts}, {sums}"
