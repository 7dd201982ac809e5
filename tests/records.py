"""Small hand-written station records."""

from miasma.schema import RAW_COLUMNS, RAW_DDL

BASE = dict.fromkeys(RAW_COLUMNS, "") | {
    "STATION": "01001099999", "DATE": "2024-12-03", "LATITUDE": "70.5", "LONGITUDE": "-8.5",
    "ELEVATION": "9.0", "NAME": "ISLAND NAVY, NO", "TEMP": "  32.3", "TEMP_ATTRIBUTES": " 9",
    "DEWP": "  25.6", "DEWP_ATTRIBUTES": " 9", "SLP": "1024.4", "SLP_ATTRIBUTES": " 9",
    "STP": "023.2", "STP_ATTRIBUTES": " 9", "VISIB": "  7.1", "VISIB_ATTRIBUTES": " 4",
    "WDSP": " 17.1", "WDSP_ATTRIBUTES": " 9", "MXSPD": " 23.3", "GUST": " 29.5",
    "MAX": "  34.0", "MAX_ATTRIBUTES": " ", "MIN": "  30.9", "MIN_ATTRIBUTES": " ",
    "PRCP": " 0.01", "PRCP_ATTRIBUTES": "G", "SNDP": "999.9", "FRSHTT": "011000",
}
HEADER = {c: c for c in RAW_COLUMNS}


def record(**changes) -> dict:
    return BASE | changes


def raw(spark, *records):
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in records], RAW_DDL)


def line(r: dict) -> str:
    return ",".join(f'"{r[c]}"' for c in RAW_COLUMNS)


def payload(spark, *lines):
    return spark.createDataFrame([(text.encode(),) for text in lines], "value BINARY")
