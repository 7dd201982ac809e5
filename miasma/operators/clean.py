"""From raw text records to typed observations, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from miasma.functions.numeric import number
from miasma.schema import COUNTED_MEASURES, DAMAGED, FLAGS, NUMERIC_MEASURES, RAW_COLUMNS, SENTINELS

DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select([F.trim(f.name).alias(f.name) if isinstance(f.dataType, StringType) else f.name
                      for f in df.schema.fields])


def parse_date(text: Column) -> Column:
    """Timestamp of a ``yyyy-MM-dd`` text, null for anything else.

    The cast is cheaper than a formatter and, unlike it, raises nothing inside on bad text;
    the pattern keeps out the other spellings a cast would take.
    """
    day = F.trim(text)
    return F.when(day.rlike(DATE_PATTERN), day.try_cast("date").cast("timestamp"))


def trim_cast(df: DataFrame, measures=NUMERIC_MEASURES) -> DataFrame:
    """Trim all text and turn measures into doubles and ``DATE`` into a timestamp.

    What does not parse becomes null, so that one bad line cannot stop a job. Columns that
    are not text stay as they are.
    """
    def typed(name: str, dtype: str) -> Column:
        if dtype != "string":
            return F.col(name)
        if name in measures:
            return number(F.col(name)).alias(name)
        if name == "DATE":
            return parse_date(F.col(name)).alias(name)
        return F.trim(name).alias(name)

    return df.select([typed(c, t) for c, t in df.dtypes])


def drop_headers(df: DataFrame) -> DataFrame:
    """Remove header lines that travelled along with the records."""
    return df.filter(F.trim("STATION") != "STATION")


def require_keys(df: DataFrame) -> DataFrame:
    return df.filter(F.col("DATE").isNotNull() & F.col("STATION").isNotNull())


def clean_records(raw: DataFrame) -> DataFrame:
    """Raw text records to typed observations; what ``reject_reason`` names is left out."""
    return require_keys(trim_cast(raw.filter(rejection(raw).isNull()).drop(DAMAGED)))


def drop_null_rows(df: DataFrame, subset=None) -> DataFrame:
    return df.dropna("any", subset=subset)


def sentinel_to_null(df: DataFrame) -> DataFrame:
    """Null instead of a missing-value marker, or where no reading was taken.

    Works on typed measures; the reading counts may still be text.
    """
    def cleaned(measure: str) -> Column:
        missing = F.col(measure) == F.lit(SENTINELS[measure])
        attr = f"{measure}_ATTRIBUTES"
        if measure in COUNTED_MEASURES and attr in df.columns:
            readings = F.trim(F.col(attr).cast("string")).try_cast("int")
            missing = missing | (F.coalesce(readings, F.lit(1)) == 0)
        return F.when(~missing, F.col(measure))

    return df.withColumns({m: cleaned(m) for m in SENTINELS if m in df.columns})


def decode_flags(df: DataFrame, code: str = "FRSHTT") -> DataFrame:
    """Six 0/1 columns out of the flag code."""
    digit = {f"flag_{name}": F.substring(code, i, 1).try_cast("int")
             for i, name in enumerate(FLAGS, start=1)}
    return df.withColumns(digit)


def dedupe_observations(df: DataFrame, keys=("STATION", "DATE")) -> DataFrame:
    """One row per station and day: of differing copies each measure's smallest reading.

    A missing value never beats a reading. One minimum per column, so that numbers stay in the
    hash aggregate; the flag code is compared as the number it spells. The choice does not depend
    on row order. On a stream a watermark on ``DATE`` bounds the state; a station's day comes out
    once the watermark has passed it.
    """
    types = dict(df.dtypes)

    def least(c: str) -> Column:
        if c == "FRSHTT" and types[c] == "string":
            return F.lpad(F.min(F.col(c).try_cast("int")).cast("string"), len(FLAGS), "0").alias(c)
        return F.min(c).alias(c)

    kept = df.groupBy(*keys).agg(*[least(c) for c in df.columns if c not in keys])
    return kept.select(df.columns)


def rejection(df: DataFrame, damaged_fields: Column | None = None) -> Column:
    """Why a raw record cannot be used, null for a good one.

    Readers tell by ``damaged_line`` which lines have another number of fields than a record: those
    are short, or long. A record with empty fields is whole. Where the column is missing, records
    come from a table and were whole. ``damaged_fields`` is the number of fields of ``damaged_line``, for
    callers that have counted them.
    """
    types = dict(df.dtypes)

    def text(name: str) -> Column:
        return F.trim(F.col(name).cast("string"))

    station, date = text("STATION"), F.col("DATE")
    bad_date = parse_date(date).isNull() if types["DATE"] == "string" else F.lit(False)
    damaged = F.col(DAMAGED).isNotNull() if DAMAGED in types else F.lit(False)
    if DAMAGED in types and damaged_fields is None:
        damaged_fields = field_count(F.col(DAMAGED))
    cut = damaged & (damaged_fields < len(RAW_COLUMNS)) if DAMAGED in types else damaged
    return (F.when(station == "STATION", "header")
            .when(F.col("STATION").isNull() | (station == ""), "no station")
            .when(cut, "short line")
            .when(damaged, "long line")
            .when(date.isNull() | (text("DATE") == ""), "no date")
            .when(bad_date, "bad date"))


def field_count(line: Column) -> Column:
    """Fields of a CSV line; a comma between quotes is part of a field.

    What stands between quotes can be read in one way only, so the pattern never goes back.
    """
    bare = F.regexp_replace(line, r'"(?:[^"\\]++|\\.)*+"', F.lit(""))
    return F.array_size(F.split(bare, ","))


def quarantine(lines: DataFrame, text: str = "line") -> DataFrame:
    """The unusable records of ``decode_payload(…, keep_text=True)``: reason, number of fields, text.

    Fields are counted once per line and reasons told once: ``inline`` keeps Catalyst from repeating an
    expression wherever its column is mentioned.
    """
    def once(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.select(*kept, F.inline(F.array(F.struct(value.alias(name)))))

    kept = [c for c in ("STATION", "DATE", DAMAGED, text) if c in lines.columns]
    counted = once(lines, "fields", field_count(F.col(text)))
    kept.append("fields")
    if DAMAGED in kept:  # the text of the whole line, unless that has line breaks
        same = F.col(DAMAGED) == F.col(text)
        reason = rejection(lines, F.when(same, F.col("fields")).otherwise(field_count(F.col(DAMAGED))))
    else:
        reason = rejection(lines)
    told = once(counted, "reason", reason).filter(F.col("reason").isNotNull())
    return told.select("reason", "fields", F.col(text).alias("text"))


def reject_reason(df: DataFrame) -> DataFrame:
    """Add ``reason``: why a raw record cannot be used, null for a good one."""
    return df.withColumn("reason", rejection(df))


def reject_report(df: DataFrame) -> DataFrame:
    """Number of unusable records per reason."""
    return (reject_reason(df).filter(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count("*").alias("records")))


def fill_defaults(df: DataFrame, columns=None, value: float = 0) -> DataFrame:
    """Nulls to ``value`` in the named columns, or in all numeric ones."""
    return df.fillna({c: value for c in columns}) if columns else df.fillna(value)


def cast_columns(df: DataFrame, columns, dtype: str = "double") -> DataFrame:
    return df.select([F.col(c).cast(dtype).alias(c) if c in columns else F.col(c)
                      for c in df.columns])


def region_filter(df: DataFrame, region: str, column: str = "city") -> DataFrame:
    return df.filter(F.col(column) == region)
