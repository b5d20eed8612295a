"""Landed API payloads: one JSON document per (place, period) holding parallel arrays.

``explode_payload`` turns the struct of arrays into one typed row per hour entirely on
the JVM side (``arrays_zip`` + ``inline``), one document per task row, so a payload
never passes through Python or the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.constants import HOURLY_VARS, NON_DOUBLE_VARS
from stratus.functions.dates import parse_local_ts


def hourly_struct(names=HOURLY_VARS) -> T.StructType:
    """``hourly`` struct: ``time`` plus one array per variable.

    ``weather_code`` and ``is_day`` are read as text so that bad values become NULL
    during typing instead of failing the whole document.
    """
    fields = [T.StructField("time", T.ArrayType(T.StringType()), True)]
    for n in names:
        et = T.StringType() if n in NON_DOUBLE_VARS else T.DoubleType()
        fields.append(T.StructField(n, T.ArrayType(et), True))
    return T.StructType(fields)


def payload_schema(names=HOURLY_VARS) -> T.StructType:
    """Schema of a landed document (explicit: no inference, only requested columns read)."""
    return T.StructType([
        T.StructField("name", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("elevation", T.DoubleType(), True),
        T.StructField("timezone", T.StringType(), True),
        T.StructField("hourly", hourly_struct(names), True),
    ])


def read_landed(spark: SparkSession, path: str, names=HOURLY_VARS) -> DataFrame:
    """Scan landed JSON documents (one per line) with the explicit payload schema.

    Unreadable lines arrive with their text in ``_corrupt``; ``_landed`` orders documents by
    landing time, then file name, then place in the file.
    """
    schema = payload_schema(names).add("_corrupt", T.StringType())
    docs = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return docs.withColumn("_landed", F.struct(F.col("_metadata.file_modification_time").alias("at"),
                                               F.col("_metadata.file_path").alias("file"),
                                               F.monotonically_increasing_id().alias("line")))


def _lengths(arrays_col: str, names) -> list[Column]:
    """Lengths of ``time`` and of every variable array the document carries (absent → NULL)."""
    h = F.col(arrays_col)
    return [F.coalesce(F.size(h["time"]), F.lit(0))] + [F.when(h[n].isNotNull(), F.size(h[n])) for n in names]


def is_rectangular(arrays_col: str = "hourly", names=HOURLY_VARS) -> Column:
    """Every array the document carries has the length of ``time`` (absent variables are
    allowed and become NULL columns; ``greatest``/``least`` skip them)."""
    ls = _lengths(arrays_col, names)
    return F.greatest(*ls) == F.least(*ls) if len(ls) > 1 else F.lit(True)


def payload_error(df: DataFrame, arrays_col: str = "hourly", names=HOURLY_VARS) -> Column:
    """Why a document cannot be exploded, or NULL."""
    h = F.col(arrays_col)
    out = (F.when(F.coalesce(F.trim("name"), F.lit("")) == "", "no place name")
            .when(h.isNull() | h["time"].isNull(), "no hourly data")
            .when(~is_rectangular(arrays_col, names), "arrays of unequal length")
            .when(F.exists(h["time"], lambda t: parse_local_ts(t).isNull()), "unreadable time"))
    return F.when(F.col("_corrupt").isNotNull(), "unreadable document").otherwise(out) if "_corrupt" in df.columns else out


def coerce_types(df: DataFrame, types: dict) -> DataFrame:
    """Lenient typing: values that do not fit become NULL.

    Integer types take integral numbers in any form (``3.0``); booleans take numbers and
    the words true and false.
    """
    out = df
    for c, t in types.items():
        number = F.col(c).try_cast("double")
        if t == "boolean":
            word = F.lower(F.trim(F.col(c).cast("string")))
            out = out.withColumn(c, F.when(word == "true", True).when(word == "false", False).otherwise(number != 0))
        elif t in ("smallint", "int"):
            out = out.withColumn(c, F.when(number == F.rint(number), _bounded(number, t)))
        else:
            out = out.withColumn(c, F.col(c).try_cast(t))
    return out


def _bounded(number: Column, t: str) -> Column:
    """A double as a smaller integer type, NULL outside its range (a plain cast would raise)."""
    top = {"smallint": 2 ** 15, "int": 2 ** 31}[t]
    return F.when(number.between(-top, top - 1), number).cast(t)


def explode_payload(df: DataFrame, arrays_col: str = "hourly", names=HOURLY_VARS,
                    now=None) -> DataFrame:
    """Landed documents → stage rows (``location_name … measured_at, <vars>, loaded_at``).

    Only sound documents are exploded; :func:`invalid_payloads` returns the rest with the
    reason. A variable the document does not carry is NULL in every row. An hour that a document
    gives twice gives two rows, as on the day on which clocks go back. A ``_landed``
    column (the documents' landing order) is passed on.
    """
    h = F.col(arrays_col)
    n_hours = F.size(h["time"])
    elem = {f.name: f.dataType.elementType for f in df.schema[arrays_col].dataType.fields}

    def arr(n):  # a variable missing from the document becomes an array of NULLs
        return F.coalesce(h[n], F.array_repeat(F.lit(None).cast(elem[n]), n_hours)).alias(n)

    zipped = F.arrays_zip(h["time"].alias("time"), *[arr(n) for n in names])
    landed = [c for c in ("_landed",) if c in df.columns]
    rows = (df.where(payload_error(df, arrays_col, names).isNull())
              .select(*landed, F.col("name").alias("location_name"), "country",
                      F.col("latitude").cast("double").alias("latitude"),
                      F.col("longitude").cast("double").alias("longitude"),
                      F.col("elevation").cast("double").alias("elevation_m"),
                      "timezone", F.inline(zipped)))
    types = {}
    if "weather_code" in names:
        types["weather_code"] = "smallint"
    if "is_day" in names:
        types["is_day"] = "boolean"
    rows = coerce_types(rows, types)
    loaded = F.lit(None).cast("timestamp_ntz") if now is None else F.lit(now).cast("timestamp_ntz")
    return rows.select("location_name", "country", "latitude", "longitude", "elevation_m", "timezone",
                       parse_local_ts(F.col("time")).alias("measured_at"),
                       *names, loaded.alias("loaded_at"), *landed)


def invalid_payloads(df: DataFrame, arrays_col: str = "hourly", names=HOURLY_VARS) -> DataFrame:
    """Documents that cannot be exploded, with the reason in ``error``."""
    return df.withColumn("error", payload_error(df, arrays_col, names)).where(F.col("error").isNotNull())
