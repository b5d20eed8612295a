"""Place configuration (the YAML list of cities) as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CITY_CONFIG_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
    T.StructField("tz", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("country_iso2", T.StringType(), True),
    T.StructField("country_iso3", T.StringType(), True),
    T.StructField("continent", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("is_capital", T.BooleanType(), True),
    T.StructField("climate_zone", T.StringType(), True),
    T.StructField("active", T.BooleanType(), True),
    T.StructField("pos", T.IntegerType(), False),
])


def load_cities(spark: SparkSession, source) -> DataFrame:
    """Config records (path to YAML with a ``cities`` list, or a list of dicts) → DataFrame.

    ``pos`` keeps the list position, which decides "first record wins" downstream.
    The config is a small, bounded file; it is parsed once and shipped as rows.
    """
    if isinstance(source, str):
        import yaml
        with open(source, encoding="utf-8") as f:
            records = yaml.safe_load(f)["cities"]
    else:
        records = list(source)
    names = [f.name for f in CITY_CONFIG_SCHEMA.fields if f.name != "pos"]
    rows = []
    for i, r in enumerate(records):
        row = [r.get(n) for n in names]
        # quoted ISO codes such as "NO" must stay text
        for j, n in enumerate(names):
            if n in ("country_iso2", "country_iso3") and row[j] is not None and not isinstance(row[j], str):
                row[j] = str(row[j])
        rows.append((*row, i))
    return spark.createDataFrame(rows, CITY_CONFIG_SCHEMA)


def active_cities(cities: DataFrame, col: str = "active") -> DataFrame:
    """Rows whose ``active`` flag is true; a missing flag means inactive."""
    return cities.where(F.coalesce(F.col(col), F.lit(False)))
