"""Open payloads: landed documents kept whole as ``VARIANT``, variables read by their path.

The typed landing (``sources.payload``) reads the variables it knows. Here a document is parsed once into binary
variant values, so that variables nobody has declared yet are kept, listed, and read later with a type of choice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.dates import parse_local_ts

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def land_variant(df: DataFrame, doc_col: str = "doc") -> DataFrame:
    """The JSON texts of ``doc_col`` as ``payload``; ``error`` tells why a document is no use, else NULL."""
    landed = df.withColumn("payload", F.try_parse_json(doc_col))
    name = F.trim(F.try_variant_get("payload", "$.name", "string"))
    return landed.withColumn("error", F.when(F.col("payload").isNull(), "unreadable document")
                             .when(F.coalesce(name, F.lit("")) == "", "no place name")
                             .when(F.try_variant_get("payload", "$.hourly.time", "array<string>").isNull(), "no hourly data"))


def open_variables(landed: DataFrame, known) -> DataFrame:
    """``variable, n_documents``: the hourly variables of sound documents that are not in ``known``."""
    spark = landed.sparkSession
    hourly = landed.where("error IS NULL").select(F.try_variant_get("payload", "$.hourly", "variant").alias("hourly"))
    keys = hourly.lateralJoin(spark.tvf.variant_explode(F.col("hourly").outer())).select(F.col("key").alias("variable"))
    return (keys.where(~F.col("variable").isin("time", *known)).groupBy("variable").agg(F.count(F.lit(1)).alias("n_documents")))


def read_variables(landed: DataFrame, variables: dict[str, str]) -> DataFrame:
    """``location_name, measured_at`` and the named hourly variables (name → type) of sound documents.

    A variable that a document lacks, an array too short and a value that does not fit its type give NULL.
    """
    for v in variables:
        if not _NAME.fullmatch(v):
            raise ValueError(f"not a variable name: {v!r}")
    sound = landed.where("error IS NULL")
    arrays = sound.select(F.try_variant_get("payload", "$.name", "string").alias("location_name"),
                          F.try_variant_get("payload", "$.hourly.time", "array<string>").alias("_times"),
                          *(F.try_variant_get("payload", f"$.hourly.{v}", "array<variant>").alias(f"_a_{v}") for v in variables))
    hours = arrays.select("*", F.posexplode("_times").alias("_k", "_time"))
    # every element is typed by itself: one that does not fit leaves its neighbours alone
    return hours.select("location_name", parse_local_ts(F.col("_time")).alias("measured_at"),
                        *(F.try_variant_get(F.get(f"_a_{v}", "_k"), "$", t).alias(v) for v, t in variables.items()))
