"""Helpers shared by the operators: tables, scratch tables in the shared folder, word rules."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import stratus
from stratus.session import scratch_path

# Functions travel to the Python workers with their code, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(stratus)

#: Whether Spark deletes shuffle files at the end of a query. Else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The white space of the contracts: the space and the control characters 09 to 0D.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read again.

    Cuts the lineage like ``checkpoint()`` (a lost executor costs no recomputation), but
    in compressed columns, so that later steps read only what they select. ``options`` are the writer's.
    The shuffle files go as soon as the table is written, so that the disk holds those of one step.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``saved`` that nothing reads any more."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(conf).delete(path, True)


def whole_text(col: str | Column) -> Column:
    """The text, null as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def text_or_blank(value) -> bytes:
    """A text value inside a Python task as UTF-8, null as empty."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass")
