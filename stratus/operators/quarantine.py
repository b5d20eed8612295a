"""Checks in the pass that writes: broken rows go to quarantine, counts come from the same scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: The folder column: true for rows that break no check.
SOUND = "_sound"


@dataclass
class Written:
    """What a checked write leaves: sound rows, quarantined rows with ``_broken``, and counts by check."""

    good: DataFrame
    quarantined: DataFrame
    counts: dict[str, int]


def checked_write(df: DataFrame, path: str, broken: dict[str, Column], mode: str = "overwrite") -> Written:
    """Writes ``df`` below ``path``, rows that break a check (a true condition; NULL passes) into a folder of their own.

    Their ``_broken`` names the checks in the order given. The counts (``rows``, ``quarantined`` and one per
    check) are observed while the rows are written, so the source is scanned once.
    """
    flags = {name: F.coalesce(c, F.lit(False)) for name, c in broken.items()}
    names = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in flags.items())), lambda n: n.isNotNull())
    marked = df.withColumn("_broken", names)
    seen = Observation()
    marked = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_broken") > 0).alias("quarantined"),
                            *(F.count_if(F.array_contains("_broken", n)).alias(n) for n in flags))
    marked.withColumn(SOUND, F.size("_broken") == 0).write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(SOUND).parquet(path)
    schema = marked.schema.add(SOUND, "boolean")
    back = df.sparkSession.read.schema(schema).parquet(path)
    return Written(back.where(F.col(SOUND)).drop(SOUND, "_broken"), back.where(~F.col(SOUND)).drop(SOUND), dict(seen.get))
