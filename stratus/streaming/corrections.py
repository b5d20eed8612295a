"""Corrections across micro-batches: the newest version of a (place, day) slice wins, in whatever order it lands.

``replace_batch`` alone knows the documents of one batch, so an old document that lands late would overwrite a
newer one. Here the newest version of every slice is kept in the stream's state store: rows of an older
version are dropped, those of the same or a newer version replace the slice. The state holds, by place and
month, one number per day, and is checkpointed with the stream, so a restarted run goes on with it. A month
is the group, not a day, as every group costs a call of Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from stratus.operators.forecast import _pickle_by_value
from stratus.streaming.ingest import TS_FORMAT, replace_batch

#: Sets of places by hash. Part of the state's key: a running stream keeps its number.
BUCKETS = 512


def newest_versions(rows: DataFrame, version: str, loc: str = "location_name", ts: str = "measured_at") -> DataFrame:
    """The rows of each (place, day) whose version is the newest seen so far. A streaming transformation.

    A NULL version is older than any other. Of the rows of one batch only the newest version goes on.
    """
    schema = rows.schema
    never = -(1 << 62)

    def keep(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        places, held = state.get if state.exists else ([], b"")
        found = pd.concat(list(frames))                     # one bucket's month
        at = {p: i for i, p in enumerate(places)}
        codes, names = pd.factorize(found[loc])             # -1: no place, the last of the rows
        row = np.array([at.setdefault(p, len(at)) for p in [*names, *([None] if (codes < 0).any() else [])]])[codes]
        newest = np.full(31 * len(at), never - 1, "int64")
        newest[:31 * len(places)] = np.frombuffer(held, "int64")
        slot = row * 31 + found[ts].dt.day.to_numpy() - 1
        versions = found[version].fillna(never).to_numpy("int64")
        np.maximum.at(newest, slot, versions)
        state.update((list(at), newest.tobytes()))
        yield found[versions == newest[slot]][[f.name for f in schema.fields]]

    _pickle_by_value()
    held = f"places array<{schema[loc].dataType.simpleString()}>, versions binary"
    return (rows.where(F.col(ts).isNotNull()).withColumn("_month", F.date_trunc("month", ts))
            .withColumn("_bucket", F.pmod(F.hash(loc), F.lit(BUCKETS))).groupBy("_bucket", "_month")
            .applyInPandasWithState(keep, schema, held, "append", GroupStateTimeout.NoTimeout))


def ingest_corrections(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, transform,
                       version: str = "version", fmt: str = "json", max_files: int | None = None) -> int:
    """Processes every landed file not yet consumed, in order of landing, then stops; returns the number of micro-batches.

    ``transform`` gives stage rows with a whole number ``version``; the target keeps it.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("timestampNTZFormat", TS_FORMAT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    newest = newest_versions(transform(reader.load(source)), version)
    batches = [0]

    def on_batch(df: DataFrame, batch_id: int) -> None:
        batches[0] += 1
        replace_batch(df.sparkSession, df, target)

    q = (newest.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return batches[0]
