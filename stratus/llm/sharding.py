"""Sharding by vector bin packing.

Documents go into ``n_shards`` shards that balance bytes, tokens and rows jointly. Documents
of equal texts are a *group* and stay together; every group is a vector of three loads, each
measured in shares (the whole table's load over the number of shards). Items are placed in
falling order of their largest load, each where the dot product with the residual capacity is
highest among the shards that have room for it; if none has room in all loads, the shard with most room
for bytes takes it, as the law is about bytes.

The number of items that the driver places has a bound that the data do not move:

* a group with more than ``1 / PARTS`` of a share in any load is an item of its own
  (at most ``3 * PARTS * n_shards``); one with more than a whole share is cut, by the rank
  of its rows, into as many equal pieces as it holds shares, rounded up;
* smaller groups travel in bundles, by size class and hash, each of about ``1 / PARTS`` of a
  share. Size classes give bundles that are heavy in bytes or in rows, so that they
  level both.

Ranks within items and slots within shards come from windows over hash cells, whose sizes are
summed up first: an item with many rows is spread over many tasks, ``CELLS`` for each share.

Law ``bytes``: the sizes (UTF-8 bytes of the text and ``overhead``) of shards are near equal, as
far as single documents and whole groups below a share allow. Tokens are words parted by white space
unless ``tokens`` gives a column.

Defined results: a null text has no bytes and equals an empty one; a null id is an id like
others; repeated rows are rows of their own, in any order among themselves; an empty table
gives an empty result. Extra columns pass, those named like a result column are replaced;
names that begin with ``_x13_`` are reserved.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import saved, whole_text
from stratus.llm.mixing import word_count

#: Groups above 1 / PARTS of a share are placed on their own, bundles are about as large.
PARTS = 200
#: Cells of an item for each share of rows that it holds.
CELLS = 64
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def place(loads: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of every item; ``loads`` holds a row of loads, in shares, for each item, bytes first."""
    shards = np.zeros(len(loads), np.int64)
    room = np.ones((n_shards, loads.shape[1]))
    for i in np.argsort(-loads.max(axis=1, initial=0), kind="stable"):
        product = room @ loads[i]
        fits = (room >= loads[i]).all(axis=1)
        shards[i] = np.argmax(np.where(fits, product, -np.inf) if fits.any() else room[:, 0])
        room[shards[i]] -= loads[i]
    return shards


def pieces_of(loads: np.ndarray) -> np.ndarray:
    """The number of pieces of each group: its shares, rounded up."""
    return np.maximum(1, np.ceil(loads.max(axis=1, initial=0) - 1e-9)).astype(np.int64)


def _keyed(docs: DataFrame, id_col: str, text_col: str, tokens: Column | None, overhead: int) -> DataFrame:
    text = whole_text(text_col)
    return docs.withColumns({
        "_x13_id": F.col(id_col), "_x13_size": F.octet_length(text).cast("long") + F.lit(overhead),
        "_x13_tokens": word_count(text) if tokens is None else F.coalesce(tokens.cast("long"), F.lit(0)),
        "_x13_digest": F.unhex(F.md5(text.cast("binary"))), "_x13_crc": F.crc32(text.cast("binary"))})


def _groups(keyed: DataFrame) -> DataFrame:
    """One row per group: its digest, size class and loads."""
    return (keyed.groupBy("_x13_digest").agg(F.count("*").alias("rows"), F.sum("_x13_size").alias("bytes"),
                                             F.sum("_x13_tokens").alias("tokens"), F.max("_x13_size").alias("_x13_size"))
            .withColumn("class", _size_class()).drop("_x13_size"))


def _size_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col("_x13_size"), F.lit(1)))).cast("int")


_LOADS = ("bytes", "tokens", "rows")


def assign_shards(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                  tokens: Column | None = None, overhead: int = 16, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) and ``size, text_crc32, law, shard, slot, grown_shard``.

    Slots of a shard run from 0 without gaps. ``grown_shard`` is null: the law is ``bytes``.
    """
    spark = docs.sparkSession
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULT]
    keyed = _keyed(docs, id_col, text_col, tokens, overhead)
    groups = saved(_groups(keyed), "groups")
    classes = groups.groupBy("class").agg(*(F.sum(c).alias(c) for c in _LOADS)).orderBy("class").collect()  # at most 64
    total = {c: sum(r[c] for r in classes) for c in _LOADS}
    share = {c: max(total[c], 1) / n_shards for c in _LOADS}

    is_big = F.lit(False)
    for c in _LOADS:
        is_big = is_big | (F.col(c) * PARTS > share[c])
    widths = [(r["class"], max(1, math.ceil(PARTS * max(r[c] / share[c] for c in _LOADS)))) for r in classes]
    width = spark.createDataFrame(widths, "class int, width long")  # at most 64 rows
    bucket = F.pmod(F.xxhash64("_x13_digest"), F.col("width"))
    # at most 3 * PARTS * n_shards groups and, bundles, as many and 64 more
    big = groups.where(is_big).select("_x13_digest", *_LOADS).orderBy("_x13_digest").collect()
    bundles = (groups.where(~is_big).join(F.broadcast(width), "class").withColumn("bucket", bucket)
               .groupBy("class", "bucket").agg(*(F.sum(c).alias(c) for c in _LOADS)).orderBy("class", "bucket").collect())

    loads = np.array([[r[c] / share[c] for c in _LOADS] for r in [*big, *bundles]], float).reshape(-1, len(_LOADS))
    rows = [r["rows"] for r in [*big, *bundles]]
    pieces = pieces_of(loads)
    pieces[len(big):] = 1
    owner = np.repeat(np.arange(len(loads)), pieces)
    shards = place(loads[owner] / pieces[owner, None], n_shards)

    cells = [int(min(n, max(1, math.ceil(CELLS * n / share["rows"])))) for n in rows]
    own = spark.createDataFrame([(bytes(r["_x13_digest"]), i, cells[i]) for i, r in enumerate(big)],
                                "_x13_digest binary, _x13_big long, _x13_big_cells long")
    bundled = spark.createDataFrame([(r["class"], r["bucket"], len(big) + i, cells[len(big) + i])
                                     for i, r in enumerate(bundles)],
                                    "class int, bucket long, _x13_bundle long, _x13_bundle_cells long")
    bundled = bundled.join(F.broadcast(width), "class").select(
        F.col("class").alias("_x13_class"), F.col("bucket").alias("_x13_bucket"), "_x13_bundle", "_x13_bundle_cells")
    starts, filled, first, was = [], [0] * n_shards, 0, -1
    for i, shard in zip(owner.tolist(), shards.tolist()):
        first = 0 if i != was else first + 1
        was, n, p = i, rows[i], int(pieces[i])
        low, high = -(-first * n // p), -(-(first + 1) * n // p)
        starts.append((i, first, shard, filled[shard] - low, n, p))
        filled[shard] += high - low
    placed = spark.createDataFrame(starts, "_x13_item long, _x13_piece long, _x13_shard int, _x13_start long, "
                                           "_x13_n long, _x13_pieces long")

    width = width.select(F.col("class").alias("_x13_class"), F.col("width").alias("_x13_width"))
    item = (keyed.select(*(F.col(c) for c in keep), "_x13_id", "_x13_size", "_x13_crc", "_x13_digest")
            .withColumn("_x13_class", _size_class())
            .join(F.broadcast(own), "_x13_digest", "left").join(F.broadcast(width), "_x13_class", "left")
            .withColumn("_x13_bucket", F.when(F.col("_x13_big").isNull(), F.pmod(F.xxhash64("_x13_digest"), F.col("_x13_width"))))
            .join(F.broadcast(bundled), ["_x13_class", "_x13_bucket"], "left")
            .withColumn("_x13_item", F.coalesce("_x13_big", "_x13_bundle"))
            .withColumn("_x13_cell", F.pmod(F.xxhash64("_x13_id", "_x13_digest"), F.coalesce("_x13_big_cells", "_x13_bundle_cells")))
            .drop("_x13_class", "_x13_bucket", "_x13_width", "_x13_big", "_x13_bundle", "_x13_big_cells", "_x13_bundle_cells"))

    before = Window.partitionBy("_x13_item").orderBy("_x13_cell").rowsBetween(Window.unboundedPreceding, -1)
    # bounded like the items: a row for each of them and CELLS for each shard
    offsets = saved(item.groupBy("_x13_item", "_x13_cell").agg(F.count("*").alias("_x13_held"))
                    .withColumn("_x13_before", F.coalesce(F.sum("_x13_held").over(before), F.lit(0))).drop("_x13_held"), "cells")
    in_cell = Window.partitionBy("_x13_item", "_x13_cell").orderBy("_x13_id", "_x13_digest")
    first_piece = placed.where("_x13_piece = 0").select("_x13_item", "_x13_n", "_x13_pieces")
    return (item.withColumn("_x13_rank", F.row_number().over(in_cell).cast("long") - 1)
            .join(F.broadcast(offsets), ["_x13_item", "_x13_cell"])
            .withColumn("_x13_rank", F.col("_x13_rank") + F.col("_x13_before"))
            .join(F.broadcast(first_piece), "_x13_item")
            .withColumn("_x13_piece", F.expr("(_x13_rank * _x13_pieces) div _x13_n"))
            .join(F.broadcast(placed.drop("_x13_n", "_x13_pieces")), ["_x13_item", "_x13_piece"])
            .select(*keep, F.col("_x13_size").alias("size"), F.col("_x13_crc").cast("long").alias("text_crc32"),
                    F.lit("bytes").alias("law"), F.col("_x13_shard").alias("shard"),
                    (F.col("_x13_start") + F.col("_x13_rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, **options) -> None:
    """The documents as Parquet files below ``path``, a folder ``shard=k`` each, in slot order within a file.

    Each shard is written by several tasks, cut by slot, so that no task holds a whole shard.
    """
    placed = assign_shards(docs, n_shards, **options)
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
