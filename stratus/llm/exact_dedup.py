"""Exact deduplication with a heavy-hitter split.

Rows are equal when their texts are identical after deleting white space. A Misra-Gries
summary of the digests of every input partition finds the digests that may hold a large
share of the rows; their true counts and winners are verified over all rows and
broadcast, so copies of a heavy text are settled on the map side. All other digests, each
at most ``1 / HEAVY`` of the rows, go through an ordinary shuffle.

Defined results: a null text counts as empty; all empty texts are one group. A null id
loses every tie. Among rows equal in text length and id one stays, whichever. An empty
table gives an empty result. Columns whose names begin with ``_x9_`` are reserved.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import SPACE_CHARS, saved, whole_text

#: A digest is heavy when it holds more than 1 / HEAVY of all rows: at most HEAVY digests.
HEAVY = 512


def misra_gries(digests: Iterator[bytes], counters: int) -> dict[bytes, int]:
    """Misra-Gries summary: each count is at most ``n / (counters + 1)`` below the truth."""
    kept: dict[bytes, int] = {}
    for d in digests:
        if d in kept:
            kept[d] += 1
        elif len(kept) < counters:
            kept[d] = 1
        else:
            kept = {k: v - 1 for k, v in kept.items() if v > 1}
    return kept


def heavy_candidates(digests: DataFrame, n_rows: int, heavy: int = HEAVY) -> DataFrame:
    """Digests that may hold more than ``1 / heavy`` of the rows.

    With ``2 * heavy`` counters a partition's summary misses at most
    ``n / (2 * heavy)`` of a digest's rows, so summed lower bounds of a heavy digest pass
    ``n_rows / (2 * heavy)``; and no more than ``2 * heavy`` digests can pass it.
    """
    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = misra_gries((d for b in batches for d in b.column(0).to_pylist()), 2 * heavy)
        yield pa.record_batch([pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())],
                              names=["digest", "low"])

    return (digests.select("digest").mapInArrow(summary, "digest binary, low long")
            .groupBy("digest").agg(F.sum("low").alias("low"))
            .where(F.col("low") > n_rows / (2 * heavy)).select("digest"))


def _winner():
    """Most code points, then smallest id (null last), then any one row."""
    return F.max(F.struct("n_chars", (F.col("id").isNotNull()).alias("has_id"), F.bitwise_not("id").alias("not_id"),
                          "row")).alias("win")


def _digest(text: Column) -> Column:
    # never null, and declared so: a filter on nulls would work it out once more
    return F.coalesce(F.unhex(F.sha2(F.translate(text, SPACE_CHARS, "").cast("binary"), 256)), F.lit(b""))


def _split(docs: DataFrame, id_col: str, text_col: str, heavy: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' keys, the verified groups of heavy digests, and the keys of all other rows."""
    text = whole_text(text_col)
    keys = saved(docs.select(
        F.col(id_col).cast("long").alias("id"),
        _digest(text).alias("digest"),
        F.length(text).alias("n_chars"),
        F.monotonically_increasing_id().alias("row")), "digests")

    candidates = heavy_candidates(keys, keys.count(), heavy)
    # At most 2 * HEAVY verified rows of some 70 bytes: the bound of the broadcast.
    winners = saved(_groups(keys.join(F.broadcast(candidates), "digest")), "heavy")
    return keys, winners, keys.join(F.broadcast(winners.select("digest")), "digest", "left_anti")


def _groups(keys: DataFrame) -> DataFrame:
    return keys.groupBy("digest").agg(F.count("*").alias("size"), _winner())


def mark_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          heavy: int = HEAVY) -> DataFrame:
    """One row per input row: id, ``digest``, ``n_chars``, ``keep_id``, ``group_size``, ``kept``."""
    keys, winners, cold = _split(docs, id_col, text_col, heavy)
    hot = keys.join(F.broadcast(winners), "digest", "left").where(F.col("size").isNotNull())
    shuffled = cold.join(_groups(cold), "digest")
    return (hot.select(*shuffled.columns).unionByName(shuffled).select(
        F.col("id").alias(id_col), "digest", "n_chars",
        F.bitwise_not("win.not_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("win.row")).alias("kept")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          heavy: int = HEAVY) -> DataFrame:
    """The rows that stay, with the columns of ``docs``; order aside, every other row is gone.

    Copies of heavy digests go on the map side, so of those only rows equal to a winner meet, combined
    before they move. Every other text moves once: the join with the rows that stay and the choice among
    repeated rows of one id share their keys.
    """
    _, winners, cold = _split(docs, id_col, text_col, heavy)
    text, own = whole_text(text_col), F.col(id_col).cast("long")
    keyed = docs.withColumns({"_x9_digest": _digest(text), "_x9_chars": F.length(text), "_x9_has_id": own.isNotNull(),
                              "_x9_id": F.coalesce(own, F.lit(0))})
    key = ["_x9_digest", "_x9_chars", "_x9_has_id", "_x9_id"]  # without nulls, so that the joins are plain ones

    def stays(groups: DataFrame) -> DataFrame:
        return groups.select(F.col("digest").alias(key[0]), F.col("win.n_chars").alias(key[1]), F.col("win.has_id").alias(key[2]),
                             F.coalesce(F.bitwise_not("win.not_id"), F.lit(0)).alias(key[3]))

    hot = keyed.join(F.broadcast(stays(winners)), key, "left_semi").dropDuplicates(key[:1])
    rest = (keyed.join(F.broadcast(winners.select(F.col("digest").alias(key[0]))), key[0], "left_anti")
            .join(stays(_groups(cold)), key, "left_semi").dropDuplicates(key))  # repeated rows of one id
    return hot.unionByName(rest).select(*docs.columns)
