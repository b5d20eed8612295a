"""Labelled documents for the classifiers: folds by id, and a bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import saved


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text modulo ``modulus``. A null id is."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, text and ``label`` (0 or 1) of the labelled documents to learn from, about ``rows`` at most, saved.

    The ids are drawn by a hash and broadcast, being few by their bound. An id counts as positive if one of
    its labels is, and gives one text however many rows it has: of several the one with the smallest hash,
    found by a combined aggregate, so that an id of very many rows leaves one row per task.
    """
    known = (labels.where(F.col(label).isNotNull() & ~held_out(id_col, modulus, remainder))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_label")))
    n = known.count()
    part = F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, rows / max(1, n)))
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    found = texts.join(F.broadcast(known.where(part)), F.col("_doc") == F.col("_id"))
    one = found.groupBy("_id", "_label").agg(F.min(F.struct(F.xxhash64("_text"), "_text")).alias("_best"))
    return saved(one.select(F.col("_id").alias(id_col), F.col("_best._text").alias(text_col), F.col("_label").alias(label)), "sample")
