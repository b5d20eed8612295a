"""Embedding whitening: a distributed centred covariance, its leading components, a broadcast projection.

An entry ``c`` becomes the integer ``x = floor(SCALE * c) + SHIFT``. One pass sums the x-vectors
exactly, a second one centres every vector and multiplies: each task sums its outer products
into one matrix, and Spark adds the matrices up entry by entry. The driver gets a matrix of
dimension x dimension, whatever the number of vectors, and finds its leading eigenpairs by
Householder tridiagonalisation, bisection by Sturm counts, and inverse iteration with
reorthogonalisation inside clusters (``eigen``). Components and mean are broadcast
(9 vectors), and a third pass projects and scales every vector.

Defined results: vectors that are null, empty, or hold a null or non-finite entry are dropped, and so are entries
beyond ``LIMIT``, which no exact integer arithmetic holds, and vectors whose length is not the most frequent
one (the greatest of equally frequent). Repeated rows and null ids take part as rows of
their own. Components without variance can't be whitened (eigenvalue at rounding error, as for a
single vector or fewer dimensions than components) and are left out. A deviation beyond a long is null.
An empty table gives an empty result. Only the id column passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import saved
from stratus.llm.eigen import leading_pairs

#: An entry c is read as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries of a size beyond this are dropped with their vector.
LIMIT = float(1 << 32)
#: Vectors that are multiplied at once.
ROWS = 4096


def integer_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, x``: the usable vectors as longs, all of one length."""
    usable = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(LIMIT)))
    x = F.transform(vector_col, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + SHIFT)
    kept = embeddings.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & usable)
    # one row per length; nearly always one
    length = kept.groupBy(F.size(vector_col).alias("d")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "d"))).first()[0]
    return kept.where(F.size(vector_col) == F.lit(length["d"] if length else 0)).select(F.col(id_col).alias("id"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and their sum, as integers."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column(0)).sum(axis=0).astype(object)  # below 2^63 within a batch
                n, total = n + batch.num_rows, own if total is None else total + own
        if n:
            yield pa.record_batch([pa.array(range(-1, len(total))), pa.array([str(n), *map(str, total)])], names=["at", "total"])

    found = (vectors.select("x").mapInArrow(step, "at long, total string")
             .groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("at").collect())
    return (int(found[0]["total"]), [int(r["total"]) for r in found[1:]]) if found else (0, [])


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Vectors less their mean, given as integers and the fractions left, so that no digit is lost."""
    return (x - whole).astype(float) - rest


def covariance(vectors: DataFrame, n: int, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The covariance with divisor ``n``: each task's products of centred vectors, added up by Spark."""
    d = len(whole)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0))
            for k in range(0, len(x), ROWS):
                y = _centred(x[k:k + ROWS], whole, rest)
                total += y.T @ y
        yield pa.record_batch([pa.array(np.arange(d * d)), pa.array(total.ravel())], names=["at", "total"])

    found = (vectors.select("x").mapInArrow(step, "at long, total double")
             .groupBy("at").agg(F.sum("total").alias("total")).toArrow())  # d * d rows
    out = np.zeros(d * d)
    out[found.column("at").to_numpy()] = found.column("total").to_numpy()
    out = out.reshape(d, d) / n
    return (out + out.T) / 2


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """The sum over entries of ``(n * x - S)^2``, exact; None beyond a long."""
    least, most = (int(v) for v in (x.min(initial=0), x.max(initial=0)))
    widest = max([abs(n * v - s) for v in (least, most) for s in total] or [0])
    if widest * widest * len(total) < 1 << 63:
        return ((n * x - np.array(total, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(total, object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact.tolist()]


def whiten(embeddings: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: id, ``component, n, deviation, whitened, explained, identity_error``."""
    spark = embeddings.sparkSession
    vectors = saved(integer_vectors(embeddings, id_col, vector_col), "vectors")
    n, total = sums(vectors)
    whole = np.array([(s + n // 2) // n for s in total], np.int64)
    rest = np.array([(s - n * int(w)) / n for s, w in zip(total, whole)])
    matrix = covariance(vectors, n, whole, rest) if n else np.zeros((0, 0))
    values, axes = leading_pairs(matrix, components)
    trace = float(np.trace(matrix))
    real = values > len(matrix) * np.finfo(float).eps * max(trace, 1.0)
    values, axes = values[real], axes[:, real]
    scaled = spark.sparkContext.broadcast(axes / np.sqrt(values))
    k = len(values)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1)) if batch.num_rows else np.zeros((0, len(total)), np.int64)
            white = np.concatenate([_centred(x[i:i + ROWS], whole, rest) @ scaled.value for i in range(0, len(x), ROWS)]
                                   or [np.zeros((0, k))])
            yield pa.record_batch([batch.column(0), pa.array(_deviations(x, n, total), pa.int64()),
                                   *(pa.array(white[:, c]) for c in range(k))],
                                  names=["id", "deviation", *(f"w{c}" for c in range(k))])

    kind = vectors.schema["id"].dataType.simpleString()
    white = saved(vectors.mapInArrow(step, f"id {kind}, deviation long" + "".join(f", w{c} double" for c in range(k))), "white")
    # at most components squared over two numbers, in one pass
    error = F.greatest(F.lit(0.0), F.lit(0.0), *(F.abs(F.covar_pop(f"w{a}", f"w{b}") - float(a == b)) for a in range(k) for b in range(a + 1)))
    worst = float(white.agg(error.alias("e")).first()["e"] or 0.0)
    if not k:
        return white.limit(0).select(F.col("id").alias(id_col), F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
                                     "deviation", *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")))
    each = F.explode(F.array(*(F.struct(F.lit(c + 1).alias("component"), F.col(f"w{c}").alias("whitened"),
                                        F.lit(float(values[c] / trace)).alias("explained")) for c in range(k))))
    return (white.select("id", "deviation", each.alias("each"))
            .select(F.col("id").alias(id_col), "each.component", F.lit(n).cast("long").alias("n"), "deviation", "each.whitened",
                    "each.explained", F.lit(worst).alias("identity_error")))
