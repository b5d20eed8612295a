"""Arrow steps that the substring operators share: texts to anchors, anchors to windows, spans to kept text.

A document is known by its id and the hash of its text, so that null or repeated ids keep
their own texts apart; rows equal in both are the same text and get the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import winnow
from stratus.llm.common import whole_text

#: Symbols of a text under both rolling hashes.
Symbols = Callable[[bytes], tuple[np.ndarray, np.ndarray]]

#: Rows of an Arrow batch that a step emits at most, but for those of one text.
_EMIT = 200_000


def byte_symbols(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text, np.uint8)
    return winnow.FIRST.byte_values[raw], winnow.SECOND.byte_values[raw]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc``, ``fp``, ``body``: the whole text as UTF-8."""
    text = whole_text(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("fp"),
                       text.cast("binary").alias("body"))


_ITEM = "doc long, fp long, bucket long, context long, anchor int, lo int, hi int"


def _items(doc: pa.Array, fp: pa.Array, found: list[tuple[int, dict]]) -> pa.RecordBatch:
    at = pa.array(np.concatenate([np.full(len(f["lo"]), i) for i, f in found]))
    cols = [pa.array(np.concatenate([f[k] for _, f in found]).astype(np.int64 if k in ("bucket", "context") else np.int32))
            for k in ("bucket", "context", "anchor", "lo", "hi")]
    return pa.record_batch([doc.take(at), fp.take(at), *cols],
                           names=["doc", "fp", "bucket", "context", "anchor", "lo", "hi"])


def _emitted(batch: pa.RecordBatch, found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for i, f in enumerate(found):
        if len(f["lo"]):
            held.append((i, f))
            size += len(f["lo"])
        if size > _EMIT:
            yield _items(batch.column(0), batch.column(1), held)
            held, size = [], 0
    if held:
        yield _items(batch.column(0), batch.column(1), held)


def find_anchors(texts: DataFrame, symbols: Symbols, window: int, gram: int) -> DataFrame:
    """A row for every anchor: the text's name, bucket, context, and the windows that select it."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _emitted(batch, (winnow.anchors(*symbols(body.as_py()), window, gram)
                                        for body in batch.column(2)))

    return texts.mapInArrow(step, _ITEM)


def packed(texts: DataFrame) -> DataFrame:
    """The texts compressed, for a shuffle."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            small = pa.array([z.compress(body.as_py()) for body in batch.column(2)], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1), small], names=["doc", "fp", "body"])

    return texts.mapInArrow(step, "doc long, fp long, body binary")


def with_lists(bodies: DataFrame, intervals: DataFrame, how: str) -> DataFrame:
    """Each packed text with the arrays of its distinct intervals' ``anchor``, ``lo``, ``hi``: at most one each per symbol.

    Rows equal in id and text bring the same intervals, so their number doesn't lengthen the lists.
    """
    names = [c for c in ("anchor", "lo", "hi") if c in intervals.columns]
    lists = (intervals.groupBy(F.col("doc").alias("_doc"), F.col("fp").alias("_fp"))
             .agg(F.collect_set(F.struct(*names)).alias("_set"))
             .select("_doc", "_fp", *(F.col("_set")[c].alias(f"{c}s") for c in names)))
    return (bodies.join(lists, (bodies["fp"] == lists["_fp"]) & bodies["doc"].eqNullSafe(lists["_doc"]), how)
            .drop("_doc", "_fp"))


def _arrays(batch: pa.RecordBatch, i: int, *names: str) -> list[np.ndarray]:
    return [batch.column(n)[i].values.to_numpy().astype(np.int64) for n in names]


def cut(listed: DataFrame, symbols: Symbols, window: int, width: int) -> DataFrame:
    """The listed intervals cut into cells of ``width`` windows, as rows like those of ``find_anchors``."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            yield from _emitted(batch, (
                winnow.cells(*symbols(z.decompress(batch.column(2)[i].as_py())),
                             *_arrays(batch, i, "anchors", "los", "his"), window, width)
                for i in range(batch.num_rows)))

    return listed.mapInArrow(step, _ITEM)


def expand(listed: DataFrame, symbols: Symbols, window: int) -> DataFrame:
    """A row for every window of the intervals: ``doc, fp, start, name1, name2``."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            doc, fp = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                lo, hi = _arrays(batch, i, "los", "his")
                start, one, two = winnow.windows(*symbols(z.decompress(batch.column(2)[i].as_py())), lo, hi, window)
                at = pa.array(np.full(len(start), i))
                yield pa.record_batch([doc.take(at), fp.take(at), pa.array(start.astype(np.int32)), pa.array(one),
                                       pa.array(two)], names=["doc", "fp", "start", "name1", "name2"])

    return listed.mapInArrow(step, "doc long, fp long, start int, name1 long, name2 long")


def rewrite(listed: DataFrame, finish: Callable[[bytes, np.ndarray, np.ndarray], tuple],
            schema: str) -> DataFrame:
    """``doc`` and what ``finish(text, starts, ends)`` makes of the text and its maximal runs to remove."""
    names = ["doc", *(part.split()[0] for part in schema.split(", "))]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        none = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for i in range(batch.num_rows):
                lo, hi = _arrays(batch, i, "los", "his") if batch.column("los")[i].is_valid else (none, none)
                rows.append(finish(z.decompress(batch.column(2)[i].as_py()), *winnow.union(lo, hi)))
            yield pa.record_batch([batch.column(0), *map(pa.array, zip(*rows))], names=names)

    return listed.mapInArrow(step, f"doc long, {schema}")
