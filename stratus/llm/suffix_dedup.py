"""Suffix deduplication by refining buckets of sampled suffixes.

Removes every byte that a string of ``length`` bytes covers which also starts anywhere
else. Sorting all suffixes would shuffle one row per byte in every round; instead only
suffixes at winnowed anchors enter, one per some hundred bytes, chosen by content so that
equal strings choose equal anchors.

* Initial buckets: the anchor's q-gram. Its fingerprint is the bucket's identifier, the
  same on every machine. Suffixes alone in their bucket are settled: unique.
* A refinement splits the buckets by a direct hash of all bytes that the anchor's windows
  reach; bucket identifiers of other suffixes are not used for it. Suffixes that still share a bucket share all of
  their windows: repeated. A bucket that did not split is settled as a whole.
* The rest, suffixes left alone in a bucket that did split and one witness of each larger
  part, go on: their windows are cut into cells by offset from the anchor, the cells are
  bucketed by the longer string that all windows of a cell contain, and refined in the same
  way; what is still open is refined once more, window by window, by all ``length`` bytes.
  Settled parts are reused: they enter the next round only through their witness.

Defined results: a null or empty text has nothing to remove; texts shorter than
``length`` are kept; a null id and repeated ids are documents like any other; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import repeats
from stratus.llm.common import discard, saved


def _refined(suffixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One refinement of the buckets: suffixes found to be repeated, and those to go on with."""
    buckets = saved(suffixes.groupBy("bucket").agg(F.count("*").alias("n"), F.min("context").alias("c0"),
                                                   F.max("context").alias("c1")).where("n > 1")
                    .select("bucket", (F.col("c0") != F.col("c1")).alias("splits")), "buckets")
    shared = saved(suffixes.join(buckets, "bucket"), "shared")
    discard(suffixes, buckets)
    place = F.struct("doc", "fp", "lo")
    parts = saved(shared.where("splits").groupBy("bucket", "context")
                  .agg(F.count("*").alias("n"), F.min(place).alias("witness")), "parts")
    split = shared.where("splits").join(parts, ["bucket", "context"])
    settled = shared.where(~F.col("splits")).unionByName(split.where("n > 1").select(shared.columns))
    again = split.where((F.col("n") == 1) | place.eqNullSafe(F.col("witness")))
    return settled.select("doc", "fp", "lo", "hi"), again.select("doc", "fp", "anchor", "lo", "hi")


def repeated_strings(texts: DataFrame, length: int = 400) -> DataFrame:
    """``doc, fp, lo, hi``: spans of bytes, together all that repeated strings of ``length`` bytes cover."""
    suffixes = saved(repeats.find_anchors(texts, repeats.byte_symbols, length, max(1, length // 2)), "suffixes")
    found, again = _refined(suffixes)

    bodies = saved(repeats.with_lists(repeats.packed(texts), again, "inner"), "bodies")
    pieces = saved(repeats.cut(bodies, repeats.byte_symbols, length, max(1, length // 20)), "pieces")
    more, again = _refined(pieces)

    strings = saved(repeats.expand(repeats.with_lists(bodies.select("doc", "fp", "body"), again, "inner"),
                                   repeats.byte_symbols, length), "strings")
    discard(bodies)
    twice = saved(strings.groupBy("name1", "name2").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "twice")
    last = strings.join(twice, ["name1", "name2"]).select("doc", "fp", F.col("start").alias("lo"), F.col("start").alias("hi"))
    return (found.unionByName(more).unionByName(last)
            .select("doc", "fp", "lo", (F.col("hi") + length).alias("hi")))


def _finish(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple:
    edges = np.concatenate([[0], np.column_stack([start, end]).ravel(), [len(text)]]).astype(int)
    kept = hashlib.sha256()
    for a, b in zip(edges[::2], edges[1::2]):
        kept.update(text[a:b])
    return len(text), int((end - start).sum()), len(start), kept.hexdigest()


def remove_repeated_strings(docs: DataFrame, length: int = 400, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_bytes, n_removed, n_spans, kept_sha256``."""
    texts = repeats.keyed(docs, id_col, text_col)
    spans = repeated_strings(texts, length)
    return repeats.rewrite(repeats.with_lists(repeats.packed(texts), spans, "left"), _finish,
                           "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                           ).withColumnRenamed("doc", id_col)
