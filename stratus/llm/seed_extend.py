"""Substring deduplication by seed and extend.

Seeds are winnowed anchors: the ``gram`` words of smallest hash in every ``length``-word
window, so two documents that share a window share its seed. Documents are joined on their
seeds; a seed that no smaller document has cannot be extended into a repeat and drops out.
The others are extended both ways, over all windows that have the seed as anchor (its
context). Occurrences of equal context form a class and extend alike; they are settled
against the class's smallest document. Only the smallest document of each class, where a
smaller one shares the seed in another context, is extended word by word, window against
window. Overlapping repeats merge into maximal repeats.

Comparing classes instead of pairs keeps the work linear: a passage shared by a third of
all documents gives one class, not pairs of its members.

Rules: a word is removed when a window of ``length`` consecutive words that covers it also
starts in a document with a smaller id, judged on the input. Defined results: null or blank
texts have no words; a null id counts as larger than any id and null ids are not smaller
than each other, nor are repeated ids; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import repeats, winnow
from stratus.llm.common import discard, saved

#: A null id is ordered after every id.
_LAST = (1 << 63) - 1


def word_symbols(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words; ``bytes.split`` parts at exactly the white space of the contract."""
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, text.split()), np.uint64)
    return one, winnow.mixed(one + np.uint64(0x9E3779B97F4A7C15))


def repeats_of_smaller(texts: DataFrame, length: int = 13, gram: int = 5) -> DataFrame:
    """``doc, fp, lo, hi``: spans of words, together all repeats of smaller documents."""
    rank = F.coalesce("doc", F.lit(_LAST))
    seeds = saved(repeats.find_anchors(texts, word_symbols, length, gram), "seeds")
    ranked = seeds.select("*", rank.alias("rank"))

    joined = saved(ranked.groupBy("bucket").agg(F.min("rank").alias("first"), F.max("rank").alias("last"),
                                                F.min("context").alias("c0"), F.max("context").alias("c1"))
                   .where(F.col("first") < F.col("last"))
                   .select("bucket", "first", (F.col("c0") != F.col("c1")).alias("differ")), "joined")
    shared = saved(ranked.join(joined, "bucket"), "shared-seeds")
    discard(seeds, joined)
    alike = shared.where(~F.col("differ") & (F.col("rank") > F.col("first")))

    classes = saved(shared.where("differ").groupBy("bucket", "context").agg(F.min("rank").alias("least")), "classes")
    others = shared.where("differ").join(classes, ["bucket", "context"])
    settled = others.where(F.col("rank") > F.col("least"))
    front = others.where(F.col("rank") == F.col("least"))

    extended = saved(repeats.expand(repeats.with_lists(repeats.packed(texts), front, "inner"), word_symbols, length)
                     .select("*", rank.alias("rank")), "extended")
    first = saved(extended.groupBy("name1", "name2").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
                  .where(F.col("first") < F.col("last")).drop("last"), "first-windows")
    found = extended.join(first, ["name1", "name2"]).where(F.col("rank") > F.col("first"))
    return (alike.select("doc", "fp", "lo", "hi").unionByName(settled.select("doc", "fp", "lo", "hi"))
            .withColumn("hi", F.col("hi") + length)
            .unionByName(found.select("doc", "fp", F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))))


def _finish(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple:
    words, kept, at = text.split(), [], 0
    for a, b in zip(start.tolist(), end.tolist()):
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def remove_repeats(docs: DataFrame, length: int = 13, gram: int = 5, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words, n_removed, kept_sha256``."""
    texts = repeats.keyed(docs, id_col, text_col)
    spans = repeats_of_smaller(texts, length, gram)
    return repeats.rewrite(repeats.with_lists(repeats.packed(texts), spans, "left"), _finish,
                           "n_words long, n_removed long, kept_sha256 string").withColumnRenamed("doc", id_col)
