"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

Spark builds the index: terms, document frequencies and BM25 impacts of all items, scaled
so that an item scores 1 against itself. The index is cut into shards of a bounded number
of postings; each shard is broadcast and every passage of every document is a query
against it. Items of like length (between two powers of two of words) have an index of their own: a
passage is ``2 * step`` words, the next one begins ``step`` words on, and ``step`` is the longest item
of the class, so a leaked item lies whole in some passage and no long item widens a short one's.
Indexes of several classes are sent together up to the size of a shard.

Items stand in blocks; the index keeps every term's greatest impact in every block. Sums of
these bounds over a passage's terms skip the blocks that can't reach the threshold (terms of
little impact are left out here and allowed for in the bound); in the other blocks WAND moves
its cursors to the next item that can reach it. All items above the threshold are retrieved,
and each is verified: enough of its question's and of its answer's word n-grams must stand
in the passage.

A test item's answer follows a line mark ``Answer:`` or ``A:``, else it is the last sentence,
else the last third of the words. Words are lower-cased; white space and signs part them.

Defined results: documents or items without words match nothing; a null id is reported as
null; repeated rows are reported each; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm.common import discard, saved, whole_text

K1, B = 1.2, 0.75
#: Postings of a shard, about: what is broadcast at once.
SHARD_POSTINGS = 100_000
#: Cells of the table of bounds (terms x blocks); blocks have two items or as many as it takes.
BOUNDS = 16_000_000
#: Terms whose greatest impacts add up to no more than this are left out of the block bounds.
SLACK = 0.05

#: ASCII signs part words, and so do the signs of Latin-1 and of general punctuation.
_PLAIN = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_SIGNS = re.compile(rb"\xc2[\x80-\xbf]|\xe2\x80[\x80-\xbf]")
_ANSWER = re.compile(r"(?:^|\n|\s)(?:answer|a)\s*:\s*", re.IGNORECASE)
_SENTENCE = re.compile(r"[.!?]\s+(?=\S)")


def words(text: str | None) -> list[bytes]:
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN)
    if b"\xc2" in raw or b"\xe2\x80" in raw:
        raw = _SIGNS.sub(b" ", raw)
    return raw.split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    marks, ends = list(_ANSWER.finditer(text)), list(_SENTENCE.finditer(text))
    for m in reversed(marks or ends):
        question, answer = words(text[:m.start()]), words(text[m.end():])
        if question and answer:
            return question, answer
    both = words(text)
    cut = len(both) - max(1, len(both) // 3)
    return both[:cut], both[cut:]


def grams(ws: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    n = min(n, len(ws))
    return {tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)} if n else set()


def postings(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, item_id, body, term, impact``: BM25 impacts, an item's adding up to 1."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ws = words(batch.column(1)[i].as_py())
                tf = Counter(ws)
                at = pa.array(np.full(len(tf), i))
                yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array([t.decode() for t in tf], pa.string()),
                                       pa.array(list(tf.values()), pa.int64()), pa.array(np.full(len(tf), len(ws)), pa.int64())],
                                      names=["item_id", "body", "term", "tf", "length"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), whole_text(text_col).alias("body")).distinct()
    found = saved(rows.mapInArrow(step, "item_id long, body string, term string, tf long, length long"), "item-terms")
    totals = found.select("item_id", "body", "length").distinct().agg(
        F.count("*").alias("items"), F.avg("length").alias("mean"))
    df = found.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("items") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    item = Window.partitionBy("item_id", "body")
    return (found.join(df, "term").crossJoin(F.broadcast(totals))  # one row of totals
            .withColumn("impact", weight).withColumn("impact", F.col("impact") / F.sum("impact").over(item))
            .select(F.xxhash64("item_id", "body").alias("item"), "item_id", "body", "term", "length", "impact"))


@dataclass
class Shard:
    """The index of some items: postings by term, block bounds, and the items' n-grams."""
    vocabulary: dict[bytes, int]
    starts: np.ndarray      # of each term's postings; they are sorted by item
    items: np.ndarray
    impacts: np.ndarray
    bounds: np.ndarray      # terms x blocks: greatest impact
    essential: np.ndarray   # terms that take part in the block bounds
    block: int              # items of a block
    ids: list
    checks: list[tuple[set, set]]

    @staticmethod
    def build(rows: list, n: int) -> "Shard":
        item_at: dict[tuple, int] = {}
        vocabulary: dict[bytes, int] = {}
        for r in rows:
            item_at.setdefault((r.item_id, r.body), len(item_at))
            vocabulary.setdefault(r.term.encode(), len(vocabulary))
        term = np.array([vocabulary[r.term.encode()] for r in rows])
        item = np.array([item_at[r.item_id, r.body] for r in rows])
        impact = np.array([r.impact for r in rows])
        order = np.lexsort((item, term))
        term, item, impact = term[order], item[order], impact[order]
        block = max(2, -(-len(vocabulary) * len(item_at) // BOUNDS))
        bounds = np.zeros((len(vocabulary), (len(item_at) - 1) // block + 1), np.float32)
        np.maximum.at(bounds, (term, item // block), impact.astype(np.float32))
        best = bounds.max(axis=1)
        small = np.argsort(best)
        essential = np.ones(len(vocabulary), bool)
        essential[small[np.cumsum(best[small]) <= SLACK]] = False
        split = [question_and_answer(body) for _, body in item_at]
        return Shard(vocabulary, np.searchsorted(term, np.arange(len(vocabulary) + 1)), item, impact, bounds, essential, block,
                     [i for i, _ in item_at], [(grams(q, n), grams(a, n)) for q, a in split])

    def wand(self, terms: np.ndarray, block: int, threshold: float) -> Iterator[tuple[int, float]]:
        """The items of a block that score the threshold with these terms."""
        cursors = []
        for t in terms:
            a, b = self.starts[t], self.starts[t + 1]
            lo, hi = a + np.searchsorted(self.items[a:b], (block * self.block, (block + 1) * self.block))
            if lo < hi:
                cursors.append([int(self.items[lo]), int(lo), int(hi), float(self.bounds[t, block])])
        while cursors:
            cursors.sort()
            total, pivot = 0.0, None
            for c in cursors:
                total += c[3]
                if total >= threshold - 1e-6:
                    pivot = c[0]
                    break
            if pivot is None:
                return
            if cursors[0][0] == pivot:
                score = sum(self.impacts[c[1]] for c in cursors if c[0] == pivot)
                if score >= threshold:
                    yield pivot, float(score)
                moving = [c for c in cursors if c[0] == pivot]
                goal = pivot + 1
            else:
                moving, goal = [c for c in cursors if c[0] < pivot], pivot
            for c in moving:
                c[1] += int(np.searchsorted(self.items[c[1]:c[2]], goal))
                if c[1] < c[2]:
                    c[0] = int(self.items[c[1]])
            cursors = [c for c in cursors if c[1] < c[2]]

    def search(self, ws: list[bytes], step: int, threshold: float) -> Iterator[tuple[int, int, float]]:
        """Passage, item and score of all that reach the threshold, passage by passage."""
        ids = np.fromiter(map(self.vocabulary.get, ws, repeat(-1)), np.int64, len(ws))
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return
        last = max(0, (len(ws) - 1) // step - 1)
        half, v = at // step, len(self.vocabulary)
        pairs = np.unique(np.concatenate([np.minimum(half, last) * v + ids[at], np.maximum(half - 1, 0) * v + ids[at]]))
        passage, term = pairs // v, pairs % v
        heavy = self.essential[term]
        owner, starts = np.unique(passage[heavy], return_index=True)
        if not len(owner):
            return
        sums = np.add.reduceat(self.bounds[term[heavy]], starts, axis=0)
        for k, block in np.argwhere(sums >= threshold - SLACK - 1e-4):
            a, b = np.searchsorted(passage, (owner[k], owner[k] + 1))
            for item, score in self.wand(term[a:b], int(block), threshold):
                yield int(owner[k]), item, score


def bundles(sizes: list[tuple[int, int]], limit: int) -> list[list[tuple[int, int, int]]]:
    """What is sent together: lists of (class, part, parts), from (class, postings) in order."""
    out, room = [], 0.0
    for length_class, n in sizes:
        parts = -(-n // limit)
        for k in range(parts):
            if n / parts > room:
                out.append([])
                room = limit
            out[-1].append((length_class, k, parts))
            room -= n / parts
    return out


def _shards(items: DataFrame, n: int, item_id_col: str, item_text_col: str) -> Iterator[list[tuple[int, Shard]]]:
    """Shards to send together, each with the step between its passages."""
    # items of up to 32 words are one class, those of up to 64 the next one, ...
    classed = postings(items, item_id_col, item_text_col).withColumn("class", F.length(F.bin(F.greatest("length", F.lit(32)) - 1)))
    index = saved(classed, "postings")
    sizes = index.groupBy("class").agg(F.count("*").alias("n"), F.max("length").alias("longest")).orderBy("class").collect()
    step = {r["class"]: max(32, r.longest) for r in sizes}
    for bundle in bundles([(r["class"], r.n) for r in sizes], SHARD_POSTINGS):
        built = []
        for c, k, parts in bundle:
            rows = index.where((F.col("class") == c) & (F.pmod("item", F.lit(parts)) == k)).collect()  # about SHARD_POSTINGS in all
            if rows:
                built.append((step[c], Shard.build(rows, n)))
        if built:
            yield built
    discard(index)


@dataclass(frozen=True)
class Limits:
    """When an item counts as leaked: BM25 score (1: all of it), and the shares of its n-grams."""
    score: float = 0.5
    question: float = 0.5
    answer: float = 0.5
    n: int = 3


def _leaks(index: list[tuple[int, Shard]], text: str, limits: Limits) -> list[tuple]:
    """``item_id, passage_start, score, question_overlap, answer_overlap`` of a text's verified items."""
    ws, out = words(text), []
    for step, shard in index:
        best, passage_grams = {}, (-1, set())
        for passage, item, score in shard.search(ws, step, limits.score):
            if passage_grams[0] != passage:
                passage_grams = (passage, short_grams(ws[passage * step:(passage + 2) * step], limits.n))
            question, answer = (sum(g in passage_grams[1] for g in part) / len(part) if part else 1.0
                                for part in shard.checks[item])
            if question >= limits.question and answer >= limits.answer and score > best.get(item, (0, 0.0))[1]:
                best[item] = (passage * step, score, question, answer)
        out += [(shard.ids[item], *row) for item, row in sorted(best.items())]
    return out


def _sent(spark: SparkSession, index: list[tuple[int, Shard]]) -> Callable[[], list[tuple[int, Shard]]]:
    """The shards as a broadcast; of plain parts, as a broadcast is not pickled with its class."""
    parts = spark.sparkContext.broadcast([(step, [getattr(shard, f.name) for f in fields(Shard)]) for step, shard in index])
    return lambda: [(step, Shard(*p)) for step, p in parts.value]


def find_leaks(docs: DataFrame, items: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
               text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and verified item, from its best passage: id,
    ``item_id, passage_start, score, question_overlap, answer_overlap``."""
    spark = docs.sparkSession
    schema = (f"{id_col} long, item_id long, passage_start long, score double, question_overlap double, "
              "answer_overlap double")
    names = [part.split()[0] for part in schema.split(", ")]
    texts = docs.select(F.col(id_col).cast("long"), whole_text(text_col))
    shards = _shards(items, limits.n, item_id_col, item_text_col)

    def scan(get: Callable[[], Shard]) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = get()
            for batch in batches:
                found = [(i, row) for i, body in enumerate(batch.column(1)) for row in _leaks(index, body.as_py(), limits)]
                if found:
                    cols = [pa.array(c, pa.int64() if k < 2 else pa.float64())
                            for k, c in enumerate(zip(*(row for _, row in found)))]
                    yield pa.record_batch([batch.column(0).take(pa.array([i for i, _ in found])), *cols], names=names)

        return texts.mapInArrow(rows, schema)

    return reduce(DataFrame.unionByName, (scan(_sent(spark, s)) for s in shards), spark.createDataFrame([], schema))


def drop_contaminated(docs: DataFrame, items: DataFrame, limits: Limits = Limits(), text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a verified test item, in one pass per shard without a shuffle."""
    shards = _shards(items, limits.n, item_id_col, item_text_col)

    def clean(docs: DataFrame, get: Callable[[], Shard]) -> DataFrame:
        at = docs.columns.index(text_col)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = get()
            for batch in batches:
                yield batch.filter(pa.array([not _leaks(index, t.as_py() or "", limits) for t in batch.column(at)],
                                            pa.bool_()))

        return docs.mapInArrow(rows, docs.schema)

    return reduce(lambda kept, shard: clean(kept, _sent(docs.sparkSession, shard)), shards, docs)


def short_grams(passage: list[bytes], n: int) -> set:
    """The passage's n-grams, and shorter ones for the sake of short questions and answers."""
    return set().union(*(grams(passage, k) for k in range(1, n + 1)))
