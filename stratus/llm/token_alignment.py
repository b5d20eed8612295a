"""Cross-tokenizer alignment with counts of linked token pairs under a minimal perfect hash.

Two tokenizers cut the same bytes (a space and the text): A, byte-level BPE read from a JSON
vocabulary, and B, BPE pieces with byte fallback. Byte offsets where tokens of both end cut a
text into groups; a token of A and one of B are *linked* where their byte ranges overlap. The
count of a pair of ids is the number of documents in which it is linked.

1. Every text is encoded once; the ids are kept in the shared folder.
2. The distinct pairs of all documents get numbers without gaps by a minimal perfect hash
   (``perfect_hash``), built by Spark tasks.
3. A pass over the ids counts the distinct pairs of each document into a dense vector indexed by
   number; the tasks' vectors are summed as a tree, slice by slice. The pair behind a number is
   compared with the pair asked for, so that no other pair can be counted in its place.
4. A second pass aligns the documents again and looks up the counts.

A task holds the keys and counts of one block of pairs, at most ``BLOCK_PAIRS`` or, if more, those
of one id of A: pairs are parted into blocks by their id of A, and steps 2 to 4 run block by block.

Defined results: null and empty texts, and texts whose tokens' bytes are not exactly the space and
the text under both tokenizers, have no tokens: all numbers are 0 and ``groups`` is empty. Repeated
rows and null ids are documents of their own. An empty table gives an empty result. Only
the id column passes. Strings of special tokens inside a text are plain text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import perfect_hash
from stratus.llm.common import discard, saved, whole_text

RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
#: The public vocabularies; both paths are parameters.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: the published pre-split of the byte-level vocabulary.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Pairs whose keys and counts a task holds at once (16 bytes each).
BLOCK_PAIRS = 4_000_000
#: Entries of a slice of a count vector; first-level sums of a slice.
SLICE, FAN = 4096, 64
#: Bytes of text that are aligned at once.
CHUNK = 1 << 21


def byte_letters() -> dict[str, int]:
    """The bytes behind the letters of a byte-level vocabulary: printable ones stand for themselves,
    the others for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_tokens(vocabulary: bytes) -> list[bytes]:
    """The bytes of every id of A; ids of special tokens stand for no bytes."""
    found = json.loads(vocabulary)
    letters, special = byte_letters(), {t["id"] for t in found["added_tokens"]}
    out = [b""] * (1 + max(found["model"]["vocab"].values()))
    for token, i in found["model"]["vocab"].items():
        if i not in special:
            out[i] = bytes(letters[c] for c in token)
    return out


def byte_encoder(tokens: list[bytes]) -> tiktoken.Encoding:
    """A's encoder. Ids are in the order of merges, so they are the ranks."""
    return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks={t: i for i, t in enumerate(tokens) if t}, special_tokens={})


def piece_tokens(pieces: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of every id of B."""
    return [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, pieces.id_to_piece(i)) for i in range(pieces.get_piece_size()))]


def _encoded(texts: DataFrame, model: Broadcast) -> DataFrame:
    """``row, id`` and the ids of A and B as packed 16-bit numbers, 32-bit for large vocabularies."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, proto, kind = model.value
        tokens_a = byte_tokens(vocabulary)
        a, b = byte_encoder(tokens_a), sentencepiece.SentencePieceProcessor(model_proto=proto)
        tokens_b = piece_tokens(b)

        def both(text: str) -> tuple[bytes, bytes]:
            if text:
                body, x, y = b" " + text.encode(), a.encode_ordinary(" " + text), b.encode(text)
                if body == b"".join(map(tokens_a.__getitem__, x)) == b"".join(map(tokens_b.__getitem__, y)):
                    return np.array(x, kind).tobytes(), np.array(y, kind).tobytes()
            return b"", b""

        for batch in batches:
            found = [both(t.as_py()) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.binary()),
                                   pa.array([y for _, y in found], pa.binary())], names=["row", "id", "a", "b"])

    return texts.mapInArrow(step, f"row long, id {texts.schema['id'].dataType.simpleString()}, a binary, b binary")


class Aligned:
    """The links of some documents: token numbers, whether a group ends, and each link's document."""

    def __init__(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, n_a: np.ndarray):
        ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        in_a, in_b = (np.zeros((ends_a[-1] if len(a) else 0) + 1, bool) for _ in range(2))
        in_a[ends_a], in_b[ends_b] = True, True
        at = np.flatnonzero(in_a | in_b)
        in_a, in_b = in_a[at], in_b[at]
        self.of_a, self.of_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        self.group_ends = in_a & in_b
        self.doc = np.searchsorted(np.cumsum(n_a), self.of_a, "right")
        self.a, self.b = a, b

    def texts(self, n_tokens: np.ndarray) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3``: the ids of every group, by document."""
        ends_a, ends_b = self.of_a[self.group_ends] + 1, self.of_b[self.group_ends] + 1
        group_a = np.searchsorted(ends_a, np.arange(len(self.a)), "right")
        group_b = np.searchsorted(ends_b, np.arange(len(self.b)), "right")
        ids, marks = (np.zeros(len(self.a) + len(self.b), np.int64) for _ in range(2))
        place = np.arange(len(self.a)) + np.concatenate([[0], ends_b])[group_a]
        ids[place] = self.a
        marks[place[ends_a - 1]] = 1
        place = np.arange(len(self.b)) + ends_a[group_b]
        ids[place] = self.b
        marks[place[ends_b - 1]] = 2
        offsets = np.concatenate([[0], np.cumsum(n_tokens)]).astype(np.int32)
        marks[offsets[1:][n_tokens > 0] - 1] = 3
        parts = pc.binary_join_element_wise(pa.array(ids).cast(pa.string()), pa.array([",", "|", ";", ""]).take(pa.array(marks)), "")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), parts), "")


def _aligned(batches: Iterator[pa.RecordBatch], size_a: np.ndarray, size_b: np.ndarray, kind: str) -> Iterator[tuple]:
    """The batch, tokens of A and B by document, and ``Aligned``, for chunks of documents."""
    for batch in batches:
        a, b = batch.column("a"), batch.column("b")
        width = np.dtype(kind).itemsize
        n_a, n_b = (pc.binary_length(c).to_numpy(zero_copy_only=False).astype(np.int64) // width for c in (a, b))
        chunk = np.cumsum(n_a + n_b) * 4 // CHUNK
        for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(chunk)) + 1):
            if len(part):
                ids = [np.frombuffer(b"".join(c[part[0]:part[-1] + 1].to_pylist()), kind).astype(np.int64) for c in (a, b)]
                yield batch[part[0]:part[-1] + 1], n_a[part], n_b[part], Aligned(*ids, size_a, size_b, n_a[part])


def _pairs(encoded: DataFrame, sizes: Broadcast) -> DataFrame:
    """The distinct linked pairs of all documents, as ``id of A * ids of B + id of B``."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size_a, size_b, kind = sizes.value
        held: list[np.ndarray] = []
        for _, _, _, x in _aligned(batches, size_a, size_b, kind):
            held.append(np.unique(x.a[x.of_a] * len(size_b) + x.b[x.of_b]))
            if sum(map(len, held)) > BLOCK_PAIRS:
                held = [np.unique(np.concatenate(held))]
                if len(held[0]) > BLOCK_PAIRS // 2:
                    yield pa.record_batch([pa.array(held.pop())], names=["pair"])
        if held:
            yield pa.record_batch([pa.array(np.unique(np.concatenate(held)))], names=["pair"])

    return encoded.mapInArrow(step, "pair long").distinct()


def _counts(encoded: DataFrame, sizes: Broadcast, block: Broadcast, n_pairs: int) -> np.ndarray:
    """The number of documents of each pair of a block, by its number."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (size_a, size_b, kind), (arrays, keys, part, parts) = sizes.value, block.value
        numbers, dense = perfect_hash.PerfectHash(*arrays), np.zeros(len(keys), np.int64)
        for _, _, _, x in _aligned(batches, size_a, size_b, kind):
            pair, doc = x.a[x.of_a] * len(size_b) + x.b[x.of_b], x.doc
            if parts > 1:
                own = x.a[x.of_a] % parts == part
                pair, doc = pair[own], doc[own]
            pair = np.unique(doc * (len(size_a) * len(size_b)) + pair) % (len(size_a) * len(size_b))
            np.add.at(dense, _verified(numbers, keys, pair), 1)
        for k in range(0, len(dense), SLICE):
            if dense[k:k + SLICE].any():
                yield pa.record_batch([pa.array([k // SLICE], pa.int64()), pa.array([dense[k:k + SLICE].tobytes()], pa.binary())],
                                      names=["slice", "counts"])

    def summed(table: pa.Table) -> pa.Table:
        total = reduce(np.add, (np.frombuffer(c.as_py(), np.int64) for c in table.column("counts")))
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "slice long, counts binary"
    tree = (encoded.mapInArrow(step, schema).withColumn("task", F.spark_partition_id() % FAN)
            .groupBy("slice", "task").applyInArrow(summed, schema).groupBy("slice").applyInArrow(summed, schema))
    out = np.zeros(n_pairs, np.int64)
    for r in tree.toLocalIterator():
        own = np.frombuffer(bytes(r["counts"]), np.int64)
        out[r["slice"] * SLICE:r["slice"] * SLICE + len(own)] = own
    return out


def _verified(numbers: perfect_hash.PerfectHash, keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    at = numbers.numbers(pairs)
    if not np.array_equal(keys[at], pairs):
        raise ValueError("a linked pair is missing from the set of distinct pairs")
    return at


def _looked_up(encoded: DataFrame, sizes: Broadcast, block: Broadcast, counted: Broadcast, whole: bool) -> DataFrame:
    """``row, n_best, count_sum`` from one block, and with ``whole`` the id and the columns that need no counts."""
    kind_of_id = encoded.schema["id"].dataType.simpleString()
    schema = "row long, n_best long, count_sum long" + whole * f", id {kind_of_id}, n_a long, n_b long, n_groups long, n_links long, groups string"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (size_a, size_b, kind), (arrays, keys, part, parts) = sizes.value, block.value
        numbers, (counts, best) = perfect_hash.PerfectHash(*arrays), counted.value
        for docs, n_a, n_b, x in _aligned(batches, size_a, size_b, kind):
            ids, pair, doc = x.a[x.of_a], x.a[x.of_a] * len(size_b) + x.b[x.of_b], x.doc
            if parts > 1:
                own = ids % parts == part
                ids, pair, doc = ids[own], pair[own], doc[own]
            count, total = counts[_verified(numbers, keys, pair)], np.zeros(docs.num_rows, np.int64)
            np.add.at(total, doc, count)
            out = {"row": docs.column("row"), "n_best": np.bincount(doc[count == best[ids]], minlength=len(total)), "count_sum": total}
            if whole:
                out |= {"id": docs.column("id"), "n_a": n_a, "n_b": n_b,
                        "n_groups": np.bincount(x.doc[x.group_ends], minlength=len(total)),
                        "n_links": np.bincount(x.doc, minlength=len(total)), "groups": x.texts(n_a + n_b)}
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in out.values()], names=list(out))

    return encoded.mapInArrow(step, schema)


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE,
                    piece_bpe: str = PIECE_BPE, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``groups`` is the alignment itself: the ids of A and B of each group, ``a1,a2|b1;a3|b2,b3``.
    """
    sc = docs.sparkSession.sparkContext
    vocabulary, proto = Path(byte_bpe).read_bytes(), Path(piece_bpe).read_bytes()  # some megabytes, read by the driver
    tokens_a = byte_tokens(vocabulary)
    tokens_b = piece_tokens(sentencepiece.SentencePieceProcessor(model_proto=proto))
    kind = "<u2" if max(len(tokens_a), len(tokens_b)) <= 1 << 16 else "<u4"
    sizes = sc.broadcast((*(np.array(list(map(len, t)), np.int64) for t in (tokens_a, tokens_b)), kind))

    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    encoded = saved(_encoded(keyed, sc.broadcast((vocabulary, proto, kind))), "token-ids", compression="zstd")
    pairs = saved(_pairs(encoded, sizes), "pairs")

    n_pairs = pairs.count()
    parts = max(1, -(-n_pairs // block_pairs))
    found = []
    for part in range(parts):
        own = pairs.where(F.expr(f"(pair div {len(tokens_b)}) % {parts} = {part}"))
        numbers = perfect_hash.build(own, n_pairs // parts)
        keys = np.zeros(len(numbers), np.int64)
        for batch in own.toArrow().to_batches():
            some = batch.column(0).to_numpy()
            keys[numbers.numbers(some)] = some
        block = sc.broadcast((numbers.arrays(), keys, part, parts))
        counts, best = _counts(encoded, sizes, block, len(numbers)), np.zeros(len(tokens_a), np.int64)
        np.maximum.at(best, keys // len(tokens_b), counts)
        rows = _looked_up(encoded, sizes, block, sc.broadcast((counts, best)), whole=part == 0)
        found.append(rows if parts == 1 else saved(rows, "looked-up"))
    discard(pairs)
    out = found[0]
    if parts > 1:
        sums = (reduce(DataFrame.unionByName, (f.select("row", "n_best", "count_sum") for f in found)).groupBy("row")
                .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
        out = out.drop("n_best", "count_sum").join(sums, "row")
    return out.select(F.col("id").alias(id_col), *RESULT)
