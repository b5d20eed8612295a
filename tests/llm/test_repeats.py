"""The substring operators against brute force on small texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm.helpers import frame
from stratus.llm import repeats, seed_extend, suffix_dedup, winnow

def brute_bytes(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rough_texts(rng, n=60):
    """Texts that share passages of all lengths, whole and cut, besides runs and junk."""
    def words(k):
        return " ".join("".join(rng.choice("abcdeü") for _ in range(rng.randint(1, 6))) for _ in range(k))
    pool = [words(rng.randint(3, 40)) for _ in range(6)]
    texts = [None, "", " ", "a" * 300, "ab" * 150, "x", "\U0001F600é" * 40]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, len(p) // 3)
            parts += [words(rng.randint(0, 15)), p[a:len(p) - rng.randint(0, len(p) // 3)]]
        texts.append(" ".join(parts))
    return texts + texts[10:14] + [texts[12] + " tail"]


def test_bucket_refinement_removes_exactly_the_repeated_strings(spark):
    texts = rough_texts(random.Random(5))
    for length in (12, 40):
        got = {r.doc_id: tuple(r)[1:] for r in
               suffix_dedup.remove_repeated_strings(frame(spark, texts), length).collect()}
        want = brute_bytes(texts, length)
        assert [got[i] for i in range(len(texts))] == want
        assert any(0 < w[1] < w[0] for w in want)


def test_suffix_dedup_null_and_repeated_ids(spark):
    t = "the same words in both of the texts " * 2
    got = suffix_dedup.remove_repeated_strings(frame(spark, [t, t, "other", "other"], [None, None, 3, 3]), 20).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 0), (False, 0), (True, 72), (True, 72)]
    assert suffix_dedup.remove_repeated_strings(frame(spark, []), 20).count() == 0


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_anchor_intervals_partition_the_windows(monkeypatch, block):
    monkeypatch.setattr(winnow, "BLOCK", block)
    raw = np.frombuffer(random.Random(1).randbytes(500), np.uint8)
    got = winnow.anchors(winnow.FIRST.byte_values[raw], winnow.SECOND.byte_values[raw], 20, 8)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(got["lo"], got["hi"])])
    assert starts.tolist() == list(range(500 - 20 + 1))


def test_union_of_intervals():
    a, b = winnow.union(np.array([5, 0, 2, 20]), np.array([9, 3, 5, 21]))
    assert (a.tolist(), b.tolist()) == ([0, 20], [9, 21])


def brute_words(texts, ids, length):
    rank = [float("inf") if i is None else i for i in ids]
    words = [(t or "").encode().split() for t in texts]
    first = {}
    for r, w in zip(rank, words):
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            first[key] = min(first.get(key, r), r)
    out = []
    for r, w in zip(rank, words):
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < r:
                gone |= set(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_seed_and_extend_removes_exactly_the_repeats_of_smaller_documents(spark):
    rng = random.Random(9)
    texts = rough_texts(rng, 80) + ["a b " * 30, "b a " * 25, "a\u00a0b c\x0bd " * 9]
    ids = rng.sample(range(1000), len(texts) - 3) + [None, None, 5]
    for length, gram in ((13, 5), (6, 2)):
        got = {(r[0], r[1], r[3]): r[2] for r in
               map(tuple, seed_extend.remove_repeats(frame(spark, texts, ids), length, gram).collect())}
        want = brute_words(texts, ids, length)
        assert got == {(i, n, h): k for i, (n, k, h) in zip(ids, want)}
        assert any(0 < w[1] < w[0] for w in want)


def test_seed_extend_empty_table(spark):
    assert seed_extend.remove_repeats(frame(spark, [])).count() == 0


def test_repeated_rows_do_not_lengthen_the_lists(spark):
    """Many equal rows of one id, and of a null id: as many intervals to a text as for two rows, and the same result."""
    words = " ".join("w%d" % i for i in range(120))
    sizes = {}
    for n in (2, 300):
        docs = frame(spark, [words] * n + [words] * n, [5] * n + [None] * n)
        texts = repeats.keyed(docs, "doc_id", "text")
        for name, spans in (("op5", seed_extend.repeats_of_smaller(texts)), ("op6", suffix_dedup.repeated_strings(texts, 100))):
            lists = repeats.with_lists(repeats.packed(texts), spans, "inner")
            sizes.setdefault(name, []).append(max(r[0] for r in lists.selectExpr("size(los)").collect()))
        kept = seed_extend.remove_repeats(docs).select("doc_id", "n_removed", "kept_sha256").distinct().collect()
        assert sorted((r.doc_id or 0, r.n_removed) for r in kept) == [(0, 120), (5, 0)]
        gone = suffix_dedup.remove_repeated_strings(docs, 100).select("n_bytes", "n_removed").distinct().collect()
        assert len(gone) == 1 and gone[0].n_bytes == gone[0].n_removed
    assert all(a == b for a, b in sizes.values())
