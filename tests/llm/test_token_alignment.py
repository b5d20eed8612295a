import hashlib
import os
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratus.llm import perfect_hash, token_alignment
from llm.helpers import frame

pytestmark = pytest.mark.skipif(not os.path.exists(token_alignment.BYTE_BPE), reason="no vocabulary files")

TEXTS = ["the cat sat on the mat", "the cat sat on the mat", "", None, " ", "  two  spaces \n\n and\tlines ",
         "naïve café — 東京 😀 <|endoftext|> </s> <s>", "▁ is not a space", "a", "don't can't we've I'LL", "x" * 5000,
         "word " * 3000, "\u0000 nul", "İstanbul ﬁ ² ½", "12345 67 8 9,10.11", "   ", "\r\n", "tail   "]


def brute(texts):
    a = Tokenizer.from_file(token_alignment.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=token_alignment.PIECE_BPE)
    letters = token_alignment.byte_letters()

    def spans(tokens):
        out, at = [], 0
        for i, body in tokens:
            out.append((i, at, at + len(body)))
            at += len(body)
        return out

    docs = []
    for text in texts:
        x = y = []
        if text:
            x = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
            y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                 for i in b.encode(text)]
            whole = (" " + text).encode()
            if not whole == b"".join(t for _, t in x) == b"".join(t for _, t in y):
                x = y = []
        x, y = spans(x), spans(y)
        links = [(p, q) for p, s, e in x for q, u, v in y if s < v and u < e] if len(x) < 1500 else None
        if links is None:  # the same by offsets of the bytes
            of_a = {k: (n, i) for n, (i, s, e) in enumerate(x) for k in range(s, e)}
            of_b = {k: (n, i) for n, (i, s, e) in enumerate(y) for k in range(s, e)}
            links = [(p[1], q[1]) for p, q in {(of_a[k], of_b[k]) for k in of_a}]
        cuts = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            groups.append(",".join(str(i) for i, s, e in x if low <= s and e <= high) + "|"
                          + ",".join(str(i) for i, s, e in y if low <= s and e <= high) if len(cuts) < 500 else None)
        docs.append((len(x), len(y), len(cuts), links, ";".join(groups) if None not in groups else None))
    counts = Counter(pair for *_, links, _ in docs for pair in set(links))
    best = {}
    for (p, _), n in counts.items():
        best[p] = max(best.get(p, 0), n)
    return [(n_a, n_b, n_g, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), text)
            for n_a, n_b, n_g, links, text in docs]


@pytest.mark.parametrize("block_pairs", [token_alignment.BLOCK_PAIRS, 40])
def test_alignment_equals_brute_force(spark, block_pairs):
    rows = token_alignment.align_documents(frame(spark, TEXTS).repartition(3), block_pairs=block_pairs).collect()
    assert len(rows) == len(TEXTS)
    want = brute(TEXTS)
    for r in rows:
        *numbers, text = want[r.doc_id]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum] == numbers, r.doc_id
        assert text is None or r.groups == text, r.doc_id
    assert not want[7][0] and want[0][0]  # the piece for a space as a letter: no tokens


def test_odd_tables(spark):
    assert token_alignment.align_documents(frame(spark, [])).count() == 0
    twice = token_alignment.align_documents(frame(spark, ["same text", "same text"], ids=[None, None])).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].doc_id is None
    assert twice[0].count_sum == 2 * twice[0].n_links


def test_registered_query_hashes_the_groups(spark, tmp_path):
    from stratus.llm.queries import op12_token_alignment
    frame(spark, ["some words here", ""]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in op12_token_alignment(spark, str(tmp_path)).collect()}
    assert rows[0].groups_sha256 == hashlib.sha256(brute(["some words here"])[0][-1].encode()).hexdigest()
    assert rows[1].groups_sha256 == "" and rows[1].n_a == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000, 30_000])
def test_numbers_are_a_gapless_bijection(spark, n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64)
    numbers = perfect_hash.build(spark.createDataFrame([(int(k),) for k in keys], "pair long"), n)
    assert sorted(numbers.numbers(keys).tolist()) == list(range(n)) and len(numbers) == n


def test_a_foreign_key_is_noticed(spark):
    numbers = perfect_hash.build(spark.createDataFrame([(k,) for k in range(100)], "pair long"), 100)
    keys = np.zeros(100, np.int64)
    keys[numbers.numbers(np.arange(100))] = np.arange(100)
    with pytest.raises(ValueError):
        token_alignment._verified(numbers, keys, np.array([3, 1000]))


def test_counts_are_summed_over_many_tasks(spark):
    texts = [f"word{i % 7} and word{i % 5}" for i in range(60)]
    one = token_alignment.align_documents(frame(spark, texts).coalesce(1)).drop("groups")
    many = token_alignment.align_documents(frame(spark, texts).repartition(20)).drop("groups")
    assert one.orderBy("doc_id").collect() == many.orderBy("doc_id").collect()
    assert one.agg(F.max("count_sum")).first()[0] > 60
