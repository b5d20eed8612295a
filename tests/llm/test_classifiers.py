"""Toxicity and quality on small labelled corpora: automata, contexts, folds, odd rows, accuracy."""

import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from llm.helpers import frame
from stratus.llm import quality, toxicity
from stratus.llm.labels import held_out, training_sample


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(3)
    terms = ["abba", "abcab", "bacab", "abcabcabc", "cabcabba", "bbbbbbbbbb", "acacbcabca"]
    lexicon = toxicity.FuzzyLexicon(terms, frozenset(["cabcabba"]))
    allowed = {t: 0 if t == "cabcabba" else toxicity.edits_allowed(t) for t in terms}
    words = ["".join(w) for n in range(0, 6) for w in itertools.product("abc", repeat=n)]
    words += ["".join(rng.choice("abc") for _ in range(rng.randint(6, 12))) for _ in range(1500)]
    words += [t[:k] + rng.choice("abcd") + t[k + rng.randint(0, 1):] for t in terms for k in range(len(t))]
    hits = 0
    for w in words:
        near = sorted((distance(w, t), t) for t in terms if distance(w, t) <= allowed[t])
        want = (near[0][1], near[0][0]) if near else None
        assert lexicon.match(w) == want, w
        hits += want is not None
    assert hits > 80


def corpus(spark, n=700, seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ta", "ri", "mo", "ne", "sul"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    insults = ["blorgface", "snarkwit", "dungheap"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_learns_terms_misspellings_and_quotation(spark):
    rows = corpus(spark)
    docs, labels = frame(spark, [r[1] for r in rows]), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic long")
    model = toxicity.train(docs, labels)
    assert set(model.terms) == {"blorgface", "snarkwit", "dungheap"}
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert all(got[i].predicted == y and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, y in rows)
    score = model.scorer()
    plain = "tari mone sul tamo rine "
    assert score(plain + "you blorgfase and snarkwitt " + plain) > 0.5  # two misspelled insults
    assert score(plain + "b1orgface snarkw1t dunghe@p " + plain) > 0.5
    assert score(plain + 'he said "blorgface" ' + plain) < 0.5 > score(None) and score("") == score(None)
    odd = frame(spark, [None, "", "x" * 100_000, rows[0][1], rows[0][1]], [None, 1, 2, None, None])
    assert [r.predicted for r in toxicity.score_documents(odd, model).collect()] == [0, 0, 0, 1, 1]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows if not r[2]}
    assert toxicity.drop_toxic(frame(spark, []), model).count() == 0


def test_without_labels_nothing_is_toxic(spark):
    docs = frame(spark, ["a b c", None])
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic long"))
    assert [r.predicted for r in toxicity.score_documents(docs, model).collect()] == [0, 0]
    assert quality.score_documents(docs, quality.train(docs, spark.createDataFrame([], "doc_id long, quality long"))).first().score == 0.5


def test_labels_outside_the_fold_are_not_read(spark):
    rows = corpus(spark, 200)
    docs = frame(spark, [r[1] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(3, None)], "doc_id long, toxic long")
    seen = training_sample(docs, labels, "toxic", 5, 0, 10_000)
    assert {r.doc_id for r in seen.collect()} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5}
    few = training_sample(docs, labels, "toxic", 5, 0, 40).count()
    assert 15 < few < 75
    assert spark.createDataFrame([(None,)], "doc_id long").select(held_out("doc_id", 5, 0)).first()[0]


def test_an_id_of_many_rows_gives_the_fit_one_text(spark):
    rows = [(7, "same text")] * 300 + [(7, "text %d" % i) for i in range(300)] + [(8, None), (9, ""), (11, "nine")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(5)
    labels = spark.createDataFrame([(7, 0), (7, 1), (8, 1), (9, 0), (None, 1)], "doc_id long, quality long")
    seen = [(r.doc_id, r.text, r.quality) for r in training_sample(docs, labels, "quality", 10 ** 6, -1, 100).collect()]
    again = [(r.doc_id, r.text, r.quality) for r in training_sample(docs.repartition(3), labels, "quality", 10 ** 6, -1, 100).collect()]
    assert sorted(seen) == sorted(again) and sorted((i, y) for i, _, y in seen) == [(7, 1), (8, 1), (9, 0)]
    assert [t for i, t, _ in sorted(seen)][1:] == [None, ""]


def test_the_fit_takes_whole_bags_up_to_its_bound(spark, monkeypatch):
    got = []
    monkeypatch.setattr(quality, "fit", lambda x, owner, y: got.append((len(x), len(y))))
    texts = ["word " * (64 * n) for n in (3, 1000, 5, 2, 700)]
    docs, labels = frame(spark, texts), spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality long")
    quality.train(docs, labels, 10 ** 6, -1)
    monkeypatch.setattr(quality, "TRAIN_PASSAGES", 1)
    quality.train(docs, labels, 10 ** 6, -1)
    assert got[0] == (1710, 5) and got[1][1] == 1 and got[1][0] in (3, 1000, 5, 2, 700)


def test_quality_tells_junk_and_streams_long_texts(spark):
    rng = random.Random(1)
    rows = [(i, t, y) for i, t, y in corpus(spark, 400, 2)]
    texts, labels = [], []
    for i, t, _ in rows:
        kind = i % 4
        texts.append(t if kind else rng.choice([t.upper() + " !!", " ".join(w + rng.choice(["%%%", "###"]) for w in t.split()),
                                                " ".join([t.split()[0]] * 80)]))
        labels.append((i, int(kind > 0)))
    docs = frame(spark, texts)
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality long"))
    got = {r.doc_id: r for r in quality.score_documents(docs, model).collect()}
    held = [i for i, _ in labels if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in labels)
    assert np.mean([got[i].predicted == y for i, y in labels if i in set(held)]) > 0.95
    long = (" ".join(t for _, t, _ in rows[:100]) + " ") * 3
    whole = np.concatenate(list(quality.passages(long.encode())))
    z, _, _, e = model.encoded(whole)
    a = np.exp(e - e.max())
    value = (a @ z) / a.sum() @ model.parts["c"] + model.parts["d"][0]
    assert len(whole) > quality.BLOCK and abs(model.score(long.encode()) - 1 / (1 + np.exp(-value))) < 1e-9
    odd = quality.score_documents(frame(spark, [None, "", " ", "x" * 50_000], [None, 1, 1, 1]), model).collect()
    assert len(odd) == 4 and len({r.score for r in odd[:3]}) == 1
    assert quality.score_documents(frame(spark, []), model).count() == 0


def test_gradient_of_the_bag_loss():
    rng = np.random.default_rng(0)
    x, owner, y = rng.normal(size=(30, quality.INPUTS)), np.repeat(np.arange(10), 3), (np.arange(10) % 2).astype(float)
    x[owner % 2 == 1, 0] += 4
    model = quality.fit(x, owner, y, rounds=200)
    z, _, _, e = model.encoded(x)
    scores = []
    for k in range(10):
        a = np.exp(e[owner == k])
        scores.append(a @ z[owner == k] / a.sum() @ model.parts["c"] + model.parts["d"][0])
    assert ((np.array(scores) > 0) == (y == 1)).all()


def bag_loss(model, x, owner, y):
    z, _, _, e = model.encoded(x)
    total = 0.0
    for k, target in enumerate(y):
        a = np.exp(e[owner == k])
        value = float(a @ z[owner == k] / a.sum() @ model.parts["c"] + model.parts["d"][0])
        total += np.log1p(np.exp(value)) - target * value
    return total


def test_slopes_equal_finite_differences():
    rng = np.random.default_rng(4)
    x, owner, y = rng.normal(size=(17, quality.INPUTS)), np.repeat(np.arange(5), [1, 4, 2, 7, 3]), np.array([0, 1, 1, 0, 1.0])
    model = quality.QualityModel.fresh(x.mean(axis=0), x.std(axis=0) + 1e-3)
    slopes = quality.slopes(model, x, owner, y)
    for name, part in model.parts.items():
        for at in [tuple(rng.integers(n) for n in part.shape) for _ in range(12)]:
            was, h = part[at], 1e-5
            part[at] = was + h
            up = bag_loss(model, x, owner, y)
            part[at] = was - h
            down = bag_loss(model, x, owner, y)
            part[at] = was
            assert abs((up - down) / (2 * h) - slopes[name][at]) < 1e-6, (name, at)


def test_blocks_of_bags_sum_to_the_whole_gradient(monkeypatch):
    rng = np.random.default_rng(2)
    owner = np.repeat(np.arange(12), rng.integers(1, 9, 12))
    x, y = rng.normal(size=(len(owner), quality.INPUTS)), (np.arange(12) % 3 == 0).astype(float)
    whole = quality.fit(x, owner, y, rounds=20).parts
    monkeypatch.setattr(quality, "FIT_BLOCK", 5)
    cut = quality.fit(x, owner, y, rounds=20).parts
    assert all(np.allclose(whole[k], cut[k], atol=1e-9) for k in whole)
