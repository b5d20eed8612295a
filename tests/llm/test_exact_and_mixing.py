"""Exact dedup, mixing and decontamination against brute force, with odd rows."""

import collections
import hashlib
import random
import re

import pytest

from llm.helpers import frame
from stratus.llm import decontaminate, exact_dedup, mixing

SPACES = str.maketrans("", "", " \t\n\x0b\x0c\r")


def test_exact_dedup_equals_brute_force(spark):
    rng = random.Random(2)
    pool = ["a b c", "abc", "a bc", " abc ", "\tabc\x0b\x0c\r\n", "", None, " ", "x" * 5000, "é \U0001F600"]
    texts = [rng.choice(pool) for _ in range(300)] + ["only %d" % k for k in range(50)]
    ids = rng.sample(range(1000), len(texts))
    for heavy in (2, 512):
        rows = exact_dedup.mark_exact_duplicates(frame(spark, texts, ids), heavy=heavy).collect()
        groups = collections.defaultdict(list)
        for i, t in zip(ids, texts):
            groups[(t or "").translate(SPACES)].append((-len(t or ""), i))
        want = {(i, min(g)[1], len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g}
        assert {(r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in rows} == want
        assert all(r.kept == (r.doc_id == r.keep_id) for r in rows) and len(rows) == len(texts)
    kept = exact_dedup.drop_exact_duplicates(frame(spark, texts, ids))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w[1] for w in want})
    assert kept.columns == frame(spark, []).columns


def test_exact_dedup_repeated_rows_and_null_ids(spark):
    docs = frame(spark, ["t", "t", "t", "u"], [5, 5, None, None])
    rows = exact_dedup.mark_exact_duplicates(docs).collect()
    assert sum(r.kept for r in rows if r.group_size == 3) == 1 and {r.keep_id for r in rows} == {5, None}
    assert sorted((r.doc_id or 0) for r in exact_dedup.drop_exact_duplicates(docs).collect()) == [0, 5]
    assert exact_dedup.drop_exact_duplicates(frame(spark, [])).count() == 0


def test_one_id_with_most_rows_is_settled_before_the_shuffle(spark):
    docs = spark.range(4000).selectExpr("if(id % 3 > 0, 7, id) AS doc_id", "if(id % 3 > 0, 'hot  text', 'text ' || id) AS text",
                                        "id AS extra").unionByName(spark.sql("SELECT 9L doc_id, 'hottext' text, 0L extra"))
    kept = exact_dedup.drop_exact_duplicates(docs)
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == sorted([7, *range(0, 4000, 3)]) and kept.columns == docs.columns
    assert [r.text for r in rows if r.doc_id == 7] == ["hot  text"]
    nulls = spark.range(600).selectExpr("if(id % 2 = 0, null, 0L) AS doc_id", "'a' || (id % 100) AS text")
    assert collections.Counter(r.doc_id for r in exact_dedup.drop_exact_duplicates(nulls, heavy=2).collect()) == {0: 50, None: 50}


def test_texts_move_once(spark):
    docs = frame(spark, ["text %d" % (i % 30) for i in range(50)])
    weights = spark.range(50).selectExpr("id AS doc_id", "1.0 AS weight")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # nothing is small enough, as on large tables
    try:
        plan = exact_dedup.drop_exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
        # heavy rows combined, the others dealt by their key; the other two deal the groups' keys and winners
        assert sum(" Exchange " in line for line in plan.splitlines()) == 4 and plan.count("BroadcastHashJoin") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = mixing.mix_documents(docs, weights)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if " Exchange " in line]
    assert len(dealt) == 2 and all("_x4_id" in d or "_x4_weight_id" in d for d in dealt) and "Window" not in plan


def test_misra_gries_bounds():
    rng = random.Random(1)
    data = [b"hot"] * 400 + [b"%d" % rng.randrange(300) for _ in range(600)]
    rng.shuffle(data)
    kept = exact_dedup.misra_gries(iter(data), 9)
    assert 400 - 1000 / 10 <= kept[b"hot"] <= 400 and len(kept) <= 9


def targets(sizes, epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(epochs * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] / w > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in full else rest * weight[s] / w for s in names}
        full |= over


def test_mixing_targets_epochs_and_order(spark):
    rng = random.Random(4)
    rows = [(i, None if i % 17 == 0 else " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60))),
             rng.choice(["b", "a", None, "é", "tiny", "B"]) if i > 3 else "tiny", i % 3) for i in range(400)]
    rows = [r for r in rows if r[2] != "tiny" or r[0] < 12]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    weights = spark.createDataFrame([(r[0], None if r[0] % 5 == 0 else r[0] % 4 / 2) for r in rows], "doc_id long, weight double")
    out = mixing.mix_sources(docs, weights).collect()
    again = mixing.mix_sources(docs.repartition(7), weights).collect()
    assert {(r.doc_id, r.taken) for r in out} == {(r.doc_id, r.taken) for r in again} and len(out) == len(rows)
    sizes = collections.Counter({s: 0 for s in {r[2] for r in rows}})
    for _, t, s, _ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    taken = collections.Counter()
    for r in out:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-5)
        assert r.taken // max(r.size, 1) >= int(want[r.source] / sizes[r.source]) or r.size == 0  # whole epochs first
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_the_mix_repeats_and_cuts_texts(spark):
    rows = [(i, f" a{i}\tb  c{i} d\n" + "long " * 7 * (i % 4) if i % 5 else None, "x" if i < 40 else "y", "old") for i in range(43)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, repeats string")
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect()}
    out = mixing.mix_documents(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken", "repeats", "first_words"]
    cut = 0
    for r in out.collect():
        whole = rows[r.doc_id][1] or ""
        words = len((r.text or "").split()) * r.repeats + len((r.first_words or "").split())
        assert r.taken == taken[r.doc_id] == words
        assert r.text == (whole if r.repeats else None) and whole.startswith(r.first_words or "")
        cut += r.first_words is not None
    kept = [r for r in out.collect() if r.taken]
    assert len(kept) < len(rows) and any(r.repeats > 1 for r in kept) and 0 < cut <= 2


def test_equal_rows_at_the_cut_share_what_is_left(spark):
    rows = [(5, "one two three", "a")] * 90 + [(i, "w " * (i % 6), "b" if i % 2 else "a") for i in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(docs).collect()
    taken, target = collections.Counter(), {r.source: r.target for r in out}
    for r in out:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert len({r.taken for r in out if r.doc_id == 5}) == 1 and len(out) == len(rows)
    assert all(0 <= round(target[s]) - taken[s] < 90 for s in target)
    mixed = mixing.mix_documents(docs.repartition(5))
    assert sorted((r.doc_id, r.taken) for r in mixed.collect()) == sorted((r.doc_id, r.taken) for r in out)


def test_heavier_documents_come_more_often(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'one two' AS text", "if(id < 1500, 'a', 'b') AS source")
    weights = docs.selectExpr("doc_id", "if(doc_id % 2 = 0, 1.0, 0.25) AS weight")
    got = mixing.mix_sources(docs, weights).where("source = 'a'").groupBy((mixing.F.col("doc_id") % 2).alias("odd")).sum("taken").collect()
    by = {r[0]: r[1] for r in got}
    assert by[0] > 1.4 * by[1]  # the target of the first source is 2/3 of its size
    assert mixing.mix_sources(frame(spark, [])).count() == 0


ITEMS = [(1, "What is the tall red tower of Gavorn made from? It is made of old copper plates."),
         (2, "Question: who wrote the seven songs about rivers and salt? Answer: Marla Ketting wrote them in spring."),
         (3, "Zor"), (4, None), (5, ""), (6, " ".join("term%d" % i for i in range(200)))]


def test_leaks_are_found_and_clean_texts_are_not(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    noise = lambda k, n: " ".join("noise%d" % ((k * 31 + i * 7) % 400) for i in range(n))
    texts = [None, "", noise(1, 500), f"{noise(2, 333)} {ITEMS[0][1].upper()} {noise(3, 900)}",
             noise(4, 5) + " " + ITEMS[1][1].replace(" ", "*** ") + noise(5, 70), ITEMS[5][1],
             "What is the tall red tower of Gavorn made from? Nobody knows that today.",  # a question without its answer
             "the old plates are made of copper", noise(6, 9) + " It is made of old copper plates."]
    rows = decontaminate.find_leaks(frame(spark, texts), items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(3, 1), (4, 2), (5, 6)}
    assert [r for r in rows if r.score < 0.99 or r.question_overlap < 1 or r.answer_overlap < 1] == []
    kept = decontaminate.drop_contaminated(frame(spark, texts), items)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 6, 7, 8] and kept.columns == frame(spark, []).columns
    assert decontaminate.find_leaks(frame(spark, texts), items.limit(0)).count() == 0
    assert decontaminate.find_leaks(frame(spark, []), items).count() == 0


def test_a_long_item_does_not_widen_the_passages_of_short_ones(spark, monkeypatch):
    short = "Who keeps the brass lantern of Velm? The old ferry woman Tarn keeps it."
    long = " ".join("long%d" % i for i in range(4000))
    ws = decontaminate.words(short)
    noise = lambda k, n: " ".join("noise%d" % ((k * 37 + i * 11) % 900) for i in range(n))
    scattered = " ".join(b" ".join(ws[i:i + 3]).decode() + " " + noise(i, 400) for i in range(0, len(ws), 2))
    texts = [scattered, noise(1, 70) + " " + short + " " + noise(2, 70), noise(3, 50) + " " + long]
    one = spark.createDataFrame([(1, short)], "item_id long, text string")
    both = spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame(spark, texts), one).collect()} == {(1, 1)}
    for limit in (100_000, 2_000):  # both classes in one bundle, then several shards
        monkeypatch.setattr(decontaminate, "SHARD_POSTINGS", limit)
        assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame(spark, texts), both).collect()} == {(1, 1), (2, 2)}
        assert [r.doc_id for r in decontaminate.drop_contaminated(frame(spark, texts), both).collect()] == [0]


def test_shards_agree_with_one_index(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"Question {i}: which {i * 7} stones lie by gate {i}? Answer: the {i * 3} grey ones of {i}.")
                                   for i in range(40)], "item_id long, text string")
    docs = frame(spark, [f"words before {r.text} and after" for r in items.collect()])
    key = lambda r: (r.doc_id, r.item_id, r.passage_start, round(r.score, 9))
    whole = sorted(map(key, decontaminate.find_leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "SHARD_POSTINGS", 150)
    cut = sorted(map(key, decontaminate.find_leaks(docs, items).collect()))
    assert whole == cut and {(k, k) for k in range(40)} <= {r[:2] for r in cut}


def test_bundles_hold_every_part_within_the_limit():
    sizes = [(5, 30), (6, 250), (7, 40), (9, 100)]
    got = decontaminate.bundles(sizes, 100)
    assert [p for b in got for p in b] == [(5, 0, 1), (6, 0, 3), (6, 1, 3), (6, 2, 3), (7, 0, 1), (9, 0, 1)]
    assert all(sum(dict(sizes)[c] / parts for c, _, parts in b) <= 100 for b in got) and decontaminate.bundles([], 100) == []


def test_block_max_wand_equals_exhaustive_scoring(spark, monkeypatch):
    rng = random.Random(7)
    vocabulary = ["w%d" % int(rng.paretovariate(0.6)) for _ in range(3000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 40)))) for i in range(120)]
    rows = decontaminate.postings(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").collect()
    shard = decontaminate.Shard.build(rows, 3)
    impact = collections.defaultdict(dict)
    for r in rows:
        impact[r.item_id, r.body][r.term] = r.impact
    number = {key: k for k, key in enumerate(dict.fromkeys((r.item_id, r.body) for r in rows))}
    assert all(abs(sum(v.values()) - 1) < 1e-9 for v in impact.values())
    step, hits = 40, 0
    for _ in range(60):
        ws = [rng.choice(vocabulary) for _ in range(rng.randint(0, 300))]
        if rng.random() < 0.7:
            ws[10:10] = rng.choice(items)[1].split()
        got = {(p, i): s for p, i, s in shard.search([w.encode() for w in ws], step, 0.4)}
        want = {}
        for p in range(max(1, -(-len(ws) // step) - 1)):
            terms = set(ws[p * step:(p + 2) * step])
            for key, scores in impact.items():
                total = sum(v for t, v in scores.items() if t in terms)
                if total >= 0.4:
                    want[p, number[key]] = total
        assert got.keys() == {k for k, v in want.items()} and all(abs(got[k] - want[k]) < 1e-9 for k in got)
        hits += len(got)
    assert hits > 40


def test_the_least_long_is_an_id_like_others(spark):
    rows = exact_dedup.mark_exact_duplicates(frame(spark, ["a b", "ab ", "x"], [7, -2 ** 63, 2 ** 63 - 1])).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in rows} == {
        (7, -2 ** 63, False), (-2 ** 63, -2 ** 63, True), (2 ** 63 - 1, 2 ** 63 - 1, True)}
