"""The n-gram Jaccard join against brute force."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.helpers import frame
from stratus.llm import jaccard_join
from stratus.llm.common import saved
from stratus.llm.components import components


def brute(texts, ids, n, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
                links += sets[i] != sets[j]
    return {(ids[i], len(s), ids[find(i)]) for i, s in enumerate(sets)}, links


def edited(rng, words, share):
    out = list(words)
    for _ in range(int(share * len(out))):
        k = rng.randrange(len(out) + 1)
        kind = rng.random()
        if kind < 0.4 and out:
            out.pop(min(k, len(out) - 1))
        elif kind < 0.8:
            out.insert(k, rng.choice("pqrstuv") * rng.randint(1, 4))
        elif out:
            out[min(k, len(out) - 1)] = "edit%d" % rng.randrange(50)
    return out


@pytest.mark.parametrize("n, percent, group", [(3, 90, 1 << 16), (5, 80, 300), (1, 60, 1 << 16)])
def test_components_equal_brute_force(spark, monkeypatch, n, percent, group):
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    monkeypatch.setattr(jaccard_join, "ORDERED", 4 if group == 300 else 1 << 15)
    rng = random.Random(n)
    texts = [None, "", "  \t", "One", "one", "two words", "TWO words", "É é"]
    for _ in range(30):
        base = ["w%d" % rng.randrange(3000) for _ in range(rng.choice([4, 12, 30, 80, 200, 500]))]
        for _ in range(rng.randint(1, 7)):  # chains of edits reach beyond the threshold
            texts.append(" ".join(base))
            base = edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.05]))
    shared = ["common%d" % i for i in range(60)]
    texts += [" ".join(shared + ["own%d_%d" % (k, i) for i in range(rng.randint(5, 90))]) for k in range(25)]
    ids = rng.sample(range(10_000), len(texts))
    got = {tuple(r) for r in jaccard_join.jaccard_components(frame(spark, texts, ids), n, percent).collect()}
    want, links = brute(texts, ids, n, percent)
    assert got == want and links > 20


def test_null_ids_and_empty_table(spark):
    rows = jaccard_join.jaccard_components(frame(spark, ["a b c d", "a b c d", "x"], [None, 7, 7]), 3, 90).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows) == [(0, 2, 0), (7, 1, 7), (7, 2, 7)]
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0


def test_one_document_of_each_group_stays(spark):
    words = " ".join("w%d" % i for i in range(200))
    docs = frame(spark, [words, words + " more", "other text here", None], [4, 2, 3, None])
    kept = jaccard_join.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(200, 240)] + [(7, 7), (300, 301), (301, 300)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert all(got[i] == 0 for i in range(41)) and got[220] == 100 and got[301] == 300
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_signatures_meet_at_the_threshold():
    rng = np.random.default_rng(4)
    for size in (12, 25, 60, 200, 900, 3000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            change = int(len(a) * 0.1 / 1.9)  # as many tokens replaced as 0.9 allows
            b = np.unique(np.concatenate([a[change:], rng.integers(0, 1 << 63, change, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            assert 100 * both >= 90 * (len(a) + len(b) - both)
            assert np.intersect1d(jaccard_join.signatures(a, 90), jaccard_join.signatures(b, 90)).size


def as_group(leader, sets, labels, percent):
    rows = []
    for x, label in zip(sets, labels):
        _, lacking, apart = jaccard_join.apart_tokens(x, leader, percent)
        rows.append({"label": label, "size": len(x), "lacking": lacking, "apart": apart.view(np.int64).tolist()})
    kind = pa.list_(pa.struct([("label", pa.int64()), ("size", pa.int64()), ("lacking", pa.int64()), ("apart", pa.list_(pa.int64()))]))
    return jaccard_join.Group(pa.array([rows], kind)[0])


@pytest.mark.parametrize("percent, columns", [(60, 2048), (80, 5), (90, 2048)])
def test_an_opened_group_gives_all_links_between_labels(monkeypatch, percent, columns):
    """Random families about a leader: the links found are those of comparing every two sets."""
    monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
    rng = np.random.default_rng(percent)
    met = opened = 0
    for _ in range(60):
        base = rng.integers(0, 1 << 63, rng.integers(5, 120), dtype=np.uint64)

        def variant(of):
            keep = of[rng.random(len(of)) > rng.choice([0, 0.03, 0.1, 0.3])]
            return np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, rng.integers(1, 8), dtype=np.uint64)]))

        leader = variant(base)
        sets = [variant(base)]
        while len(sets) < 14:
            sets.append(variant(sets[rng.integers(0, len(sets))] if rng.random() < 0.7 else base))
        labels = [int(k) for k in rng.integers(0, 9, len(sets))]
        query, group = (as_group(leader, sets[a], labels[a], percent) for a in (slice(0, 6), slice(6, 14)))
        got = jaccard_join.linked_labels(query, group, len(leader), percent)
        want = set()
        for i in range(6):
            for j in range(6, 14):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and labels[i] != labels[j]:
                    want.add((min(labels[i], labels[j]), max(labels[i], labels[j])))
        assert {tuple(map(int, p)) for p in got} == want
        met, opened = met + bool(want), opened + 1
    assert met > 10


def test_a_group_that_no_query_reaches_is_not_opened():
    leader = np.arange(100, dtype=np.uint64)
    near, far = np.arange(20, 100, dtype=np.uint64), np.arange(80, dtype=np.uint64)
    query, group = as_group(leader, [near], [1], 80), as_group(leader, [far], [2], 80)
    assert not len(jaccard_join.linked_labels(query, group, 100, 80))
    assert len(jaccard_join.linked_labels(query, as_group(leader, [near[1:]], [2], 80), 100, 80)) == 1


@pytest.mark.parametrize("own", [6, 9, 14])
def test_a_passage_in_all_documents_opens_no_more_than_rows(spark, monkeypatch, own):
    """One passage of 60 words everywhere: rows that the join makes grow about as the documents."""
    made = []
    keep = jaccard_join.saved

    def counted(df, name, **options):
        out = keep(df, name, **options)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(jaccard_join, "saved", counted)
    passage = " ".join("common%d" % i for i in range(60))
    most = {}
    for size in (400, 1600):
        made.clear()
        texts = [passage + " " + " ".join("own%d_%d" % (k, i) for i in range(own)) for k in range(size)]
        rows = jaccard_join.jaccard_components(frame(spark, texts), 5, 80).collect()
        both, union = 56, 56 + 2 * own
        assert len({r.component_id for r in rows}) == (1 if 100 * both >= 80 * union else size)
        most[size] = max(n for name, n in made if name in ("stars", "compared", "groups", "label-links"))
    assert most[1600] <= 5 * max(most[400], 1)


def test_members_of_one_leader_are_dealt_to_several_tasks(spark, monkeypatch):
    """One passage everywhere, so one leader: its members meet in one task no more than ``ORDERED`` at a time."""
    tasks = []
    keep = jaccard_join.saved

    def dealt(df, name, **options):
        if name == "groups":
            salts = df.groupBy(F.spark_partition_id().alias("task"), "v").agg(F.countDistinct("open", "salt").alias("n"))
            tasks.extend(salts.collect())
        return keep(df, name, **options)

    monkeypatch.setattr(jaccard_join, "saved", dealt)
    monkeypatch.setattr(jaccard_join, "ORDERED", 20)
    passage = " ".join("common%d" % i for i in range(60))
    texts = [passage + " " + " ".join("own%d_%d" % (k, i) for i in range(9)) for k in range(400)]
    # the members are dealt by their leader for the first join, labels are few enough to be broadcast
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "6k"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = jaccard_join.jaccard_components(frame(spark, texts), 5, 80).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len({r.component_id for r in rows}) == 400
    assert len({r.v for r in tasks}) == 1 and len(tasks) > 1 and sum(r.n for r in tasks) >= 20


@pytest.mark.parametrize("size", [400, 1600])
def test_buckets_of_one_passage_have_one_leader(spark, size):
    """Nodes of many shared buckets: every one is compared with one leader, not with one for each bucket's first node."""
    passage = " ".join("common%d" % i for i in range(60))
    rows = []
    for k in range(size):
        text = passage + " " + " ".join("own%d_%d" % (k, i) for i in range(9))
        rows += [(int(sign), k) for sign in jaccard_join.signatures(jaccard_join.shingles(text.encode(), 5), 80)]
    stars = jaccard_join._stars(spark.createDataFrame(rows, "sign long, node long")).collect()
    assert len(stars) == size - 1 and len({r.v for r in stars}) == 1


def test_all_nodes_of_a_bucket_have_one_leader(spark):
    """Chains of buckets: the nodes of a bucket share a leader, or one of them is the leader of the rest."""
    rng = random.Random(4)
    rows = sorted({(rng.randrange(60), rng.randrange(80)) for _ in range(200)})
    stars = jaccard_join._stars(spark.createDataFrame(rows, "sign long, node long")).collect()
    leaders = {}
    for r in stars:
        leaders.setdefault(r.u, set()).add(r.v)
    for sign in range(60):
        nodes = [n for s, n in rows if s == sign]
        if len(nodes) > 1:
            assert set.intersection(*({n} | leaders.get(n, set()) for n in nodes))


def test_components_over_many_tiles_equal_brute_force(spark, monkeypatch):
    """A leader's groups in several tiles and salts: open and other members, and members of one another."""
    monkeypatch.setattr(jaccard_join, "GROUP", 300)
    monkeypatch.setattr(jaccard_join, "TILE", 600)
    monkeypatch.setattr(jaccard_join, "ORDERED", 12)
    rng = random.Random(8)
    shared = ["common%d" % i for i in range(60)]
    texts = [" ".join(shared + ["own%d_%d" % (k % 25, i) for i in range(k % 25)] + ["x%d" % (k // 25)]) for k in range(75)]
    texts += [" ".join(edited(rng, t.split(), 0.02)) for t in texts]
    ids = rng.sample(range(10_000), len(texts))
    got = {tuple(r) for r in jaccard_join.jaccard_components(frame(spark, texts, ids), 5, 80).collect()}
    want, links = brute(texts, ids, 5, 80)
    assert got == want and links > 20 and len({c for _, _, c in want}) > 3


def test_groups_travel_about_as_often_as_there_are_documents(spark, monkeypatch, tmp_path):
    """One passage everywhere, all members open: a group isn't sent to a task for each other group."""
    keep, path = jaccard_join.Group.__init__, str(tmp_path / "made")

    def counted(self, *members):
        with open(path, "ab") as f:
            f.write(b"x")
        keep(self, *members)

    monkeypatch.setattr(jaccard_join.Group, "__init__", counted)
    monkeypatch.setattr(jaccard_join, "GROUP", 1000)
    passage = " ".join("common%d" % i for i in range(60))
    made = {}
    for size in (400, 1600):
        open(path, "wb").close()
        texts = [passage + " " + " ".join("own%d_%d" % (k, i) for i in range(9)) for k in range(size)]
        assert len({r.component_id for r in jaccard_join.jaccard_components(frame(spark, texts), 5, 80).collect()}) == size
        with open(path, "rb") as f:
            made[size] = len(f.read())
    assert 10 < made[400] and made[1600] <= 5 * made[400]


def test_members_parted_by_their_leader_share_the_same_tokens():
    """Bits and extra tokens stand for the apart tokens: any two members share as many, and find the same links."""
    rng = np.random.default_rng(6)
    for size in (1, 8, 40, 300):
        leader = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        pool = np.unique(rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        sets = [np.unique(np.concatenate([leader[rng.random(len(leader)) > 0.1], pool[rng.random(len(pool)) < 0.1]])) for _ in range(30)]
        rows = []
        for k, member in enumerate(sets):
            _, lacking, apart = jaccard_join.apart_tokens(member, leader, 80)
            lost, extra = jaccard_join.parted(apart, leader)
            rows.append({"label": k, "size": len(member), "lacking": lacking, "lost": lost, "extra": extra.view(np.int64).tolist()})
        kind = pa.list_(pa.struct([("label", pa.int64()), ("size", pa.int64()), ("lacking", pa.int64()), ("lost", pa.binary()),
                                   ("extra", pa.list_(pa.int64()))]))
        got = [jaccard_join.Group(pa.array([rows[a]], kind)[0], len(leader)) for a in (slice(0, 12), slice(12, 30))]
        want = [as_group(leader, sets[a], range(30)[a], 80) for a in (slice(0, 12), slice(12, 30))]
        assert all(sorted(np.bincount(x.owner)) == sorted(np.bincount(y.owner)) for x, y in zip(got, want))
        assert (jaccard_join.linked_labels(*got, len(leader), 80) == jaccard_join.linked_labels(*want, len(leader), 80)).all()


def test_a_forest_joins_what_the_links_join():
    rng = np.random.default_rng(2)
    for count in (0, 1, 30, 200):
        links = rng.integers(-50, 50, (count, 2))
        least = {int(k): int(k) for k in links.ravel()}
        for _ in range(100):
            for x, y in links.tolist():
                least[x] = least[y] = min(least[x], least[y])
        assert dict(jaccard_join.forest(links).tolist()) == {x: y for x, y in least.items() if x != y}


def test_shuffle_files_go_with_the_step_that_wrote_them(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {p for p in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in p}
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    set_before = spark.conf.get(key, None)
    out = saved(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "counts")
    for _ in range(50):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert out.count() == 100 and spark.conf.get(key, None) == set_before
