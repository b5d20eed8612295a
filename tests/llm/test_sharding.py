import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import sharding
from llm.helpers import frame


def checked(rows, texts, n_shards):
    """What holds for every result; gives the sizes of the shards."""
    assert len(rows) == len(texts)
    slots, sizes = defaultdict(list), np.zeros(n_shards)
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 16, zlib.crc32(body), "bytes", None)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert set(slots) <= set(range(n_shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def by_hand(loads, n_shards):
    """The greedy placement, step by step."""
    room, out = [[1.0] * len(loads[0]) for _ in range(n_shards)], {}
    for i in sorted(range(len(loads)), key=lambda i: (-max(loads[i]), i)):
        products = [sum(r * v for r, v in zip(room[s], loads[i])) for s in range(n_shards)]
        fitting = [s for s in range(n_shards) if all(v <= r for r, v in zip(room[s], loads[i]))]
        if fitting:
            out[i] = max(fitting, key=lambda s: (products[s], -s))
        else:
            out[i] = max(range(n_shards), key=lambda s: (room[s][0], -s))
        room[out[i]] = [r - v for r, v in zip(room[out[i]], loads[i])]
    return [out[i] for i in range(len(loads))]


@pytest.mark.parametrize("seed", range(5))
def test_placement_by_the_highest_dot_product(seed):
    loads = np.random.default_rng(seed).integers(1, 64, (60, 3)) / 512  # exact in binary, so ties are ties
    assert sharding.place(loads, 7).tolist() == by_hand(loads.tolist(), 7)


def test_groups_stay_together_and_shards_are_level(spark):
    rng = np.random.default_rng(1)
    texts = ["w" * int(rng.integers(1, 400)) + f" {i}" for i in range(900)]
    texts += [f"copied text {k} " * 9 for k in range(12) for _ in range(8)] + ["", None, " "]
    rows = sharding.assign_shards(frame(spark, texts), n_shards=8).collect()
    sizes = checked(rows, texts, 8)
    assert sizes.max() < 1.02 * sizes.mean() and sizes.min() > 0.98 * sizes.mean()
    where = defaultdict(set)
    for r in rows:
        where[texts[r.doc_id] or ""].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    n = np.bincount([r.shard for r in rows])
    assert n.max() < 1.15 * n.mean()  # rows are levelled too


@pytest.mark.parametrize("parts", [sharding.PARTS, 4])
def test_a_group_of_a_third_of_the_rows_is_cut_into_equal_pieces(spark, monkeypatch, parts):
    monkeypatch.setattr(sharding, "PARTS", parts)  # few parts: small groups travel in bundles
    texts = ["the same text in many rows " * 4] * 1000 + [f"text number {i} of its own " * 4 for i in range(2000)]
    rows = sharding.assign_shards(frame(spark, texts).repartition(9), n_shards=10).collect()
    sizes = checked(rows, texts, 10)
    assert sizes.max() < 1.05 * sizes.mean()
    copies = np.bincount([r.shard for r in rows if r.doc_id < 1000])
    copies = copies[copies > 0]
    assert len(copies) <= 4 and copies.max() - copies.min() <= 1


def test_reruns_and_partitions_give_the_same_shards(spark):
    texts = [f"text {i % 40} " * (1 + i % 13) for i in range(400)]
    one = sharding.assign_shards(frame(spark, texts).coalesce(1), 6).select("doc_id", "shard", "slot")
    many = sharding.assign_shards(frame(spark, texts).repartition(11), 6).select("doc_id", "shard", "slot")
    assert one.exceptAll(many).count() == 0


def test_odd_tables(spark):
    assert sharding.assign_shards(frame(spark, []), 5).count() == 0
    one = sharding.assign_shards(frame(spark, ["x"] * 6, ids=[None, None, 1, 1, 2, -2 ** 63]), 2)
    assert one.columns == ["doc_id", "text", "lang", "source", "n_chars", "_doc", *sharding.RESULT]
    assert sorted((r["shard"], r["slot"]) for r in one.collect()) == [(s, k) for s in (0, 1) for k in range(3)]
    clash = frame(spark, ["a b", "c"]).withColumn("shard", F.lit("old")).withColumn("size", F.lit(-1.5)).withColumn("rows", F.lit(1))
    got = sharding.assign_shards(clash, 2)
    assert dict(got.dtypes)["shard"] == "int" and got.columns.count("size") == 1 and "rows" in got.columns
    long = sharding.assign_shards(frame(spark, ["word " * 200_000, "a", "b"]), 3).collect()
    assert len({r["shard"] for r in long}) >= 2


def test_written_shards_hold_their_slots_in_order(spark, tmp_path):
    texts = [f"text {i}" for i in range(50)]
    sharding.write_shards(frame(spark, texts), str(tmp_path / "shards"), n_shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.text for r in back.collect()) == sorted(texts)
    assert back.groupBy("shard").agg((F.max("slot") + 1 == F.count("*")).alias("ok")).where("ok").count() == 4
