"""N-gram Jaccard join with a token-group matrix.

Links documents whose sets of word n-grams have a Jaccard similarity of ``percent`` / 100
or more, and gives every document the smallest id it reaches through links.

1. Equal sets are one *node*, known by the smallest id among them; copies go no further.
2. Seeds. The tokens of a set are dealt by hash into as many parts as a similar set may
   differ in tokens, and one more: linked sets agree on a whole part. The content of a part
   with the size class is a signature; nodes that share none are not linked. Some four to
   ten tokens make a part, so a passage that many documents share makes no seed.
   A set emits at most ``PARTS`` parts a class and no empty part. Parts are dealt at random,
   a third of them stays untouched even at the threshold, and small sets are dealt
   ``families`` times, so that the chance to miss a link just at the threshold is at most 1.6e-9
   (sets of 9 and 11 tokens at 80 percent), and vanishes above it.
3. Groups. The nodes of a seed's bucket are similar sets about a leader ``L``. The first node of a bucket is
   the one that stands in most buckets; ``L`` is the first of the firsts of that node's own buckets, so that buckets
   of one passage have one leader, who needn't be in all of them. Every member is compared with the leader; linked
   members get one component label.
4. Token-group matrix. Members that are not linked to their leader are *open* and may be linked to others of
   its group. Tokens in which a member and the leader differ are *apart*; ``x, y`` share exactly
   ``|L| - |lacking x| - |lacking y| + |apart x & apart y|`` tokens. The members are parted, similar ones
   together, into groups of some ``GROUP`` apart tokens, and every group stores the union of its apart tokens.
   Open members query the groups: the overlap with a group's union bounds the overlap with each of its members, and only
   groups that some query may be linked to are opened. In an opened group all overlaps come from
   one product of 0/1 matrices over the tokens that both sides hold, so they are exact and no pair
   of members becomes a row. Groups travel in tiles of some ``TILE`` apart tokens, once for each pair of tiles; a leader of
   no more than a tile, so most of them, has one for all. Members linked to the leader go by its name, and of the links found
   in a pair of tiles those of a spanning forest go on.

Every link comes from an exact comparison of the two sets. Words are parted by the space and
09-0D and A-Z is lower-cased; a text of fewer than ``n`` words is one n-gram.

Defined results: null, empty and blank texts have empty sets and no links. Rows of one id are
one document. A null id can't name a link: its row has a null component. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm import repeats, winnow
from stratus.llm.common import discard, saved
from stratus.llm.components import components

#: Parts of a set that are emitted as signatures, per size class.
PARTS = 96
#: Apart tokens of a group of the matrix (a member counts as 64 more); a group is one row.
GROUP = 1 << 16
#: Apart tokens (and 64 for a member) of a tile, the groups that travel together. A task holds two tiles at a time.
TILE = 1 << 20
#: Members of a leader that are put in order together before they are cut into groups.
ORDERED = 1 << 15
#: About the chance to miss a link at the threshold: families are added until an estimate is below this.
MISS = 1e-9


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams."""
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, text.lower().split()), np.uint64)
    if not len(words):
        return words
    return np.unique(winnow.FIRST.every(winnow.FIRST.prefix(words), min(n, len(words))))


def size_class(size: int, percent: int) -> tuple[int, int]:
    """Least and greatest size of the class of a size; greatest is what a set linked to the least may have."""
    low = 1
    while (high := low * 100 // percent) < size:
        low = high + 1
    return low, high


def dealing(low: int, high: int, percent: int) -> tuple[int, int]:
    """Parts and families of a size class."""
    parts = 2 * high * (100 - percent) // (100 + percent) + 1
    if parts == 1:
        return 1, 0  # different sets of these sizes can't be linked
    one_left = min(1.0, parts / math.e * (1 - 1 / math.e) ** (parts - 1)) * math.exp(-low / parts)
    return parts, 1 if one_left <= MISS else math.ceil(math.log(MISS) / math.log(one_left))


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    size, out = len(tokens), []
    if not size:
        return np.zeros(0, np.int64)
    low, high = size_class(size, percent)
    above = size_class(high + 1, percent)
    for low, high in [(low, high)] + [above] * (size * 100 // percent >= above[0]):
        parts, families = dealing(low, high, percent)
        for family in range(families):
            h = winnow.mixed(tokens + np.uint64(0x9E3779B97F4A7C15 * (family + 1) % (1 << 64)))
            part = h % np.uint64(parts)
            if parts > PARTS:
                h, part = h[part < PARTS], part[part < PARTS]
            order = np.argsort(part, kind="stable")
            part = part[order]
            starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(part)), bool), part[1:] != part[:-1]]))
            if len(starts):
                content = np.add.reduceat(winnow.mixed(h[order] + np.uint64(1)), starts)
                place = part[starts] * np.uint64(64) + np.uint64(family)
                out.append(winnow.mixed(content + winnow.mixed(place + np.uint64(high << 32))).view(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _sets(texts: DataFrame, n: int, percent: int) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, one, two, signs = [], [], [], []
            for body in batch.column(2):
                tokens = shingles(body.as_py(), n)
                size.append(len(tokens))
                one.append(winnow.mixed(tokens + np.uint64(3)).sum(dtype=np.uint64).view(np.int64))
                two.append(winnow.mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))
                signs.append(signatures(tokens, percent))
            ends = np.cumsum([0, *map(len, signs)], dtype=np.int32)
            yield pa.record_batch([batch.column(0), pa.array(size, pa.int64()), pa.array(one, pa.int64()),
                                   pa.array(two, pa.int64()),
                                   pa.ListArray.from_arrays(ends, np.concatenate([*signs, np.zeros(0, np.int64)]))],
                                  names=["doc", "size", "set1", "set2", "signs"])

    return texts.mapInArrow(step, "doc long, size long, set1 long, set2 long, signs array<long>")


def apart_tokens(member: np.ndarray, leader: np.ndarray, percent: int) -> tuple[bool, int, np.ndarray]:
    """Whether the two sets are linked, how many tokens of the leader the member lacks, and the tokens of only one."""
    both = len(np.intersect1d(member, leader, assume_unique=True))
    linked = 100 * both >= percent * (len(member) + len(leader) - both)
    return linked, len(leader) - both, np.setxor1d(member, leader, assume_unique=True)


def parted(apart: np.ndarray, leader: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Apart tokens as a bit for each token of the leader, set if the member lacks it, and the tokens that only the member has.

    Bits, as most members of a leader that lack some of its own tokens lack many, at 64 bits each otherwise.
    """
    at = np.minimum(np.searchsorted(leader, apart), len(leader) - 1)
    lost = leader[at] == apart
    bits = np.zeros(len(leader), bool)
    bits[at[lost]] = True
    return np.packbits(bits).tobytes(), apart[~lost]


def _compared(stars: DataFrame, bodies: DataFrame, n: int, percent: int) -> DataFrame:
    """Members ``u`` and leaders ``v`` compared by their whole sets: ``linked``, the sizes ``size, top`` of member and
    leader, ``lacking``, the tokens apart as ``lost, extra`` (see ``parted``), and the ``least`` of them.
    ``salt``: the members are dealt into ``salts`` shares of some ``ORDERED``."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            facts, extra, lost, least = [], [], [], []
            for x, y in zip(batch.column(4), batch.column(5)):
                member, leader = (shingles(z.decompress(t.as_py()), n) for t in (x, y))
                linked, lacking, tokens = apart_tokens(member, leader, percent)
                facts.append((linked, len(member), len(leader), lacking))
                least.append(int(tokens.view(np.int64).min()) if len(tokens) else None)
                bits, tokens = parted(tokens, leader)
                lost.append(bits)
                extra.append(tokens.view(np.int64))
            ends = np.cumsum([0, *map(len, extra)], dtype=np.int32)
            yield pa.record_batch([*batch.columns[:4], pa.array([f[0] for f in facts], pa.bool_()),
                                   *(pa.array([f[k] for f in facts], pa.int64()) for k in (1, 2, 3)),
                                   pa.ListArray.from_arrays(ends, np.concatenate([*extra, np.zeros(0, np.int64)])),
                                   pa.array(lost, pa.binary()), pa.array(least, pa.int64())],
                                  names=["u", "v", "salt", "salts", "linked", "size", "top", "lacking", "extra", "lost", "least"])

    def body(name: str) -> DataFrame:
        return bodies.select(F.col("doc").alias(name), F.col("body").alias(f"{name}_body"))

    salts = stars.groupBy("v").agg(F.ceil(F.count("*") / ORDERED).alias("salts"))
    dealt = stars.join(salts, "v").withColumn("salt", F.pmod(F.xxhash64("u"), "salts"))
    return (dealt.join(body("u"), "u").join(body("v"), "v").select("u", "v", "salt", "salts", "u_body", "v_body")
            .mapInArrow(step, "u long, v long, salt long, salts long, linked boolean, size long, top long, lacking long, "
                              "extra array<long>, lost binary, least long"))


class Group:
    """Members of a group of the matrix: labels, sizes, numbers of lacking tokens, and apart tokens end to end.

    The members bring their ``apart`` tokens, or ``lost`` and ``extra`` ones about a leader of ``top`` tokens; then a token
    that the leader has goes by its place there, for all members alike.
    """

    def __init__(self, members: pa.StructScalar, top: int | None = None):
        rows = members.values
        self.label, self.size, self.lacking = (rows.field(c).to_numpy() for c in ("label", "size", "lacking"))
        lists = rows.field("apart" if top is None else "extra")
        self.tokens = lists.flatten().to_numpy()
        self.owner = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy()))
        if top is not None:
            bits = np.frombuffer(b"".join(rows.field("lost").to_pylist()), np.uint8).reshape(len(rows), -1)
            owner, place = np.nonzero(np.unpackbits(bits, axis=1, count=top))
            self.tokens, self.owner = np.concatenate([place, self.tokens]), np.concatenate([owner, self.owner])

    @cached_property
    def union(self) -> np.ndarray:
        return np.unique(self.tokens)

    def only(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the members to keep, and their owners."""
        some = keep[self.owner]
        return self.tokens[some], self.owner[some]


#: Columns of the matrices that are multiplied at once.
COLUMNS = 2048


def linked_labels(query: Group, group: Group, top: int, percent: int) -> np.ndarray:
    """Pairs of component labels that a link between a query and a member of the group joins (two columns)."""
    none = np.zeros((0, 2), np.int64)
    if len(query.label) == 0 or query.label.min() == query.label.max() == group.label.min() == group.label.max():
        return none
    # the bound by the group's union
    union = group.union
    met = np.isin(query.tokens, union)
    met = np.bincount(query.owner[met], minlength=len(query.label))
    most = top - query.lacking - group.lacking.min() + met
    ask = (100 + percent) * most >= percent * (query.size + group.size.min())
    if not ask.any():
        return none
    # opened: the overlaps of all queries that ask with all members, over the tokens of both
    tokens, owner = query.only(ask)
    columns = np.intersect1d(tokens, union)
    rank = np.cumsum(ask) - 1
    shared = np.zeros((ask.sum(), len(group.label)), np.float32)
    for k in range(0, len(columns), COLUMNS):
        part = columns[k:k + COLUMNS]
        sides = []
        for t, o, n in ((tokens, rank[owner], len(shared)), (group.tokens, group.owner, len(group.label))):
            at = np.searchsorted(part, t)
            hit = part[np.minimum(at, len(part) - 1)] == t
            m = np.zeros((n, len(part)), np.float32)
            m[o[hit], at[hit]] = 1
            sides.append(m)
        shared += sides[0] @ sides[1].T
    both = top - query.lacking[ask][:, None] - group.lacking + shared.astype(np.int64)
    linked = (100 + percent) * both >= percent * (query.size[ask][:, None] + group.size)
    x, y = np.nonzero(linked & (query.label[ask][:, None] != group.label))
    labels = np.stack([query.label[ask][x], group.label[y]], axis=1)
    return np.unique(np.sort(labels, axis=1), axis=0)


def forest(links: np.ndarray) -> np.ndarray:
    """Links (two columns) that join what the given ones join: each name but the least of a component, and the least."""
    names, at = np.unique(links, return_inverse=True)
    x, y = at.reshape(-1, 2).T
    root, before = np.arange(len(names)), None
    while before is None or (root != before).any():
        before = root.copy()
        low = np.minimum(root[x], root[y])
        for side in (x, y):
            np.minimum.at(root, before[side], low)
        root = root[root]
    return np.stack([names, names[root]], axis=1)[root != np.arange(len(names))]


def _groups(compared: DataFrame) -> DataFrame:
    """The groups of the matrix, of leaders with open members, as ``v, open, salt, block``: the leader's size ``top``,
    ``members``, the ``tile``, and the ``pairs`` of tiles that the group is wanted in.

    The members of a tile are open ones or not. Wanted are the pairs ``one, two`` of an open tile with itself, with later
    open ones and with all others. A leader of no more than a tile has the pair ``0, 0`` for all of its groups.
    """
    cost = F.col("size") - F.col("top") + 2 * F.col("lacking") + 64  # apart tokens by number

    def tiles(kind: Column) -> Column:
        return F.coalesce(F.floor(F.sum(F.when(kind, cost)) / F.max("salts") / TILE) + 1, F.lit(0))

    unsettled = (compared.groupBy("v").agg(F.max("salts").alias("salts"), (F.sum(cost) <= TILE).alias("whole"),
                                           tiles(~F.col("linked")).alias("open_tiles"), tiles(F.col("linked")).alias("tiles"))
                 .where("open_tiles > 0").withColumn("salt", F.expr("explode(sequence(0L, salts - 1))")))
    # joined by the salt too, so that a leader's members needn't meet in one task; the windows take the same deal
    members = (compared.drop("salts").join(unsettled.hint("merge"), ["v", "salt"])
               .withColumn("open", ~F.col("linked")))
    so_far = Window.partitionBy("v", "salt", "open").orderBy("least", "u").rowsBetween(Window.unboundedPreceding, -1)
    groups = (members.withColumn("before", F.coalesce(F.sum(cost).over(so_far), F.lit(0)))
              .groupBy("v", "salt", "open", F.floor(F.col("before") / GROUP).alias("block"))
              .agg(*(F.max(c).alias(c) for c in ("top", "salts", "whole", "open_tiles", "tiles")),
                   F.floor(F.min("before") / TILE).alias("nth"),
                   F.collect_list(F.struct(F.expr("if(open, u, v)").alias("label"), "size", "lacking", "extra", "lost"))
                   .alias("members")))
    # what a salt holds beyond its share goes to its last tile
    return saved(groups.withColumn("asking", F.expr("salts * open_tiles"))
                 .withColumn("tile", F.expr("if(open, salt * open_tiles + least(nth, open_tiles - 1), "
                                            "asking + salt * tiles + least(nth, tiles - 1))"))
                 .withColumn("pairs", F.expr("""if(whole, array(struct(0L AS one, 0L AS two)), concat(
                     transform(sequence(0L, least(tile, asking - 1)), x -> struct(x AS one, tile AS two)),
                     transform(filter(sequence(0L, asking + salts * tiles - 1), x -> tile < asking AND x > tile),
                               x -> struct(tile AS one, x AS two))))"""))
                 .select("v", "open", "salt", "block", "top", "tile", "members", "pairs"), "groups")


def _label_links(groups: DataFrame, percent: int) -> DataFrame:
    """``u, v``: links within the leaders' groups, as many as join what they join. Members linked to ``v`` are called ``v``."""
    dealt = (groups.withColumn("pair", F.explode("pairs"))
             .select("v", "pair.one", "pair.two", "open", "tile", "top", "members")
             .repartition("v", "one", "two").sortWithinPartitions("v", "one", "two"))

    def links(key: tuple, held: list[tuple]) -> pa.RecordBatch:
        _, one, two = key
        found = [np.zeros((0, 2), np.int64)]
        for i, (is_open, tile, top, query) in enumerate(held):
            if is_open and (one == two or tile == one):
                for j, (other, place, _, group) in enumerate(held):
                    # within a tile two open groups meet once
                    if (j >= i or not other) if one == two else place == two:
                        found.append(linked_labels(query, group, top, percent))
        some = forest(np.concatenate(found))
        return pa.record_batch([pa.array(some[:, 0]), pa.array(some[:, 1])], names=["u", "v"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for *now, is_open, tile, top, members in zip(*batch.columns):
                now = tuple(k.as_py() for k in now)
                if now != key and held:
                    yield links(key, held)
                    held = []
                key = now
                held.append((is_open.as_py(), tile.as_py(), top.as_py(), Group(members, top.as_py())))
        if held:
            yield links(key, held)

    return saved(dealt.mapInArrow(step, "u long, v long").distinct(), "label-links")


def _stars(seeds: DataFrame, *read: DataFrame) -> DataFrame:
    """``u, v``: the members and leaders of all groups, given as ``sign, node``. ``read`` is what goes once they are read."""
    buckets = saved(seeds.groupBy("sign").agg(F.min("node").alias("first"), F.max("node").alias("last"))
                    .where("first < last").select("sign"), "buckets")
    placed = saved(seeds.join(buckets, "sign").select("sign", "node"), "placed")
    discard(buckets, *read)
    degrees = placed.groupBy("node").agg(F.count("*").alias("degree"))
    tops = saved(placed.join(degrees, "node").groupBy("sign").agg(
        F.max(F.struct("degree", (-F.col("node")).alias("neg"))).alias("top")), "tops")
    firsts = tops.select("sign", (-F.col("top.neg")).alias("node"))
    # only the first nodes' own rows are joined, and a node is first in no more buckets than it has signatures
    best = (placed.join(firsts.select("node").distinct().hint("merge"), "node").join(tops.hint("merge"), "sign")
            .groupBy("node").agg(F.max("top").alias("best")))
    leads = saved(firsts.join(best.hint("merge"), "node").select("sign", (-F.col("best.neg")).alias("v")), "leads")
    stars = saved(placed.withColumnRenamed("node", "u").join(leads, "sign").where("u <> v").select("u", "v").distinct(),
                  "stars")
    discard(placed, tops, leads)
    return stars


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``."""
    texts = repeats.keyed(docs, id_col, text_col)
    full = saved(_sets(texts, n, percent), "sets")
    sets = saved(full.drop("signs"), "set-names")
    nodes = saved(full.where("size > 0 AND doc IS NOT NULL").groupBy("set1", "set2")
                  .agg(F.min("doc").alias("node"), F.any_value("signs").alias("signs")), "nodes")
    discard(full)

    names = saved(nodes.drop("signs"), "node-names")
    stars = _stars(nodes.select(F.explode("signs").alias("sign"), "node"), nodes)

    wanted = stars.select(F.col("u").alias("wanted")).union(stars.select("v")).distinct()
    # the list of nodes grows with the input: never broadcast it
    bodies = saved(repeats.packed(texts).join(wanted.hint("merge"), F.col("doc") == F.col("wanted"), "left_semi")
                   .select("doc", "body"), "bodies")
    compared = saved(_compared(stars, bodies, n, percent), "compared")
    discard(stars, bodies)
    straight = saved(compared.where("linked").select("u", "v"), "leader-links")
    groups = _groups(compared)
    discard(compared)
    links = _label_links(groups, percent)
    discard(groups)
    final = saved(components(straight.union(links)), "components")
    discard(straight, links)

    own = names.join(final, "node", "left").select(
        F.col("set1").alias("_1"), F.col("set2").alias("_2"), F.coalesce("component", "node").alias("component"))
    # A repeated id may name several nodes' sets; all rows of a set have its smallest id.
    own = saved(own, "node-components")
    return (sets.join(own, (F.col("set1") == F.col("_1")) & (F.col("set2") == F.col("_2")) & (F.col("size") > 0)
                      & F.col("doc").isNotNull(), "left")
            .select(F.col("doc").alias(id_col), F.col("size").alias("n_shingles"),
                    F.coalesce("component", "doc").alias("component_id")))


def keep_one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but those whose component has a smaller id; the columns stay."""
    found = jaccard_components(docs, n, percent, id_col, text_col)
    gone = found.where(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("_x2_id")).distinct()
    gone = gone.hint("merge")  # grows with the input: never broadcast it
    return docs.join(gone, docs[id_col] == F.col("_x2_id"), "left_anti")
