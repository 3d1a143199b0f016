"""Near duplicates by SuperMinHash signatures, banding, verification on full sets and union-find.

A signature has SIZE places. Every shingle draws, from a generator seeded by itself, a permutation of the places and, for
the j-th place of its permutation, a number in [j, j + 1); a place keeps the least number it is given. As a shingle's
numbers take different ranks, places agree more evenly than with independent hashes, and once every place holds a
number below j + 1 no later rank can change one: all shingles of a text stop there, most often after one to three ranks. Ranks
are computed for all shingles of many texts at once.

Places are cut into bands of a few; texts that agree on a whole band share a bucket. Two texts at the threshold of 80 per
cent agree on one of the 32 bands of four but for a chance of 5 in 100 million; a link that is found between other
texts of their group makes up for most of these. What shares a bucket is linked only if the full sets are similar enough.

Within a bucket pairs are not listed. First each text meets the bucket's smallest node: the one it shares most bands with, then the
others it is not yet joined to. In buckets that still hold several components all texts then meet a few texts of
the largest ones, and only what is left is compared across components, by blocks of bounded size. There a pair is
compared in the first bucket it shares, unless signatures agree on too few places (at the threshold a chance below 1 in 10 ** 8)
or union-find has joined it already; so a block gives fewer links than it has nodes. Links of a task are joined by
union-find to a forest, and the forests of all tasks by alternating stars.

Words are maximal runs of characters other than ASCII white space, A-Z lower-cased. Equal sets are one node, a 64-bit hash.
Null and empty texts have no shingles, are linked with nothing and stay. Rows that repeat an id or a text are rows of
their own; null ids take part in links and never name a component, so rows without an id stay only if no row of their
component has one. Only the two named columns are read, so no other column can clash; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.components import components
from veriledger.llm.frames import quoted, slices, stored
from veriledger.llm.jaccard import HEADS, Join, merged, node_components, node_of, shingle_sets
from veriledger.llm.wanted import Wanted
from veriledger.llm.words import SPREAD, spread
from veriledger.operators import skew

SHINGLE = 4
PERCENT = 80

#: Bands of a signature and places of a band.
BANDS, ROWS = 32, 4
SIZE = BANDS * ROWS

#: Places in which the signatures of a pair agree at least, by one byte of each place.
AGREEING = 72

#: Bits of a place's number below its rank.
FRACTION = 25

#: Shingles whose permutations are held at once.
ELEMENTS = 1 << 16

#: Bytes of text that are taken apart at once.
TEXT_BYTES = 2 << 20

#: Links that a task joins at once.
LINKS = 1 << 18

#: Nodes and shingles of a bucket, or of a block of a larger one, that are compared with each other at once.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 20


def _draws(elements: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """For each element the place it swaps with at this rank, from `rank` on, and its number."""
    drawn = spread(elements + np.uint64((rank + 1) * int(SPREAD) % (1 << 64)))
    swap = rank + (((drawn >> np.uint64(32)) * np.uint64(SIZE - rank)) >> np.uint64(32)).astype(np.int64)
    return swap, (drawn & np.uint64((1 << FRACTION) - 1)).astype(np.uint32) | np.uint32(rank << FRACTION)


def _signed_part(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of a few non-empty sets."""
    held = np.full((len(sets), SIZE), np.uint32(0xFFFFFFFF))
    flat = held.reshape(-1)
    elements = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    # At the first rank every permutation is still the identity.
    swap, number = _draws(elements, 0)
    np.minimum.at(flat, row * SIZE + swap, number)
    places = None
    for rank in range(1, SIZE):
        open_ = held.max(1) >= np.uint32(rank << FRACTION)
        stays = open_[row]
        if not stays.any():
            break
        if places is None:
            elements, row, swap = elements[stays], row[stays], swap[stays]
            places = np.tile(np.arange(SIZE, dtype=np.uint8), (len(row), 1))
            places[np.arange(len(row)), swap] = 0
        elif np.count_nonzero(stays) < 0.7 * len(stays):
            elements, row, places = elements[stays], row[stays], places[stays]
        swap, number = _draws(elements, rank)
        at = np.arange(len(row))
        place = places[at, swap]
        places[at, swap] = places[:, rank]
        np.minimum.at(flat, row * SIZE + place, number)
    return held


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SIZE 32-bit numbers for each of some non-empty sets of shingle hashes: rank, then fraction."""
    parts, start, total = [], 0, 0
    for i, own in enumerate(sets):
        if i > start and total + len(own) > ELEMENTS:
            parts.append(_signed_part(sets[start:i]))
            start, total = i, 0
        total += len(own)
    if start < len(sets):
        parts.append(_signed_part(sets[start:]))
    return np.concatenate(parts) if parts else np.empty((0, SIZE), np.uint32)


def band_keys(signed: np.ndarray) -> np.ndarray:
    """A 64-bit key for each signature and band."""
    pairs = np.ascontiguousarray(signed).view(np.uint64).reshape(len(signed), BANDS, ROWS // 2)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * SPREAD
    for i in range(ROWS // 2):
        keys = spread(keys ^ pairs[:, :, i]) * SPREAD
    return keys.view(np.int64).reshape(len(signed), BANDS)


def _profiles(size: int):
    """Number of shingles, node, band keys and marks of each text; a set's keys and marks only where a batch first has it."""

    def run(batches):
        for whole in batches:
            seen: set[int] = set()
            for batch in slices(whole, 1, TEXT_BYTES):
                sets = shingle_sets(batch.column(1), size)
                nodes = [node_of(s) for s in sets]
                fresh = _first_places(nodes, seen)
                signed = signatures([sets[i] for i in fresh])
                keys, marks = band_keys(signed), (signed & np.uint32(0xFF)).astype(np.uint8)
                at = {i: k for k, i in enumerate(fresh)}
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()),
                    pa.array([keys[at[i]] if i in at else None for i in range(len(sets))], pa.list_(pa.int64())),
                    pa.array([marks[at[i]].tobytes() if i in at else None for i in range(len(sets))], pa.binary()),
                ], names=["key", "mark", "n_shingles", "node", "bands", "marks"])

    return run


def _first_places(nodes: list[int | None], seen: set[int]) -> list[int]:
    """Where a node stands that has not been seen before."""
    found = []
    for i, node in enumerate(nodes):
        if node is not None and node not in seen:
            seen.add(node)
            found.append(i)
    return found


def _agreeing(percent: int):
    """Of pairs with sizes and marks, those that sizes and signatures allow to be similar."""

    def run(batches):
        for batch in batches:
            a, b, shared, na, nb = (batch.column(i).to_numpy() for i in range(5))
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SIZE) for i in (5, 6))
            keep = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & ((x == y).sum(1) >= AGREEING)
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (a, b, shared)], names=["a", "b", "shared"])

    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    both = np.concatenate([x, y])
    both.sort()
    overlap = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * overlap >= percent * (len(x) + len(y) - overlap)


class Forest:
    """Union-find: the smallest of the nodes that links join."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def top(self, x: int) -> int:
        root = x
        while self.parent.setdefault(root, root) != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, a: int, b: int) -> None:
        x, y = self.top(a), self.top(b)
        self.parent[max(x, y)] = min(x, y)

    def links(self) -> pa.RecordBatch:
        """Each node with the smallest one it is joined to, but for itself."""
        nodes = [n for n, p in self.parent.items() if n != p]
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([self.top(n) for n in nodes], pa.int64())], names=["a", "b"])


def _forest(batches):
    """The links of a task as a forest."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.parent) > LINKS:
            yield forest.links()
            forest = Forest()
    yield forest.links()


def grouped(links: DataFrame) -> DataFrame:
    """`node` and `label`, the smallest node of its group, of nodes that links `a`, `b` join."""
    return components(links.mapInArrow(_forest, "a long, b long"))


def _across(percent: int):
    """Of buckets sorted by key and blocks: the links between components, as a forest of labels."""

    def table(held):
        key = held[0].column(0)[0].as_py()
        node, label, block, sizes = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3, 7))
        marks = np.frombuffer(b"".join(m for b in held for m in b.column(7).to_pylist()), np.uint8).reshape(-1, SIZE)
        bands = np.concatenate([b.column(8).flatten().to_numpy() for b in held]).reshape(-1, BANDS)
        sets = [s for b in held for s in np.split(b.column(9).flatten().to_numpy(),
                                                  np.cumsum(b.column(9).value_lengths().to_numpy())[:-1])]
        # Bands up to the one that this bucket stands for: a pair that shares an earlier one has met there.
        earlier = np.arange(BANDS) < (bands == key).argmax(1)[:, None]
        by = np.argsort(sizes, kind="stable")
        node, label, block, sizes, marks, bands, earlier = (x[by] for x in (node, label, block, sizes, marks, bands, earlier))
        inner = (block == block[0]).all()
        ends = np.searchsorted(sizes, sizes * 100 // percent, "right")
        forest = Forest()
        for i in range(len(node)):
            fit = np.arange(i + 1, ends[i])
            fit = fit[label[fit] != label[i]]
            if not inner:
                fit = fit[block[fit] != block[i]]
            fit = fit[(marks[fit] == marks[i]).sum(1) >= AGREEING]
            fit = fit[~((bands[fit] == bands[i]) & earlier[i]).any(1)]
            for j in fit.tolist():
                a, b = int(label[i]), int(label[j])
                if forest.top(a) != forest.top(b) and _similar(sets[by[i]], sets[by[j]], percent):
                    forest.join(a, b)
        return forest.links()

    def run(batches):
        held, group = [], None
        for batch in batches:
            where = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((where[:, 1:] != where[:, :-1]).any(0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if s == e:
                    continue
                here = tuple(where[:, s].tolist())
                if here != group:
                    if sum(b.num_rows for b in held) > 1:
                        yield table(held)
                    held, group = [], here
                held.append(batch.slice(s, e - s))
        if sum(b.num_rows for b in held) > 1:
            yield table(held)

    return run


class NearDuplicates:
    """The near duplicates of a table's texts."""

    def __init__(self, df: DataFrame, key: str = "doc_id", column: str = "text", size: int = SHINGLE,
                 percent: int = PERCENT):
        #: `mark` stands for a row's id where texts are looked for again.
        self.source = df.select(quoted(key).alias("key"), quoted(column).cast("string").alias("text"),
                                F.xxhash64(quoted(key)).alias("mark"))
        self.size, self.percent = size, percent
        schema = T.StructType([self.source.schema["key"], *T.StructType.fromDDL(
            "mark long, n_shingles long, node long, bands array<long>, marks binary").fields])
        self.rows = stored(self.source.mapInArrow(_profiles(size), schema), "profiles")

    def buckets(self) -> DataFrame:
        """`key`, `node` and `head`, the smallest node, of buckets with several nodes."""
        bands = self.rows.filter("bands is not null").select("node", F.explode("bands").alias("key"))
        heads = (bands.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"))
                 .filter("head < last").select("key", "head"))
        return stored(skew.join_parent(bands, heads, [("key", "key")], "inner").distinct(), "buckets")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """Size, marks and shingles of each of some nodes. A text is looked for by a row that has it, so
        few other texts are taken apart again."""
        size = self.size
        held = skew.join_parent(self.rows.filter("bands is not null").select("node", "n_shingles", "marks", "bands", "mark"), nodes,
                                [("node", "node")], "left_semi")
        one = stored(held.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("marks").alias("marks"),
                                              F.first("bands").alias("bands"), F.min("mark").alias("mark")), "nodes")
        rows, wanted = Wanted(one, "mark"), Wanted(one, "node")

        def run(batches):
            for whole in batches:
                whole = whole.filter(pa.array(rows.may_hold(whole.column(1).to_numpy())))
                for batch in slices(whole, 0, TEXT_BYTES):
                    sets = shingle_sets(batch.column(0), size)
                    found = {n: s for n, s in zip(map(node_of, sets), sets) if n is not None}
                    nodes = np.fromiter(found, np.int64, len(found))
                    keep = nodes[wanted.may_hold(nodes)].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keep, pa.int64()), pa.array([found[n].view(np.int64) for n in keep], pa.list_(pa.int64()))],
                        names=["node", "shingles"])

        whole = (self.source.select("text", "mark").mapInArrow(run, "node long, shingles array<long>")
                 .groupBy("node").agg(F.first("shingles").alias("shingles")))
        return stored(one.join(whole, "node").select("node", "n", "marks", "bands", "shingles"), "sets")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Of distinct pairs `a`, `b` the linked ones, by the intersection of their full sets."""
        own = sets.select("node", "shingles")
        both = pairs.join(own.toDF("a", "set_a"), "a").join(own.toDF("b", "set_b"), "b")
        overlap = F.size(F.array_intersect("set_a", "set_b"))
        linked = (100 + self.percent) * overlap >= self.percent * (F.size("set_a") + F.size("set_b"))
        return stored(both.filter(linked).select("a", "b"), "links")

    def allowed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Of distinct pairs `a`, `b`, with the bands they share, those that sizes and signatures allow."""
        own = sets.select("node", "n", "marks")
        both = pairs.join(own.toDF("a", "na", "ma"), "a").join(own.toDF("b", "nb", "mb"), "b")
        return both.select("a", "b", "shared", "na", "nb", "ma", "mb").mapInArrow(
            _agreeing(self.percent), "a long, b long, shared long")

    def labels(self) -> DataFrame:
        """`node` and `label` of each node that is linked to another."""
        buckets = self.buckets()
        sets = self.sets(buckets.select("node").distinct())
        stars = (buckets.filter("node <> head").groupBy(F.col("node").alias("a"), F.col("head").alias("b"))
                 .agg(F.count("*").alias("shared")))
        stars = stored(self.allowed(stars, sets), "stars")
        nearest = stars.groupBy("a").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b"))
        labels = stored(grouped(self.verified(nearest, sets)), "labels")
        labels = merged(labels, self.verified(apart(stars, labels).join(nearest, ["a", "b"], "left_anti"), sets))
        # Buckets of two nodes are done.
        tiles = buckets.select("key", "node")
        counts = (tiles.join(sets.select("node", "n"), "node").groupBy("key")
                  .agg(F.count("*").alias("nodes"), F.sum("n").alias("shingles")).filter("nodes > 2"))
        tiles = stored(skew.join_parent(tiles, counts, [("key", "key")], "inner"), "tiles")
        heads = Join.to_heads(Join.mixed(tiles, labels)).withColumn("shared", F.lit(0).cast("long"))
        labels = merged(labels, self.verified(self.allowed(heads, sets).drop("shared"), sets))
        # The heads of a smaller bucket have met all of it.
        tiles = tiles.filter(F.col("nodes") > HEADS + 1)
        return merged(labels, stored(self.across(Join.mixed(tiles, labels), sets), "links"))

    def across(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between different components of a bucket. Each pair of a bucket's blocks is work of its own."""
        blocks = F.greatest(F.ceil(F.col("nodes") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
        both = (rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
                .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
                .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                        "node", "label", "block")
                .join(sets, "node"))
        return (both.select("key", "i", "j", "node", "label", "block", "n", "marks", "bands", "shingles")
                .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
                .mapInArrow(_across(self.percent), "a long, b long").distinct())


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs `a`, `b` whose nodes are not joined yet."""
    for c in ("a", "b"):
        pairs = pairs.join(labels.toDF(c, f"{c}_label"), c, "left")
    return pairs.filter("coalesce(a_label, a) <> coalesce(b_label, b)").select("a", "b")


def report(df: DataFrame, key: str = "doc_id", column: str = "text", size: int = SHINGLE,
           percent: int = PERCENT) -> DataFrame:
    """Per row its `key`, `n_shingles`, `component_id`, the smallest key its links reach, its own included, and
    `kept`, whether it is that key."""
    found = NearDuplicates(df, key, column, size, percent)
    nodes = node_components(found.rows, found.labels(), "key").drop("chosen")
    rows = found.rows.select("key", "n_shingles", "node")
    filled = skew.join_parent(rows.filter("node is not null"), nodes, [("node", "node")], "inner").drop("node")
    every = filled.union(rows.filter("node is null").select("key", "n_shingles", F.col("key").alias("component_id")))
    return every.withColumn("kept", F.col("key").eqNullSafe(F.col("component_id")))


def deduplicated(df: DataFrame, key: str = "doc_id", column: str = "text", size: int = SHINGLE,
                 percent: int = PERCENT) -> DataFrame:
    """The rows, all columns, whose key names their component; every row that has that key stays."""
    kept = report(df, key, column, size, percent).filter("kept").select(F.col("key").alias("__kept")).distinct()
    return df.join(kept, quoted(key).eqNullSafe(F.col("__kept")), "left_semi")
