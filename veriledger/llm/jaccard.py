"""Documents whose sets of word shingles have a Jaccard similarity of a given share or more.

Equal sets are one node from the start. Nodes that may be linked meet in tiles. A tile belongs to a band
of set sizes and one of the band's ranges of shingle hashes: two sets of a band that are similar enough
differ in at most d shingles, and the hashes are cut into more than d ranges, so at least one range holds
the same shingles in both. A tile's key is the digest of what a set has in a range, so only sets that
agree on whole ranges meet, however common a single shingle is. A set also enters the tiles of the bands
that its larger partners may be in.

In a tile the pairs pass two tests. Hashed bitmaps of the sets bound the overlap from above by bit counts;
what passes is decided by intersecting the sorted sets. Links are found in rounds. The first tests every node against the
smallest node of its tiles and joins what is linked to components; in the tiles that still hold several
components, the second tests the nodes against a few of the largest ones. That settles groups of copies of
any size without testing their pairs. The last round tests all pairs of different components that still share a
tile. There, large tiles are cut into blocks and each pair of blocks is a task's work, so no tile is
gathered whole.

Words are maximal runs of characters other than ASCII white space, A-Z lower-cased. Shingles and nodes are
64-bit hashes. Null or empty texts have no shingles and no links.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.components import components
from veriledger.llm.frames import extended, pieces, quoted, slices, stored
from veriledger.llm.wanted import Wanted
from veriledger.llm.words import BLANKS, SPREAD, grams, hashes, split, spread
from veriledger.operators.skew import join_parent

SHINGLE = 4
PERCENT = 85

#: Ratio of a band's largest set to the next smaller band's.
BAND_RATIO = 1.5

#: Bits of a bitmap for each shingle of a set, at least.
BITS = 8

#: Nodes that a tile's others are tested against before all pairs are.
HEADS = 3

#: Bytes of text that are taken apart at once, and keys that a task puts in order at once.
TEXT_BYTES, KEYS = 2 << 20, 500_000

#: Nodes of a tile, or of a block of a larger tile, that are tested against each other at once.
TILE_NODES = 2048

_FIELDS = [T.StructField("n_shingles", T.LongType()), T.StructField("node", T.LongType())]


class Bands:
    """Bands of set sizes and the cuts of each."""

    def __init__(self, percent: int):
        self.percent, self.ends = percent, [1]

    def of(self, size: int) -> int:
        while self.ends[-1] < size:
            self.ends.append(max(self.ends[-1] + 1, int(self.ends[-1] * BAND_RATIO)))
        return bisect_left(self.ends, size)

    def differing(self, band: int) -> int:
        """Shingles in which two similar sets of a band can differ."""
        return (100 - self.percent) * 2 * self.ends[band] // (100 + self.percent)

    def entered(self, size: int) -> range:
        """The bands of a set and of its larger partners."""
        return range(self.of(size), self.of(size * 100 // self.percent) + 1)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; fewer words than a shingle's are one shingle."""
    words = split(texts, BLANKS, True)
    values = hashes(words)[words.ids] if len(words.ids) else np.empty(0, np.uint64)
    whole = grams(values, size)
    sets = []
    for a, b in zip(words.rows[:-1].tolist(), words.rows[1:].tolist()):
        if b - a >= size:
            found = np.sort(whole[a:b - size + 1])
            first = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=first[1:])
            sets.append(found[first])
        elif b > a:
            sets.append(grams(values[a:b], b - a))
        else:
            sets.append(values[:0])
    return sets


def node_of(shingles: np.ndarray) -> int | None:
    """A set's node; none for the empty set."""
    if not len(shingles):
        return None
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def tile_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the tiles that a set enters."""
    made = []
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread(shingles))])
    for band in bands.entered(len(shingles)):
        differing = bands.differing(band)
        if not differing:
            continue  # only equal sets are similar
        ranges = differing + 1 + differing // 8 + 2
        edges = (np.arange(1, ranges, dtype=np.uint64) * np.uint64((1 << 64) // ranges))
        cuts = np.concatenate([[0], np.searchsorted(shingles, edges), [len(shingles)]])
        digests = sums[cuts[1:]] - sums[cuts[:-1]]
        counts = np.diff(cuts).astype(np.uint64)
        keys = spread((digests ^ counts * SPREAD) * SPREAD
                      + np.arange(ranges, dtype=np.uint64) + np.uint64(band << 32))
        # Ranges that are empty in both sets show nothing, unless there could be no other equal range.
        filled = counts > 0
        made.append(keys if np.count_nonzero(~filled) >= ranges - differing else keys[filled])
    return np.concatenate(made) if made else shingles[:0]


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """The set hashed to bits; the length is a power of two, so a longer bitmap folds to a shorter."""
    length = 1 << max(6, (BITS * len(shingles) - 1).bit_length())
    bits = np.zeros(length, np.uint8)
    bits[(shingles & np.uint64(length - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, length: int) -> np.ndarray:
    while len(bits) > length:
        bits = bits[:len(bits) // 2] | bits[len(bits) // 2:]
    return bits


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values).view(np.int64))


def _profile(texts: pa.Array, size: int) -> dict:
    """Each set's size and node."""
    sets = shingle_sets(texts, size)
    return {"n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "node": pa.array([node_of(s) for s in sets], pa.int64())}


def _sought(size: int, sought: Wanted):
    """Size, node and bitmap of each set; no node and bitmap for one that is not sought."""
    def work(texts: pa.Array) -> dict:
        sets = shingle_sets(texts, size)
        nodes = pa.array([node_of(s) for s in sets], pa.int64())
        nodes = pc.if_else(pa.array(sought.may_hold(nodes.fill_null(0).to_numpy())), nodes, None)
        maps = [bitmap(s).tobytes() if known else None for s, known in zip(sets, nodes.is_valid().to_pylist())]
        return {"n_shingles": pa.array([len(s) for s in sets], pa.int64()), "node": nodes, "bits": pa.array(maps, pa.binary())}
    return work


def _tile_rows(size: int, percent: int):
    """For a batch of texts: one row per key for its smallest node, and one for each other node, which
    is known to share its tile. `at` is what a row is shuffled by, so only the former meet by key. A smallest
    node's head is null if it is alone, and the node itself if the batch has others of its tile."""
    names = ["at", "key", "node", "head"]

    def run(parts):
        bands = Bands(percent)
        for batch in parts:
            nodes, keys, seen, waiting = [], [], set(), 0
            for shingles in (s for part in slices(batch, 0, TEXT_BYTES) for s in shingle_sets(part.column(0), size)):
                node = node_of(shingles)
                if node is None or node in seen:
                    continue
                seen.add(node)
                own = tile_keys(shingles, bands)
                keys.append(own)
                nodes.append(np.full(len(own), node, np.int64))
                waiting += len(own)
                if waiting > KEYS:
                    yield table(keys, nodes)
                    keys, nodes, waiting = [], [], 0
            if keys:
                yield table(keys, nodes)

    def table(keys, nodes):
        key, node = np.concatenate(keys).view(np.int64), np.concatenate(nodes)
        by = np.lexsort((node, key))
        key, node = key[by], node[by]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        fresh = first.copy()
        fresh[1:] |= node[1:] != node[:-1]
        head = node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        key, node, head, first = key[fresh], node[fresh], head[fresh], first[fresh]
        at = np.where(first, key, spread(key.view(np.uint64) ^ node.view(np.uint64)).view(np.int64))
        alone = first & np.append(first[1:], True)
        return pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(key), pa.array(node), pa.array(head, mask=alone)], names=names)

    return run


def _live(parts):
    """From rows sorted by key, node: those of keys with several nodes, each with the smallest."""
    last_key = last_node = None
    written = False  # whether the first node of the last key is written
    for batch in parts:
        key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        given = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        head = batch.column(2).fill_null(0).to_numpy()
        known = given & (head != node)
        rest = np.flatnonzero(~known)
        k, n, followed = key[rest], node[rest], given[rest]
        out = [(key[known], node[known], head[known])]
        if len(k):
            if k[0] == last_key:
                k, n = np.concatenate([[last_key], k]), np.concatenate([[last_node], n])
                followed = np.concatenate([[False], followed])
                carried = True
            else:
                carried = False
            first = np.ones(len(k), bool)
            first[1:] = k[1:] != k[:-1]
            begin = np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))
            lead = n[begin]
            other = n != lead
            several = np.add.reduceat(other | followed, np.flatnonzero(first)) > 0
            live = np.repeat(several, np.diff(np.append(np.flatnonzero(first), len(k))))
            # The carried first row stands for its key; it is not to be written twice.
            show = live & (other | first)
            if carried and written:
                show[0] = False
            out.append((k[show], n[show], lead[show]))
            final = begin[-1]
            shown = bool(live[-1])
            written = shown or (carried and final == 0 and written)
            last_key, last_node = k[-1], lead[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                         names=["key", "node", "head"])


def _bound(n, bits, sizes, maps, percent):
    """Which of several sets can be similar to one, by their sizes and bitmaps of one length."""
    overlap = np.minimum(n - np.bitwise_count(bits & ~maps).sum(1, dtype=np.int64),
                         sizes - np.bitwise_count(maps & ~bits).sum(1, dtype=np.int64))
    return (100 + percent) * overlap >= percent * (n + sizes)


def _passing(percent: int):
    """Of pairs with sizes and bitmaps, those whose bound allows a link."""

    def run(parts):
        for batch in parts:
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            keep = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                length = min(len(x), len(y))
                keep[i] = _bound(na[i], folded(x, length), nb[i:i + 1], folded(y, length)[None], percent)[0]
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return run


def _linked(size: int, percent: int):
    """Of pairs with their texts, those that are linked, by intersecting the sorted sets."""

    def run(parts):
        for batch in parts:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            place = {}
            for nodes, column in ((a, 2), (b, 3)):
                for i, node in enumerate(nodes):
                    place.setdefault(node, (column, i))
            texts = pa.array([batch.column(c)[i].as_py() for c, i in place.values()], pa.string())
            parts_ = pieces(pc.binary_length(texts).to_pylist(), TEXT_BYTES)
            sets = dict(zip(place, (s for a, b in parts_ for s in shingle_sets(texts.slice(a, b - a), size))))
            found = []
            for x, y in zip(a, b):
                s, t = sets[x], sets[y]
                both = np.concatenate([s, t])
                both.sort()
                overlap = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * overlap >= percent * (len(s) + len(t) - overlap):
                    found.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                              pa.array([p[1] for p in found], pa.int64())], names=["a", "b"])

    return run


def _across(percent: int):
    """Of tiles sorted by key and blocks: pairs of different labels that their bound allows."""

    def pairs(rows):
        node, label, block, sizes, maps = rows
        by = np.argsort(sizes, kind="stable")
        node, label, block, sizes = node[by], label[by], block[by], sizes[by]
        length = min(len(m) for m in maps)
        maps = np.stack([folded(maps[i], length) for i in by])
        inner = (block == block[0]).all()
        ends = np.searchsorted(sizes, sizes * 100 // percent, "right")
        for i in range(len(node)):
            fit = np.arange(i + 1, ends[i])
            fit = fit[label[fit] != label[i]]
            if not inner:
                fit = fit[block[fit] != block[i]]
            if len(fit):
                fit = fit[_bound(sizes[i], maps[i], sizes[fit], maps[fit], percent)]
                for j in fit.tolist():
                    yield (node[i], node[j]) if node[i] < node[j] else (node[j], node[i])

    def run(parts):
        held, group = [], None
        for batch in parts:
            where = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((where[:, 1:] != where[:, :-1]).any(0)) + 1
            found = set()
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                here = tuple(where[:, s].tolist())
                if here != group:
                    found |= finish(held)
                    held, group = [], here
                held.append(batch.slice(s, e - s))
            if found:
                yield table(found)
        if found := finish(held):
            yield table(found)

    def finish(held):
        if sum(b.num_rows for b in held) < 2:
            return set()
        columns = [np.concatenate([b.column(i).to_numpy() for b in held]) for i in (3, 4, 5, 6)]
        maps = [np.frombuffer(x.as_buffer(), np.uint64) for b in held for x in b.column(7)]
        return set(pairs((*columns, maps)))

    def table(found):
        a, b = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


class Join:
    """The links of a table's texts: `nodes` and, after `run`, `labels` of the nodes that are linked."""

    def __init__(self, df: DataFrame, column: str = "text", size: int = SHINGLE, percent: int = PERCENT):
        self.texts = df.select(quoted(column).cast("string").alias("text"))
        self.size, self.percent = size, percent

    def tiles(self) -> DataFrame:
        """`key`, `node` and `head`, a smaller node of the tile or itself, of tiles with several nodes."""
        rows = self.texts.mapInArrow(_tile_rows(self.size, self.percent),
                                     "at long, key long, node long, head long")
        met = rows.repartition("at").sortWithinPartitions("key", "node").select("key", "node", "head")
        return stored(met.mapInArrow(_live, "key long, node long, head long"), "tiles")

    def profiles(self, tiles: DataFrame) -> DataFrame:
        """Text, size and bitmap of each node of a tile."""
        wanted = stored(tiles.select("node").union(tiles.select("head")).distinct(), "wanted")
        sought = Wanted(wanted, "node")
        # Texts that no tile holds are dropped where they are read. Bitmaps are made there too: texts go through Python once, and
        # the tasks that sort them hold no Python worker beside.
        fields = [*_FIELDS, T.StructField("bits", T.BinaryType())]
        texts = extended(self.texts, "text", fields, _sought(self.size, sought), None, TEXT_BYTES).filter("node is not null")
        own = texts.groupBy("node").agg(*[F.first(c).alias(n) for c, n in (("n_shingles", "n"), ("text", "text"), ("bits", "bits"))])
        return stored(own.join(wanted, "node", "left_semi"), "profiles")

    def verified(self, pairs: DataFrame, profiles: DataFrame, bounded: bool) -> DataFrame:
        """Of distinct pairs `a`, `b`, the linked ones; `bounded` if their bound is tested already."""
        if not bounded:
            bits = profiles.select("node", "n", "bits")
            pairs = (pairs.join(bits.toDF("a", "na", "bits_a"), "a").join(bits.toDF("b", "nb", "bits_b"), "b")
                     .select("a", "b", "na", "nb", "bits_a", "bits_b")
                     .mapInArrow(_passing(self.percent), "a long, b long"))
        pairs = stored(pairs, "passing")
        # In later rounds few texts are needed; the others are not shuffled.
        needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        text = profiles.select("node", "text").join(needed, "node", "left_semi")
        both = (pairs.join(text.toDF("a", "text_a"), "a").join(text.toDF("b", "text_b"), "b")
                .select("a", "b", "text_a", "text_b"))
        return stored(both.mapInArrow(_linked(self.size, self.percent), "a long, b long"), "links")

    def run(self) -> DataFrame:
        """`node` and `label` of each node that is linked to another."""
        tiles = self.tiles()
        profiles = self.profiles(tiles)
        starts = tiles.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
        labels = stored(components(self.verified(starts, profiles, bounded=False)), "labels")
        # Tiles of two nodes are done.
        tiles = tiles.select("key", "node").distinct()
        counts = tiles.groupBy("key").agg(F.count("*").alias("nodes")).filter("nodes > 2")
        tiles = stored(join_parent(tiles, counts, [("key", "key")], "inner"), "tiles")
        labels = merged(labels, self.verified(self.to_heads(self.mixed(tiles, labels)), profiles, bounded=False))
        # The heads of a smaller tile have met all of it.
        tiles = tiles.filter(F.col("nodes") > HEADS + 1)
        pairs = stored(self.across(self.mixed(tiles, labels), profiles), "pairs")
        return merged(labels, self.verified(pairs, profiles, bounded=True))

    @staticmethod
    def mixed(tiles: DataFrame, labels: DataFrame) -> DataFrame:
        """The rows of tiles that hold several components, with each node's label and its component's size."""
        sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
        sized = stored(join_parent(labels, sizes, [("label", "label")], "inner"), "sized")
        labelled = tiles.join(sized, "node", "left").withColumns(
            {"label": F.coalesce("label", "node"), "size": F.coalesce("size", F.lit(1))})
        several = (labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                   .filter("low <> high").select("key"))
        return stored(join_parent(labelled, several, [("key", "key")], "left_semi"), "mixed")

    @staticmethod
    def to_heads(rows: DataFrame) -> DataFrame:
        """Distinct pairs of a node and one of its tile's heads: a few nodes of its largest components."""
        order = Window.partitionBy("key").orderBy(F.desc("size"), "node")
        heads = (rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= HEADS)
                 .select("key", F.col("node").alias("head"), F.col("label").alias("other")))
        return (join_parent(rows, heads, [("key", "key")], "inner").filter("label <> other")
                .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct())

    def across(self, rows: DataFrame, profiles: DataFrame) -> DataFrame:
        """Distinct pairs of different components of a tile that their bound allows."""
        blocks = F.ceil(F.col("nodes") / TILE_NODES)
        both = (rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
                .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
                .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                        "node", "label", "block")
                .join(profiles.select("node", "n", "bits"), "node"))
        return (both.select("key", "i", "j", "node", "label", "block", "n", "bits")
                .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
                .mapInArrow(_across(self.percent), "a long, b long").distinct())


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links between nodes."""
    if links.isEmpty():
        return labels
    ends = links
    for c in ("a", "b"):
        ends = ends.join(labels.toDF(c, "label"), c, "left").withColumn(c, F.coalesce("label", c)).drop("label")
    joined = stored(components(ends), "labels")
    moved = labels.join(joined.toDF("label", "top"), "label", "left").select(
        "node", F.coalesce("top", "label").alias("label"))
    return stored(moved.union(joined.join(labels, "node", "left_anti")), "labels")


def profiled(df: DataFrame, column: str = "text", size: int = SHINGLE, keep=None) -> DataFrame:
    """The rows with `n_shingles` and `node`, the set's hash, null for no shingles."""
    return extended(df, column, _FIELDS, lambda texts: _profile(texts, size), keep, TEXT_BYTES)


def node_components(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Per node `component_id`, the smallest key its links reach (null if all keys are), and `chosen`,
    true for one node of each component, of those that have the smallest key."""
    nodes = rows.filter("node is not null").groupBy("node").agg(F.min(key).alias("first"))
    linked = stored(nodes.join(labels, "node"), "linked")
    facts = linked.groupBy("label").agg(F.min(F.struct(F.col("first").isNull(), "first", "node")).alias("best"))
    own = join_parent(linked, facts, [("label", "label")], "inner").select(
        "node", F.col("best.first").alias("component_id"), (F.col("node") == F.col("best.node")).alias("chosen"))
    alone = nodes.join(labels, "node", "left_anti").select(
        "node", F.col("first").alias("component_id"), F.lit(True).alias("chosen"))
    return own.union(alone)


def classes(df: DataFrame, key: str = "doc_id", column: str = "text", size: int = SHINGLE,
            percent: int = PERCENT) -> DataFrame:
    """Per row its key, `n_shingles` and `component_id`, the smallest key its links reach, its own included.

    A row without shingles is its own component. Rows that repeat a key or a text are rows of their own
    and linked as their texts are; null keys take part in links but never name a component.
    """
    rows = stored(profiled(df, column, size, keep=[key]), "rows")
    nodes = node_components(rows, Join(df, column, size, percent).run(), key)
    filled = join_parent(rows.filter("node is not null"), nodes.drop("chosen"), [("node", "node")], "inner").select(
        key, "n_shingles", "component_id")
    return filled.union(rows.filter("node is null").select(key, "n_shingles", F.col(key).alias("component_id")))


def one_of_each(df: DataFrame, key: str = "doc_id", column: str = "text", size: int = SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """The rows without all but one of each component: one with the smallest key stays. Rows without
    shingles stay. The columns are the given ones; `n_shingles` and `node` may be among them."""
    plain = df.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    at, text = (f"c{df.columns.index(c)}" for c in (key, column))
    names = [quoted(f"c{i}").alias(c) for i, c in enumerate(df.columns)]
    rows = stored(profiled(plain, text, size, keep=[at]), "rows")
    nodes = node_components(rows, Join(plain, text, size, percent).run(), at)
    kept = (rows.filter("node is not null").select("node", at).distinct()
            .join(nodes.filter("chosen"), "node").filter(quoted(at).eqNullSafe(F.col("component_id")))
            .select("node", quoted(at).alias("kept_key")))
    whole = profiled(plain, text, size)
    # Copies under one key are dropped before the join, in part where they are read.
    once = whole.filter("node is not null").dropDuplicates(["node", at])
    found = once.join(kept, (once["node"] == kept["node"]) & once[at].eqNullSafe(kept["kept_key"]))
    return found.select(*names).union(whole.filter("node is null").select(*names))
