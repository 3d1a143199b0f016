"""Hard negatives of anchors: rows of another label that score just below a positive.

A score is the integer inner product of two vectors. Each pair worth keeping becomes one packed key: the anchor, the score
in descending order, whether the row is a positive or a negative, and the row's id. Keys are dealt out by anchor and
sorted within their partitions, so an iterator that walks through a partition meets an anchor's rows from the highest score
on. A positive opens a window; every negative goes to the open windows that still need one. The iterator holds an
anchor's few open windows and nothing else.

All rows meet all anchors in tiles: a part of the rows and a block of anchors of bounded size. Rows stream past the
block, which is all that a task holds. Before anything is shuffled a tile drops what cannot be among the result:
of the positives all but an anchor's first few, of the negatives all but the first few of each window. As windows are known
only when the positives are, tiles are run through twice, first for positives, then for negatives.

Rows take part if id, label and vector are given and every component is finite. Of rows that share an id the one with the
smallest label, then vector, counts. Rows whose vectors differ in length have no score with each other. Components beyond
the bound of `vectors.bound` count as the bound. Anchors without positives, and positives without negatives, have no rows;
neither has an empty table. Only the named columns are read, so no other column can clash.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.frames import quoted, stored
from veriledger.llm.vectors import integers

SCALE = 256
POSITIVES = 5
NEGATIVES = 5

#: A negative's score is at least this share of the positive's, in per cent.
PERCENT = 80

#: Bytes of the anchors' components that a tile holds.
BLOCK_BYTES = 8 << 20

#: Rows of a tile: enough that what tiles keep is little against the pairs they see.
TILE_ROWS = 1 << 17

#: Scores that a task computes at once.
SCORES = 1 << 22

#: Below every score.
NONE = -(1 << 62)

KEY = struct.Struct(">QQBQ")
_FLIP = 1 << 63


def usable(df: DataFrame, key: str, label: str, column: str, scale: int) -> DataFrame:
    """`key`, `label` (a number) and `vector` (integers) of the rows that take part, one per id."""
    kind = df.schema[label].dataType
    mark = quoted(label).cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(quoted(label))
    slim = df.filter(quoted(key).isNotNull() & quoted(label).isNotNull()).select(
        quoted(key).cast("long").alias("key"), mark.alias("label"), quoted(column).alias("vector"))

    def run(batches):
        for batch in batches:
            good, lengths, values = integers(batch.column(2), scale)
            keep = pa.array(good)
            held = lengths[good]
            vectors = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32()),
                pa.array(values[np.repeat(good, lengths)], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep), vectors], names=["key", "label", "vector"])

    rows = slim.mapInArrow(run, "key long, label long, vector array<long>")
    return rows.groupBy("key").agg(F.min(F.struct("label", "vector")).alias("row")).select("key", "row.label", "row.vector")


def packed(anchors: np.ndarray, scores: np.ndarray, kind: int, ids: np.ndarray) -> pa.Array:
    """Keys whose order as bytes is: anchor, score from the highest, positives first, id."""
    rows = np.empty(len(anchors), [("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
    rows["anchor"] = anchors.astype(np.int64).view(np.uint64) ^ np.uint64(_FLIP)
    rows["score"] = ~(scores.astype(np.int64).view(np.uint64) ^ np.uint64(_FLIP))
    rows["kind"] = kind
    rows["id"] = ids.astype(np.int64).view(np.uint64) ^ np.uint64(_FLIP)
    offsets = np.arange(0, len(rows) * KEY.size + 1, KEY.size, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, ident = KEY.unpack(key)
    return anchor - _FLIP, (score ^ (_FLIP * 2 - 1)) - _FLIP, kind, ident - _FLIP


class First:
    """The few best (score, id) of each of many groups: the highest scores, ties by the smaller id."""

    def __init__(self, groups: int, size: int):
        self.scores = np.full((groups, size), NONE, np.int64)
        self.ids = np.zeros((groups, size), np.int64)

    @property
    def least(self) -> np.ndarray:
        """What a group's next score has to reach."""
        return self.scores[:, -1]

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(group):
            return
        size = self.scores.shape[1]
        touched = np.unique(group)
        group = np.concatenate([np.repeat(touched, size), group])
        score = np.concatenate([self.scores[touched].reshape(-1), score])
        ident = np.concatenate([self.ids[touched].reshape(-1), ident])
        by = np.lexsort((ident, -score, group))
        group, score, ident = group[by], score[by], ident[by]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        best = rank < size
        self.scores[group[best], rank[best]] = score[best]
        self.ids[group[best], rank[best]] = ident[best]


class Anchors:
    """The anchors of a tile whose vectors have one length."""

    def __init__(self, keys, labels, vectors):
        self.keys, self.labels, self.vectors = keys, labels, vectors
        self.norm = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(1).max(initial=0)))

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Exact inner products: no partial sum exceeds the product of the norms, so the narrowest type that
        holds that is exact."""
        most = self.norm * float(np.sqrt((vectors.astype(np.float64) ** 2).sum(1).max(initial=0)))
        kind = np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64
        return vectors.astype(kind) @ self.vectors.T.astype(kind)


class Positives(Anchors):
    """Of the rows with an anchor's label the first few."""

    def __init__(self, keys, labels, vectors, size: int):
        super().__init__(keys, labels, vectors)
        self.first = First(len(keys), size)

    def see(self, keys, labels, vectors) -> None:
        scores = self.scores(vectors)
        row, anchor = np.nonzero((scores >= self.first.least.astype(scores.dtype)) & (labels[:, None] == self.labels))
        other = keys[row] != self.keys[anchor]
        row, anchor = row[other], anchor[other]
        self.first.add(anchor, scores[row, anchor].astype(np.int64), keys[row])

    def found(self):
        anchor, rank = np.nonzero(self.first.scores > NONE)
        yield packed(self.keys[anchor], self.first.scores[anchor, rank], 0, self.first.ids[anchor, rank])


class Negatives(Anchors):
    """Of the rows with another label the first few of each of an anchor's windows."""

    def __init__(self, keys, labels, vectors, windows: np.ndarray, size: int, percent: int):
        super().__init__(keys, labels, vectors)
        self.upper = windows
        # without a positive the window is empty
        self.lower = np.where(windows > NONE, -((-percent * np.where(windows > NONE, windows, 0)) // 100), -NONE)
        self.first = [First(len(keys), size) for _ in range(windows.shape[1])]

    def see(self, keys, labels, vectors) -> None:
        scores = self.scores(vectors)
        for k, first in enumerate(self.first):
            least = np.maximum(first.least, self.lower[:, k]).astype(scores.dtype)
            row, anchor = np.nonzero((scores >= least) & (scores <= self.upper[:, k].astype(scores.dtype)))
            other = labels[row] != self.labels[anchor]
            row, anchor = row[other], anchor[other]
            first.add(anchor, scores[row, anchor].astype(np.int64), keys[row])

    def found(self):
        held = []
        for first in self.first:
            anchor, rank = np.nonzero(first.scores > NONE)
            held.append(np.stack([anchor, first.scores[anchor, rank], first.ids[anchor, rank]]))
        anchor, score, ident = np.unique(np.concatenate(held, axis=1), axis=1)
        yield packed(self.keys[anchor], score, 1, ident)


def _arrays(batch: pa.RecordBatch, length: int, rows: np.ndarray):
    """Keys, labels and vectors of some rows of a batch, all of one length."""
    part = batch.take(pa.array(rows))
    return (part.column(0).to_numpy(), part.column(1).to_numpy(),
            part.column(2).flatten().to_numpy().reshape(len(rows), length))


def _by_length(batch: pa.RecordBatch):
    lengths = batch.column(2).value_lengths().to_numpy()
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


def _tiles(made):
    """Runs the rows of each tile past its anchors; the rows come sorted by tile, a tile's anchors first.
    `made` turns keys, labels, vectors and windows of anchors into what sees the rows."""

    def ended(held):
        for seeing in held.values():
            for keys in seeing.found():
                if len(keys):
                    yield pa.RecordBatch.from_arrays([keys], names=["packed"])

    def run(batches):
        tile, waiting, held = None, [], {}
        for whole in batches:
            at = np.stack([whole.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows]):
                if start == end:
                    continue
                here, side = tuple(at[:2, start].tolist()), at[2, start]
                if here != tile:
                    yield from ended(held)
                    tile, waiting, held = here, [], {}
                batch = pa.RecordBatch.from_arrays(
                    whole.slice(start, end - start).columns[3:], names=["key", "label", "vector", "windows"])
                if side == 0:
                    waiting.append(batch)
                    continue
                if waiting:
                    held, waiting = gathered(waiting), []
                for length, rows in _by_length(batch):
                    if length in held:
                        step = max(1, SCORES // len(held[length].keys))
                        for i in range(0, len(rows), step):
                            held[length].see(*_arrays(batch, length, rows[i:i + step]))
        yield from ended(held)

    def gathered(waiting):
        """The anchors by the length of their vectors; a tile's rows come after all of its anchors."""
        parts = {}
        for batch in waiting:
            for length, rows in _by_length(batch):
                parts.setdefault(length, []).append(
                    (*_arrays(batch, length, rows), batch.column(3).take(pa.array(rows)).to_pylist()))
        return {n: made(*(np.concatenate([p[i] for p in own]) for i in range(3)), [w for p in own for w in p[3]])
                for n, own in parts.items()}

    return run


class Tiles:
    """Parts of the rows and blocks of the anchors that together hold every pair once."""

    def __init__(self, rows: DataFrame, anchors: DataFrame):
        self.rows, self.anchors = rows, anchors
        count = rows.count()
        held = anchors.agg(F.sum(F.size("vector") * 4 + 64)).first()[0] or 0
        self.blocks = max(1, -(-int(held) // BLOCK_BYTES))
        tasks = rows.sparkSession.sparkContext.defaultParallelism
        self.parts = max(1, -(-count // TILE_ROWS), -(-tasks // self.blocks))

    def run(self, made, windows: DataFrame | None = None) -> DataFrame:
        """What the tiles keep of their pairs, as `packed` keys. `windows` has the anchors' positive scores; anchors
        that it lacks take no part."""
        none = F.lit(None).cast("array<long>")
        anchors = (self.anchors.withColumn("windows", none) if windows is None
                   else self.anchors.join(windows.select("key", F.col("scores").alias("windows")), "key"))
        block = F.pmod(F.xxhash64(F.lit("block"), "key"), F.lit(self.blocks)).cast("int")
        part = F.pmod(F.xxhash64(F.lit("part"), "key"), F.lit(self.parts)).cast("int")
        columns = ["part", "block", "side", "key", "label", "vector", "windows"]
        held = anchors.withColumns({
            "block": block, "part": F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))), "side": F.lit(0)})
        seen = self.rows.withColumns({
            "part": part, "block": F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))), "side": F.lit(1),
            "windows": none})
        tiles = (held.select(*columns).union(seen.select(*columns))
                 .repartition(2 * self.parts * self.blocks, "part", "block")
                 .sortWithinPartitions("part", "block", "side"))
        return tiles.mapInArrow(_tiles(made), "packed binary")


def dealt(keys: DataFrame) -> DataFrame:
    """Packed keys, each anchor's in one partition and in order."""
    return keys.repartition(F.substring("packed", 1, 8)).sortWithinPartitions("packed")


def first_positives(keys: DataFrame, size: int) -> DataFrame:
    """`key`, `ids` and `scores` of each anchor's first few rows."""

    def run(batches):
        anchor, held = None, []
        for batch in batches:
            done = []
            for key in batch.column(0).to_pylist():
                here, score, _, ident = unpacked(key)
                if here != anchor:
                    if held:
                        done.append((anchor, held))
                    anchor, held = here, []
                if len(held) < size:
                    held.append((ident, score))
            if done:
                yield table(done)
        if held:
            yield table([(anchor, held)])

    def table(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in done], pa.int64()), pa.array([[i for i, _ in h] for _, h in done], pa.list_(pa.int64())),
             pa.array([[s for _, s in h] for _, h in done], pa.list_(pa.int64()))], names=["key", "ids", "scores"])

    return dealt(keys).mapInArrow(run, "key long, ids array<long>, scores array<long>")


def positive_keys(windows: DataFrame) -> DataFrame:
    """The packed keys of the positives."""

    def run(batches):
        for batch in batches:
            counts = batch.column(1).value_lengths().to_numpy()
            anchors = np.repeat(batch.column(0).to_numpy(), counts)
            yield pa.RecordBatch.from_arrays(
                [packed(anchors, batch.column(2).flatten().to_numpy(), 0, batch.column(1).flatten().to_numpy())],
                names=["packed"])

    return windows.mapInArrow(run, "packed binary")


def _mined(size: int, percent: int):
    """Walks through the sorted keys: a positive opens a window, a negative goes to the open ones."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        anchor, windows = None, []
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                here, score, kind, ident = unpacked(key)
                if here != anchor:
                    anchor, windows = here, []
                if kind == 0:
                    windows.append([ident, score, 0])
                    continue
                # full windows, and those the scores have left behind, are closed
                windows = [w for w in windows if w[2] < size and 100 * score >= percent * w[1]]
                for w in windows:
                    w[2] += 1
                    found.append((anchor, w[0], w[2], ident, w[1], score))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    return run


def mined(df: DataFrame, anchors: Column | str, key: str = "vec_id", label: str = "label", column: str = "embedding",
          positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT, scale: int = SCALE) -> DataFrame:
    """Per anchor and positive its first negatives: `anchor_id`, `positive_id`, `rank`, `negative_id`,
    `positive_score` and `negative_score`. `anchors` is a condition on `key`, the ids as longs."""
    rows = stored(usable(df, key, label, column, scale), "rows")
    tiles = Tiles(rows, rows.filter(anchors))
    best = tiles.run(lambda k, l, v, _: Positives(k, l, v, positives))
    windows = stored(first_positives(best, positives), "windows")

    def negative(keys, labels, vectors, scores):
        filled = np.array([[*s, *[NONE] * (positives - len(s))] for s in scores], np.int64).reshape(len(keys), positives)
        return Negatives(keys, labels, vectors, filled, negatives, percent)

    keys = tiles.run(negative, windows).union(positive_keys(windows))
    return dealt(keys).mapInArrow(
        _mined(negatives, percent),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
