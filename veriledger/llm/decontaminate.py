"""Benchmark passages in training text, found by suffix arrays of the training text.

The documents are cut into index shards of a bounded number of words. A task builds the suffix array of
a shard, binary-searches the suffixes of all benchmark items in it and reads off where a window of an
item occurs. The benchmark travels in blocks of a bounded size, a few of which are sent to the tasks at once. If there
are more, the documents are read once for every further few; what is found is stored by the digest of the text, of hit texts
alone, and put together at the end. So any number of items meets any number of documents, and neither a task nor
the driver holds more than a few blocks.

Words are maximal runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. Null and empty
texts have no words: such documents are never hit, such items have no windows. Repeated items of one id
count once; an item without id counts as the item named by the empty string.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.frames import extended, pieces, quoted, slices, stored, without
from veriledger.llm.words import NOT_ALNUM, Words, split
from veriledger.operators.skew import join_parent

WINDOW = 13

#: Words of an index shard, and bytes of text of a benchmark block. Both bound memory only: a longer
#: text is a shard by itself, a longer item a block by itself.
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 8 << 20

#: Blocks that tasks hold at once.
GROUP_BLOCKS = 4

#: Places of windows handled at once.
AT_ONCE = 4_000_000


class Block(NamedTuple):
    """Items of the benchmark: ids into the block's distinct words, and each item's first word."""

    names: list[str]
    ids: np.ndarray
    rows: np.ndarray
    distinct: pa.Array


class SuffixArray:
    """All suffixes of a row of texts in order. A text's end is a token of its own below all words, so
    no match runs from one text into the next."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vocabulary: int):
        texts = len(rows) - 1
        lengths = np.diff(rows)
        self.starts = rows[:-1] - rows[0] + np.arange(texts)
        self.lengths = lengths
        self.base = texts
        n = self.size = int(rows[-1] - rows[0]) + texts
        self.tokens = np.empty(n + 1, np.int64)
        ends = self.starts + lengths
        inside = np.ones(n, bool)
        inside[ends] = False
        self.tokens[:n][inside] = ids[rows[0]:rows[-1]].astype(np.int64) + texts
        self.tokens[ends] = np.arange(texts)
        self.tokens[n] = 0
        self.bits = max(int(texts + vocabulary), 1).bit_length()
        self.width = max(1, 63 // self.bits)
        self._sort()

    def _sort(self) -> None:
        n = self.size
        key = np.zeros(n, np.int64)
        for j in range(self.width):
            key <<= self.bits
            if j < n:
                key[:n - j] |= self.tokens[j:n]
        order = np.argsort(key)
        self.keys = key[order]
        group = _groups(self.keys, np.arange(n))
        rank = np.zeros(n + 1, np.int64)
        rank[order] = group
        open_ = _unsettled(group)
        bits, depth = max(n, 1).bit_length(), self.width
        steps = 2 if 3 * bits <= 63 else 1
        while len(open_):
            places = order[open_]
            key = rank[places]
            for j in range(1, steps + 1):
                key = key << bits | rank[np.minimum(places + j * depth, n)]
            by = np.argsort(key)
            places, key = places[by], key[by]
            order[open_] = places
            group = _groups(key, open_)
            rank[places] = group
            open_ = open_[_unsettled(group)]
            depth *= steps + 1
        self.order = order

    def common(self, places: np.ndarray, pattern: np.ndarray, starts: np.ndarray, limits: np.ndarray,
               known) -> np.ndarray:
        """How many words of a pattern, up to a limit, the text has from each place on."""
        same = np.minimum(known, limits)
        active = np.flatnonzero(same < limits)
        while len(active):
            equal = (self.tokens[np.minimum(places[active] + same[active], self.size)]
                     == pattern[starts[active] + same[active]])
            active = active[equal]
            same[active] += 1
            active = active[same[active] < limits[active]]
        return same

    def ranges(self, pattern: np.ndarray, starts: np.ndarray, limits: np.ndarray):
        """First and last plus one of the suffixes that begin with each stretch of the pattern."""
        first = np.zeros(len(starts), np.int64)
        last = np.zeros(len(starts), np.int64)
        for j in range(self.width):
            inside = j < limits
            word = np.where(inside, pattern[np.minimum(starts + j, len(pattern) - 1)], 0)
            first = first << self.bits | word
            last = last << self.bits | np.where(inside, word, (1 << self.bits) - 1)
        low, high = np.searchsorted(self.keys, first, "left"), np.searchsorted(self.keys, last, "right")
        deep = np.flatnonzero((limits > self.width) & (high > low))
        for upper in (False, True):
            a, b = low[deep].copy(), high[deep].copy()
            while len(live := np.flatnonzero(a < b)):
                middle = (a[live] + b[live]) // 2
                at = deep[live]
                places = self.order[middle]
                same = self.common(places, pattern, starts[at], limits[at], self.width)
                whole = same == limits[at]
                text = self.tokens[np.minimum(places + same, self.size)]
                wanted = pattern[np.minimum(starts[at] + same, len(pattern) - 1)]
                right = np.where(whole, upper, text < wanted)
                a[live[right]], b[live[~right]] = middle[right] + 1, middle[~right]
            if upper:
                high[deep] = a
            else:
                found = a
        low[deep] = found
        return low, np.maximum(low, high)

    def longest(self, pattern: np.ndarray, starts: np.ndarray, limits: np.ndarray):
        """The longest match of each stretch of the pattern and one place of it."""
        low = np.zeros(len(starts), np.int64)
        high = np.full(len(starts), self.size)
        while len(live := np.flatnonzero(low < high)):
            middle = (low[live] + high[live]) // 2
            places = self.order[middle]
            same = self.common(places, pattern, starts[live], limits[live], 0)
            text = self.tokens[np.minimum(places + same, self.size)]
            wanted = pattern[np.minimum(starts[live] + same, len(pattern) - 1)]
            right = (same < limits[live]) & (text < wanted)
            low[live[right]], high[live[~right]] = middle[right] + 1, middle[~right]
        best, place = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for near in (low - 1, low):
            real = np.flatnonzero((near >= 0) & (near < self.size))
            places = self.order[near[real]]
            same = self.common(places, pattern, starts[real], limits[real], 0)
            better = same > best[real]
            best[real[better]], place[real[better]] = same[better], places[better]
        return best, place


def _groups(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The first slot of each run of equal sorted keys."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.maximum.accumulate(np.where(first, slots, 0))


def _unsettled(group: np.ndarray) -> np.ndarray:
    same = group[1:] == group[:-1]
    shared = np.zeros(len(group), bool)
    shared[1:] |= same
    shared[:-1] |= same
    return np.flatnonzero(shared)


def _in_shard(block: Block, words: Words, base: int) -> np.ndarray:
    """The block's words as tokens of a shard; -1 where the shard has no such word."""
    known = pc.index_in(block.distinct, words.distinct)
    known = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = known[block.ids] if len(block.ids) else np.empty(0, np.int64)
    return np.where(tokens >= 0, tokens + base, -1)


def windows(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and item of every window: `size` consecutive words, or a shorter item's all."""
    lengths = np.diff(rows)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    item = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)
    return rows[item] + nth, np.minimum(lengths[item], size), item


def _hits(array: SuffixArray, block: Block, pattern: np.ndarray, size: int, edges: np.ndarray) -> set:
    """Adds each occurrence's ends to `edges`; gives the pairs of text and item."""
    starts, limits, item = windows(block.rows, size)
    absent = np.concatenate([[0], np.cumsum(pattern < 0)])
    whole = absent[starts + limits] == absent[starts]
    starts, limits, item = starts[whole], limits[whole], item[whole]
    if not len(starts):
        return set()
    low, high = array.ranges(pattern, starts, limits)
    some = np.flatnonzero(high > low)
    pairs: set = set()
    for a, b in pieces((high - low)[some], AT_ONCE):
        chosen = some[a:b]
        counts = (high - low)[chosen]
        which = np.repeat(chosen, counts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        places = array.order[low[which] + nth]
        np.add.at(edges, places, 1)
        np.add.at(edges, places + limits[which], -1)
        text = np.searchsorted(array.starts, places, "right") - 1
        for pair in np.unique(text * len(block.names) + item[which]).tolist():
            pairs.add((pair // len(block.names), block.names[pair % len(block.names)]))
    return pairs


_FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
           T.StructField("items", T.ArrayType(T.StringType())),
           T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))]


_NAMES = [f.name for f in _FIELDS]


def _search(texts: pa.Array, blocks: list, size: int) -> dict:
    n_words, n_hit, items, spans = [], [], [], []
    words = split(texts, NOT_ALNUM, True)
    for a, b in pieces(np.diff(words.rows), SHARD_WORDS):
        part = _shard(words, a, b)
        array = SuffixArray(part.ids, part.rows, len(part.distinct))
        edges = np.zeros(array.size + 1, np.int64)
        found: list[set] = [set() for _ in range(b - a)]
        for sent in blocks:
            block = sent.value
            for text, name in _hits(array, block, _in_shard(block, part, array.base), size, edges):
                found[text].add(name)
        hit = np.cumsum(edges) > 0
        running = np.concatenate([[0], np.cumsum(hit)])
        n_words += array.lengths.tolist()
        n_hit += (running[array.starts + array.lengths] - running[array.starts]).tolist()
        items += [sorted(x) for x in found]
        for i in range(b - a):
            own = hit[array.starts[i]:array.starts[i] + array.lengths[i]] if found[i] else hit[:0]
            turns = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
            spans.append(turns.reshape(-1, 2).tolist())
    return {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
            "items": pa.array(items, pa.list_(pa.string())),
            "spans": pa.array(spans, pa.list_(pa.list_(pa.int64())))}


def _shard(words: Words, a: int, b: int) -> Words:
    """Texts a to b with numbers of their own words only."""
    ids = words.ids[words.rows[a]:words.rows[b]]
    used = np.zeros(len(words.distinct), bool)
    used[ids] = True
    number = np.cumsum(used) - 1
    return Words(number[ids], words.begins, words.ends, words.rows[a:b + 1] - words.rows[a],
                 words.distinct.filter(pa.array(used)))


def groups_of(benchmark: DataFrame, key: str, column: str) -> Iterator[list]:
    """The items as lists of a few broadcast blocks. The driver reads one block at a time."""
    context = benchmark.sparkSession.sparkContext
    sent, names, texts, size = [], [], [], 0

    def send():
        words = split(pa.array(texts, pa.string()), NOT_ALNUM, True)
        sent.append(context.broadcast(Block(list(names), words.ids.astype(np.int64), words.rows, words.distinct)))

    rows = benchmark.select(quoted(key).cast("string"), quoted(column).cast("string"))
    for name, text in rows.toLocalIterator():
        more = len((text or "").encode())
        if texts and size + more > BLOCK_BYTES:
            send()
            names, texts, size = [], [], 0
            if len(sent) == GROUP_BLOCKS:
                yield sent
                sent = []
        names.append(name or "")
        texts.append(text or "")
        size += more
    if texts:
        send()
    if sent:
        yield sent


def matched(documents: DataFrame, benchmark: DataFrame, column: str = "text", key: str = "item_id",
            size: int = WINDOW, keep=None) -> DataFrame:
    """The documents with `n_words`, `n_hit` (words inside an occurrence of a window), `items` (ids of
    items with occurring windows, as sorted strings) and `spans` (hit stretches of words, end exclusive).

    Columns of these names give way to the new ones; every row is kept, repeated ones too. With no
    items nothing is hit.
    """
    groups = groups_of(benchmark, key, column)
    sent = next(groups, [])
    own = [c for c in without(documents, _NAMES) if keep is None or c in keep]

    def search(rows: DataFrame, group: list, kept: list[str] | None) -> DataFrame:
        return extended(rows, column, _FIELDS, lambda texts: _search(texts, group, size), kept)

    more = None
    for group in groups:
        hits = search(documents.select(quoted(column)), group, [column]).filter("n_hit > 0")
        hits = hits.select(F.md5(quoted(column).cast("binary")).alias("digest"), "items", "spans")
        hits = stored(hits.groupBy("digest").agg(F.first("items").alias("items"), F.first("spans").alias("spans")), "hits")
        for block in group:
            block.unpersist()
        more = hits if more is None else more.union(hits)
    if more is None:
        return search(documents, sent, keep)
    digest = F.md5(quoted(column).cast("string").cast("binary")).alias("_digest")
    found = search(documents.select(*[quoted(c) for c in dict.fromkeys([*own, column])], digest), sent, [*own, "_digest"])
    rest = more.groupBy("digest").agg(F.flatten(F.collect_list("items")).alias("_items"),
                                      F.flatten(F.collect_list("spans")).alias("_spans"))
    both = join_parent(found, rest, [("_digest", "digest")], "left")
    spans = F.when(F.col("_spans").isNull(), F.col("spans")).otherwise(_joined(F.concat("spans", "_spans")))
    items = F.when(F.col("_items").isNull(), F.col("items")).otherwise(
        F.array_sort(F.array_distinct(F.concat("items", "_items"))))
    both = both.withColumns({"spans": spans, "items": items})
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return both.withColumn("n_hit", hit).select(*[quoted(c) for c in own], *_NAMES)


def _joined(spans: Column) -> Column:
    """Stretches that touch as one, in order."""
    none = F.expr("cast(array() as array<array<bigint>>)")

    def step(done, s):
        last = F.element_at(done, -1)
        apart = (F.size(done) == 0) | (s[0] > F.when(F.size(done) > 0, last[1]))
        grown = F.array(last[0], F.greatest(last[1], s[1]))
        return F.when(apart, F.concat(done, F.array(s))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown)))

    return F.aggregate(F.array_sort(spans), none, step)


def contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def verdicts(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its counts, a digest of the items' ids and whether it counts as contaminated."""
    return matched(documents, benchmark, keep=["doc_id"]).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))


def removed(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without the contaminated ones."""
    return matched(documents, benchmark).filter(~contaminated()).drop(*_NAMES)


def longest_matches(documents: DataFrame, benchmark: DataFrame, column: str = "text", key: str = "item_id",
                    row: str = "doc_id") -> DataFrame:
    """Per item its longest verbatim match in the documents: `item`, `at` (word in the item), `length` in
    words, the document's key as a string and `place`, the word in the document where it begins.

    Equal lengths go to the smallest key, then the first places. An item without a common word is absent.
    """
    schema = "item string, length long, doc string, at long, place long"
    texts = documents.select(quoted(row).cast("string"), quoted(column).cast("string"))
    best = F.struct(-F.col("length"), "doc", "at", "place")
    found = None
    for group in groups_of(benchmark, key, column):
        longest = texts.mapInArrow(_longest(group), schema).groupBy("item").agg(F.min(best).alias("m"))
        longest = stored(longest, "longest")  # a row an item
        for block in group:
            block.unpersist()
        found = longest if found is None else found.union(longest)
    if found is None:
        return documents.sparkSession.createDataFrame([], "item string, length long, doc string, at long, place long")
    return found.groupBy("item").agg(F.min("m").alias("m")).select(
        "item", (-F.col("m.col1")).alias("length"), "m.doc", "m.at", "m.place")


def _longest(sent: list):
    """Per shard and item the longest match."""

    def run(parts):
        for batch in (s for whole in parts for s in slices(whole, 1)):
            words = split(batch.column(1), NOT_ALNUM, True)
            for a, b in pieces(np.diff(words.rows), SHARD_WORDS):
                part = _shard(words, a, b)
                array = SuffixArray(part.ids, part.rows, len(part.distinct))
                for handle in sent:
                    block = handle.value
                    pattern = _in_shard(block, part, array.base)
                    if not len(pattern) or not array.size:
                        continue
                    starts = np.arange(len(pattern))
                    item = np.searchsorted(block.rows, starts, "right") - 1
                    best, place = array.longest(pattern, starts, block.rows[item + 1] - starts)
                    out = []
                    for i in np.lexsort((starts, -best, item)):
                        if best[i] and (not out or out[-1][0] != item[i]):
                            text = int(np.searchsorted(array.starts, place[i], "right") - 1)
                            out.append((item[i], int(best[i]), batch.column(0)[a + text].as_py(),
                                        int(starts[i] - block.rows[item[i]]), int(place[i] - array.starts[text])))
                    yield pa.RecordBatch.from_pylist(
                        [{"item": block.names[i], "length": n, "doc": d, "at": s, "place": p}
                         for i, n, d, s, p in out],
                        schema=pa.schema([("item", pa.string()), ("length", pa.int64()), ("doc", pa.string()),
                                          ("at", pa.int64()), ("place", pa.int64())]))

    return run
