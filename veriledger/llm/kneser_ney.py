"""A quality classifier: the perplexity of a text under an interpolated modified Kneser-Ney model of
trusted text, held against a quantile of trusted text of its language.

The model is over characters. A word that repeats the word before it is spelled, with the space before it,
as one sign that tells how often it was repeated, so running on is as unlikely as it is in trusted text. The n-grams of all
documents are counted, with how often each is in trusted training text; shuffled joins of the counts with
their contexts and with the next lower order give every n-gram its probability. The n-grams that trusted text has
most often are then cut into at most SENT_SHARDS hash tables, and tasks look their texts' n-grams up in
them. What a text has of the others, if there are more, is counted and joined with their table, so what is sent to tasks
does not grow with the input. Costs are whole numbers of a small unit and discounts are summed by counts, so which
n-grams are sent, and in which order anything is added, changes no sum.

Trusted text has label 1. One trusted document in five, by the checksum of its id, stays out of training
and sets the thresholds. A short text's mean is drawn towards its language's mean, as chance moves it more.

Null and empty texts have no perplexity and are not kept. A null language is a language of its own; one
with too few trusted documents takes the threshold of all. Without trusted documents, or without a
trusted document to set a threshold, every text that is not empty is kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.frames import extended, quoted, slices, stored, without
from veriledger.llm.words import SPREAD, grams, spread

ORDER = 5
BEGIN = 2

#: The signs of a word's first, second, ... repetition; later ones share the last.
AGAIN, MOST_AGAIN = 0xE000, 16

#: Bytes of text that are spelled at once; a symbol takes some hundred bytes on the way.
AT_ONCE = 1 << 19

#: n-grams of slices that wait to be merged into a task's table.
PENDING = 500_000

#: n-grams of a shard, whose table takes 24 to 48 MB.
SHARD_GRAMS = 1 << 20

#: Shards that are sent to all tasks; other n-grams are joined.
SENT_SHARDS = 4

#: Counts in trusted text from which n-grams are not told apart when the most frequent ones are taken.
FREQUENT = 1 << 12

#: Bytes up to which the table of trusted ids, or of languages, is sent to all tasks; beyond, Spark joins as it sees fit.
SENT_BYTES = 32 << 20

#: Units of a cost in a nat.
UNIT = 1 << 20

#: The quantile of trusted held-out text and how many nats beyond it still pass, characters of the mean that
#: every text is drawn to, bins per nat in which quantiles are counted, and documents that a language needs
#: for a threshold of its own.
QUANTILE, BEYOND, DRAWN, BINS, LEAST = 0.998, 0.25, 30, 1000, 50

_BLANKS = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], np.uint64)


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's symbols after ORDER - 1 begin signs, in one row, and where each text's symbols begin."""
    pad = chr(BEGIN) * (ORDER - 1)
    parts = [t or "" for t in texts.to_pylist()]
    row = np.frombuffer("".join(pad + t for t in parts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in parts], np.int64)
    starts = np.cumsum(lengths + ORDER - 1) - lengths
    inside = ~np.isin(row, _BLANKS)
    text = np.repeat(np.arange(len(parts)), lengths + ORDER - 1)
    for j in range(1, ORDER):
        inside[starts - j] = False
    before = np.concatenate([[False], inside[:-1]])
    begins = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    if len(begins) > 1:
        lengths_of = ends - begins
        at = _since(begins, len(row)).astype(np.uint64)
        mixed = np.where(inside, spread(row + at * SPREAD), np.uint64(0))
        sums = np.add.reduceat(mixed, begins)
        again = (sums[1:] == sums[:-1]) & (lengths_of[1:] == lengths_of[:-1]) & (text[begins[1:]] == text[begins[:-1]])
        words = np.flatnonzero(again) + 1
        if len(words):
            nth = np.arange(1, len(begins))
            nth = (nth - np.maximum.accumulate(np.where(again, 0, nth)))[words - 1]
            edges = np.zeros(len(row) + 1, np.int8)
            edges[ends[words - 1]] += 1
            np.add.at(edges, ends[words], -1)
            dropped = np.cumsum(edges[:-1], dtype=np.int8) > 0
            dropped[begins[words]] = False
            row = row.copy()
            row[begins[words]] = AGAIN + np.minimum(nth, MOST_AGAIN).astype(np.uint64)
            starts = starts - np.concatenate([[0], np.cumsum(dropped)])[starts]
            row = row[~dropped]
    return row, starts


def _since(begins: np.ndarray, size: int) -> np.ndarray:
    """For each place how far the last begin lies back; before the first it counts from 0."""
    last = np.zeros(size, np.int64)
    last[begins] = begins
    return np.arange(size) - np.maximum.accumulate(last)


def _places(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First symbol of each n-gram that ends in a text's own symbol, and how many each text has."""
    counts = np.diff(np.append(starts, size + ORDER - 1)) - (ORDER - 1)
    first = np.ones(max(size - ORDER + 1, 0), bool)
    for j in range(1, ORDER):  # an n-gram that ends in a begin sign of the next text
        at = starts[1:] - j - ORDER + 1
        first[at[at >= 0]] = False
    return np.flatnonzero(first), counts


def _count(parts):
    """The distinct n-grams of a task's texts with how many of each are in texts to train on."""
    found: list[tuple] = []
    for batch in (s for whole in parts for s in slices(whole, 0, AT_ONCE)):
        row, starts = symbols(batch.column(0))
        places, counts = _places(starts, len(row))
        if not len(places):
            continue
        trained = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), counts).astype(np.int64)
        key = grams(row, ORDER)[places]
        by = np.argsort(key)
        key = key[by]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        at = places[by[first]]
        words = row[at[:, None] + np.arange(ORDER)].astype(np.uint32)
        found.append((key[first], np.add.reduceat(trained[by], first), words))
        if sum(len(f[0]) for f in found[1:]) > PENDING:
            found = [_merged(found)]
    if not found:
        return
    _, numbers, words = _merged(found)
    found.clear()
    for a in range(0, len(numbers), 100_000):
        text = words[a:a + 100_000].tobytes().decode("utf-32-le")
        yield pa.RecordBatch.from_arrays(
            [pa.array([text[i:i + ORDER] for i in range(0, len(text), ORDER)]),
             pa.array(numbers[a:a + 100_000])], names=["gram", "n"])


def _merged(found: list[tuple]) -> tuple:
    """Counts of several slices as one, by key."""
    keys, numbers, words = (np.concatenate(c) for c in zip(*found))
    by = np.argsort(keys, kind="stable")
    keys = keys[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(numbers[by], first), words[by[first]]


def trusted(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The ids whose labels all say good, with `held_out` for one in five."""
    return (labels.filter(quoted(key).isNotNull()).groupBy(quoted(key).alias("_id"))
            .agg(F.min("quality").alias("q")).filter("q = 1")
            .select("_id", (F.crc32(F.col("_id").cast("string")) % 5 == 0).alias("_held_out")))


def _sent(df: DataFrame) -> DataFrame:
    """The table, sent to all tasks if its counted bytes are few enough, with 32 for a row's other costs."""
    size = sum((F.coalesce(F.octet_length(quoted(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(32))
    held = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if held <= SENT_BYTES else df


def _orders(grams_: DataFrame) -> list[DataFrame]:
    """Counts of each order from 1 on: of the highest as seen, of a lower one the distinct n-grams of the
    next order that end in it. n-grams that trusted text lacks have 0."""
    orders = [grams_]
    for _ in range(ORDER - 1):
        orders.append(stored(orders[-1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(
            F.sum((F.col("n") > 0).cast("long")).alias("n")), "grams"))
    return orders[::-1]


def discounts(of: dict[int, int]) -> list[float]:
    """What modified Kneser-Ney takes off counts of 1, 2 and 3 or more, from how many n-grams have each
    count; where a count is missing, the plain estimate that needs it is not."""
    n1, n2, n3, n4 = (of.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 else 2 * y, 3 - 4 * y * n4 / n3 if n3 else 3 * y]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def probabilities(grams_: DataFrame) -> DataFrame | None:
    """`gram`, `p`, the interpolated probability of its last symbol after the others, and `n`, its count; none
    if no n-gram is of trusted text."""
    orders = _orders(grams_)
    tables = [t.filter("n > 0").groupBy(F.least("n", F.lit(5)).alias("n")).agg(F.count("*").alias("c"))
              .withColumn("order", F.lit(i + 1)) for i, t in enumerate(orders)]
    counts = tables[0]
    for t in tables[1:]:
        counts = counts.union(t)
    of = {}
    for r in counts.collect():  # five numbers an order
        of.setdefault(r["order"], {})[r["n"]] = r["c"]
    if not of:
        return None
    lower = None
    vocabulary = orders[0].count() + 1
    for i, table in enumerate(orders):
        d1, d2, d3 = discounts(of[i + 1])
        taken = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        rows = table.withColumn("context", F.expr(f"substring(gram, 1, {i})"))
        once, twice, often = (F.count_if(c) for c in (F.col("n") == 1, F.col("n") == 2, F.col("n") > 2))
        contexts = rows.filter("n > 0").groupBy("context").agg(
            F.sum("n").alias("total"), ((once * d1 + twice * d2 + often * d3) / F.sum("n")).alias("left"))
        rows = rows.join(contexts, "context", "left")
        own = F.when(F.col("n") > 0, (F.col("n") - taken) / F.col("total")).otherwise(0.0)
        left = F.coalesce("left", F.lit(1.0))
        if lower is None:
            lower = stored(rows.select("gram", (own + left / vocabulary).alias("p"), "n"), "orders")
        else:
            rows = rows.withColumn("end", F.expr("substring(gram, 2)"))
            lower = stored(rows.join(lower.toDF("end", "q", "_"), "end").select(
                "gram", (own + left * F.col("q")).alias("p"), "n"), "orders")
    return lower


def _keyed(parts):
    for batch in parts:
        text = "".join(batch.column(0).to_pylist())
        row = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        key = grams(row, ORDER)[::ORDER] if len(row) else row
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(np.rint(-np.log(batch.column(1).to_numpy()) * UNIT).astype(np.int32)),
             batch.column(2)],
            names=["key", "cost", "n"])


class Costs:
    """The negative log-probabilities of n-grams, in units: of the most frequent ones in hash tables cut by the keys'
    remainder, of the others, if there are more, as the table `rest`."""

    def __init__(self, grams_: DataFrame):
        model = probabilities(grams_)
        self.parts, self.rest = [], None
        if model is None:
            return
        keyed = model.mapInArrow(_keyed, "key long, cost int, n long")
        least, sent = self._sent_from(grams_)
        if least:
            self.rest = stored(keyed.filter(F.col("n") < least).select("key", "cost"), "costs")
        count = max(1, math.ceil(sent / SHARD_GRAMS))
        shard = F.pmod(F.col("key"), F.lit(count))
        table = stored(keyed.filter(F.col("n") >= least).withColumn("shard", shard).repartition("shard")
                       .sortWithinPartitions("shard", "key"), "costs") if sent else None
        context = grams_.sparkSession.sparkContext
        for i in range(count):  # the driver holds one shard at a time
            keys, costs = np.empty(0, np.uint64), np.empty(0, np.int32)
            if sent:
                rows = table.filter(F.col("shard") == i).select("key", "cost").toArrow()
                keys, costs = rows["key"].to_numpy().view(np.uint64), rows["cost"].to_numpy()
            self.parts.append(context.broadcast(_table(keys, costs)))

    @staticmethod
    def _sent_from(grams_: DataFrame) -> tuple[int, int]:
        """The least count that n-grams in the sent tables have, and how many these are; 0 if all are sent."""
        most = SENT_SHARDS * SHARD_GRAMS
        counts = grams_.groupBy(F.least("n", F.lit(FREQUENT)).alias("n")).agg(F.count("*").alias("c"))
        least, sent = 1 << 62, 0
        for r in sorted(counts.collect(), key=lambda r: -r["n"]):  # FREQUENT + 1 rows at most
            if sent + r["c"] > most:
                return least, sent
            least, sent = r["n"], sent + r["c"]
        return 0, sent


def _table(keys: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash table with open addressing; a key of 0 is an empty place."""
    size = 1 << max(4, (2 * len(keys)).bit_length())
    own, values = np.zeros(size, np.uint64), np.zeros(size, np.int32)
    keys = np.where(keys == 0, np.uint64(1), keys)
    waiting, place = np.arange(len(keys)), _place(keys, size)
    while len(waiting):
        free = own[place[waiting]] == 0
        own[place[waiting[free]]] = keys[waiting[free]]
        settled = own[place[waiting]] == keys[waiting]
        done = waiting[settled]
        values[place[done]] = costs[done]
        waiting = waiting[~settled]
        place[waiting] = (place[waiting] + 1) & (size - 1)
    return own, values


def _place(keys: np.ndarray, size: int) -> np.ndarray:
    return (keys >> np.uint64(16)).astype(np.int64) & (size - 1)


def _lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys' costs, 0 for those that the table lacks, and which it has."""
    own, values = table
    keys = np.where(keys == 0, np.uint64(1), keys)
    place = _place(keys, len(own))
    waiting = np.flatnonzero((own[place] != keys) & (own[place] != 0))
    while len(waiting):
        at = (place[waiting] + 1) & (len(own) - 1)
        place[waiting] = at
        waiting = waiting[(own[at] != keys[waiting]) & (own[at] != 0)]
    return values[place], own[place] == keys


_FIELDS = [T.StructField("n_scored", T.LongType()), T.StructField("cost", T.LongType())]


def _looked_up(parts: list, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many n-grams each text has, and of each n-gram the key, the cost and whether a sent table has it."""
    row, starts = symbols(texts)
    places, counts = _places(starts, len(row))
    key = grams(row, ORDER)[places]
    if len(parts) == 1:
        return counts, key, *_lookup(parts[0].value, key)
    cost, known = np.empty(len(key), np.int32), np.empty(len(key), bool)
    shard = (key.view(np.int64) % len(parts)).astype(np.int64)
    by = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[by], np.arange(len(parts) + 1))
    for i, part in enumerate(parts):
        own = by[ends[i]:ends[i + 1]]
        cost[own], known[own] = _lookup(part.value, key[own])
    return counts, key, cost, known


def _digests(texts: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t or "") for t in texts.to_pylist()], np.uint64).view(np.int64)


def _rare(parts: list):
    """Of each text's n-grams that no sent table has: the text's digest, the key and how many it has."""

    def run(batches):
        for batch in (s for whole in batches for s in slices(whole, 0, AT_ONCE)):
            own, at = np.unique(_digests(batch.column(0)), return_index=True)  # a text once
            counts, key, _, known = _looked_up(parts, batch.column(0).take(pa.array(at)))
            text = np.repeat(own, counts)[~known]
            key = key[~known].view(np.int64)
            by = np.lexsort((key, text))
            text, key = text[by], key[by]
            first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (key[1:] != key[:-1]))[:len(text)])
            n = np.diff(np.append(first, len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(text[first]), pa.array(key[first]), pa.array(n, pa.int64())],
                                             names=["digest", "key", "n"])

    return run


def scored(df: DataFrame, costs: Costs, column: str = "text", keep=None) -> DataFrame:
    """The rows with `n_scored`, a text's characters, and `cost`, the sum of their negative
    log-probabilities; the costs must be of n-grams that hold the texts' own."""
    parts = costs.parts

    def work(texts: pa.Array) -> dict:
        counts, _, cost, _ = _looked_up(parts, texts)
        sums = np.concatenate([[0], np.cumsum(cost, dtype=np.int64)])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return {"n_scored": pa.array(counts), "cost": pa.array(sums[ends[1:]] - sums[ends[:-1]])}

    def in_nats(found: DataFrame) -> DataFrame:
        return found.withColumn("cost", F.col("cost") / F.lit(float(UNIT)))

    if costs.rest is None:
        return in_nats(extended(df, column, _FIELDS, work, keep, AT_ONCE))
    rare = df.select(quoted(column).cast("string").alias("text")).mapInArrow(
        _rare(parts), "digest long, key long, n long")
    # Copies of a text are counted once. The join splits keys that many texts have.
    sums = (rare.groupBy("digest", "key").agg(F.first("n").alias("n")).join(costs.rest, "key")
            .groupBy("digest").agg(F.sum(F.col("n") * F.col("cost")).alias("_rest")))
    found = extended(df, column, [*_FIELDS, T.StructField("_digest", T.LongType())],
                     lambda texts: work(texts) | {"_digest": pa.array(_digests(texts))}, keep, AT_ONCE)
    whole = (F.col("cost") + F.coalesce("_rest", F.lit(0))).alias("cost")
    return in_nats(found.join(sums, found["_digest"] == sums["digest"], "left").select(
        *[whole if c == "cost" else quoted(c) for c in found.columns if c != "_digest"]))


def _drawn(mean):
    """A text's mean cost, drawn to `mean` as if it had DRAWN characters more of it."""
    return (F.col("cost") + DRAWN * mean) / (F.col("n_scored") + DRAWN)


class Classifier:
    """Counts, costs and thresholds from a table of documents and one of labels."""

    def __init__(self, df: DataFrame, labels: DataFrame, key: str = "doc_id", column: str = "text",
                 language: str = "lang"):
        self.column, self.language = column, language
        ids = _sent(stored(trusted(labels, key), "trusted"))
        texts = df.select(quoted(key).alias("_id"), quoted(column).cast("string").alias("text"),
                          F.coalesce(quoted(language).cast("string"), F.lit("")).alias("language"))
        flagged = texts.join(ids, "_id", "left")
        trained = F.coalesce(~F.col("_held_out"), F.lit(False))
        counted = flagged.select("text", trained.alias("trained")).mapInArrow(_count, "gram string, n long")
        self.grams = stored(counted.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
        self.costs = Costs(self.grams)
        self.known = bool(self.costs.parts)
        if self.known:
            held = texts.join(ids.filter("_held_out"), "_id", "left_semi")
            self.limits = stored(self._limits(stored(
                scored(held, self.costs, "text", ["language"]).filter("n_scored > 0"), "held")), "limits")

    def _limits(self, held: DataFrame) -> DataFrame:
        """`language`, its `mean` cost of a character and the `limit` of a text's drawn mean; the row
        with a null language is for all others."""
        sums = [F.count("*").alias("texts"), (F.sum("cost") / F.sum("n_scored")).alias("mean")]
        both = held.withColumn("language", F.explode(F.array("language", F.lit(None).cast("string"))))
        means = both.groupBy("language").agg(*sums).filter((F.col("texts") >= LEAST) | F.col("language").isNull())
        joined = both.join(means.select(F.col("language").alias("of"), "texts", "mean"),
                           F.col("language").eqNullSafe(F.col("of")))
        bins = joined.groupBy("language", "texts", "mean", F.floor(_drawn(F.col("mean")) * BINS).alias("bin")).agg(
            F.count("*").alias("n"))
        up_to = F.sum("n").over(Window.partitionBy("language").orderBy("bin"))
        return (bins.withColumn("up_to", up_to).filter(F.col("up_to") >= QUANTILE * F.col("texts"))
                .groupBy("language", "mean").agg(((F.min("bin") + 1) / BINS + BEYOND).alias("limit")))

    def judged(self, df: DataFrame, keep=None) -> DataFrame:
        """The rows with `perplexity` (of a character), `limit` and `kept`; columns of these names and
        of the working ones give way. The rows must be of the table the classifier was made from."""
        names = ["perplexity", "limit", "kept", "n_scored", "cost"]
        kept = [c for c in without(df, names) if keep is None or c in keep]
        language = F.coalesce(quoted(self.language).cast("string"), F.lit("")).alias("_language")
        if not self.known:
            empty = F.length(F.coalesce(quoted(self.column).cast("string"), F.lit(""))) == 0
            nothing = F.lit(None).cast("double")
            return df.select(*[quoted(c) for c in kept], nothing.alias("perplexity"), nothing.alias("limit"),
                             (~empty).alias("kept"))
        rows = df.select(*[quoted(c) for c in without(df, names)], language)
        found = scored(rows, self.costs, self.column, [*kept, "_language"])
        own = _sent(self.limits.filter("language is not null").toDF("_language", "_mean", "_limit"))
        other = self.limits.filter("language is null").select("mean", "limit").first()
        other = other or {"mean": 0.0, "limit": float("inf")}  # no trusted document is held out
        mean = F.coalesce("_mean", F.lit(other["mean"]))
        limit = F.coalesce("_limit", F.lit(other["limit"]))
        good = (F.col("n_scored") > 0) & (_drawn(mean) <= limit)
        return found.join(own, "_language", "left").select(
            *[quoted(c) for c in kept],
            F.when(F.col("n_scored") > 0, F.exp(F.col("cost") / F.col("n_scored"))).alias("perplexity"),
            limit.alias("limit"), good.alias("kept"))


def verdicts(df: DataFrame, labels: DataFrame) -> DataFrame:
    return Classifier(df, labels).judged(df, keep=["doc_id", "lang"])


def filtered(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents without the rejected ones; the columns are the given ones but for clashing names."""
    return Classifier(df, labels).judged(df).filter("kept").drop("perplexity", "limit", "kept")
