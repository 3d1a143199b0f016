"""Passages that several documents share, found by content-defined chunks.

A gear hash rolls over the bytes of a text, and of every WINDOW places in a row the one with the smallest
hash, the last of equal ones, is a cut, amid the bytes hashed. So a cut depends on the bytes around it alone: text that is inserted
moves the cuts after it along, and they are found again. No chunk is longer than a window, and a stretch that
repeats with a short period is cut once a turn, wherever it begins. Chunks of a few words repeat by chance, so
what is compared is the digest of a row of chunks, which has at least ROW bytes; where such a row is also in a
document with a smaller id, it is a repeat. Repeats that touch make a span, and spans of a least length are
reported. Of a passage that two documents share, the cuts agree but for half of ROLLED bytes and a window at either
end; what little is the same beyond it by chance does not lengthen a row.

Rows are shuffled by digest, each with an id and two offsets. Of equal digests in one slice of texts only the
smallest id's row meets those of other slices; the others are known repeats and are spread, so a passage
that a third of all documents share fills no task.

Offsets are bytes of the UTF-8 text, end exclusive, and never part a character. Null and empty texts, and
texts shorter than a row of chunks, have no spans. Spans are those of one text: rows that share an id are told apart by
a mark of 22 bits of their text's hash, and what only rows of one id repeat is not reported. A row without an id
is known by its text: equal texts are one document, others are documents of their own, all before those with
an id. Ids are above -2 ** 62.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriledger.llm.frames import pieces, quoted, slices
from veriledger.llm.words import SPREAD, spread, utf8
from veriledger.operators.skew import join_parent

#: Bytes that a hash depends on, places of which one is a cut, and bytes of the longest chunk: a text's first
#: is longer, and a character is not parted.
ROLLED, WINDOW = 16, 24
LONGEST = ROLLED + WINDOW + 3

#: Least bytes of a row of chunks, whose digest is compared, and of a span that is reported.
ROW, LEAST = 64, 120

#: Bits of a place for the row's length and for the mark of its text; where it begins takes the others.
LENGTH_BITS, MARK_BITS = 11, 22
_BEGIN = LENGTH_BITS + MARK_BITS

#: Ids of rows without one are below this, those of others above.
_NAMED = -(1 << 62)

#: Bytes of text that are chunked at once.
AT_ONCE = 2 << 20

_GEAR = (spread(np.arange(1, 257, dtype=np.uint64) * SPREAD) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: the sum over the last bytes, each shifted by its age."""
    rolled, age = _GEAR[data], 1
    while age < ROLLED:
        older = np.zeros_like(rolled)
        older[age:] = rolled[:-age]
        rolled = rolled + (older << np.uint32(age))
        age *= 2
    return rolled


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks of the texts begin, with the end of the last; texts are cut apart."""
    # Of equal hashes the last is smallest. A window must not depend on the text before or after.
    least = gear(data).astype(np.uint64) << np.uint64(32) | np.arange(len(data), 0, -1, dtype=np.uint64)
    size = 1
    while size < WINDOW:
        more = min(size, WINDOW - size)
        least = np.minimum(least[:-more], least[more:])
        size += more
    opens, ends = offsets[:-1] + ROLLED - 1, offsets[1:] - WINDOW + 1
    some = opens < ends
    within = np.zeros(len(data) + 1, np.int8)
    np.add.at(within, opens[some], 1)
    np.add.at(within, ends[some], -1)
    least = least[np.cumsum(within, dtype=np.int8)[:len(least)] > 0]
    place = len(data) - (least & np.uint64(0xFFFFFFFF)).astype(np.int64) + 1 - ROLLED // 2
    found = np.union1d(place[np.append(True, place[1:] != place[:-1])] if len(place) else place, offsets)
    for _ in range(3):  # no character is parted
        parted = found < len(data)
        parted[parted] = (data[found[parted]] & 0xC0) == 0x80
        found = np.unique(found + parted)
    return found


def rows_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of chunks, the fewest that have ROW bytes: the text's place, begin and end in it, and the digest."""
    data, offsets = utf8(texts)
    if not len(data):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    at = cuts(data, offsets)
    begins, ends = at[:-1], at[1:]
    place = np.arange(len(data), dtype=np.uint64) - np.repeat(begins, ends - begins).astype(np.uint64)
    digests = np.add.reduceat(spread(data.astype(np.uint64) + place * SPREAD), begins)
    # Sums of the digests, each times a power of an odd number, give every row's in one step.
    powers, inverse = (np.multiply.accumulate(np.append(np.uint64(1), np.full(len(digests), b, np.uint64)))
                       for b in (SPREAD, np.uint64(pow(int(SPREAD), -1, 1 << 64))))
    sums = np.append(np.uint64(0), np.cumsum(digests * powers[:-1]))
    text = np.searchsorted(offsets, begins, "right") - 1
    first = np.flatnonzero(begins + ROW <= offsets[text + 1])
    last = np.searchsorted(at, begins[first] + ROW)
    # The last row of a text is there up to the text's end too.
    final = first[np.append(text[first][1:] != text[first][:-1], True)] if len(first) else first
    first = np.append(first, final)
    last = np.append(last, np.searchsorted(at, offsets[text[final] + 1]))
    by = np.argsort(first, kind="stable")
    first, last = first[by], last[by]
    new = np.append(True, (first[1:] != first[:-1]) | (last[1:] != last[:-1]))[:len(first)]
    first, last = first[new], last[new]
    text = text[first]
    start = offsets[text]
    return text, at[first] - start, at[last] - start, spread((sums[last] - sums[first]) * inverse[first])


def _rows(parts):
    """Rows of chunks; one that a smaller id of the same slice has too is given that id."""
    for batch in (s for whole in parts for s in slices(whole, 1)):
        ids = batch.column(0)
        sizes = [len(t) for t in batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist()]
        for a, b in pieces(sizes, AT_ONCE):
            text, begin, end, digest = rows_of(batch.column(1).slice(a, b - a))
            if not len(text):
                continue
            own = ids.slice(a, b - a).to_numpy(zero_copy_only=False)[text]
            mark = batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False)[text]
            place = begin << _BEGIN | end - begin << MARK_BITS | mark
            by = np.lexsort((own, digest))
            digest, own, place = digest[by], own[by], place[by]
            new = np.ones(len(by), bool)
            new[1:] = digest[1:] != digest[:-1]
            head = own[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest.view(np.int64)), pa.array(own), pa.array(place),
                 pa.array(head, mask=head == own)], names=["digest", "id", "place", "first"])


def _repeats(parts):
    """From rows sorted by digest and id: those whose digest a smaller id has."""
    last, lead = None, None
    for batch in parts:
        digest, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        place, given = batch.column(2).to_numpy(), batch.column(3)
        known = given.is_valid().to_numpy(zero_copy_only=False)
        first = given.fill_null(0).to_numpy().copy()
        rest = np.flatnonzero(~known)
        if len(rest):
            d, o = digest[rest], own[rest]
            new = np.ones(len(d), bool)
            new[1:] = d[1:] != d[:-1]
            head = o[np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))]
            if d[0] == last:
                head[:np.argmax(new[1:]) + 1 if new[1:].any() else len(d)] = lead
            first[rest] = head
            last, lead = d[-1], head[-1]
        repeat = first != own
        yield pa.RecordBatch.from_arrays([pa.array(c[repeat]) for c in (own, place, first)],
                                         names=["id", "place", "first"])


def _identity(key: str, column: str) -> dict:
    """A row's `id` and the `mark` of its text; a row without a key has an id by its text."""
    hashed = F.xxhash64(quoted(column).cast("string"))
    unnamed = F.lit(-(1 << 63)) + F.shiftrightunsigned(hashed, 2)
    return {"id": F.coalesce(quoted(key).cast("long"), unnamed),
            "mark": hashed.bitwiseAND(F.lit((1 << MARK_BITS) - 1))}


def _identified(df: DataFrame, key: str, column: str) -> DataFrame:
    """`id`, `text` and `mark` of the rows."""
    made = _identity(key, column)
    return df.select(made["id"].alias("id"), quoted(column).cast("string").alias("text"), made["mark"].alias("mark"))


def _spans(texts: DataFrame) -> DataFrame:
    """`id`, `mark`, `start`, `end` and `first` of every span."""
    rows = texts.mapInArrow(_rows, "digest long, id long, place long, first long")
    dealt = F.when(F.col("first").isNull(), F.col("digest")).otherwise(F.xxhash64("digest", "id"))
    repeats = (rows.repartition(dealt).sortWithinPartitions("digest", "id")
               .mapInArrow(_repeats, "id long, place long, first long"))
    start = F.shiftrightunsigned("place", _BEGIN)
    length = F.shiftrightunsigned("place", MARK_BITS).bitwiseAND(F.lit((1 << LENGTH_BITS) - 1))
    placed = repeats.select("id", F.col("place").bitwiseAND(F.lit((1 << MARK_BITS) - 1)).alias("mark"),
                            start.alias("start"), (start + length).alias("end"), "first")
    order = Window.partitionBy("id", "mark").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = placed.withColumn("opens", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    numbered = opened.withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy("id", "mark", "span").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first"))
    return joined.filter(F.col("end") - F.col("start") >= LEAST).drop("span")


def spans(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The key, `start`, `end` and `first`, a smaller key of a document that has the same there (of some
    part of the span, the smallest), of every span. The key is a whole number; null stands for rows without one."""
    def named(c: str):
        return F.when(F.col(c) >= F.lit(_NAMED), F.col(c))

    return _spans(_identified(df, key, column)).select(
        named("id").alias(key), "start", "end", named("first").alias("first"))


def repeats(df: DataFrame) -> DataFrame:
    """One row per span of a document that an earlier document has."""
    return spans(df).select("doc_id", F.col("start").alias("start_byte"), F.col("end").alias("end_byte"),
                            (F.col("end") - F.col("start")).alias("n_bytes"), F.col("first").alias("first_doc_id"))


def _cut(parts):
    for batch in parts:
        names = batch.schema.names
        texts, found = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        kept = []
        for text, own in zip(texts, found):
            if own and text is not None:
                data, at, out = text.encode(), 0, []
                for span in sorted((s["start"], s["end"]) for s in own):
                    out.append(data[at:max(span[0], at)])
                    at = max(at, span[1])
                text = b"".join([*out, data[at:]]).decode(errors="replace")
            kept.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), *batch.columns[2:]],
                                         names=[names[0], *names[2:]])


def removed(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The rows with their spans cut out of the text; each passage stays in the smallest key's row."""
    own = (_spans(_identified(df, key, column)).groupBy("id", "mark")
           .agg(F.collect_list(F.struct("start", "end")).alias("s")))
    others = [c for c in df.columns if c != column]
    plain = df.select(quoted(column).cast("string").alias("t"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(others)])
    plain = plain.withColumns(_identity(f"c{others.index(key)}", "t"))
    joined = join_parent(plain, own, [("id", "id"), ("mark", "mark")], "left").select(
        "t", "s", *[f"c{i}" for i in range(len(others))])
    schema = joined.drop("s").schema
    done = joined.mapInArrow(_cut, schema)
    return done.select(*[(F.col("t") if c == column else F.col(f"c{others.index(c)}")).alias(c) for c in df.columns])
