"""Secrets in text: patterns of known forms, and strings whose characters are too evenly mixed.

Known forms are found by patterns. Beyond them, every run of token characters is a candidate of a class
(hexadecimal, letters with digits, letters only), and a window slides over it. The window's character
counts change by the character that enters and the one that leaves, and with them the Shannon entropy;
windows that reach the class's entropy make a span. Known forms are cut out of candidates; each piece that is
long enough is a candidate of its own. Allow-listed candidates make no span.

Every test of a candidate looks for single characters, pairs or fixed words, so its time grows with the length only and
no candidate, however long, needs the stack.

All of it is column expressions over one row at a time: no shuffle, and a lost task is simply run again.
Null is the empty text, which has no spans. Offsets count code points.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriledger.llm.frames import quoted, without

# The known forms, as (kind, pattern, group whose length counts, least length).
FORMS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]

#: What makes a candidate, and the classes it may have: what it must hold, what it must not, and the least entropy of
#: a window in bits.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
CLASSES = [
    ("hexadecimal", ["[A-Fa-f]"], ["[^0-9A-Fa-f]"], 3.0),
    ("mixed", ["[0-9]", "[A-Za-z]"], [], 3.7),
    ("letters", ["[a-z]", "[A-Z]"], [], 4.1),
]

#: What words joined by marks never hold: digits, and capitals that do not begin a word. Candidates without are no secrets.
UNLIKE_WORDS = r"[0-9]|[A-Za-z][A-Z]"

#: Other candidates that are no secrets: UUIDs, runs of the alphabet, stand-ins.
ALLOWED = [
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"(?i)abcdefgh|01234567|12345678|example|sample|dummy|placeholder|changeme",
]

#: Counts are scored in millionths of a bit, so sums are whole numbers and the same on every machine.
UNIT = 1_000_000
SCORES = [0, *[round(UNIT * n * math.log2(n)) for n in range(1, WINDOW + 1)]]

#: Character codes of candidates, from the first one on.
FIRST_CODE, CODES = 0x2B, 0x7A - 0x2B + 1

#: Matches of a text that are listed at once; lists of these are then put together.
LISTED = 512


def most_score(bits: float) -> int:
    """The sum of scores up to which a window has so many bits."""
    return math.floor(UNIT * WINDOW * (math.log2(WINDOW) - bits))


def _named(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _spans(text: Column, pattern: str, least: int, extra: Column | None = None) -> Column:
    """Start, end and value of the pattern's matches, leftmost first, whose value is long enough.

    Parts between matches and the matches take turns, so their lengths give the offsets. A list is copied when it
    grows, so matches are listed by the few hundred.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("part"), found.alias("match"),
                         (found if extra is None else extra).alias("value"))
    empty = F.expr("array()").cast("array<struct<start:int,end:int,value:string>>")

    def step(acc, pair):
        start = acc["at"] + F.length(pair["part"])
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        good = pair["match"].isNotNull() & (F.length(pair["value"]) >= least)
        return F.struct(F.coalesce(end, start).alias("at"),
                        F.when(good, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    def block(acc, number):
        part = F.aggregate(F.slice(pairs, number * LISTED + 1, LISTED), F.struct(acc["at"].alias("at"), empty.alias("spans")), step)
        return F.struct(part["at"].alias("at"), F.concat(acc["spans"], part["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    blocks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / LISTED).cast("int"))
    spans = F.aggregate(blocks, start, block, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def _windows(value: Column, most: Column) -> Column:
    """First and end of the windows of a candidate whose sum of scores is small enough, as a struct.

    A step lets one character in and, once the window is full, one out. `most` is the class's bound.
    """
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - F.lit(FIRST_CODE))
    leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)
    scores = F.array(*[F.lit(s) for s in SCORES])
    start = F.struct(F.array_repeat(F.lit(0), CODES).alias("counts"), F.lit(0).alias("score"),
                     F.lit(0).alias("at"), F.lit(-1).alias("first"), F.lit(-1).alias("end"))

    def step(acc, pair):
        came, went = pair["came"], pair["went"]
        inside, outside = F.get(acc["counts"], came), F.get(acc["counts"], went)
        same = came == went
        delta = (F.get(scores, inside + 1) - F.get(scores, inside)
                 + F.when(went < 0, 0).otherwise(F.get(scores, outside - 1) - F.get(scores, outside)))
        score = acc["score"] + F.when(same, 0).otherwise(delta)
        counts = F.transform(acc["counts"], lambda n, i: n + (i == came).cast("int") - (i == went).cast("int"))
        at = acc["at"] + 1
        good = (at >= WINDOW) & (score <= most)
        return F.struct(counts.alias("counts"), score.alias("score"), at.alias("at"),
                        F.when(good & (acc["first"] < 0), at - WINDOW).otherwise(acc["first"]).alias("first"),
                        F.when(good, at).otherwise(acc["end"]).alias("end"))

    pairs = F.filter(F.arrays_zip(codes.alias("came"), leaving.alias("went")), lambda p: p["came"].isNotNull())
    return F.aggregate(pairs, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["end"].alias("end")))


def _bound_of(value: Column) -> Column:
    """The bound of a candidate's class; null if it has no class or is allow-listed."""
    bound = F.lit(None).cast("int")
    for _, holds, lacks, bits in reversed(CLASSES):
        fits = reduce(and_, [value.rlike(p) for p in holds] + [~value.rlike(p) for p in lacks])
        bound = F.when(fits, F.lit(most_score(bits))).otherwise(bound)
    for pattern in ALLOWED:
        bound = F.when(~value.rlike(pattern), bound)
    return F.when(value.rlike(UNLIKE_WORDS), bound)


def _uncovered(candidates: Column, known: Column) -> Column:
    """The pieces of the candidates that no known form covers, if long enough."""
    piece = "array<struct<start:int,value:string>>"

    def pieces(c):
        over = F.array_sort(F.filter(known, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"])))
        last = F.struct(c["end"].alias("start"), F.lit(0).alias("rank"), c["end"].alias("end"), F.lit("").alias("kind"))

        def step(acc, k):
            own = F.struct(acc["at"].alias("start"),
                           F.substring(c["value"], acc["at"] - c["start"] + 1, k["start"] - acc["at"]).alias("value"))
            return F.struct(F.greatest(acc["at"], k["end"]).alias("at"),
                            F.when(k["start"] - acc["at"] >= WINDOW, F.concat(acc["pieces"], F.array(own)))
                            .otherwise(acc["pieces"]).alias("pieces"))

        start = F.struct(c["start"].alias("at"), F.expr("array()").cast(piece).alias("pieces"))
        cut = F.aggregate(F.concat(over, F.array(last)), start, step, lambda acc: acc["pieces"])
        whole = F.array(F.struct(c["start"].alias("start"), c["value"].alias("value"))).cast(piece)
        return F.when(F.size(over) > 0, cut).otherwise(whole)

    return F.flatten(F.transform(candidates, pieces))


def scanned(df: DataFrame, column: str = "text", keep=None) -> DataFrame:
    """The rows with `secret_spans`: structs of start, rank (the kind's place), end and kind, in order.

    Known forms are `assign`, `access` and `hex`; `entropy` is what the windows add. A column of that
    name gives way; every row is kept.
    """
    kept = [c for c in without(df, ["secret_spans"]) if keep is None or c in keep]
    text = F.coalesce(quoted(column).cast("string"), F.lit(""))
    rows = df.select(*[quoted(c) for c in kept], text.alias("_scan"))
    text = F.col("_scan")
    known = []
    for rank, (kind, pattern, group, least) in enumerate(FORMS):
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        if kind == "hex":
            # The same maximal runs, without listing every short one.
            pattern = f"[0-9a-f]{{{least},}}"
            value = None
        known.append(_named(_spans(text, pattern, least, value), rank, kind))
    rows = rows.withColumn("_known", F.concat(*known))
    rows = rows.withColumn("_candidates", _spans(text, CANDIDATE, WINDOW))
    judged = F.filter(
        F.transform(_uncovered(F.col("_candidates"), F.col("_known")), lambda c: F.struct(c["start"].alias("start"), c["value"].alias("value"),
                                              _bound_of(c["value"]).alias("bound"))),
        lambda c: c["bound"].isNotNull())
    found = F.transform(judged, lambda c: F.struct(c["start"].alias("start"),
                                                   _windows(c["value"], c["bound"]).alias("w")))
    high = F.transform(
        F.filter(found, lambda c: c["w"]["first"] >= 0),
        lambda c: F.struct((c["start"] + c["w"]["first"]).alias("start"), F.lit(len(FORMS)).alias("rank"),
                           (c["start"] + c["w"]["end"]).alias("end"), F.lit("entropy").alias("kind")))
    spans = F.array_sort(F.concat(F.col("_known"), F.when(F.size("_candidates") > 0, high).otherwise(
        F.expr("array()").cast("array<struct<start:int,rank:int,end:int,kind:string>>"))))
    return rows.select(*[quoted(c) for c in kept], spans.alias("secret_spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(df: DataFrame) -> DataFrame:
    """Per document the counts of the known forms, a digest of their spans and all spans."""
    spans = F.col("secret_spans")
    counts = [_count(spans, kind) for kind, *_ in FORMS]
    return scanned(df, keep=["doc_id"]).select(
        "doc_id", *counts,
        F.sha2(_listed(F.filter(spans, lambda s: s["rank"] < len(FORMS))), 256).alias("base_sha256"),
        _listed(spans).alias("spans"))


def redacted(df: DataFrame, column: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows, each stretch of spans that overlap replaced by the mark; a null text stays null."""
    rows = scanned(df, column)
    text = quoted(column)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, span):
        fresh = span["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, span["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    new = F.aggregate("secret_spans", start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return rows.withColumn(column, F.when(F.size("secret_spans") > 0, new).otherwise(text)).select(
        *[quoted(c) for c in df.columns if c.lower() != "secret_spans"])
