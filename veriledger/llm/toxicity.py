"""Toxicity of texts whose words may be disguised: a noisy channel undoes leetspeak, spacing and repetition,
then the restored words are scored.

A disguised word is a lattice: each of its signs may stand for letters, be a mark to skip, or repeat the
sign before it, each at a cost of the channel. Viterbi's algorithm finds the letters that are cheapest under
the channel and a character trigram model of the words of all documents; a few next cheapest words are kept
too, and the one that weighs most counts. A word of letters alone, no one
three times in a row, is its own only path. Runs of single signs are one word that was spaced out. Letters of any
script count; what stands for a letter, and the trigrams, are of Latin ones, so other words are only freed of marks and
repeats. In scripts without spaces a run of letters is one word.

What marks a text as toxic is learnt from labelled documents: the restored words and their beginnings that
toxic texts have far more often. A feature weighs what its log-odds surely are, the estimate less some
standard errors, so a few chance counts weigh little; a word weighs as its heaviest feature, and a text as its
distinct words together. At most LABELLED labelled documents are learnt
from, by the smallest hashes of their ids, each text once; everything else covers all rows. Labels of
held-out documents, one in five by the checksum of the id, are never read.

Null and empty texts have no words and get the score of a text without toxic words. Without labels of both
kinds every text gets the smoothed share of toxic labels.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.frames import extended, quoted, slices, stored
from veriledger.llm.words import BLANKS, split

LABELLED = 20_000

#: Features of a word: the word and its beginnings of these lengths. Kept are those that the test statistic
#: singles out, the strongest first, and that many at most.
BEGINNINGS = (4, 5, 6, 7)
LEAST_TOXIC, LEAST_RATIO, LEAST_G, FEATURES = 3, 4.0, 20.0, 20_000

#: Standard errors that are taken off a feature's log-odds.
SURE = 1.64

# Letters that signs stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¢": "c"}
MASK = "*#%"
SKIPPED = ".-_~'`,:;/\\=^\"*#%&"

#: Costs of the channel in nats: a sign that stands for a letter, a masked letter, a mark or a repeat skipped.
STANDS, MASKED, SKIPS, REPEATS = 1.0, 2.5, 0.3, 0.2

#: Letters of the trigram model are a-z and U+00DF to U+017F, so its trigrams are fewer than 200 cubed.
_FIRST, _LAST = "ß", "ſ"

#: Letters of any script, with the marks that some put on them.
_MARKED = ("Mn", "Mc")
QUOTES = "\"'()[]{}<>«»“”„"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
PLAIN = re.compile(f"[a-z{_FIRST}-{_LAST}]+")
TRIPLE = re.compile(r"(.)\1\1")
RUN = re.compile(r"(.)\1+")
DECORATION = re.compile(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$")
EDGES = "\"'()[]{}<>.,;:!?«»“”„…¿¡*#%&"

#: Paths that Viterbi's algorithm keeps for each pair of last letters, and words that it gives.
PATHS, BEST = 3, 8

#: Restored words that a task remembers, and bytes of text that it takes apart at once.
REMEMBERED = 60_000
TEXT_BYTES = 4 << 20


def _letter(sign: str) -> bool:
    return "a" <= sign <= "z" or sign.isalpha() or sign > "\u02ff" and unicodedata.category(sign) in _MARKED


def _lettered(word: str) -> bool:
    """Whether a word is of letters alone, not all of them the model's."""
    return not word.isascii() and all(map(_letter, word))


def squeezed(word: str) -> str:
    """The word with each run of one letter as a single letter, as words are compared."""
    return RUN.sub(r"\1", word) if RUN.search(word) else word


class Characters:
    """A trigram model of words, with Witten-Bell smoothing down to equal shares of all letters."""

    def __init__(self, counts: list[tuple[str, int]]):
        self.counts = [Counter(), Counter(), Counter()]
        self.after = [Counter(), Counter(), Counter()]
        self.kinds = [Counter(), Counter(), Counter()]
        for gram, n in counts:
            for size in (3, 2, 1):
                self.counts[size - 1][gram[3 - size:]] += n
        for size in (1, 2, 3):
            for gram, n in self.counts[size - 1].items():
                self.after[size - 1][gram[:-1]] += n
                self.kinds[size - 1][gram[:-1]] += 1
        self.cost = lru_cache(maxsize=1 << 16)(self._cost)

    def _cost(self, two: str, sign: str) -> float:
        p = 1 / 220
        for size in (1, 2, 3):
            context = two[3 - size:]
            total, kinds = self.after[size - 1][context], self.kinds[size - 1][context]
            if total:
                p = (self.counts[size - 1][context + sign] + kinds * p) / (total + kinds)
        return -math.log(p)

    def decoded(self, token: str) -> list[str]:
        """The cheapest words that the token may stand for, the likeliest first."""
        paths: dict[str, list[tuple[float, str]]] = {"^^": [(0.0, "")]}
        before = ""
        for sign in token:
            ways: list[tuple[str, float]] = []
            if _letter(sign):
                ways.append((sign, 0.0))
            ways += [(letter, STANDS) for letter in LEET.get(sign, "")]
            if sign in MASK:
                ways += [(letter, MASKED) for letter in _LETTERS]
            if sign in SKIPPED:
                ways.append(("", SKIPS))
            elif sign == before:
                ways.append(("", REPEATS))
            elif not ways:
                ways.append(("", STANDS))
            found: dict[str, list[tuple[float, str]]] = {}
            for state, ends in paths.items():
                for letter, price in ways:
                    if letter:
                        price += self.cost(state, letter)
                    found.setdefault(state[1] + letter if letter else state, []).extend(
                        (cost + price, word + letter) for cost, word in ends)
            paths, before = {state: _cheapest(ends) for state, ends in found.items()}, sign
        whole = [(cost + self.cost(state, "$"), word) for state, ends in paths.items() for cost, word in ends]
        return [word for _, word in sorted(whole)[:BEST]]

    def restored(self, token: str) -> tuple[str, ...]:
        """What a token may stand for, squeezed, the likeliest first; nothing if it holds no word."""
        token = DECORATION.sub("", token.lower()).strip(QUOTES)
        bare = token.strip(EDGES)
        if (PLAIN.fullmatch(bare) or _lettered(bare)) and not TRIPLE.search(bare):
            return (squeezed(bare),)
        if not any(map(_letter, token)) and not any(s in LEET and not s.isdigit() for s in token):
            return ()
        words = self.decoded(bare)
        if token != bare:
            words += self.decoded(token)
        words.append("".join(filter(_letter, token)))
        return tuple(dict.fromkeys(filter(None, map(squeezed, words))))


def _cheapest(ends: list[tuple[float, str]]) -> list[tuple[float, str]]:
    """The cheapest paths of a state, each word once."""
    best: dict[str, float] = {}
    for cost, word in sorted(ends):
        if word not in best:
            best[word] = cost
            if len(best) == PATHS:
                break
    return [(cost, word) for word, cost in best.items()]


def features(word: str) -> list[str]:
    return [f"={word}", *[word[:n] for n in BEGINNINGS if len(word) > n]]


def _single(word: bytes) -> bool:
    return len(word) == 1 or len(word) < 5 and len(word.decode(errors="replace")) == 1


def _words_of(texts: pa.Array, restore):
    """The text's place and the number of each token, and what the numbers may stand for."""
    found = split(texts, BLANKS, False)
    distinct = found.distinct.to_pylist()
    names: dict[tuple[str, ...], int] = {}
    number = np.empty(len(distinct), np.int64)
    for i, token in enumerate(distinct):
        number[i] = names.setdefault(restore(token.decode(errors="replace")), len(names))
    text = np.repeat(np.arange(len(found.rows) - 1), np.diff(found.rows))
    single = np.fromiter(map(_single, distinct), bool, len(distinct))[found.ids]
    word = number[found.ids]
    at = np.flatnonzero(single)
    more = []
    if len(at):
        apart = np.flatnonzero((np.diff(at) != 1) | (text[at[1:]] != text[at[:-1]])) + 1
        for run in np.split(at, apart):
            if len(run) >= 3:
                spaced = b"".join(distinct[i] for i in found.ids[run]).decode(errors="replace")
                more.append((text[run[0]], names.setdefault(restore(spaced), len(names))))
    if more:
        text = np.concatenate([text, [t for t, _ in more]])
        word = np.concatenate([word, [w for _, w in more]])
    return text, word, list(names)


def _trigrams(parts):
    """A task's counts of the trigrams of its plain words."""
    counts: Counter = Counter()
    for batch in (s for whole in parts for s in slices(whole, 0, TEXT_BYTES)):
        found = split(batch.column(0), BLANKS, True)
        numbers = np.bincount(found.ids, minlength=len(found.distinct))
        words: Counter = Counter()
        for token, n in zip(found.distinct.to_pylist(), numbers.tolist()):
            word = token.decode(errors="replace").lower().strip(EDGES)
            if PLAIN.fullmatch(word):
                words[word] += n
        row = np.frombuffer("".join(f"^^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
        weight = np.repeat(list(words.values()), [len(w) + 3 for w in words]) if words else np.empty(0, np.int64)
        if len(row) < 3:
            continue
        key = row[:-2] << 42 | row[1:-1] << 21 | row[2:]
        inside = (row[2:] != ord("^")) & (row[1:-1] != ord("$"))
        key, weight = key[inside], weight[2:][inside]
        own, place = np.unique(key, return_inverse=True)
        total = np.bincount(place, weight).astype(np.int64)
        for k, n in zip(own.tolist(), total.tolist()):
            counts[chr(k >> 42) + chr(k >> 21 & 0x1FFFFF) + chr(k & 0x1FFFFF)] += n
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()))],
                                         names=["gram", "n"])


def character_model(df: DataFrame, column: str = "text") -> Characters:
    """The trigrams of all documents; their number is bounded by the letters."""
    counts = (df.select(quoted(column).cast("string")).mapInArrow(_trigrams, "gram string, n long")
              .groupBy("gram").agg(F.sum("n").alias("n")).toArrow())
    return Characters(sorted(zip(counts["gram"].to_pylist(), counts["n"].to_pylist())))


class _Restorer:
    """A worker's memory of restored words."""

    def __init__(self, characters: Characters):
        self.characters, self.known = characters, {}

    def __call__(self, token: str) -> tuple[str, ...]:
        bare = token.lower().strip(EDGES)
        if PLAIN.fullmatch(bare) or _lettered(bare):  # its own only path, and not worth the memory
            run = RUN.search(bare)
            if run is None:
                return (bare,)
            if not TRIPLE.search(bare, run.start()):
                return (squeezed(bare),)
        word = self.known.get(token)
        if word is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            word = self.known[token] = self.characters.restored(token)
        return word


_HELD: list = []


def _restorer(sent) -> _Restorer:
    """The restorer of a broadcast model, kept until another model comes to the worker."""
    counts = sent.value
    if not _HELD or _HELD[0] is not counts:
        _HELD[:] = [counts, _Restorer(Characters(counts))]
    return _HELD[1]


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


class Scorer:
    """The character model, the weights of features and the bias, from documents and labels."""

    def __init__(self, df: DataFrame, labels: DataFrame, key: str = "doc_id", column: str = "text"):
        context = df.sparkSession.sparkContext
        model = character_model(df, column)
        self.sent = context.broadcast(sorted(model.counts[2].items()))
        self.weights: dict[str, float] = {}
        own = (labels.filter(quoted(key).isNotNull() & F.col("toxic").isNotNull())
               .groupBy(quoted(key).alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
               .filter(~held_out(F.col("_id"))).orderBy(F.xxhash64("_id"), "_id").limit(LABELLED))
        texts = df.select(quoted(key).alias("_id"), quoted(column).cast("string").alias("text"))
        chosen = stored(texts.join(F.broadcast(own), "_id").select("text", "_toxic"), "labelled")
        words = stored(self._words(chosen.groupBy(F.xxhash64("text").alias("h"), "text").agg(
            F.max("_toxic").alias("toxic"))), "words")
        totals = {r["toxic"]: r["n"] for r in words.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        toxic, clean = totals.get(1, 0), totals.get(0, 0)
        share = (toxic + 1) / (toxic + clean + 2)
        self.bias, self.weights = math.log(share / (1 - share)), {}
        if toxic and clean:
            self._fit(words)
        self.scores = context.broadcast(self.weights)

    def _words(self, rows: DataFrame) -> DataFrame:
        """Per labelled text its distinct restored words."""
        sent = self.sent

        def work(texts: pa.Array) -> dict:
            text, word, names = _words_of(texts, _restorer(sent))
            made = [set() for _ in range(len(texts))]
            for t, w in set(zip(text.tolist(), word.tolist())):
                if names[w]:
                    made[t].add(names[w][0])
            return {"words": pa.array([sorted(m) for m in made], pa.list_(pa.string()))}

        return extended(rows, "text", [T.StructField("words", T.ArrayType(T.StringType()))], work, ["h", "toxic"], TEXT_BYTES)

    def _fit(self, words: DataFrame) -> None:
        """Weights from all labelled texts. How far they are to be trusted is seen on texts that they were
        not learnt from: each half's weights judge the other, and a regression on that scales them."""
        halves = [words.filter(F.pmod("h", F.lit(2)) == i) for i in (0, 1)]
        pairs = [p for i in (0, 1) for p in evidence(halves[1 - i], learnt(halves[i]))]
        scale, bias = line(np.array([e for e, _ in pairs]), np.array([float(t) for _, t in pairs]))
        self.bias = float(bias)
        self.weights = {f: float(scale * w) for f, w in learnt(words).items()}

    def scored(self, df: DataFrame, column: str = "text", keep=None) -> DataFrame:
        """The rows with `score`, from 0 to 1, likelier toxic the higher; a column of that name gives way."""
        sent, scores, bias = self.sent, self.scores, self.bias

        def work(texts: pa.Array) -> dict:
            weights = scores.value
            # Only a word that begins like a feature can weigh anything.
            starts = {f.removeprefix("=")[:BEGINNINGS[0]] for f in weights}
            text, word, names = _words_of(texts, _restorer(sent))
            heavy = np.array([max((weight_of(w, weights) for w in ways if w[:BEGINNINGS[0]] in starts), default=0.0)
                              for ways in names])
            total = np.full(len(texts), bias)
            some = np.flatnonzero(heavy[word] != 0) if len(word) else np.empty(0, np.int64)
            if len(some):
                pair = np.unique(text[some] * len(names) + word[some])
                np.add.at(total, pair // len(names), heavy[pair % len(names)])
            return {"score": pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))}

        return extended(df, column, [T.StructField("score", T.DoubleType())], work, keep, TEXT_BYTES)


def learnt(words: DataFrame) -> dict[str, float]:
    """The features that set toxic texts apart, with their weights."""
    totals = {r["toxic"]: r["n"] for r in words.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}
    word = F.explode("words").alias("w")
    beginnings = [F.when(F.length("w") > n, F.substring("w", 1, n)) for n in BEGINNINGS]
    every = words.select("h", "toxic", word).select(
        "h", "toxic", F.explode(F.array(F.concat(F.lit("="), "w"), *beginnings)).alias("f")).filter("f is not null")
    a, b = F.col("a"), F.col("b")
    counts = every.distinct().groupBy("f").agg(F.sum(F.col("toxic").cast("double")).alias("a"),
                                               F.sum(1.0 - F.col("toxic")).alias("b"))
    # How much likelier the counts are if toxic texts have the feature at a rate of their own.
    rate = (a + b) / F.lit(float(toxic + clean))
    g = 2 * (a * F.log((a / toxic) / rate) + F.when(b > 0, b * F.log((b / clean) / rate)).otherwise(0.0))
    odds = F.log(((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (clean + 1)))
    surely = odds - SURE * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    chosen = (counts.filter((a >= LEAST_TOXIC) & (a / toxic >= LEAST_RATIO * b / clean))
              .withColumn("g", g).withColumn("weight", surely)
              .filter((F.col("g") >= LEAST_G) & (F.col("weight") > 0))
              .orderBy(F.desc("g"), "f").limit(FEATURES))
    return {r["f"]: r["weight"] for r in chosen.select("f", "weight").collect()}


def weight_of(word: str, weights: dict[str, float]) -> float:
    return max(weights.get(f, 0.0) for f in features(word))


def evidence(words: DataFrame, weights: dict[str, float]) -> list[tuple[float, int]]:
    """Per labelled text, so of a bounded number, the sum of its words' weights, and its label."""

    def run(parts):
        for batch in parts:
            sums = [sum(weight_of(w, weights) for w in own) for own in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.float64()), batch.column(1)], names=["e", "toxic"])

    found = words.select("words", "toxic").mapInArrow(run, "e double, toxic int")
    return sorted((r["e"], r["toxic"]) for r in found.collect())


def line(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[float, float]:
    """Slope and bias of a logistic regression on one number, by Newton's method; the slope is not negative."""
    slope, bias = 1.0, math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + bias, -30, 30)))
        error, weight = p - y, p * (1 - p)
        gradient = np.array([error @ x + ridge * (slope - 1), error.sum()])
        curve = np.array([[weight @ (x * x) + ridge, weight @ x], [weight @ x, weight.sum() + 1e-9]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 1.0 / max(abs(step).max(), 1e-12))
        slope, bias = slope - step[0], bias - step[1]
        if abs(step).max() < 1e-9:
            break
    return max(slope, 0.0), bias


def scores(df: DataFrame, labels: DataFrame) -> DataFrame:
    rows = Scorer(df, labels).scored(df, keep=["doc_id"])
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
