"""Quality rules as weak supervision: rules vote for a text, against it, or abstain, and the posterior
probability that the text is good takes the place of a filter that every rule must pass.

Nobody labels the rules' accuracies: expectation-maximisation estimates them from how the rules agree.
All it needs of the corpus is how often each pattern of votes occurs, so one grouped count over all
documents, at most 3 to the number of rules rows, is fitted; its size does not grow with the corpus.

Words are maximal runs of characters other than ASCII white space. A null or empty text has no words; all
rules but the one on length abstain there, and it is not kept.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.frames import extended, stored
from veriledger.llm.words import BLANKS, grams, hashes, split, utf8

# The symbols that are counted.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

REPEAT_WINDOW = 5

MEASURES = ["word_bytes", "n_letters", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echoes",
            "n_distinct", "n_upper", "n_lower", "n_marks", "n_digits", "n_wordlike"]

#: Letters with one mark before and after them at most; bytes beyond ASCII count as letters.
WORDLIKE = re.compile(rb"""["'(]?[A-Za-z\x80-\xff]+(?:['-][A-Za-z\x80-\xff]+)*[.,;:!?)"']?""")


class Rule(NamedTuple):
    """A measure's share of another; good up to `good`, bad from `bad`, no vote between. With `good`
    above `bad` high shares are good ones."""

    name: str
    part: str
    whole: str
    good: float
    bad: float


# Of one measure in another: what a good text has and what a bad one.
RULES = [
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.15),
    Rule("repeated windows", "n_repeat_words", "n_words", 0.02, 0.15),
    Rule("repeated lines", "n_dup_lines", "n_lines", 0.1, 0.3),
    Rule("echoed words", "n_echoes", "n_words", 0.03, 0.2),
    Rule("distinct words", "n_distinct", "n_words", 0.35, 0.15),
    Rule("capitals", "n_upper", "n_letters", 0.2, 0.5),
    Rule("marks", "n_marks", "n_words", 0.1, 0.5),
    Rule("digits", "n_digits", "word_chars", 0.1, 0.4),
    Rule("words of letters", "n_wordlike", "n_words", 0.85, 0.7),
    Rule("letters", "n_letters", "word_bytes", 0.9, 0.8),
    Rule("word length", "word_chars", "n_words", 9.0, 14.0),
    Rule("length", "n_words", "one", 30, 10),
]

AGAINST, ABSTAINS, FOR = 0, 1, 2

#: How rules are believed to vote before any text is seen: against, abstaining, for. A rule knows one fault,
#: so it seldom speaks against a good text and misses many bad ones, which have other faults.
BELIEF_BAD = (0.35, 0.30, 0.35)
BELIEF_GOOD = (0.01, 0.29, 0.70)

#: Weight of the belief against what is seen, as a share of all texts on good ones and in texts on bad ones.
GOOD_WEIGHT, BAD_WEIGHT = 0.5, 20.0
ROUNDS = 500


class Model(NamedTuple):
    """The share of good texts, and per rule the shares of its three votes on bad and on good texts."""

    good: float
    on_bad: list[list[float]]
    on_good: list[list[float]]


def _measured(texts: pa.Array) -> dict:
    words = split(texts, BLANKS, False)
    data, offsets = utf8(texts)
    rows = words.rows

    def inside(flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        at = np.flatnonzero(flags)
        return np.diff(np.searchsorted(at, offsets))

    code_points = (data & 0xC0) != 0x80
    marks = np.concatenate([[0], np.cumsum(code_points)])
    per_word = marks[words.ends] - marks[words.begins]
    sums = np.concatenate([[0], np.cumsum(per_word)])
    same = words.ids[1:] == words.ids[:-1]
    same_at = np.flatnonzero(same) + 1
    # A word that equals the one before it, unless that is another text's last.
    same_at = same_at[~np.isin(same_at, rows)]
    like = np.fromiter((WORDLIKE.fullmatch(w) is not None for w in words.distinct.to_pylist()), bool,
                       len(words.distinct))
    like_at = np.flatnonzero(like[words.ids])
    values = hashes(words)[words.ids] if len(words.ids) else np.empty(0, np.uint64)
    windows = grams(values, REPEAT_WINDOW)
    repeated, distinct, dup_lines, lines = [], [], [], []
    for i, text in enumerate(texts.to_pylist()):
        a, b = int(rows[i]), int(rows[i + 1])
        distinct.append(len(np.unique(words.ids[a:b])))
        own = windows[a:max(b - REPEAT_WINDOW + 1, a)]
        repeated.append(_covered(own, b - a))
        seen, again, count = set(), 0, 0
        for line in (text or "").split("\n"):
            if line.strip(" \t\r\x0b\x0c"):
                count += 1
                if line in seen:
                    again += 1
                seen.add(line)
        dup_lines.append(again)
        lines.append(count)
    made = {
        "n_words": np.diff(rows), "word_chars": sums[rows[1:]] - sums[rows[:-1]], "n_symbols": inside(SYMBOLS[data]),
        "n_dup_lines": dup_lines, "n_repeat_words": repeated, "n_lines": lines,
        "n_echoes": np.diff(np.searchsorted(same_at, rows)), "n_distinct": distinct,
        "n_upper": inside((data >= 0x41) & (data <= 0x5A)), "n_lower": inside((data >= 0x61) & (data <= 0x7A)),
        "n_marks": inside((data == 0x21) | (data == 0x7C)), "n_digits": inside((data >= 0x30) & (data <= 0x39)),
        "n_wordlike": np.diff(np.searchsorted(like_at, rows)),
        "n_letters": inside((data >= 0x80) | (data | 0x20 >= 0x61) & (data | 0x20 <= 0x7A)),
        "word_bytes": inside(~BLANKS[data]),
    }
    return {n: pa.array(made[n], pa.int64()) for n in MEASURES}


def _covered(windows: np.ndarray, words: int) -> int:
    """Words in windows that occur twice or more."""
    if len(windows) < 2:
        return 0
    by = np.argsort(windows, kind="stable")
    same = windows[by][1:] == windows[by][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    edges = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(twice)
    edges[at] += 1
    edges[at + REPEAT_WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edges)[:words]))


def measured(df: DataFrame, column: str = "text", keep=None) -> DataFrame:
    """The rows with all measures; columns of their names give way."""
    return extended(df, column, [T.StructField(n, T.LongType()) for n in MEASURES], _measured, keep)


def vote(rule: Rule) -> Column:
    """A rule's vote; a text without what the rule measures gets none."""
    whole = F.lit(1) if rule.whole == "one" else F.col(rule.whole)
    part = F.col(rule.part)
    if rule.good < rule.bad:
        good, bad = part <= rule.good * whole, part >= rule.bad * whole
    else:
        good, bad = part >= rule.good * whole, part <= rule.bad * whole
    return F.when(whole == 0, ABSTAINS).when(bad, AGAINST).when(good, FOR).otherwise(ABSTAINS)


def pattern() -> Column:
    """All votes as one number, the first rule's as its lowest digit to the base 3."""
    return sum((vote(r) * 3 ** i for i, r in enumerate(RULES)), F.lit(0)).cast("int")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def fit(counts: list[tuple[int, int]]) -> Model:
    """Expectation-maximisation over the patterns and how often each occurs."""
    patterns = np.array(sorted(counts), dtype=np.int64).reshape(-1, 2)
    votes = patterns[:, :1] // 3 ** np.arange(len(RULES)) % 3
    cast = (votes[:, :, None] == np.arange(3)).astype(float)
    weight = patterns[:, 1].astype(float)
    good = 0.9
    on_bad, on_good = (np.tile(belief, (len(RULES), 1)) for belief in (BELIEF_BAD, BELIEF_GOOD))
    for _ in range(ROUNDS):
        odds = np.log(good / (1 - good)) + (cast * np.log(on_good / on_bad)).sum((1, 2))
        p = 1 / (1 + np.exp(-odds))
        wg, wb, extra = weight * p, weight * (1 - p), GOOD_WEIGHT * weight.sum() + 1
        new_good = (wg.sum() + 1) / (weight.sum() + 2)
        new_on_good = (np.einsum("i,irv->rv", wg, cast) + extra * np.array(BELIEF_GOOD)) / (wg.sum() + extra)
        new_on_bad = ((np.einsum("i,irv->rv", wb, cast) + BAD_WEIGHT * np.array(BELIEF_BAD))
                      / (wb.sum() + BAD_WEIGHT))
        change = max(abs(new_good - good), np.abs(new_on_good - on_good).max(), np.abs(new_on_bad - on_bad).max())
        good, on_good, on_bad = new_good, new_on_good, new_on_bad
        if change < 1e-9:
            break
    return Model(float(good), on_bad.tolist(), on_good.tolist())


def posterior(model: Model) -> Column:
    """The probability that a text is good, from its votes."""
    odds = F.lit(float(np.log(model.good / (1 - model.good))))
    for rule, bad, good in zip(RULES, model.on_bad, model.on_good):
        weights = np.log(np.array(good) / np.array(bad)).tolist()
        odds = odds + F.get(F.array(*[F.lit(w) for w in weights]), vote(rule))
    return 1 / (1 + F.exp(-odds))


def weighed(rows: DataFrame) -> DataFrame:
    """Measured rows with `posterior`, `base_failed` and `kept`. The rules' shares of votes are fitted to
    all rows; no rows give none."""
    counts = rows.groupBy(pattern().alias("p")).agg(F.count("*").alias("n"))
    model = fit([(r["p"], r["n"]) for r in counts.collect()])
    return (rows.withColumn("posterior", posterior(model)).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)))


def judged(df: DataFrame, column: str = "text", keep=None) -> DataFrame:
    """The rows with the measures, `posterior`, `base_failed` and `kept`; the texts are measured twice, once
    for the fit."""
    return weighed(measured(df, column, keep))


def verdicts(df: DataFrame) -> DataFrame:
    """Per document the base measures and the verdict; the few numbers a text are measured once and kept
    aside for the fit."""
    return weighed(stored(measured(df, keep=["doc_id"]), "measures")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "posterior")
