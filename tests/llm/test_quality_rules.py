import re
from collections import Counter

import numpy as np
from conftest import SF
from odd import ODD_TEXTS

from veriledger.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    counts, hit = Counter(grams), [False] * len(w)
    for i, g in enumerate(grams):
        if counts[g] > 1:
            hit[i:i + 5] = [True] * 5
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, sum(hit),
            len(w) < 10 or 100 * sum(hit) > 20 * len(w))


def run(df):
    return sorted((str(r["doc_id"]), *tuple(r)[1:7]) for r in rules.verdicts(df).collect())


def test_base_against_brute_force(spark, rng, documents):
    parts = ["a", "b ", "\n", "c\t", "é漢 ", "# ", "a b c d e ", "\x0b", " ", "|"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 30)))) for i in range(400)] + documents
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df) == sorted((str(i), *brute(t)) for i, t in rows)


def test_odd_rows(odd, nothing):
    assert run(odd) == sorted((str(i), *brute(t)) for i, t in ODD_TEXTS)
    assert not any(r["kept"] for r in rules.verdicts(odd).collect() if r["base_failed"])
    assert rules.verdicts(nothing).collect() == []


def test_expectation_maximisation_recovers_what_made_the_votes():
    """Votes drawn from known shares: the estimate comes near them and sorts the texts."""
    draw = np.random.default_rng(5)
    count = 20_000
    good = draw.random(count) < 0.85
    votes = np.empty((count, len(rules.RULES)), int)
    truth = draw.dirichlet((3, 3, 4), len(rules.RULES))
    for r in range(len(rules.RULES)):
        votes[good, r] = draw.choice(3, good.sum(), p=(0.01, 0.19, 0.80))
        votes[~good, r] = draw.choice(3, (~good).sum(), p=truth[r])
    patterns = votes @ 3 ** np.arange(len(rules.RULES))
    model = rules.fit(list(Counter(patterns.tolist()).items()))
    assert abs(model.good - good.mean()) < 0.02
    assert np.abs(np.array(model.on_bad) - truth).max() < 0.05
    odds = np.log(model.good / (1 - model.good)) + sum(
        np.log(np.array(model.on_good)[r, votes[:, r]] / np.array(model.on_bad)[r, votes[:, r]])
        for r in range(len(rules.RULES)))
    assert ((odds > 0) == good).mean() > 0.98


def test_accuracy_without_labels(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = rules.verdicts(docs).join(labels.select("doc_id", "quality"), "doc_id").filter("not base_failed").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)
