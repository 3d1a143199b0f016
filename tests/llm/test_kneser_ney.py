import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF
from odd import ODD_TEXTS

from veriledger.llm import kneser_ney as k

ORDER = k.ORDER


def spelled(text):
    """Characters, with each repeated word and the space before it as one sign."""
    out, before, nth = [], None, 0
    for m in re.finditer(r"([ \t\n\x0b\x0c\r]*)([^ \t\n\x0b\x0c\r]*)", text or ""):
        space, word = m.groups()
        nth = nth + 1 if word and word == before else 0
        out.append(chr(k.AGAIN + min(nth, k.MOST_AGAIN)) if nth else space + word)
        if word:
            before = word
    return "".join(out)


def model(trusted, others):
    """Interpolated modified Kneser-Ney by the book, over dictionaries."""
    pad = chr(k.BEGIN) * (ORDER - 1)
    seen = Counter()
    for text in trusted:
        s = pad + spelled(text)
        seen.update(s[i:i + ORDER] for i in range(len(s) - ORDER + 1))
    every = set(seen)
    for text in others:
        s = pad + spelled(text)
        every.update(s[i:i + ORDER] for i in range(len(s) - ORDER + 1))
    counts = {ORDER: seen}
    for n in range(ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    symbols = len({g[-1] for g in every}) + 1
    tables = {}
    for n in range(1, ORDER + 1):
        d = k.discounts(Counter(min(c, 5) for c in counts[n].values()))
        total, left = Counter(), defaultdict(float)
        for g, c in counts[n].items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3) - 1]
        tables[n] = (counts[n], d, total, left)

    def p(gram):
        if not gram:
            return 1 / symbols
        own, d, total, left = tables[len(gram)]
        lower = p(gram[1:])
        context = gram[:-1]
        if not total[context]:
            return lower
        c = own[gram]
        return ((c - d[min(c, 3) - 1]) if c else 0) / total[context] + left[context] / total[context] * lower

    return p, every


TEXTS = ["the cat sat on the mat", "the the the dog", "a cat, a dog", "ab ab ab ab ab ab x", "zzz $$$ !!!", "der hund"]


def test_symbols():
    import pyarrow as pa

    row, starts = k.symbols(pa.array([*TEXTS, None, "", " x x", "x x "], pa.string()))
    ends = [*(starts[1:] - ORDER + 1), len(row)]
    found = ["".join(map(chr, row[a:b])) for a, b in zip(starts, ends)]
    assert found == [spelled(t) for t in [*TEXTS, None, "", " x x", "x x "]]


def test_probabilities_against_brute_force(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(t, i < 4) for i, t in enumerate(TEXTS * 2)], "text string, trained boolean").repartition(3)
    grams = df.mapInArrow(k._count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    p, every = model([t for i, t in enumerate(TEXTS * 2) if i < 4], TEXTS)
    found = {r["gram"]: r["p"] for r in k.probabilities(grams).collect()}
    assert set(found) == every
    assert all(found[g] == pytest.approx(p(g), rel=1e-9) for g in every)
    # the chances of all symbols after a context make one
    symbols = {g[-1] for g in every}
    context = "he ca"[-ORDER + 1:]
    assert sum(p(context + s) for s in symbols) < 1 + 1e-9


@pytest.mark.parametrize("shard", [1 << 20, 50])
def test_scores_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(k, "SHARD_GRAMS", shard)
    rows = [(i, t, "en") for i, t in enumerate(TEXTS * 3)]
    labels = [(i, 1 if i % 6 < 4 else 0, 0) for i, _, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    own = k.Classifier(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    train = [t for (i, t, _), (_, q, _) in zip(rows, labels) if q and zlib.crc32(str(i).encode()) % 5]
    p, _ = model(train, TEXTS)
    for r in k.scored(docs, own.costs, keep=["text"]).collect():
        s = chr(k.BEGIN) * (ORDER - 1) + spelled(r["text"])
        cost = -sum(math.log(p(s[i:i + ORDER])) for i in range(len(s) - ORDER + 1))
        assert r["n_scored"] == len(s) - ORDER + 1 and r["cost"] == pytest.approx(cost, rel=1e-4)


@pytest.mark.parametrize("shard,sent", [(10, 1), (20, 2), (1, 1)])
def test_bounded_tables_are_sent(spark, monkeypatch, shard, sent):
    """However many n-grams there are, few are sent to the tasks, and the costs are those of all."""
    rows = [(i, t, "en") for i, t in enumerate([*TEXTS * 3, None, "", "xyz" * 30, "xyz" * 30])]
    labels = [(i, 1 if i % 6 < 4 else 0, 0) for i, _, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    def costs(own):
        assert sum(int((p.value[0] != 0).sum()) for p in own.costs.parts) <= k.SENT_SHARDS * k.SHARD_GRAMS
        judged = {r["doc_id"]: (r["perplexity"], r["limit"], r["kept"]) for r in own.judged(docs, keep=["doc_id"]).collect()}
        return sorted((r["doc_id"], r["n_scored"], r["cost"], str(judged[r["doc_id"]])) for r in
                      k.scored(docs, own.costs, keep=["doc_id"]).collect())

    every = costs(k.Classifier(docs, marks))
    monkeypatch.setattr(k, "SHARD_GRAMS", shard)
    monkeypatch.setattr(k, "SENT_SHARDS", sent)
    few = costs(k.Classifier(docs, marks))
    assert few == every


def test_tables_are_sent_by_their_size(spark, monkeypatch):
    """A table that is too large to be sent is joined, with the same outcome."""
    rows = [(i, t, "en") for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    marks = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")

    def outcome():
        return sorted((r["doc_id"], r["perplexity"], r["limit"], r["kept"]) for r in k.verdicts(docs, marks).collect())

    sent = outcome()
    assert "broadcast" in k._sent(marks)._jdf.queryExecution().logical().toString()
    monkeypatch.setattr(k, "SENT_BYTES", 10)
    assert "broadcast" not in k._sent(marks)._jdf.queryExecution().logical().toString()
    assert outcome() == sent


def test_held_out_accuracy(spark):
    """On documents whose labels only set thresholds, nearly all good ones are kept and most others not."""
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    own = k.Classifier(docs, labels)
    rows = own.judged(docs, keep=["doc_id"]).join(labels.select("doc_id", "quality"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    good, bad = ([r["kept"] for r in held if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(9004, 1, 0), (9006, 1, 0), (9006, 0, 0), (9005, 1, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = k.verdicts(odd, labels).collect()
    assert len(rows) == len(ODD_TEXTS)
    assert all(r["kept"] is False and r["perplexity"] is None for r in rows if r["doc_id"] in (9001, 9002))
    kept = k.filtered(odd, labels)
    assert {"doc_id", "text", "lang", "n_words", "spans", "score", "node"} <= set(kept.columns)
    nobody = labels.limit(0)
    known = {r["doc_id"]: r["kept"] for r in k.verdicts(odd, nobody).collect()}
    assert known[9001] is False and known[9002] is False and known[9004] and known[9006]
    assert k.verdicts(nothing, labels).collect() == []
