import random
import zlib

import pytest
from conftest import SF
from odd import ODD_TEXTS
from pyspark.sql import functions as F

from veriledger.llm import toxicity as x

INSULTS = "trash pathetic idiot disgusting worthless stupid clown loser scum moron".split()
SIGNS = {"o": "0", "i": "1!|", "e": "3", "a": "4@", "s": "5$", "t": "7+", "b": "8", "g": "9", "l": "1|"}


@pytest.fixture(scope="module")
def tables(spark):
    sf = SF.replace("0.001", "0.01")
    return [spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels")]


@pytest.fixture(scope="module")
def scorer(tables):
    return x.Scorer(*tables)


def test_trigrams_against_brute_force(spark, documents):
    from collections import Counter

    counts = Counter()
    for _, text in documents:
        for word in text.split():
            word = word.lower().strip(x.EDGES)
            if x.PLAIN.fullmatch(word):
                w = f"^^{word}$"
                counts.update(w[i:i + 3] for i in range(len(w) - 2))
    model = x.character_model(spark.createDataFrame(documents, "doc_id long, text string").repartition(4))
    assert dict(model.counts[2]) == dict(counts)
    contexts = {g[:2] for g in counts}
    letters = {g[2] for g in counts}
    for two in sorted(contexts)[:20]:
        assert sum(2.718281828459045 ** -model.cost(two, c) for c in letters) < 1 + 1e-6


def test_viterbi_finds_the_cheapest_path(tables):
    """Against all ways to read a short token."""
    from itertools import product

    model = x.character_model(tables[0])
    for token in ("1d10t", "s+up1d", "l0s3r", "a.b"):
        ways = []
        for sign in token:
            own = [(sign, 0.0)] if x._letter(sign) else []
            own += [(c, x.STANDS) for c in x.LEET.get(sign, "")]
            if sign in x.SKIPPED:
                own.append(("", x.SKIPS))
            ways.append(own)
        best = min((sum(p for _, p in way) + sum(model.cost(w[i:i + 2], w[i + 2]) for i in range(len(w) - 2)), w[2:-1])
                   for way in product(*ways) for w in ["^^" + "".join(c for c, _ in way) + "$"])
        assert model.decoded(token)[0] == best[1]


def test_disguises_are_undone(tables):
    model, rng = x.character_model(tables[0]), random.Random(1)
    for word in INSULTS:
        k = rng.randrange(len(word))
        disguises = ["".join(rng.choice(SIGNS[c]) if c in SIGNS and rng.random() < 0.6 else c for c in word),
                     word[:k] + word[k] * 4 + word[k + 1:], ".".join(word), word.upper() + "!!", f"({word})"]
        for d in disguises:
            assert x.squeezed(word) in model.restored(d), d


def test_disguised_texts_score_like_plain_ones(spark, scorer):
    rows = []
    for i, word in enumerate(INSULTS):
        rows += [(4 * i, f"ernt the {word} and {word} hean"), (4 * i + 1, f"ernt the {' '.join(word)} and {'-'.join(word)} hean"),
                 (4 * i + 2, "ernt the {0} and {0} hean".format(word.replace("o", "0").replace("i", "1").replace("s", "$"))),
                 (4 * i + 3, "ernt the and hean")]
    scores = {r["doc_id"]: r["score"] for r in scorer.scored(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    caught = [scores[4 * i + j] >= 0.5 for i in range(len(INSULTS)) for j in range(3)]
    # forty toxic documents to learn from
    assert sum(caught) >= 0.75 * len(caught)
    assert all(scores[4 * i + 3] < 0.2 for i in range(len(INSULTS)))


def test_letters_of_any_script(tables):
    model = x.character_model(tables[0])
    for token, word in [("Привет", "привет"), ("«Привет!»", "привет"), ("п.р.и.в.е.т", "привет"), ("приииивет", "привет"),
                        ("ΑΘΛΙΟΣ", "αθλιος"), ("مرحبا", "مرحبا"), ("नमस्ते", "नमस्ते"), ("漢字", "漢字"), ("дур*ак", "дурак")]:
        assert word in [w.replace("ς", "σ") if "ς" not in word else w for w in model.restored(token)] or \
            word in model.restored(token), (token, model.restored(token))
    assert model.restored("12345") == () and model.restored("—…") == ()


@pytest.mark.parametrize("clean,toxic", [
    ("дом река поле город вечер книга дорога солнце", "негодяй мерзавец"),
    ("σπιτι ποταμι πολη βραδυ βιβλιο δρομος ηλιος", "αθλιος ηλιθιος"),
    ("بيت نهر مدينة مساء كتاب طريق شمس", "احمق حقير"),
    ("घर नदी शहर शाम किताब सड़क सूरज", "मूर्ख नीच"),
    ("家 川 町 夜 本 道 太陽", "馬鹿者 愚か者"),
])
def test_toxic_words_of_other_scripts_are_learnt(spark, clean, toxic):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = rng.choices(clean.split(), k=8) + ([rng.choice(toxic.split())] if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r["predicted"] for r in x.scores(docs, labels).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [found[i] for i in held] == [int(i % 4 == 0) for i in held]
    spaced = spark.createDataFrame([(1, f"{clean} {'-'.join(toxic.split()[0])} {toxic.split()[1]}!!!")], "doc_id long, text string")
    assert x.Scorer(docs, labels).scored(spaced).head()["score"] >= 0.5


def test_held_out_accuracy(tables, scorer):
    docs, labels = tables
    rows = scorer.scored(docs, keep=["doc_id"]).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    clean = [r["score"] for r in held if r["toxic"] == 0]
    toxic = [r["score"] for r in held if r["toxic"] == 1]
    assert sum(s < 0.5 for s in clean) >= 0.97 * len(clean)
    assert sum(s >= 0.5 for s in toxic) >= 0.5 * len(toxic)


def test_held_out_labels_are_not_read(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn("toxic", F.when(x.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = x.Scorer(docs, labels), x.Scorer(docs, flipped)
    assert a.weights == b.weights and a.bias == b.bias


def test_odd_rows(spark, odd, nothing, tables):
    labels = spark.createDataFrame([(9004, 1, 1), (9006, 1, 0), (9005, 1, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = x.scores(odd, labels).collect()
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert x.scores(nothing, labels).collect() == []
    assert len(x.scores(odd, labels.limit(0)).collect()) == len(ODD_TEXTS)
