import math
import random

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from veriledger.llm import hard_negatives
from veriledger.llm.vectors import bound

SCHEMA = "vec_id long, embedding array<double>, label int, score int, windows string, `part` int"
ANCHOR = "key % 10 = 0"


def brute(rows, every=10, size=5, take=5, percent=80):
    """Every anchor against every row."""
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        most = bound(len(v))
        row = (label, [max(-most, min(most, math.floor(256 * x))) for x in v])
        best[i] = min(best.get(i, row), row)
    found = []
    for a, (label, v) in best.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in best.items()
                        if i != a and len(w) == len(v))
        for s, p, _ in [r for r in scored if r[2] == label][:size]:
            near = [(t, n) for t, n, other in scored if other != label and percent * -s <= 100 * -t <= 100 * -s]
            found += [(a, p, k + 1, n, -s, -t) for k, (t, n) in enumerate(near[:take])]
    return sorted(found)


def run(df, anchors=ANCHOR, **more):
    return sorted(tuple(r) for r in hard_negatives.mined(df, anchors, **more).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows], SCHEMA)


def clustered(rng, n, labels=4, width=8, spread=0.3):
    middle = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    rows = []
    for i in range(n):
        c = rng.randrange(labels)
        rows.append((i, [x + rng.gauss(0, spread) for x in middle[c]], c if rng.random() < 0.7 else rng.randrange(labels)))
    return rows


@pytest.fixture
def small_tiles(monkeypatch):
    """Several parts, blocks and steps on small tables."""
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 900)
    monkeypatch.setattr(hard_negatives, "SCORES", 64)


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    found = run(df)
    assert found and found == brute(rows)


def test_tiles(spark, rng, small_tiles):
    rows = clustered(rng, 400)
    assert run(frame(spark, rows).repartition(5)) == brute(rows)


def test_ties_and_hot_label(spark, rng, small_tiles):
    """Few different scores, so ids decide; two thirds of the rows have one label."""
    rows = [(i, [float(rng.randint(0, 2)) for _ in range(3)], rng.choice([1, 1, 1, 1, 2, 3])) for i in range(300)]
    rng.shuffle(rows)
    assert run(frame(spark, rows)) == brute(rows)
    assert run(frame(spark, rows), positives=2, negatives=3, percent=95) == brute(rows, 10, 2, 3, 95)


def test_odd_rows(spark, rng):
    rows = clustered(rng, 120)
    rows += [(20, rows[20][1], rows[20][2]), (30, rows[31][1], 9), (30, rows[30][1], 0), (None, rows[3][1], 1),
             (None, rows[3][1], 1), (1000, None, 1), (1010, [], 1), (1011, [], 1), (1012, [], 2), (1020, [1.0] * 3, 2),
             (1021, [1.0] * 3, 2), (1022, [0.9] * 3, 1), (1030, [None] * 8, 2), (1040, [math.nan] * 8, 1),
             (1050, [math.inf] * 8, 1), (1060, [1e300] * 8, 1), (1061, [9e299] * 8, 1), (1062, [1e300] * 8, 2),
             (1070, [-1e300] * 8, 1), (1080, rows[0][1], None), (-10, rows[5][1], 2), (-7, rows[6][1], -2)]
    rng.shuffle(rows)
    assert run(frame(spark, rows)) == brute(rows)


def test_nothing(spark):
    rows = frame(spark, [(1, [1.0], 1)])
    assert run(rows) == []  # no anchors
    assert run(rows.limit(0)) == []
    assert run(frame(spark, [(10, [1.0], 1), (11, [1.0], 2)])) == []  # no positives
    assert run(frame(spark, [(10, [1.0], 1), (11, [1.0], 1)])) == []  # no negatives


def test_text_labels(spark, rng):
    rows = clustered(rng, 80)
    df = frame(spark, rows).withColumn("label", F.concat(F.lit("c"), "label"))
    assert run(df) == brute(rows)


def test_packed_keys_sort_as_meant():
    rng = random.Random(1)
    edge = [-(1 << 62), -1, 0, 1, 5, 1 << 62]
    rows = [(rng.choice(edge), rng.choice(edge), rng.randint(0, 1), rng.choice(edge)) for _ in range(300)]
    keys = [hard_negatives.packed(np.array([a]), np.array([s]), k, np.array([i]))[0].as_py() for a, s, k, i in rows]
    assert [hard_negatives.unpacked(k) for k in keys] == rows
    assert sorted(range(300), key=lambda n: keys[n]) == sorted(
        range(300), key=lambda n: (rows[n][0], -rows[n][1], rows[n][2], rows[n][3]))


def test_an_anchor_with_many_rows_is_not_gathered(spark):
    """What reaches the last step is what tiles keep, and the step holds an anchor's open windows only."""
    rows = [(i, [1.0 + i % 97 / 1000, 1.0], i % 2) for i in range(3000)]
    assert run(frame(spark, rows), "key = 0") == [r for r in brute(rows, 3000) if r[0] == 0]
