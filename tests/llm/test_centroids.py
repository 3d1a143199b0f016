import hashlib
import math

import numpy as np
import pytest
from conftest import SF

from veriledger.llm import centroids
from veriledger.llm.vectors import bound

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, rest int, hash string"


def whole(x, scale):
    return max(-bound(64), min(bound(64), math.floor(scale * x)))


def brute(rows, count=16, rounds=3):
    """Plain clustering by exact integers."""
    kept = [(i, [whole(x, 64) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    middle = [v for _, v in seeds[:count]]
    if not middle:
        return []

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        at = nearest()
        for c in range(len(middle)):
            own = [v for (_, v), (_, k) in zip(kept, at) if k == c]
            if own:
                middle[c] = [sum(x) // len(own) for x in zip(*own)]
    at = nearest()
    digests = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]

    def fits(total):
        return total if total < 1 << 63 else None

    return sorted((str(i), c, d, fits(sum(e for e, k in at if k == c)), fits(sum(e for e, _ in at)), digests[c])
                  for (i, _), (d, c) in zip(kept, at))


def run(df, **more):
    return sorted((str(r[0]), *r[1:]) for r in centroids.clusters(df, **more).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "y") for i, v in rows], SCHEMA)


def vectors(rng, n, spread=1.0):
    return [(i, [float(np.float32(rng.gauss(0, spread))) for _ in range(64)]) for i in range(n)]


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert run(df) == brute(rows)


def test_odd_rows(spark, rng):
    """Null, short, non-finite and very large vectors, ids missing or twice, equal vectors."""
    rows = vectors(rng, 60)
    rows += [(7, rows[9][1]), (7, rows[7][1]), (None, rows[3][1]), (None, rows[3][1]), (100, None), (101, []),
             (102, [1.0] * 63), (103, [1.0] * 63 + [None]), (104, [1.0] * 63 + [math.nan]), (105, [math.inf] * 64),
             (106, [3e38] * 64), (107, [-3e38] * 64), (108, [0.0] * 64), (109, [0.0] * 64)]
    assert run(frame(spark, rows).repartition(3)) == brute(rows)


def test_few_and_equal_vectors(spark, rng):
    same = [(i, [0.5] * 64) for i in range(40)]
    assert run(frame(spark, same)) == brute(same)  # all centroids are equal, the first gets all
    few = vectors(rng, 3)
    assert run(frame(spark, few)) == brute(few)
    nameless = [(None, v) for _, v in few]
    for rows in ([], nameless, [(1, None)]):
        empty = centroids.clusters(frame(spark, rows))
        assert empty.collect() == []
        assert empty.columns == ["key", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_other_parameters(spark, rng):
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-3, 4, 64)]) for i in range(80)]  # many ties
    assert run(frame(spark, rows), count=5, rounds=6, leading=3) == brute(rows, 5, 6)


@pytest.mark.parametrize("spread", [0.01, 1.0, 1e5])
@pytest.mark.parametrize("leading", [0, 1, 8, 64])
def test_bounds_lose_nothing_and_rule_out(spread, leading):
    draw = np.random.default_rng(5)
    shape = draw.normal(0, spread, (64, 64)) * np.logspace(0, -2, 64)
    points = np.floor(64 * (draw.normal(0, 1, (600, 64)) @ shape)).astype(np.int64)
    mean = points.mean(0)
    axes = np.linalg.eigh(np.cov(points.T))[1][:, ::-1][:, :leading]
    turned = centroids.Rotation(mean, axes)
    nearest = centroids.Nearest(points[:16], turned)
    first, rest, _ = turned.of(points)
    near, margin = nearest.bounds(first, rest)
    exact = ((points[:, None] - points[None, :16]) ** 2).sum(2)
    assert (near - margin <= exact).all()
    cluster, distance = nearest.of(points, first, rest)
    assert (distance == exact.min(1)).all() and (cluster == exact.argmin(1)).all()
    if leading >= 8:
        assert (near - margin > distance[:, None]).mean() > 0.5  # most centroids need no exact distance
