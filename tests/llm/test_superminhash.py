import math

import numpy as np
import pytest
from odd import ODD_TEXTS
from pyspark.sql import functions as F
from test_jaccard import WORD

from veriledger.llm import jaccard, superminhash
from veriledger.llm.components import components
from veriledger.llm.wanted import Wanted


def brute(rows, percent=80):
    """Every pair that shares a shingle, by exact sets of words."""
    sets = []
    for _, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for a, own in enumerate(sets):
        shared = {}
        for gram in own:
            for b in holders.setdefault(gram, []):
                shared[b] = shared.get(b, 0) + 1
            holders[gram].append(a)
        for b, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[b]) - n):
                parent[top(a)] = top(b)
    ids = {}
    for a, (i, _) in enumerate(rows):
        ids.setdefault(top(a), []).append(i)
    least = {t: min((i for i in own if i is not None), default=None) for t, own in ids.items()}
    found = [(i, len(sets[a]), least[top(a)] if sets[a] else i) for a, (i, _) in enumerate(rows)]
    return sorted((str(i), n, str(c), i == c) for i, n, c in found)


def run(df, **more):
    return sorted((str(r["key"]), r["n_shingles"], str(r["component_id"]), r["kept"])
                  for r in superminhash.report(df, **more).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def edited(rng, base, vocabulary, edits):
    w = list(base)
    for _ in range(edits):
        k = rng.randrange(len(w))
        if rng.random() < 0.5:
            w[k] = rng.choice(vocabulary)
        elif rng.random() < 0.5:
            del w[k]
        else:
            w.insert(k, rng.choice(vocabulary))
    return w


def near_copies(rng):
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for size in (12, 40, 120, 700):
        base = rng.choices(vocabulary, k=size)
        rows += [" ".join(edited(rng, base, vocabulary, rng.randint(0, 1 + size // 30))) for _ in range(50)]
    rows += [" ".join(rng.choices(vocabulary[:6], k=rng.randint(0, 9))) for _ in range(100)]
    base = rng.choices(vocabulary, k=60)  # a passage that many texts share, which alone links none
    rows += [" ".join(base[:20] + rng.choices(vocabulary, k=40)) for _ in range(60)]
    rng.shuffle(rows)
    return [*enumerate(rows), (7, rows[9]), (-1, rows[11]), (-2, rows[11].upper())]


@pytest.mark.parametrize("block", [2048, 16])
def test_against_brute_force(spark, rng, monkeypatch, block):
    monkeypatch.setattr(superminhash, "BLOCK", block)
    rows = near_copies(rng)
    assert run(frame(spark, rows).repartition(5)) == brute(rows)


def test_documents(spark, documents):
    assert run(frame(spark, documents)) == brute(documents)


def test_another_share(spark, rng):
    rows = near_copies(rng)
    assert run(frame(spark, rows), percent=90) == brute(rows, 90)


def test_odd_rows(odd, nothing):
    assert run(odd) == brute(ODD_TEXTS)
    assert run(nothing) == []


def test_one_of_each_stays(spark, rng, odd):
    rows = near_copies(rng)
    kept = superminhash.deduplicated(frame(spark, rows))
    assert kept.columns == ["doc_id", "text"]
    stay = {i for i, _, _, k in brute(rows) if k}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(i for i in map(str, (r[0] for r in rows)) if i in stay)
    assert superminhash.deduplicated(odd).columns == odd.columns


def chain(rng):
    """Each text is linked to the next one only, and all share most bands with some: a component that no
    head can settle."""
    words = [f"c{i}" for i in range(400)]
    return [(i, " ".join(words[3 * i:3 * i + 60])) for i in range(100)]


def test_chains(spark, rng):
    rows = chain(rng)
    rng.shuffle(rows)
    found = brute(rows)
    assert len({c for _, _, c, _ in found}) == 1
    assert run(frame(spark, rows)) == found


# signatures

def plain_signature(elements):
    """One element after the other, each through its whole permutation."""
    least = [math.inf] * superminhash.SIZE
    for e in elements.tolist():
        places = list(range(superminhash.SIZE))
        for rank in range(superminhash.SIZE):
            swap, number = superminhash._draws(np.array([e], np.uint64), rank)
            places[rank], places[swap[0]] = places[swap[0]], places[rank]
            least[places[rank]] = min(least[places[rank]], int(number[0]))
    return least


def test_signatures_equal_the_plain_form():
    """Stopping early and working on many sets at once change nothing."""
    draw = np.random.default_rng(1)
    sets = [draw.integers(0, 2 ** 63, n).astype(np.uint64) for n in (1, 2, 7, 60, 300, 3)]
    assert superminhash.signatures(sets).tolist() == [plain_signature(s) for s in sets]
    assert superminhash.signatures([]).shape == (0, superminhash.SIZE)


def test_signatures_do_not_depend_on_the_batch(monkeypatch):
    draw = np.random.default_rng(2)
    sets = [draw.integers(0, 2 ** 63, n).astype(np.uint64) for n in draw.integers(1, 900, 60)]
    whole = superminhash.signatures(sets)
    monkeypatch.setattr(superminhash, "ELEMENTS", 1000)
    assert (superminhash.signatures(sets) == whole).all()


def test_places_agree_as_often_as_sets_and_more_evenly():
    """The share of agreeing places is the similarity; for small sets its variance is below that of
    independent hashes."""
    draw = np.random.default_rng(3)
    for n, lower in ((5, 0.6), (20, 0.8), (2000, 1.1)):
        shares = []
        for _ in range(300):
            union = draw.integers(0, 2 ** 63, n).astype(np.uint64)
            cut = n // 10
            a, b = superminhash.signatures([union[:n - cut] if cut else union[:-1], union[cut:]])
            shares.append((a == b).mean())
        true = (n - 2 * (n // 10)) / n if n >= 10 else (n - 1) / n
        assert abs(np.mean(shares) - true) < 0.02
        assert np.var(shares) < lower * 1.25 * true * (1 - true) / superminhash.SIZE


def test_similar_sets_share_a_bucket_and_pass_the_filter():
    draw = np.random.default_rng(4)
    for n in (4, 5, 9, 10, 30, 100, 1000):
        for _ in range(40):
            union = draw.integers(0, 2 ** 63, n + n // 4).astype(np.uint64)
            off = len(union) - -(-80 * len(union) // 100)
            half = off // 2
            a, b = union[:len(union) - half], union[off - half:]
            signed = superminhash.signatures([a, b])
            keys = superminhash.band_keys(signed)
            assert (keys[0] == keys[1]).any()
            assert ((signed[0] ^ signed[1]) & 0xFF == 0).sum() >= superminhash.AGREEING


def test_band_keys_differ_by_band():
    signed = np.zeros((1, superminhash.SIZE), np.uint32)
    assert len(set(superminhash.band_keys(signed)[0].tolist())) == superminhash.BANDS


# the filter of wanted numbers and the grouping

def test_wanted_never_says_no_to_what_it_holds(spark, monkeypatch):
    from veriledger.llm import wanted

    values = spark.range(0, 5000, 1, 4).select(F.xxhash64("id").alias("v"))
    held = np.array([r["v"] for r in values.collect()])
    others = np.array([r["v"] for r in spark.range(10_000, 15_000).select(F.xxhash64("id").alias("v")).collect()])
    found = Wanted(values.union(spark.sql("select cast(null as bigint)")), "v")
    assert found.may_hold(held).all()
    assert found.may_hold(others).mean() < 0.15
    monkeypatch.setattr(wanted, "MOST_BITS", 1 << 15)  # a filter that is full lets more through
    assert Wanted(values, "v").may_hold(held).all()
    assert not Wanted(values.limit(0), "v").may_hold(held).any()


def test_union_find_forests(spark, rng, monkeypatch):
    monkeypatch.setattr(superminhash, "LINKS", 20)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    df = spark.createDataFrame(links, "a long, b long").repartition(6)
    mine = {r["node"]: r["label"] for r in superminhash.grouped(df).collect()}
    plain = {r["node"]: r["label"] for r in components(df).collect()}
    assert mine == plain


def test_the_centre_of_a_star_is_split(spark, monkeypatch):
    """Most links of a component hang on one node: adaptive execution deals its rows to several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        links = spark.range(1, 100_001, 1, 8).select(F.lit(0).cast("long").alias("a"), F.shiftrightunsigned(F.xxhash64("id"), 1).alias("b"))
        tasks = []
        plain = jaccard.join_parent

        def watched(child, parent, on, how):
            joined = plain(child, parent, on, how)
            if on == [("u", "u")]:
                counts = joined.withColumn("task", F.spark_partition_id()).groupBy("u").agg(
                    F.countDistinct("task").alias("n"), F.sum(F.col("v") % 7), F.count("m"))
                tasks.extend(r["n"] for r in counts.collect() if r["u"] == 0)
            return joined

        monkeypatch.setattr("veriledger.llm.components.join_parent", watched)
        found = components(links)
        assert found.count() == 100_001 and found.filter("label <> 0").count() == 0
        assert max(tasks) > 1, tasks
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
