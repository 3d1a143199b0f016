import re

import pytest
from odd import ODD_TEXTS

from veriledger.llm import jaccard
from veriledger.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """Every pair that shares a shingle, by exact sets of words."""
    sets = []
    for _, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        if len(w) >= 4:
            sets.append({tuple(w[k:k + 4]) for k in range(len(w) - 3)})
        else:
            sets.append({tuple(w)} if w else set())
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
            if 100 * n >= 85 * (len(own) + len(sets[b]) - n):
                parent[top(a)] = top(b)
    ids = {}
    for a, (i, _) in enumerate(rows):
        ids.setdefault(top(a), []).append(i)
    least = {t: min((i for i in own if i is not None), default=None) for t, own in ids.items()}
    return sorted((str(i), len(sets[a]), str(least[top(a)] if sets[a] else i)) for a, (i, _) in enumerate(rows))


def run(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]))
                  for r in jaccard.classes(df).collect())


def near_copies(rng):
    vocabulary = [f"w{k}" for k in range(400)]
    base = rng.choices(vocabulary, k=120)
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6])):
            k = rng.randrange(len(w))
            if rng.random() < 0.5:
                w[k] = rng.choice(vocabulary)
            elif rng.random() < 0.5:
                del w[k]
            else:
                w.insert(k, rng.choice(vocabulary))
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(i, " ".join(rng.choices(vocabulary[:6], k=rng.randint(0, 9)))) for i in range(160, 260)]
    for i in range(260, 320):
        w = base[:rng.randint(5, 40)]
        rows.append((i, " ".join(w + rng.choices(vocabulary, k=rng.randint(0, 1))).upper()))
    return rows + [(7, rows[9][1]), (-1, rows[11][1])]


@pytest.mark.parametrize("tile_nodes", [2048, 16])
def test_against_brute_force(spark, rng, monkeypatch, tile_nodes):
    monkeypatch.setattr(jaccard, "TILE_NODES", tile_nodes)
    rows = near_copies(rng)
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_three_nodes_of_one_batch(spark, rng):
    """Tiles whose nodes all lie in one batch: two others may be linked where neither is to the smallest."""
    rows = []
    for i in range(0, 3000, 3):
        w = [f"w{i}x{k}" for k in range(11)]
        rows += [(i, " ".join(w)), (i + 1, " ".join([*w, f"x{i}"])), (i + 2, " ".join([*w, f"z{i}"]))]
    rng.shuffle(rows)
    assert run(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)) == brute(rows)


def test_documents(spark, documents):
    assert run(spark.createDataFrame(documents, "doc_id long, text string")) == brute(documents)


def test_odd_rows(odd, nothing):
    assert run(odd) == brute(ODD_TEXTS)
    assert run(nothing) == []


def test_one_of_each_stays(spark, rng, odd, nothing):
    rows = near_copies(rng)
    kept = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert kept.columns == ["doc_id", "text"]
    found = brute(rows)
    # of the ids that two rows have, one row may be another component's
    stayed = sorted(str(r["doc_id"]) for r in kept.collect())
    assert stayed == sorted([*{c for _, n, c in found if n}, *[i for i, n, _ in found if not n]])
    assert jaccard.one_of_each(odd).columns == odd.columns
    left = jaccard.one_of_each(odd).collect()
    # three without shingles, and of each of the others one
    assert len(left) == 3 + 4
    assert jaccard.one_of_each(nothing).collect() == []


def test_similar_sets_share_a_tile(rng):
    """The bands and ranges lose no pair: sets at the threshold meet, at all sizes."""
    import numpy as np

    bands = jaccard.Bands(85)
    draw = np.random.default_rng(3)
    for n in [2, 3, 5, 6, 7, 8, 10, 13, 20, 41, 100, 333, 1000, 4000]:
        for _ in range(20):
            union = np.sort(draw.integers(0, 2 ** 63, n + n // 4 + 1).astype(np.uint64))
            least = -(-85 * len(union) // 100)
            a = np.sort(draw.permutation(union)[:draw.integers(least, len(union) + 1)])
            rest = np.setdiff1d(union, a)
            drop = draw.integers(0, len(a) - least + 1)
            b = np.sort(np.concatenate([draw.permutation(a)[drop:], rest]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * len(np.union1d(a, b)) and not np.array_equal(a, b):
                assert set(jaccard.tile_keys(a, bands)) & set(jaccard.tile_keys(b, bands)), n
                x, y = jaccard.bitmap(a), jaccard.bitmap(b)
                size = min(len(x), len(y))
                assert jaccard._bound(len(a), jaccard.folded(x, size), np.array([len(b)]),
                                      jaccard.folded(y, size)[None], 85)[0]


def test_components(spark, rng):
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    linked = {x for a, b in links if a != b for x in (a, b)}
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: top(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_texts_go_through_python_once_for_their_profiles(spark, odd, rng, monkeypatch):
    """The tasks that sort texts by node run no Python; each node's bitmap is that of its own set."""
    import pyarrow as pa

    long = [" ".join(f"w{rng.randrange(1000)}" for _ in range(60)) for _ in range(20)]
    texts = spark.createDataFrame([(t + end,) for t in long for end in ("", " more", " other", "")], "text string")
    frame = type(odd)
    seen, plain = [], frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda df, *a, **k: seen.append(df) or plain(df, *a, **k))
    join = jaccard.Join(texts.union(odd.select("text")))
    tiles = join.tiles()
    seen.clear()
    rows = join.profiles(tiles).collect()
    assert len(seen) == 1 and len(rows) >= 60
    for r in rows:
        found, = jaccard.shingle_sets(pa.array([r["text"]]), jaccard.SHINGLE)
        assert (r["node"], r["n"], r["bits"]) == (jaccard.node_of(found), len(found), jaccard.bitmap(found).tobytes())
    assert {r["node"] for r in rows} >= {r["node"] for r in tiles.select("node").collect()}
