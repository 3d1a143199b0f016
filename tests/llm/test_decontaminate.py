import hashlib
import re

import pytest
from odd import ODD_TEXTS

from veriledger.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, items):
    windows = {}
    for name, text in items:
        w = words(text)
        size = min(13, len(w))
        for j in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[j:j + size]), set()).add(str(name) if name is not None else "")
    sizes = {len(w) for w in windows}
    out = []
    for i, text in documents:
        w, names = words(text), set()
        hit = [False] * len(w)
        for size in sizes:
            for j in range(len(w) - size + 1):
                found = windows.get(tuple(w[j:j + size]))
                if found:
                    names |= found
                    hit[j:j + size] = [True] * size
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((str(i), len(w), sum(hit), len(names), digest, sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out)


def run(spark, documents, items):
    docs = documents if not isinstance(documents, list) else spark.createDataFrame(documents, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted((str(r[0]), *tuple(r)[1:]) for r in d.verdicts(docs, bench).collect())


def planted(rng, documents):
    vocabulary = [w for _, t in documents[:40] for w in t.split()]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 12, 13, 14, 40])))) for i in range(30)]
    items += [(3, items[3][1]), (None, items[4][1]), (98, None), (99, ""), (97, "..."), (4, "another text of item four")]
    docs = []
    for i in range(120):
        w = rng.choices(vocabulary, k=rng.randint(0, 120))
        if i % 3 == 0:
            _, text = items[rng.randrange(30)]
            part = text.split()
            a = rng.randrange(len(part))
            j = rng.randint(0, len(w))
            w[j:j] = part[a:] if i % 2 else part
        docs.append((i, rng.choice([" ", "\n", ", "]).join(w)))
    return docs, items


def test_against_brute_force(spark, rng, documents):
    docs, items = planted(rng, documents)
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("blocks", [1, 3])
def test_more_items_than_tasks_hold(spark, rng, documents, monkeypatch, blocks):
    """Items that come in many groups of blocks are found as if they came at once; hot copies are found once."""
    monkeypatch.setattr(d, "BLOCK_BYTES", 250)
    monkeypatch.setattr(d, "GROUP_BLOCKS", blocks)
    docs, items = planted(rng, documents)
    docs = [*docs, *[(5000 + i, docs[0][1]) for i in range(60)], *ODD_TEXTS]
    items = [*items, (items[0][0], items[-1][1])]  # an id in two groups
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    assert len(list(d.groups_of(bench, "item_id", "text"))) > 2
    assert run(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3), items) == brute(docs, items)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_hit int, items string")
    whole = d.matched(df, bench)
    assert whole.columns == ["doc_id", "text", "n_words", "n_hit", "items", "spans"]
    monkeypatch.undo()
    once = d.matched(df, bench)

    def rows(found):
        return sorted((str(r["doc_id"]), str(r["text"])[:50], r["n_words"], r["n_hit"], r["items"], r["spans"]) for r in found.collect())

    assert rows(whole) == rows(once)
    assert d.removed(df, bench).columns == ["doc_id", "text"]


def test_longest_of_many_groups(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "one two three"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "x b c d e y"), (8, "two three four"), (9, "nothing"), (7, "e f g h")],
                                  "item_id long, text string").coalesce(1)
    every = sorted(map(tuple, d.longest_matches(docs, bench).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 10)
    monkeypatch.setattr(d, "GROUP_BLOCKS", 1)
    assert sorted(map(tuple, d.longest_matches(docs, bench).collect())) == every
    assert d.longest_matches(docs, bench.limit(0)).collect() == []


def test_small_shards_and_blocks(rng, documents):
    """The task's own work, in shards of few words and blocks of few items."""
    import numpy as np
    import pyarrow as pa
    from types import SimpleNamespace

    from veriledger.llm.words import NOT_ALNUM, split

    docs, items = planted(rng, documents)
    blocks = []
    for a in range(0, len(items), 7):
        own = items[a:a + 7]
        w = split(pa.array([t for _, t in own], pa.string()), NOT_ALNUM, True)
        names = [str(n) if n is not None else "" for n, _ in own]
        blocks.append(SimpleNamespace(value=d.Block(names, w.ids.astype(np.int64), w.rows, w.distinct)))
    before, d.SHARD_WORDS = d.SHARD_WORDS, 300
    try:
        made = d._search(pa.array([t for _, t in docs], pa.string()), blocks, 13)
    finally:
        d.SHARD_WORDS = before
    expected = {i: row for i, *row in brute(docs, items)}
    for k, (i, _) in enumerate(docs):
        n_words, n_hit, n_items, digest, _ = expected[str(i)]
        assert (made["n_words"][k].as_py(), made["n_hit"][k].as_py()) == (n_words, n_hit)
        assert hashlib.sha256(",".join(made["items"][k].as_py()).encode()).hexdigest() == digest
        assert sum(b - a for a, b in made["spans"][k].as_py()) == n_hit


def test_suffix_array_is_sorted_and_finds_the_longest_match(rng):
    import numpy as np

    ids = np.array([rng.randrange(4) for _ in range(400)])
    rows = np.array([0, 100, 100, 250, 400])
    array = d.SuffixArray(ids, rows, 4)
    suffixes = [tuple(array.tokens[p:array.size]) for p in array.order]
    assert suffixes == sorted(suffixes) and sorted(array.order) == list(range(array.size))
    pattern = np.array([rng.randrange(5) for _ in range(60)]) + array.base
    starts = np.arange(60)
    best, place = array.longest(pattern, starts, 60 - starts)
    for s in range(60):
        def common(p):
            n = 0
            while s + n < 60 and p + n < array.size and pattern[s + n] == array.tokens[p + n]:
                n += 1
            return n
        assert best[s] == max(common(p) for p in range(array.size))
        assert best[s] == 0 or common(place[s]) == best[s]


def test_odd_rows(spark, odd):
    items = [(1, "x"), (2, "text without an id"), (3, "word word")]
    assert run(spark, odd, items) == brute(ODD_TEXTS, items)


def test_empty_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.verdicts(nothing, none).collect() == []
    assert all(r["n_hit"] == 0 and not r["contaminated"] for r in d.verdicts(odd, none).collect())


def test_removed_and_longest(spark, documents):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p"), (2, "one two three"), (3, None)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, "x b c d e f g h i j k l m n o y"), (8, "two three four")],
                                  "item_id long, text string")
    assert sorted(r["doc_id"] for r in d.removed(docs, bench).collect()) == [2, 3]
    found = {r["item"]: tuple(r)[1:] for r in d.longest_matches(docs, bench).collect()}
    assert found == {"7": (14, "1", 1, 1), "8": (2, "2", 0, 1)}
