import numpy as np
import pyarrow as pa
import pytest
import xxhash
from odd import ODD_TEXTS

from veriledger.llm import chunks as c


def test_cuts_resist_insertions(rng):
    """After an insertion the chunks away from it are the same."""
    words = [f"{rng.randrange(10 ** 6):x}" for _ in range(3000)]
    text = " ".join(words)
    changed = text[:5000] + "inserted words" + text[5000:]

    def cut(t):
        data = np.frombuffer(t.encode(), np.uint8)
        at = c.cuts(data, np.array([0, len(data)]))
        return [t[a:b] for a, b in zip(at[:-1], at[1:])]

    a, b = cut(text), cut(changed)
    assert "".join(a) == text and "".join(b) == changed
    assert max(map(len, a)) <= c.LONGEST
    assert len(set(a) - set(b)) <= 3


def test_cuts_do_not_depend_on_other_texts(rng):
    texts = ["".join(rng.choices("abc déf漢 ", k=rng.randint(0, 900))) for _ in range(60)]
    together = c.rows_of(pa.array(texts))
    for i, t in enumerate(texts):
        own = c.rows_of(pa.array([t]))
        mine = together[0] == i
        for x, y in zip(own[1:], together[1:]):
            assert np.array_equal(x, y[mine])


def test_gear_is_the_sum_of_shifted_bytes(rng):
    data = np.frombuffer(bytes(rng.choices(range(256), k=200)), np.uint8)
    rolled = c.gear(data)
    for i in range(200):
        expected = sum(int(c._GEAR[data[i - j]]) << j for j in range(min(c.ROLLED, i + 1))) % (1 << 32)
        assert rolled[i] == expected


def planted(rng, documents):
    vocabulary = sorted({w for _, t in documents[:60] for w in t.split()})
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 300)))) for i in range(300)]
    repeats = set()
    for n in range(60):
        passage = " ".join(rng.choices(vocabulary, k=rng.randint(51, 80)))
        for k, i in enumerate(sorted(rng.sample(range(5 * n, 5 * n + 5), 3))):
            w = docs[i][1].split()
            j = rng.randint(0, len(w))
            docs[i] = (i, " ".join([*w[:j], passage, *w[j:]]))
            if k:
                repeats.add(i)
    return docs, repeats


def test_planted_passages(spark, rng, documents):
    docs, expected = planted(rng, documents)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    rows = c.repeats(df).collect()
    assert {r["doc_id"] for r in rows} == expected
    text = dict(docs)
    for r in rows:
        span = text[r["doc_id"]].encode()[r["start_byte"]:r["end_byte"]]
        assert r["first_doc_id"] < r["doc_id"] and span in text[r["first_doc_id"]].encode()


def found(a, b):
    """The bytes of the longest span of `b` whose rows `a` has too."""
    _, _, _, have = c.rows_of(pa.array([a]))
    _, begins, ends, digests = c.rows_of(pa.array([b]))
    most = begin = end = 0
    for x, y in zip(begins[np.isin(digests, have)].tolist(), ends[np.isin(digests, have)].tolist()):
        begin, end = (begin, max(end, y)) if x <= end and end else (x, y)
        most = max(most, end - begin)
    return most


def test_every_passage_of_51_words(rng, documents):
    """Passages of the documents' own words, put into different places of different texts."""
    words = [w for _, t in documents for w in (t or "").split()]
    lost = 0
    for n in range(1000):
        k = rng.randrange(len(words) - 51)
        passage = " ".join(words[k:k + 51])
        a, b = (" ".join([*rng.choices(words, k=rng.randint(1, 60)), passage, *rng.choices(words, k=40)])
                for _ in range(2))
        lost += found(a, b) < c.LEAST
    assert lost == 0


@pytest.mark.parametrize("turn", ["a", "no ", "go on ", "buy now ", "cheap pills ", "click here to win "])
def test_stretches_of_a_short_period(rng, turn):
    """One in the middle of different texts is found wherever it begins."""
    for _ in range(50):
        stretch = turn * 20 + turn * (200 // len(turn))
        a, b = (f"{rng.getrandbits(rng.randint(100, 900)):x} {stretch} {rng.getrandbits(300):x}" for _ in range(2))
        assert found(a, b) >= c.LEAST


def brute(rows):
    """Spans of every text from the rows of chunks of all texts, in dictionaries. Chunks are found text by text."""
    holders, placed = {}, {}
    for i, t in rows:
        if i is None:
            i = -(1 << 63) + (xxhash.xxh64_intdigest((t or "").encode(), 42) >> 2)
        _, begins, ends, digests = c.rows_of(pa.array([t], pa.string()))
        for b, e, d in zip(begins.tolist(), ends.tolist(), digests.tolist()):
            holders.setdefault(d, set()).add(i)
            placed.setdefault((i, t), set()).add((b, e, d))
    out = set()
    for (i, _), own in placed.items():
        spans = []
        for b, e, d in sorted(own):
            if min(holders[d]) < i:
                if spans and b <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([b, e])
        out |= {(i if i >= -(1 << 62) else None, b, e) for b, e in spans if e - b >= c.LEAST}
    return out


def shared_ids(rng):
    """Different texts under one id and under none, with passages of other documents at either end."""
    words = [f"{rng.randrange(10 ** 5):x}" for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(40, 90))) for _ in range(40)]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(6)]
    rows = [(100 + i, t) for i, t in enumerate(texts[:6])] + [(i, p) for i, p in enumerate(passages)]
    for n, p in enumerate(passages):
        a, b = texts[6 + 2 * n:8 + 2 * n]
        rows += [(7, f"{p} {a}"), (7, f"{b} {p}"), (None, f"{a} {p}"), (None, f"{p} {b}"), (None, f"{p} {b}")]
    rng.shuffle(rows)
    return rows


def test_texts_of_one_id_are_told_apart(spark, rng):
    rows = shared_ids(rng)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r["doc_id"], r["start_byte"], r["end_byte"]) for r in c.repeats(df).collect()}
    assert found == brute(rows)
    left = {}
    for r in c.removed(df).collect():
        left.setdefault(r["doc_id"], []).append(r["text"])
    passages = {t for i, t in rows if i is not None and i < 6}
    for i in range(6):  # a passage stays where its id is the smallest of those that have it
        smallest = [p for p in passages if (i, p) in rows]
        assert not smallest or len(left[i]) == 1
    # text that no other document has is never cut
    for i, t in rows:
        if i is not None and i >= 100:
            assert left[i] == [t]
    assert not any(p in t for p in passages for t in left[7])


def test_a_passage_at_the_start_of_one_and_the_end_of_another(spark, rng):
    words = [f"{rng.randrange(10 ** 5):x}" for _ in range(500)]
    passage, a, b = (" ".join(rng.choices(words, k=60)) for _ in range(3))
    rows = [(1, passage), (7, f"{passage} {a}"), (7, f"{b} {passage}")]
    left = [r["text"] for r in c.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert passage in left and sum(t.endswith(a[20:]) and passage not in t for t in left) == 1
    assert sum(t.startswith(b[:-40]) and passage not in t for t in left) == 1


def test_against_brute_force(spark, documents):
    rows = [*documents, *[(i + 10_000, t) for i, t in documents[:20]], *ODD_TEXTS, *ODD_TEXTS]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {(r["doc_id"], r["start_byte"], r["end_byte"]) for r in c.repeats(df).collect()}
    assert found == brute(rows)


def test_removed(spark, rng, documents, odd, nothing):
    docs, expected = planted(rng, documents)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = c.removed(df)
    assert left.columns == df.columns
    text = {r["doc_id"]: r["text"] for r in left.collect()}
    assert {i for i, t in docs if text[i] != t} == expected
    assert {r["doc_id"] for r in c.repeats(left).collect()} == set()
    assert c.removed(odd).columns == odd.columns and c.removed(odd).count() == len(ODD_TEXTS)
    assert c.repeats(nothing).collect() == []
