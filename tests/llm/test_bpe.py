import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from odd import ODD_TEXTS

from veriledger.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def own():
    return bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def reference(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


ALPHABET = "ab aàé 12,.!?'s'll\n\t  ü漢字😀xyztheingAB_-=     "


def test_documents(own, reference, documents):
    for _, text in documents:
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == reference.encode_ordinary(text)
        assert own.decode(packed).decode() == text


def test_random_texts_and_edits(own, reference, rng):
    for _ in range(800):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 60)))
        held = bpe.EncodedText(own, text)
        assert held.ids() == reference.encode_ordinary(text)
        for _ in range(3):
            a = rng.randint(0, len(held.text))
            b = rng.randint(a, len(held.text))
            held.replace(a, b, "".join(rng.choices(ALPHABET, k=rng.randint(0, 6))))
            assert held.ids() == reference.encode_ordinary(held.text)
        held.append("ing the")
        assert held.ids() == reference.encode_ordinary(held.text)


def test_prefix_tables(own, rng):
    """Every prefix has the last token of its own encoding; appends and edits keep that."""
    for _ in range(100):
        piece = bytes(rng.choices(b"abehinorst", k=rng.randint(1, 90)))
        table = bpe.PrefixTable(own, piece[:20])
        table.append(piece[20:])
        for end in range(1, len(piece) + 1):
            assert own.tokens[table.last[end - 1]] == own.merged(piece[:end])[-1]
        at = rng.randrange(len(piece))
        table.replace(at, at + 1, b"th")
        edited = piece[:at] + b"th" + piece[at + 1:]
        assert [own.tokens[i] for i in table.ids()] == own.merged(edited)


def test_pairs(own, rng):
    tokens = list(own.tokens)
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        apart = own.merged(own.tokens[a] + own.tokens[b]) == [own.tokens[a], own.tokens[b]]
        assert own.may_follow(a, b) == apart


def test_query_columns(spark, odd, reference, nothing):
    rows = bpe.digests(odd).collect()
    expected = []
    for i, t in ODD_TEXTS:
        ids = reference.encode_ordinary(t or "")
        expected.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in rows) == sorted(expected)
    assert bpe.digests(nothing).collect() == []


def test_decode_of_stored_ids(spark, documents):
    df = spark.createDataFrame(documents[:50], "doc_id long, text string")
    rows = bpe.decode(bpe.encode(df)).collect()
    assert all(bytes(r["decoded"]).decode() == r["text"] for r in rows)
