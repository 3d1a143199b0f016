"""Words of a batch of texts as numbers, found in the UTF-8 bytes all texts share in Arrow."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes that part words: ASCII white space, or all ASCII but digits and lower-case letters.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

#: Odd numbers that spread 64-bit values.
SPREAD, SPREAD_2, SPREAD_3 = (np.uint64(x) for x in
                              (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class Words(NamedTuple):
    """`ids` of all words in text order, the byte range of each, each text's first word (`rows`, one
    more than there are texts) and the distinct words that the ids count through."""

    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    distinct: pa.Array


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each text begins, with the end; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, parting: np.ndarray, lower: bool) -> Words:
    """Maximal runs of bytes that do not part words; `lower` turns A-Z into a-z first."""
    data, offsets = utf8(texts)
    if lower:
        data = _LOWER[data]
    inside = ~parting[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = False, False
    begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    starts = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(ends - begins, out=starts[1:])
    flat = pa.Array.from_buffers(pa.large_binary(), len(begins),
                                 [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), begins, ends, np.searchsorted(begins, offsets),
                 coded.dictionary)


def spread(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern in them."""
    values = (values ^ (values >> np.uint64(30))) * SPREAD_2
    values = (values ^ (values >> np.uint64(27))) * SPREAD_3
    return values ^ (values >> np.uint64(31))


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each distinct word, the same in every batch."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.distinct.to_pylist()),
                       np.uint64, len(words.distinct))


def grams(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` values from each position on, in their order."""
    total = values[:max(len(values) - size + 1, 0)].copy()
    for i in range(1, size):
        total = total * SPREAD + values[i:len(total) + i]
    return spread(total)
