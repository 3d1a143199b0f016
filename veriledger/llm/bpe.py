"""Byte-level BPE by prefixes: every prefix of a piece has one valid last token, so the encoding of a
piece is a table that appends extend and edits rebuild from the edited byte on.

A sequence of tokens is the BPE encoding of its bytes exactly when every neighbouring pair of them is
the encoding of the pair's bytes. So the last token of a prefix is the one token that ends there and
may follow the last token of what is left, and one pass over the bytes finds them all.

Texts are cut into pieces by the tokenizer's pattern first. Null is the empty text; an empty text has
no tokens. Distinct pieces are encoded once per task while a bounded memory holds them.
"""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.frames import extended

VOCABULARY = "byte_bpe_50k.tiktoken"

#: Pieces, prefixes and pairs of tokens that a task remembers at most; beyond that it starts anew. Pieces up
#: to SHARED_BYTES share the last tokens of their common prefixes; longer ones have tables of their own.
REMEMBERED, SHARED_BYTES = 300_000, 64

#: Bytes of text that are encoded at once.
AT_ONCE = 1 << 20

_PACKED = T.StructField("token_ids", T.BinaryType())
_BYTES = T.StructField("decoded", T.BinaryType())


class _Pieces(dict):
    """Pieces with their tokens as little-endian 32-bit numbers, encoded when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        packed = np.array(self.vocabulary.tokens_of(piece.encode()), "<u4").tobytes()
        self[piece] = packed
        return packed


class Vocabulary:
    """Ranks of a tiktoken file and the pieces encoded with them."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self._split = {p: self._halves(p) for p in self.ranks if len(p) > 1}
        # Tokens that merging does not reach, or whose parts it does not reach in the order of ranks.
        self._broken = set()
        for part in sorted(self._split, key=len):
            halves = self._split[part]
            if halves is None or any(h not in self.ranks or self.ranks[h] in self._broken
                                     or self.ranks[h] > self.ranks[part] for h in halves):
                self._broken.add(self.ranks[part])
        self._left: dict[int, list] = {}
        self._right: dict[int, list] = {}
        self._last: dict[bytes, int] = {}
        self._pairs: dict[int, bool] = {}
        self._pieces = _Pieces(self)

    def merged(self, piece: bytes) -> list[bytes]:
        """Parts by merging the lowest rank first, leftmost first, until no two parts merge."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1)
                     if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that merge into a token last; none for a token that merging does not reach."""
        rank = self.ranks[token]
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [(r, i) for i in range(len(parts) - 1)
                     if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None and r < rank]
            if not found:
                return None
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts[0], parts[1]

    def _edge(self, token: int, right: bool) -> list[tuple[bytes, float]]:
        """What lies at a token's edge while it is merged: from the byte to the token, each part with the
        rank at which it becomes the next."""
        edges = self._right if right else self._left
        if token not in edges:
            part, path = self.tokens[token], []
            until = float("inf")
            while True:
                path.append((part, until))
                if len(part) == 1:
                    break
                until = self.ranks[part]
                part = self._split[part][1 if right else 0]
            edges[token] = path[::-1]
        return edges[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when their bytes are encoded together.

        The parts at their common edge grow in the order of their ranks; the tokens stay apart if at no
        time the two parts that meet there merge before either grows. A part's rank is above its halves',
        and of equal ranks the leftmost goes first.
        """
        pair = left << 32 | right
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            if left in self._broken or right in self._broken:
                whole = self.tokens[left] + self.tokens[right]
                known = self.merged(whole) == [self.tokens[left], self.tokens[right]]
            else:
                known = self._apart(self._edge(left, True), self._edge(right, False))
            self._pairs[pair] = known
        return known

    def _apart(self, left: list, right: list) -> bool:
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            rank = self.ranks.get(x + y)
            if rank is not None and rank < x_until and rank <= y_until:
                return False
            if x_until <= y_until:
                if x_until == float("inf"):
                    return True
                i += 1
            else:
                j += 1

    def stands_alone(self, token: int) -> bool:
        """Whether a token's bytes encode to it when they are all there is."""
        return token not in self._broken or self.merged(self.tokens[token]) == [self.tokens[token]]

    def tokens_of(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > SHARED_BYTES:
            return PrefixTable(self, piece).ids()
        last = self._last
        if len(last) + len(piece) > REMEMBERED:
            last.clear()
        own: list[int] = []
        while len(own) < len(piece) and (token := last.get(piece[:len(own) + 1])) is not None:
            own.append(token)
        rank, pairs = self.ranks.get, self._pairs.get
        for end in range(len(own) + 1, len(piece) + 1):
            for left in range(end - 1, -1, -1):
                token = rank(piece[left:end])
                if token is None:
                    continue
                if left:
                    before = own[left - 1]
                    fits = pairs(before << 32 | token)
                    if fits is None:
                        fits = self.may_follow(before, token)
                else:
                    fits = self.stands_alone(token)
                if fits:
                    own.append(token)
                    last[piece[:end]] = token
                    break
            else:
                raise ValueError("a byte has no token")
        found, end = [], len(piece)
        while end:
            token = own[end - 1]
            found.append(token)
            end -= len(self.tokens[token])
        return found[::-1]

    def forget(self) -> None:
        """Gives up what was remembered of pieces, prefixes and pairs."""
        for known in (self._left, self._right, self._last, self._pairs, self._pieces):
            known.clear()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self.pattern.findall(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


class PrefixTable:
    """The last token of every byte prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Lengthens the piece: known prefixes keep their tokens."""
        v, last, at = self.vocabulary, self.last, len(self.piece)
        rank, pairs, longest = v.ranks.get, v._pairs, v.longest
        piece = self.piece = self.piece + more
        for end in range(at + 1, len(piece) + 1):
            for left in range(max(0, end - longest), end):
                token = rank(piece[left:end])
                if token is None:
                    continue
                if left == 0:
                    fits = v.stands_alone(token)
                else:
                    before = last[left - 1]
                    fits = pairs.get(before << 32 | token)
                    if fits is None:
                        fits = v.may_follow(before, token)
                if fits:
                    last.append(token)
                    break
            else:
                raise ValueError("a byte has no token")

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Replaces bytes start to end; prefixes before the edit keep their tokens."""
        rest = self.piece[end:]
        self.piece, self.last = self.piece[:start], self.last[:start]
        self.append(new + rest)

    def ids(self) -> list[int]:
        if self.piece in self.vocabulary.ranks:
            return [self.vocabulary.ranks[self.piece]]
        found, end = [], len(self.piece)
        while end:
            found.append(self.last[end - 1])
            end -= len(self.vocabulary.tokens[found[-1]])
        return found[::-1]


class EncodedText:
    """A text's tokens that follow its edits: pieces away from an edit keep their tables."""

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, text
        self.pieces = [(m.start(), PrefixTable(vocabulary, m.group().encode()))
                       for m in vocabulary.pattern.finditer(text)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Replaces characters start to end and cuts anew from two pieces before them, until a cut
        falls again where one was."""
        text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        # The pattern looks one character past a piece, so the piece before the edit may change too.
        first = sum(at < start for at, _ in self.pieces)
        first = max(first - 2, 0)
        at = self.pieces[first][0] if self.pieces else 0
        old = {a + shift: i for i, (a, _) in enumerate(self.pieces) if a >= end}
        made, found = self.pieces[:first], None
        for m in self.vocabulary.pattern.finditer(text, at):
            if m.start() in old and m.start() >= start + len(new):
                found = old[m.start()]
                break
            made.append((m.start(), PrefixTable(self.vocabulary, m.group().encode())))
        if found is not None:
            made += [(a + shift, t) for a, t in self.pieces[found:]]
        self.text, self.pieces = text, made

    def ids(self) -> list[int]:
        return [i for _, table in self.pieces for i in table.ids()]


_OPEN: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """A task's vocabulary, read once per Python worker."""
    if path not in _OPEN:
        _OPEN[path] = Vocabulary(path)
    return _OPEN[path]


def encode(df: DataFrame, column: str = "text", path: str | None = None, keep=None) -> DataFrame:
    """Adds `token_ids`, the tokens of a text as little-endian unsigned 32-bit numbers.

    `path` names the rank file on every machine. Null is the empty text; every row is kept, and a
    column of the new one's name gives way to it. What a task remembers of pieces goes with it, as its worker may
    live on for other steps.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def work(texts: pa.Array) -> dict:
        v = vocabulary(path)
        return {"token_ids": pa.array([v.encode(t or "") for t in texts.to_pylist()], pa.binary())}

    return extended(df, column, [_PACKED], work, keep, AT_ONCE, lambda: vocabulary(path).forget())


def decode(df: DataFrame, column: str = "token_ids", path: str | None = None, keep=None) -> DataFrame:
    """Adds `decoded`, the bytes that packed token ids stand for; null has none."""
    path = path or public_tokenizers.path(VOCABULARY)
    kept = [c for c in df.columns if c.lower() != "decoded" and (keep is None or c in keep)]
    schema = T.StructType([df.schema[c] for c in kept] + [_BYTES])

    def run(parts):
        v = vocabulary(path)
        for batch in parts:
            ids = batch.column(batch.schema.get_field_index(column)).to_pylist()
            made = pa.array([v.decode(x or b"") for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in kept]
                                             + [made], names=[*kept, "decoded"])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, column: str = "text", path: str | None = None, keep=None) -> DataFrame:
    """Adds `token_ids` and `decoded`, the bytes decoded from them, in one pass."""
    path = path or public_tokenizers.path(VOCABULARY)

    def work(texts: pa.Array) -> dict:
        v = vocabulary(path)
        ids = [v.encode(t or "") for t in texts.to_pylist()]
        return {"token_ids": pa.array(ids, pa.binary()), "decoded": pa.array(map(v.decode, ids), pa.binary())}

    return extended(df, column, [_PACKED, _BYTES], work, keep, AT_ONCE)


def digests(df: DataFrame, column: str = "text", path: str | None = None) -> DataFrame:
    """Per document its number of tokens and digests of the ids and of the bytes decoded from them."""
    return round_trip(df, column, path, keep=["doc_id"]).select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
