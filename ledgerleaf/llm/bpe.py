"""Byte-level BPE as a lazily determinised transducer; streaming decode with an incremental UTF-8 state machine.

Encoding reads the bytes of a piece once, from left to right. Behind it stands one property of rank-ordered merging: a
text's encoding is the encoding of a prefix plus one token exactly when merging the prefix's last token and that token
by themselves leaves both as they are. A state therefore holds only the text since the last settled token border, the
last token of each prefix inside it, and how much of it a longer token may still cover; the byte that follows fixes the
next state and the tokens that no later byte can change. States and moves are made when first met and kept. The
lookahead is bounded by the longest token.

Both operators are maps over rows: no shuffle, memory bounded by one text and by the tables' fixed limits.

Defined cases: null and empty texts have no ids and decode to nothing; repeated rows are encoded each; an empty table
gives an empty result; bytes that are no UTF-8 decode to U+FFFD in
``text`` while ``decoded`` keeps the bytes; input columns named like an added column give way to it.
"""

from __future__ import annotations

import base64
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, unpacked, without

NEITHER = (-1, 0)
FEW = 16  # tokens that may go on from a state's text, up to which they are tried behind the token before it
MAX_STATES = 300_000  # states are dropped and made anew beyond these
MAX_UNITS, MAX_PIECES = 350_000, 250_000  # remembered in each of two generations; what is used again outlives the older one
MAX_PIECE = 64  # longer pieces are encoded, not remembered
#: The pattern whose matches begin with one blank at most and end before the next white space, so that none crosses a unit. Texts under other patterns aren't cut into units.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNIT = re.compile(r" ?\S+|\s+(?!\S)|\s")
#: Control characters that count as white space for the standard library's matcher only.
ODD = re.compile(r"[\x1c-\x1f]")
ROWS = 512  # rows of an Arrow batch made here


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.size = {r: len(t) for t, r in ranks.items()}
        self.byte = [bytes((b,)) for b in range(256)]
        #: text -> (its rank, -1 if it is no token; how many tokens are longer and begin with it)
        longer: dict[bytes, int] = {}
        for t in ranks:
            for k in range(1, len(t)):
                longer[t[:k]] = longer.get(t[:k], 0) + 1
        self.known = {t: (ranks.get(t, -1), longer.get(t, 0)) for t in (*longer, *ranks)}
        self.sorted = sorted(ranks)  # tokens that begin with a text stand together
        self.fits: dict[tuple[int, int], bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.reset()

    def reset(self) -> None:
        #: state: (text since the border, the token before it (-1: it doesn't matter to any token that may begin at the border), last tokens after it (-2: on no live path), places where a longer token may begin)
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, int] = {}  # 256 * state + byte: twice the next state, and 1 if the move settles tokens
        self.outs: dict[int, tuple[int, ...]] = {}  # the tokens settled by such a move
        self.ends: dict[int, list[int]] = {}  # the tokens still owed where a piece ends
        self._state((b"", -1, (), ()))

    def merged(self, text: bytes, below: int = 1 << 60) -> list[bytes]:
        """The plain definition, for ranks under ``below``: merge the neighbours of least rank, leftmost first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _halves(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``t``; none for a byte or a token that merging never makes."""
        got = self.split.get(t, self)
        if got is self:
            parts = self.merged(self.token[t], t)
            got = self.split[t] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return got

    def _fit(self, a: int, b: int) -> bool:
        """Whether merging the two tokens' text gives them again: their merges are undone, latest first, looking for one across the border that would have come earlier."""
        if a < 0:
            return True
        got = self.fits.get((a, b))
        if got is None:
            if len(self.fits) > 2 * MAX_STATES:
                self.fits.clear()
            got = self.fits[a, b] = self._undone(a, b)
        return got

    def _undone(self, a: int, b: int) -> bool:
        until, ranks, token = 1 << 60, self.ranks, self.token
        while True:
            if ranks.get(token[a] + token[b], until) < until:
                return False
            left, right = self._halves(a), self._halves(b)
            if left and (not right or a > b):  # of equal ranks the left one was merged first
                until, a = a, left[1]
            elif right:
                until, b = b + 1, right[0]
            else:
                return True

    def _all_fit(self, before: int, text: bytes) -> bool:
        """Whether every token that goes on from ``text`` fits behind ``before``; where more than a few do it isn't looked up, and may be said not to."""
        n = self.known[text][1]
        if n > FEW:
            return False
        at = bisect_right(self.sorted, text)
        return all(self._fit(before, self.ranks[t]) for t in self.sorted[at : at + n])

    def _state(self, key: tuple) -> int:
        k = self.number.get(key)
        if k is None:
            k = self.number[key] = len(self.states)
            self.states.append(key)
        return k

    def _path(self, last: tuple[int, ...], to: int, since: int) -> list[int]:
        out = []
        while to > since:
            out.append(last[to - 1])
            to -= self.size[last[to - 1]]
        return out[::-1]

    def _move(self, state: int, byte: int) -> int:
        text, before, last, opens = self.states[state]
        text += self.byte[byte]
        n, known, fits, token, still = len(text), self.known, self.fits, -1, []
        for q in (*opens, n - 1):  # the longest token first
            rank, longer = known.get(text[q:], NEITHER)
            if token < 0 and rank >= 0:
                a = last[q - 1] if q else before
                if a < 0 or (fits[a, rank] if (a, rank) in fits else self._fit(a, rank)):
                    token = rank
            if longer:
                still.append(q)
        if token < 0:
            raise ValueError(f"no token ends here: {text!r}")
        last = (*last, token)
        # the last border that the paths to all open positions share: step back from the farthest until one is left
        live, size, p, waiting = 0, self.size, n, 1 << n
        for q in still:
            waiting |= 1 << q
        while waiting & (waiting - 1):
            if waiting >> p & 1:
                waiting ^= 1 << p
                live |= 1 << p
                waiting |= 1 << p - size[last[p - 1]]
            p -= 1
        border = waiting.bit_length() - 1
        if border:
            out = self.outs[state << 8 | byte] = tuple(self._path(last, border, 0))
            before, text, last = out[-1], text[border:], last[border:]
            still = [q - border for q in still]
        if live.bit_count() < len(last):
            last = tuple([x if live >> border + k & 1 else -2 for k, x in enumerate(last, 1)])
        if not still or still[0] or before >= 0 and self._all_fit(before, text):
            before = -1
        to = self.moves[state << 8 | byte] = 2 * self._state((text, before, last, tuple(still))) + (border > 0)
        return to

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:  # a token's own text is that token
            return [whole]
        if len(self.states) > MAX_STATES:
            self.reset()
        state, ids, moves, outs = 0, [], self.moves, self.outs
        for byte in piece:
            at = state << 8 | byte
            to = moves.get(at) or self._move(state, byte)  # no move leads back to state 0
            if to & 1:
                ids.extend(outs[at])
            state = to >> 1
        owed = self.ends.get(state)
        if owed is None:
            text, _, last, _ = self.states[state]
            owed = self.ends[state] = self._path(last, len(text), 0)
        return ids + owed


class _Known(dict):
    """Ids of texts as bytes of int32, made when first asked for and remembered in two generations."""

    def __init__(self, make, most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= MAX_PIECE:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Encoder:
    """Splits a text into units (white space, or a word with the one blank before it), units into matches of the pattern, and encodes those."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        transducer = Transducer(ranks)
        self.match, self.in_units = regex.compile(pattern).findall, pattern == WORDS
        pieces = _Known(lambda p: array("i", transducer.encode(p.encode("utf-8", "surrogatepass"))).tobytes(), MAX_PIECES)
        self.piece = pieces.__getitem__
        self.unit = _Known(self._unit, MAX_UNITS).__getitem__

    def _unit(self, unit: str) -> bytes:
        letters = unit[1:] if unit[0] == " " else unit
        if letters.isalpha():  # one match
            return self.piece(unit)
        if unit[-1] in ".,;:!?" and letters[:-1].isalpha():  # two
            return self.piece(unit[:-1]) + self.piece(unit[-1])
        return b"".join(map(self.piece, self.match(unit)))

    def encode(self, text: str) -> bytes:
        if not self.in_units or ODD.search(text):
            return b"".join(map(self.piece, self.match(text)))
        return b"".join(map(self.unit, UNIT.findall(text)))


class Utf8Machine:
    """Takes bytes as they come; gives characters as soon as they are whole."""

    def __init__(self) -> None:
        self.need, self.low, self.high, self.held = 0, 0x80, 0xBF, b""

    def feed(self, data: Iterable[int]) -> str:
        out = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.held += bytes((b,))
                    self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(self.held.decode())
                        self.held = b""
                    continue
                out.append("�")
                self.need, self.held = 0, b""
            self.low, self.high = 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xF4:
                self.need, self.held = 1 + (b >= 0xE0) + (b >= 0xF0), bytes((b,))
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        left, self.need, self.held = "�" * bool(self.need), 0, b""
        return left


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.bytes = [b""] * size
        self.text: list[str | None] = [""] * size
        for t, r in ranks.items():
            self.bytes[r] = t
            try:
                self.text[r] = t.decode()
            except UnicodeDecodeError:
                self.text[r] = None  # its characters begin or end in another token
        self.whole = np.array([t is not None for t in self.text], bool)
        self.size = np.array([len(t) for t in self.bytes], np.int64)

    def decode(self, ids: np.ndarray) -> tuple[bytes, str]:
        data = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        broken = np.flatnonzero(~self.whole[ids])
        if not len(broken):
            return data, data.decode()
        edge = np.append(0, np.cumsum(self.size[ids]))
        machine, out, at = Utf8Machine(), [], 0
        heads = np.flatnonzero(np.diff(broken, prepend=-2) != 1)
        for a, z in zip(broken[heads].tolist(), np.append(broken[heads[1:] - 1], broken[-1]).tolist()):
            out.append(data[at : edge[a]].decode())
            at = edge[z + 1]
            out.append(machine.feed(data[edge[a] : at]) + machine.end())  # a whole token follows
        out.append(data[at:].decode())
        return data, "".join(out)


_made: dict[tuple, object] = {}


def _once(kind, path: str, *more):
    if (kind, path, *more) not in _made:
        _made[kind, path, *more] = kind(read_ranks(path), *more)
    return _made[kind, path, *more]


def _with(batch: pa.RecordBatch, arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    keep = {n: c for n, c in zip(batch.schema.names, batch.columns)}
    return pa.RecordBatch.from_pydict(keep | arrays)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def _lists(parts: list[bytes]) -> pa.Array:
    sizes = np.array([len(p) // 4 for p in parts], np.int64)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def bpe_encode(docs: DataFrame, ranks: str, pattern: str, keep_text: bool = True) -> DataFrame:
    """``docs`` (text, ...) with ``ids`` (array<int>): each match of ``pattern`` encoded separately by the ranks in the file ``ranks``."""
    docs = without(docs, ["ids"])
    given = carried(docs, ["text"]).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([f for f in given.schema if keep_text or f.name != "text"] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _once(Encoder, ranks, pattern)
        for b in _small(batches):
            ids = [encoder.encode(t) if t else b"" for t in b.column("text").to_pylist()]
            yield _with(b if keep_text else b.drop_columns(["text"]), {"ids": _lists(ids)})

    return unpacked(given.mapInArrow(run, schema), [*[c for c in docs.columns if keep_text or c != "text"], "ids"], ["text", "ids"])


def bpe_decode(coded: DataFrame, ranks: str) -> DataFrame:
    """``coded`` (ids, ...) with ``decoded`` (the bytes) and ``text`` (their characters); null ids are none."""
    coded = without(coded, ["decoded", "text"])
    given = carried(coded, ["ids"]).withColumn("ids", F.coalesce(F.col("ids"), F.array().cast("array<int>")))
    schema = T.StructType([*given.schema, T.StructField("decoded", T.BinaryType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _once(Decoder, ranks)
        for b in _small(batches):
            ids = b.column("ids")
            edge, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
            got = [decoder.decode(flat[a:z]) for a, z in zip(edge, edge[1:])]
            yield _with(b, {"decoded": pa.array([x for x, _ in got], pa.binary()), "text": pa.array([x for _, x in got], pa.string())})

    return unpacked(given.mapInArrow(run, schema), [*coded.columns, "decoded", "text"], ["ids", "decoded", "text"])


def bpe_round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` (text, ...) with ``text`` replaced by ids, decoded and text: both operators in one pass, so that the ids stay in the worker that knows them."""
    docs = without(docs, ["ids", "decoded"])
    given = carried(docs, ["text"]).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*[f for f in given.schema if f.name != "text"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _once(Encoder, ranks, pattern), _once(Decoder, ranks)
        for b in _small(batches):
            ids = [encoder.encode(t) if t else b"" for t in b.column("text").to_pylist()]
            got = [decoder.decode(np.frombuffer(x, np.int32)) for x in ids]
            yield _with(b.drop_columns(["text"]), {"ids": _lists(ids), "decoded": pa.array([x for x, _ in got], pa.binary()), "text": pa.array([x for _, x in got], pa.string())})

    added = ["ids", "decoded", "text"]
    return unpacked(given.mapInArrow(run, schema), [*[c for c in docs.columns if c != "text"], *added], added)
