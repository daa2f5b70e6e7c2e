"""Substring dedup by super-k-mers.

Every window of 13 consecutive words has a minimiser: the least hash among its 3-word parts. Consecutive windows with
the same minimiser form one super-k-mer, which travels as one packed string to the bucket of the minimiser, so equal
windows always meet. A bucket numbers its words exactly, sorts its windows and finds the smallest doc_id of each.

Plan: documents are dealt into chunks by a hash of doc_id (one shuffle, read twice); a chunk sends one compressed block
to each bucket: its different strings, each once with the smallest doc_id that has it here. So copies are combined before
the shuffle, and no place in a text travels. A bucket keeps each string once, whichever chunks sent it, and a chunk's number
of it; it answers a block with the runs of windows that start in a smaller doc_id than the chunk's smallest. Blocks and
answers meet the texts by chunk, where the super-k-mers are made again: places of a string beyond the chunk's smallest
doc_id lose all of it, those of the smallest what the answer names. A passage that a third of the rows share is one entry
a chunk in its bucket. A minimiser that a sample of documents shows to be frequent is split: its windows travel alone and
are spread over all buckets by the hash of the whole window. That only moves work; the result does not depend on the
sample, which grows with the corpus, so that a minimiser that fills a bucket is in it some dozens of times at any size.

Defined cases: null or blank text has no words and loses none; a text shorter than the window keeps all; rows with
equal doc_id never remove each other's words; a null doc_id counts as the greatest; an empty table gives an empty
result; repeated rows are documents of one doc_id; input columns named like an added column give way to it, other names
don't matter.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunk_of, without

PART = 3  # words of a minimiser
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
SAMPLE_ROWS, SAMPLE_PART = 4000, 0.001  # documents looked at to find frequent minimisers, or this part if it is more; they steer the dealing only
ADDED = ["n_words", "n_removed", "kept_sha256"]
NO_ID = np.iinfo(np.int64).max

_MULT = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) | 1 for k in range(1, 65)], dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _weighted(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` numbers."""
    n = len(ids) - width + 1
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out += ids[j : j + n] * _MULT[j]
    return out


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = width - span
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def _sorted_rows(ids: pa.ChunkedArray, texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Row order by (doc_id, text), the ids in that order and the texts in that order."""
    keys = [NO_ID if x is None else x for x in ids.to_pylist()]
    raw = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
    order = sorted(range(len(raw)), key=lambda i: (keys[i], raw[i]))
    return np.array(order, np.int64), np.array([keys[i] for i in order], np.int64), [raw[i] for i in order]


def _super_kmers(texts: list[bytes], window: int):
    """Joined words, their byte offsets, and per super-k-mer: row, first word, first window in the row, windows, minimiser."""
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    words = [x for w, n in zip(split, sizes) if n >= window for x in w]
    if not words:
        return None
    joined = b" ".join(words)
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=offsets[1:])
    crc = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1)
    del words, split
    least = _sliding_min(_mix(_weighted(crc, PART)), window - PART + 1)
    rows = np.flatnonzero(sizes >= window)
    long = sizes[rows]
    first = np.cumsum(long) - long
    row = np.repeat(np.arange(len(rows)), long)[: len(least)]
    at = np.arange(len(least)) - first[row]
    valid = at + window <= long[row]
    starts = valid.copy()
    starts[1:] &= (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(starts)
    count = np.diff(np.append(np.cumsum(valid)[begin] - 1, valid.sum()))
    return joined, offsets, crc, rows[row[begin]], begin, at[begin], count, least[begin]


def _heavy(spark_docs: DataFrame, window: int, buckets: int, rows: int) -> np.ndarray:
    """Minimisers that would overfill a bucket, judged on a sample; at most ``2 * buckets`` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = _super_kmers([x or b"" for x in b.column(0).cast(pa.binary()).to_pylist()], window)
            if got:
                value, n = np.unique(got[7].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n.astype(np.int64))], names=["m", "n"])

    sample = spark_docs.select("text").where(F.col("text").isNotNull())
    if rows > SAMPLE_ROWS:
        sample = sample.sample(max(SAMPLE_ROWS / rows, SAMPLE_PART), seed=7)
    seen = sample.mapInArrow(count, "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))
    total = seen.agg(F.sum("n")).first()[0] or 0
    most = seen.where(F.col("n") > max(64, total // buckets)).orderBy(F.desc("n")).limit(2 * buckets).collect()
    return np.array(sorted(r.m for r in most), np.int64).view(np.uint64)


class _Dealt:
    """A chunk's super-k-mers and the strings they are sent as, numbered by bucket and first place."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], window: int, buckets: int, heavy: np.ndarray):
        got = _super_kmers(texts, window)
        self.strings: list[bytes] = []
        self.string = np.zeros(0, np.int64)  # of each super-k-mer
        if got is None:
            return
        joined, offsets, crc, row, begin, at, count, least = got
        if len(heavy):
            hot = np.isin(least, heavy)
            if hot.any():
                n = count[hot]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                alone = np.repeat(begin[hot], n) + step
                whole = _mix(_weighted(crc, window))
                row = np.concatenate([row[~hot], np.repeat(row[hot], n)])
                at = np.concatenate([at[~hot], np.repeat(at[hot], n) + step])
                begin, least = np.concatenate([begin[~hot], alone]), np.concatenate([least[~hot], whole[alone]])
                count = np.concatenate([count[~hot], np.ones(len(alone), np.int64)])
        bucket = (_mix(least) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((at, row, bucket))
        self.row, self.at, self.count, bucket = row[order], at[order], count[order], bucket[order]
        low, high = offsets[begin[order]], offsets[begin[order] + self.count + window - 1] - 1
        parts, self.first = [], [0]  # a bucket's strings begin at ``first``
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
            known: dict[bytes, int] = {}
            parts.append(np.fromiter((known.setdefault(joined[s:e], len(known)) for s, e in zip(low[a:z].tolist(), high[a:z].tolist())), np.int64, z - a) + len(self.strings))
            self.strings.extend(known)
            self.first.append(len(self.strings))
        self.bucket, self.string, self.doc = bucket[edges], np.concatenate(parts), ids[self.row]
        self.windows = np.zeros(len(self.strings), np.int64)
        self.windows[self.string] = self.count
        self.least = np.full(len(self.strings), NO_ID)
        np.minimum.at(self.least, self.string, self.doc)


def _blocks(table: pa.Table, window: int, buckets: int, heavy: np.ndarray) -> pa.Table:
    """A chunk's blocks: (chunk, bucket, payload)."""
    schema = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])
    _, ids, texts = _sorted_rows(table.column("doc_id"), table.column("text"))
    dealt = _Dealt(ids, texts, window, buckets, heavy)
    if not dealt.strings:
        return schema.empty_table()
    press, out = zstandard.ZstdCompressor(level=3), []
    for a, z in zip(dealt.first, dealt.first[1:]):
        text = b"\n".join(dealt.strings[a:z])
        out.append(press.compress(struct.pack("<2q", len(text), z - a) + text + dealt.windows[a:z].astype(np.uint32).tobytes() + np.diff(dealt.least[a:z], prepend=0).tobytes()))
    chunk = table.column("chunk")[0].as_py()
    return pa.table([pa.array([chunk] * len(out), pa.int32()), pa.array(dealt.bucket, pa.int32()), pa.array(out, pa.binary())], schema=schema)


def _same(ids: np.ndarray, a: np.ndarray, b: np.ndarray, window: int) -> bool:
    return all(np.array_equal(ids[a + j], ids[b + j]) for j in range(window))


def _smallest(ids: np.ndarray, at: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """The smallest doc of each window's equals: by sorting hashes of exact word numbers, equals then compared word by word."""
    key = _weighted(ids, window)[at]
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])
    again = np.flatnonzero(~new)
    if not _same(ids, at[order[again]], at[order[again - 1]], window):  # two sequences with one hash: sort the words themselves
        order = np.lexsort([ids[at + j] for j in range(window)])
        new = np.append(True, np.any([ids[at[order[1:]] + j] != ids[at[order[:-1]] + j] for j in range(window)], axis=0))
    first = np.flatnonzero(new)
    out = np.empty(len(at), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(order))))
    return out


class _Bucket:
    """The blocks of one bucket: each string once, and for each block which strings it has with their smallest doc_ids."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.windows: list[np.ndarray] = []
        self.blocks: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, chunk: int, payload: bytes) -> None:
        raw = zstandard.ZstdDecompressor().decompress(payload)
        size, strings = struct.unpack_from("<2q", raw)
        before = len(self.number)
        which = np.fromiter((self.number.setdefault(x, len(self.number)) for x in raw[16 : 16 + size].split(b"\n")), np.int64, strings)
        windows = np.frombuffer(raw, np.uint32, strings, 16 + size).astype(np.int64)
        self.windows.append(windows[which >= before])  # a block's strings differ, so new ones come in order
        self.blocks.append((chunk, which.astype(np.int32), np.cumsum(np.frombuffer(raw, np.int64, strings, 16 + size + 4 * strings))))

    def answers(self, window: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """For each block with windows that start in a smaller doc_id: chunk, strings (numbered in the block), first windows, ends."""
        windows = np.concatenate(self.windows)
        low = np.full(len(windows), NO_ID)
        for _, which, least in self.blocks:
            np.minimum.at(low, which, least)
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        ids = np.concatenate([np.fromiter(map(number.__getitem__, x.split()), np.uint64) for x in self.number])
        begin = np.cumsum(windows + window - 1) - (windows + window - 1)
        step = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        found = _smallest(ids, np.repeat(begin, windows) + step, np.repeat(low, windows), window)
        first = np.cumsum(windows) - windows
        smallest = np.minimum.reduceat(found, first)
        for chunk, which, least in self.blocks:
            hit = np.flatnonzero(smallest[which] < least)
            if not len(hit):
                continue
            n = windows[which[hit]]
            string, at = np.repeat(hit, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            gone = found[np.repeat(first[which[hit]], n) + at] < least[string]
            string, at = string[gone], at[gone]
            head = np.append(True, (string[1:] != string[:-1]) | (at[1:] != at[:-1] + 1))
            tail = np.append(head[1:], True)
            yield chunk, string[head].astype(np.int32).tobytes(), at[head].astype(np.int32).tobytes(), (at[tail] + window).astype(np.int32).tobytes()


def _bucketed(window: int):
    """Blocks arrive sorted by bucket; one bucket is held at a time."""

    def answer(held: _Bucket, bucket: int) -> Iterator[pa.RecordBatch]:
        got = list(held.answers(window))
        if got:
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*got), kinds)]
            yield pa.RecordBatch.from_arrays([columns[0], pa.array([bucket] * len(got), pa.int32()), *columns[1:]], names=["chunk", "bucket", "strings", "starts", "ends"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, _Bucket()
        for b in batches:
            for chunk, bucket, payload in zip(*(c.to_pylist() for c in b.columns)):
                if bucket != now and held.blocks:
                    yield from answer(held, now)
                    held = _Bucket()
                now = bucket
                held.add(chunk, payload)
        if held.blocks:
            yield from answer(held, now)

    return run


def _spans(dealt: _Dealt, answers: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, first words, ends) to remove from a chunk's texts."""
    if not dealt.strings:
        return (np.zeros(0, np.int64),) * 3
    later = np.flatnonzero(dealt.doc > dealt.least[dealt.string])  # another document here has all of it
    rows, starts, ends = [dealt.row[later]], [dealt.at[later]], [dealt.at[later] + dealt.count[later] + window - 1]
    if answers.num_rows:
        base = dict(zip(dealt.bucket.tolist(), dealt.first))
        columns = [[np.frombuffer(x, np.int32).astype(np.int64) for x in answers.column(c).to_pylist()] for c in ("strings", "starts", "ends")]
        string = np.concatenate([x + base[b] for x, b in zip(columns[0], answers.column("bucket").to_pylist())])
        begin, end = np.concatenate(columns[1]), np.concatenate(columns[2])
        by = np.argsort(string, kind="stable")
        string, begin, end = string[by], begin[by], end[by]
        own = np.flatnonzero(dealt.doc == dealt.least[dealt.string])
        low, high = np.searchsorted(string, dealt.string[own]), np.searchsorted(string, dealt.string[own], "right")
        n = high - low
        place, run = np.repeat(own, n), np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows.append(dealt.row[place])
        starts.append(dealt.at[place] + begin[run])
        ends.append(dealt.at[place] + end[run])
    rows, starts, ends = (np.concatenate(x) for x in (rows, starts, ends))
    by = np.argsort(rows, kind="stable")
    return rows[by], starts[by], ends[by]


def _cut(text: bytes, gone: np.ndarray, words: list[bytes]) -> tuple[bytes, bytes]:
    """The text without the words gone (white space inside kept stretches stays), and the kept words joined by one space."""
    keep = np.flatnonzero(~gone)
    kept = b" ".join([words[i] for i in keep.tolist()])
    begin, pos = np.empty(len(words), np.int64), 0
    for i, w in enumerate(words):
        pos = text.index(w, pos)
        begin[i] = pos
        pos += len(w)
    heads = np.flatnonzero(np.diff(keep, prepend=-2) != 1)
    tails = np.append(heads[1:] - 1, len(keep) - 1)
    pieces = [text[begin[keep[h]] : begin[keep[t]] + len(words[keep[t]])] for h, t in zip(heads, tails)] if len(keep) else []
    return b" ".join(pieces), kept


def _finish(columns: list[str], texts_too: bool, window: int, buckets: int, heavy: np.ndarray):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        order, ids, texts = _sorted_rows(docs.column("doc_id"), docs.column("text"))
        rows, starts, ends = _spans(_Dealt(ids, texts, window, buckets, heavy), answers, window)
        low, high = np.searchsorted(rows, np.arange(len(texts))), np.searchsorted(rows, np.arange(len(texts)), "right")
        n_words, n_removed, digest, out = [], [], [], []
        for i, text in enumerate(texts):
            words = text.split()
            n_words.append(len(words))
            if low[i] == high[i]:
                kept, gone = b" ".join(words), 0
                out.append(text)
            else:
                edge = np.zeros(len(words) + 1, np.int32)
                np.add.at(edge, starts[low[i] : high[i]], 1)
                np.add.at(edge, ends[low[i] : high[i]], -1)
                mask = np.cumsum(edge[:-1]) > 0
                gone = int(mask.sum())
                if texts_too:
                    clean, kept = _cut(text, mask, words)
                    out.append(clean)
                else:
                    kept = b" ".join([words[k] for k in np.flatnonzero(~mask).tolist()])
            n_removed.append(gone)
            digest.append(hashlib.sha256(kept).hexdigest())
        given = docs.take(pa.array(order))
        cols = {c: given.column(c) for c in columns if c != "text"}
        if texts_too:
            null = given.column("text").is_null().to_pylist()
            cols["text"] = pa.array([None if z else x.decode() for z, x in zip(null, out)], pa.string())
        cols |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        return pa.table(cols)

    return run


def substring_dedup(docs: DataFrame, window: int = 13, texts: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, ...) with every word removed that a window covers which also starts in a document with a smaller doc_id.

    Returns the columns of ``docs`` (``text`` cleaned; without it if ``texts`` is false) and n_words, n_removed and
    kept_sha256 (of the kept words joined by one space). Windows are judged on the input, not on what is left.
    """
    docs = without(docs, ADDED)
    names = [c for c in docs.columns if texts or c != "text"]
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = [F.struct(*[F.col(f"`{c}`") for c in more]).alias("row")] if more else []  # passes on as it is, whatever its names
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row)
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    size = size or 0
    chunks, buckets = size // CHUNK_BYTES + 1, size // BUCKET_BYTES + 1
    heavy = _heavy(docs, window, buckets, rows) if buckets > 1 else np.zeros(0, np.uint64)
    dealt = docs.withColumn("chunk", chunk_of("doc_id", chunks))
    # the same grouping as below, so that texts are shuffled once
    blocks = dealt.groupBy("chunk").applyInArrow(lambda t: _blocks(t, window, buckets, heavy), "chunk int, bucket int, payload binary")
    answers = blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_bucketed(window), "chunk int, bucket int, strings binary, starts binary, ends binary")
    order = [c for c in docs.columns if c != "text"] + ["text"] * texts
    schema = T.StructType([docs.schema[c] for c in order] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    out = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_finish(order, texts, window, buckets, heavy), schema)
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col("row").getField(c).alias(c) for c in names], *ADDED)
