"""Spelling variants by Bloom-guided neighbourhoods.

Words consist of code points up to U+00FF, so a word is a row of bytes. The vocabulary's words are put into Bloom filters
sharded by length and blocked: 256 bits in eight lanes, in each of which a word has one bit, so a probe touches one block.
The shards are broadcast. Numpy makes all edits of the words of one length at a time, as sums of character times place:
every deletion, and every replacement by a greater character of the vocabulary's alphabet. An insertion is the deletion
seen from the longer word, and a replacement by a smaller character that of a greater one seen from the other word, so
each near pair is met once. Lanes are looked at one after the other, each by what the lanes before let pass. Only what
passes all eight is written out as a string and shuffled to an exact join with the vocabulary, which removes the false
positives. A word has as many neighbours as it has edits at most, so no key is hot.

The filters take ``BITS`` bits a word; their size is known from the count of the vocabulary before they are made. Beyond
``FILTER_BYTES`` they are made and broadcast in pieces by the words' hash, and each piece is probed by all edits that hash
into it: more passes over the vocabulary, the same pairs.

A form has at least ``RATIO`` times the occurrences of its word, so chains of forms are short, and roots are found by
pointer jumping in about log2 of their length rounds.

Defined cases: null and empty texts have no words; a null ``doc_id`` counts as an empty one; repeated rows count each;
an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, save

RUN = r"[A-Za-zÀ-ÿ]+"
EVERY, LENGTH, LEAST, RATIO = 199, 6, 5, 5  # a slip each so many; shortest and rarest word; how much more frequent a form is
BITS = 20  # of a filter, a word
FILTER_BYTES = 64 << 20
PROBES = 1 << 21  # edits looked at together
LANES = 8

_SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)
_PLACES = np.random.default_rng(12).integers(1, 1 << 62, 1 << 12, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _place(n: int) -> np.ndarray:
    """Odd factors of the places of a word; words longer than the table go through it again with other factors."""
    turns = -(-n // len(_PLACES))
    return np.concatenate([_PLACES * np.uint64(2 * k + 1) for k in range(turns)])[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def _hash(codes: np.ndarray) -> np.ndarray:
    """Hashes of equally long words, one a row."""
    return (codes.astype(np.uint64) * _place(codes.shape[1])).sum(1, dtype=np.uint64)


def _bit(h: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << ((h.astype(np.uint32) * _SALTS[lane]) >> np.uint32(27))


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, words as rows of bytes)."""
    by: dict[int, list[bytes]] = {}
    for w in words:
        by.setdefault(len(w), []).append(w.encode("latin-1"))
    for n, own in sorted(by.items()):
        yield n, np.frombuffer(b"".join(own), np.uint8).reshape(-1, n)


def _bits(shards: dict[int, int], pieces: int):
    """(piece, length, block, eight lanes) of each word, equal blocks of a batch combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, codes in _by_length(b.column(0).to_pylist()):
                h = _mixed(_hash(codes))
                key = (h % np.uint64(pieces)).astype(np.int64) * (1 << 40) + _block(h, shards[n])
                where, at = np.unique(key, return_inverse=True)
                lanes = np.zeros((LANES, len(where)), np.uint32)
                for k in range(LANES):
                    np.bitwise_or.at(lanes[k], at, _bit(h, k))
                yield pa.RecordBatch.from_arrays([pa.array(where >> 40), pa.array(np.full(len(where), n, np.int64)), pa.array(where & ((1 << 40) - 1)), *[pa.array(x.astype(np.int64)) for x in lanes]], names=["piece", "length", "block", *[f"lane{k}" for k in range(LANES)]])

    return run


def _filters(bits: DataFrame, shards: dict[int, int]) -> dict[int, np.ndarray]:
    """length -> lanes of all blocks; as many bytes as were allowed."""
    table = bits.toArrow()
    lengths, blocks = table.column("length").to_numpy(), table.column("block").to_numpy()
    out = {}
    for n in np.unique(lengths).tolist():
        own = lengths == n
        out[n] = np.zeros((LANES, shards[n]), np.uint32)
        for k in range(LANES):
            out[n][k, blocks[own]] = table.column(f"lane{k}").to_numpy()[own].astype(np.uint32)
    return out


def _passed(h: np.ndarray, shard: np.ndarray | None, piece: int, pieces: int) -> np.ndarray:
    """Which hashes may be in the vocabulary."""
    if shard is None:
        return np.zeros(0, np.int64)
    h = _mixed(h)
    at = np.arange(len(h)) if pieces == 1 else np.flatnonzero(h % np.uint64(pieces) == np.uint64(piece))
    h = h[at]
    block = _block(h, shard.shape[1])
    for k in range(LANES):
        bit = _bit(h, k)
        keep = np.flatnonzero(shard[k, block] & bit)
        at, h, block = at[keep], h[keep], block[keep]
    return at


def _edits(filters: Broadcast, alphabet: Broadcast, piece: int, pieces: int):
    """(word, near): edits of each word that the filters let pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, codes in _by_length(b.column(0).to_pylist()):
                step = max(1, PROBES // (n * (len(alphabet.value) + 1)))
                for k in range(0, len(codes), step):
                    yield from near(codes[k : k + step], n)

    def rows(codes: np.ndarray, changed: np.ndarray, which: np.ndarray) -> pa.RecordBatch:
        text = lambda m: pa.array([x.tobytes().decode("latin-1") for x in m], pa.string())
        return pa.RecordBatch.from_arrays([text(codes[which]), text(changed)], names=["word", "near"])

    def near(codes: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
        place, wide = _place(n), codes.astype(np.uint64)
        head = np.cumsum(wide * place, 1, dtype=np.uint64)
        if filters.value.get(n - 1) is not None:
            moved = np.zeros_like(wide)
            moved[:, 1:] = wide[:, 1:] * place[: n - 1]
            tail = np.cumsum(moved[:, ::-1], 1, dtype=np.uint64)[:, ::-1]  # of the characters from a place on, each one place earlier
            h = np.zeros_like(wide)
            h[:, 1:] += head[:, :-1]
            h[:, :-1] += tail[:, 1:]
            first = np.ones(codes.shape, bool)
            first[:, 1:] = codes[:, 1:] != codes[:, :-1]  # of a run of one character any deletion gives the same
            which, at = np.nonzero(first)
            good = _passed(h[first], filters.value[n - 1], piece, pieces)
            which, at = which[good], at[good]
            if len(which):
                left = np.arange(n - 1) + (np.arange(n - 1) >= at[:, None])
                yield rows(codes, np.take_along_axis(codes[which], left, 1), which)
        letters = alphabet.value
        h = (head[:, -1, None, None] + (letters.astype(np.uint64) - wide[:, :, None]) * place[None, :, None]).reshape(-1)
        more = np.flatnonzero((letters > codes[:, :, None]).reshape(-1))
        good = more[_passed(h[more], filters.value.get(n), piece, pieces)]
        if len(good):
            which, at, letter = np.unravel_index(good, (len(codes), n, len(letters)))
            changed = codes[which].copy()
            changed[np.arange(len(which)), at] = letters[letter]
            yield rows(codes, changed, which)

    return run


def vocabulary(docs: DataFrame, every: int = EVERY, length: int = LENGTH, least: int = LEAST) -> DataFrame:
    """(word, n): words of ``length`` code points found ``least`` times, each ``every``-th run by its hash with one code point deleted. Counts are combined before they are shuffled."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= length)
    lower = runs.select("doc_id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    hashed = lower.withColumn("h", F.crc32(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"), "UTF-8")))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % every == 0, slipped).otherwise(F.col("run")).alias("word")).where(F.length("word") >= length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def near_pairs(words: DataFrame) -> DataFrame:
    """words (word, n) -> (word, near): pairs one inserted, deleted or replaced code point apart, each once."""
    spark, context = words.sparkSession, words.sparkSession.sparkContext
    sizes = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a length
    pieces = max(1, -(-sum(sizes.values()) * BITS // 8 // FILTER_BYTES))
    shards = {n: max(1, -(-m * BITS // (256 * pieces))) for n, m in sizes.items()}
    only = words.select("word")
    letters = only.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().where("c <> ''").collect()  # at most 256
    alphabet = context.broadcast(np.array(sorted(ord(r.c) for r in letters), np.uint8))
    lanes = [f"lane{k}" for k in range(LANES)]
    made = only.mapInArrow(_bits(shards, pieces), "piece long, length long, block long, " + ", ".join(f"{x} long" for x in lanes))
    bits = save(made.groupBy("piece", "length", "block").agg(*[F.bit_or(x).alias(x) for x in lanes]), "filters", by=["piece"] if pieces > 1 else None)
    found = None
    for piece in range(pieces):
        filters = context.broadcast(_filters(bits.where(F.col("piece") == piece), shards))
        probed = only.repartition(max(spark.sparkContext.defaultParallelism, sum(sizes.values()) // 20_000)).mapInArrow(_edits(filters, alphabet, piece, pieces), "word string, near string")
        exact = probed.join(only.withColumnRenamed("word", "near"), "near").select("word", "near")
        found = exact if found is None else found.unionByName(exact)
    return found


def spelling_variants(docs: DataFrame, every: int = EVERY, length: int = LENGTH, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """docs (doc_id, text) -> word, form, root, n, n_near, form_n.

    Near words differ by one inserted, deleted or replaced code point. A word's form is the most frequent near word (ties:
    the smallest), if it has ``ratio`` times the word's occurrences; its root is reached by following forms to the last.
    """
    words = save(vocabulary(docs, every, length, least), "vocabulary")
    pairs = save(near_pairs(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))
    rated = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
    best = rated.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    facts = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.m") >= ratio * F.col("n"), F.col("best.near")).alias("form"), F.when(-F.col("best.m") >= ratio * F.col("n"), -F.col("best.m")).alias("form_n"))
    facts = save(facts, "word-forms")
    steps = save(facts.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "word-roots")
    while True:  # a root that has a form itself is no root yet
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(ahead, "root", "left")
        if moved.where("further IS NOT NULL").isEmpty():
            break
        old, steps = steps, save(moved.select("word", F.coalesce("further", "root").alias("root")), "word-roots")
        discard(old)
    return facts.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
