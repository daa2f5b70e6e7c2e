"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of documents with a target share of the tokens (by default its share of the corpus). Virtual
time cuts the queues into slices that hold each queue's share of ``SLICE`` tokens; a slice is scheduled by one task from
lengths alone. In it, round after round, a queue's deficit grows by its share of a window and documents are served while
the deficit covers them, so windows follow the target proportions and no document waits longer than its length. A queue
may be served ahead by a fixed part of a document, drawn from a hash of its name, so that the many sources of a document
or two don't all fall due in one round. A slice starts with the deficits the slice before it leaves: what a queue was due
by then less what it was served, which follows from virtual time, so slices need no order of execution. The served stream
is cut at every ``length`` tokens: documents are cut at window borders only, no window is padded, and the last, incomplete
window falls into sequences of powers of two.

Shuffles: lengths (a few bytes a document) to prefix sums and slices; compressed ids once, to meet their places. Every
source has a queue of its own, however many there are: shares are a table that meets the prefix sums, and a slice's task
gets those of its own queues. Queues are only counted and cut by prefix sums, so a source with a third of all rows is no
larger task than others.

Defined cases: null and empty texts are their end id alone; a null source is a queue of its own; repeated rows are packed
each; an empty table gives an empty result; only doc_id, text and source are read, so extra columns don't matter. A table
without ``source`` is one queue.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import save
from .tokens import words

LENGTH = 4096
SLICE = 1 << 22  # tokens of a slice
ROWS = 256
NONE = "null:"


def _encode(path: str, end: int):
    """(doc_id, text, source) -> (row, part, doc_id, source, n, ids); row numbers rise with the rows of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, at = words(path, end), TaskContext.get().partitionId(), 0
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                own = b.slice(k, ROWS)
                ids = known.texts(own.column("text").cast(pa.binary()).to_pylist())
                rows = np.arange(at, at + len(ids), dtype=np.int64) + (part << 33)
                at += len(ids)
                n = np.array([len(x) // known.kind.itemsize for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), pa.array([part] * len(ids), pa.int32()), own.column("doc_id"), own.column("source"), pa.array(n), pa.array([press.compress(x) for x in ids], pa.binary())],
                    names=["row", "part", "doc_id", "source", "n", "ids"],
                )

    return run


def serve(queues: dict[str, deque], due: dict[str, float], share: dict[str, float], length: int, ahead: dict[str, float] | None = None) -> Iterator[int]:
    """Deficit round-robin: yields the rows of the queues of (row, n) in the order served.

    A row's round is the first whose deficit covers it, so that rounds without a row cost nothing. ``ahead``: the part of
    a row's n that its queue may owe.
    """
    rows, rounds = [], []
    for q, queue in queues.items():
        own, n = zip(*queue)
        n = np.array(n, np.float64)
        needs = np.cumsum(n) - n * (ahead or {}).get(q, 0.0) - due[q]
        rows.extend(own)
        rounds.append(np.maximum(1, np.ceil(needs / (share[q] * length))))
    for k in np.argsort(np.concatenate(rounds), kind="stable").tolist() if rounds else []:
        yield rows[k]


def _turns(length: int) -> int:
    """Rounds of a slice."""
    return max(1, SLICE // length)


def _schedule(length: int):
    """(slice, queue, row, n, start, share, phase) of a slice -> (row, slice, place): tokens of the slice before the row."""
    tokens = float(_turns(length) * length)

    def run(table: pa.Table) -> pa.Table:
        piece = table.column("slice")[0].as_py()
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("queue", "start", "row", "n", "share", "phase"))))
        queues: dict[str, deque] = {}
        due: dict[str, float] = {}
        share: dict[str, float] = {}
        ahead: dict[str, float] = {}
        size = {}
        for q, start, row, n, part, phase in rows:
            if q not in queues:
                queues[q] = deque()
                due[q], share[q], ahead[q] = piece * part * tokens - start, part, 1 - phase
            queues[q].append((row, n))
            size[row] = n
        order = list(serve(queues, due, share, length, ahead))
        n = np.array([size[r] for r in order], np.int64)
        return pa.table([pa.array(order, pa.int64()), pa.array([piece] * len(order), pa.int64()), pa.array(np.cumsum(n) - n)], names=["row", "slice", "place"])

    return run


def _shares(sizes: DataFrame, total: int, targets: dict[str, float] | None) -> DataFrame:
    """(queue, n) of every queue -> (queue, share, phase, last): shares add up to 1, phases are spread over 0 to 1; last: weight 0."""
    if any(not x >= 0 for x in (targets or {}).values()):
        raise ValueError("a target is a weight of 0 or more")
    own = F.col("n") / F.lit(float(total))
    if targets:
        named = sizes.withColumn("name", F.expr("substr(queue, instr(queue, ':') + 1)"))
        given = sizes.sparkSession.createDataFrame([(q, float(x)) for q, x in targets.items()], "name string, weight double")
        sizes, own = named.join(given, "name", "left"), F.coalesce(F.col("weight"), own)
    scale = sizes.agg(F.sum(own)).first()[0] or 1.0
    phase = F.pmod(F.xxhash64("queue"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return sizes.select("queue", F.when(own > 0, own / F.lit(scale)).otherwise(1.0).alias("share"), phase.alias("phase"), (own <= 0).alias("last"))


def cuts(total: int, length: int) -> list[int]:
    """Where the sequences after the last whole window begin: powers of two, the largest first."""
    at, out = total - total % length, []
    for bit in range(length.bit_length() - 1, -1, -1):
        if (total % length) >> bit & 1:
            out.append(at)
            at += 1 << bit
    return out


def _pieces(path: str, end: int, length: int, total: int):
    tail = cuts(total, length)
    whole = total // length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = words(path, end).kind
        back = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for doc, source, place, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "source", "place", "ids"))):
                ids = np.frombuffer(back.decompress(raw), kind).astype("<u4")
                at = 0
                while at < len(ids):
                    g = place + at
                    if g < whole * length:
                        seq, begin, stop = g // length, g // length * length, (g // length + 1) * length
                    else:
                        k = int(np.searchsorted(tail, g, "right")) - 1
                        seq, begin, stop = whole + k, tail[k], (tail[k + 1] if k + 1 < len(tail) else total)
                    size = min(len(ids) - at, stop - g)
                    out.append((doc, at, size, zlib.crc32(ids[at : at + size].tobytes()), len(ids), seq, g - begin, source))
                    at += size
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
            kinds = [pa.int64()] * 7 + [pa.string()]
            cols = zip(*out) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=names)

    return run


def pack(docs: DataFrame, path: str, end: int, length: int = LENGTH, targets: dict[str, float] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source) -> pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    ``targets``: weights by source; sources without one keep their share of the corpus. A weight is relative to the others;
    documents of a source of weight 0 come after all others, a weight below 0 is an error. Of documents due at one place,
    the queue's name and then the row decide.
    """
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), source.alias("source"))
    coded = save(given.mapInArrow(_encode(path, end), "row long, part int, doc_id long, source string, n long, ids binary"), "token-ids")
    named = F.coalesce(F.concat(F.lit("source:"), F.col("source")), F.lit(NONE))
    sizes = save(coded.select(named.alias("queue"), "n").groupBy("queue").agg(F.sum("n").alias("n")), "queue-totals")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    if not total:
        return coded.mapInArrow(_pieces(path, end, length, 0), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string")
    lengths = coded.select("row", "part", named.alias("queue"), "n")
    shares = save(_shares(sizes, total, targets), "queue-shares")
    tokens = float(_turns(length) * length)
    # sources of weight 0 come after the last slice of the others
    end_of_others = shares.where("NOT last").join(sizes, "queue").agg(F.max(F.col("n") / F.col("share"))).first()[0] or 0
    after = int(end_of_others // tokens) + 2
    parts = lengths.groupBy("queue", "part").agg(F.sum("n").alias("sum"))
    base = parts.withColumn("base", F.sum("sum").over(W.partitionBy("queue").orderBy("part")) - F.col("sum")).drop("sum").join(shares, "queue")
    inside = F.sum("n").over(W.partitionBy("queue", "part").orderBy("row")) - F.col("n")
    starts = lengths.withColumn("inside", inside).join(base, ["queue", "part"]).withColumn("start", F.col("base") + F.col("inside"))
    turn = F.floor((F.col("start") + F.col("phase") * F.col("n")) / (F.col("share") * F.lit(float(length))))
    sliced = starts.withColumn("slice", F.floor(turn / F.lit(float(_turns(length)))) + F.when(F.col("last"), after).otherwise(0))
    order = save(sliced.select("slice", "queue", "row", "n", "start", "share", "phase").groupBy("slice").applyInArrow(_schedule(length), "row long, slice long, place long"), "schedule")
    in_slice = sliced.groupBy("slice").agg(F.sum("n").alias("tokens"))
    # a row a slice, so of 4 million tokens: small enough for one task at any size
    before = in_slice.withColumn("before", F.sum("tokens").over(W.orderBy("slice")) - F.col("tokens")).drop("tokens")
    places = order.join(before, "slice").select("row", (F.col("before") + F.col("place")).alias("place"))
    placed = coded.select("row", "doc_id", "source", "ids").join(places, "row")
    return placed.mapInArrow(_pieces(path, end, length, total), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string")
