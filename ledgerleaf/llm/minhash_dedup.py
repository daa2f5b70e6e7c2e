"""MinHash near-dedup with an LSH forest.

A document is its set of distinct word shingles (64-bit hashes of lower-cased words). Documents with one set are one node.
A signature of 128 minima is read in 32 orders, each starting at another value. The forest is these orders sorted: a
region is a run of nodes with a common prefix of ``ROOT`` values, dealt whole to one task, which gets its nodes sorted by
the next ``TAIL`` values and takes the longest common prefix of each with the one before it. A region of up to ``SMALL``
nodes gives all its pairs as candidates. A larger one gives each node with the neighbour of the longer common prefix and
with the region's first node, and falls into the regions of the next depth at which its common prefixes part, of which
those that are still large are treated alike: depth adapts to each region, value by value. Regions of more than ``LIMIT`` nodes, found by counting with partial aggregates,
are not dealt: their nodes pair with the first one and are dealt anew by a longer root. Candidates whose set sizes allow
the similarity are confirmed on the full sets.

Large regions that share members form a family. Members of a family that the confirmed links don't join to its largest
component are compared completely, in blocks: a task holds the sets of one block of them and one block of the family and
gives one link for each two components it finds linked, never a list of pairs.

So the result is exact for all pairs that share a region in some order, which a pair of similarity 0.8 misses with
probability (1 - 0.8^4)^32 < 1e-7. No cap drops candidates. A group of copies or near copies that a third of the rows form
costs a number of pairs linear in its size.

Shuffles: region numbers (8 bytes, 32 a node) to be counted; nodes with their tails (32 bytes, 32 a node) once; full sets
only of documents in candidate pairs: once to meet their pairs, then once for each pair, beside the pair's end of more
pairs, whose own set comes once for ``TOGETHER`` of them. So a first node of a large region moves its set rarely.

Defined cases: null, empty and blank texts have no shingles and link with nothing; texts shorter than a shingle are one
shingle; rows with one doc_id are one document, linked by any of its texts; a null doc_id links with nothing and has a
null component; an empty table gives an empty result; input columns named like an added column give way to it, other
names don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save, small_batches, unused, without
from .components import components
from .substring_dedup import _mix, _weighted

SHINGLE = 4
PERCENT = 80
SIZE = 128  # values of a signature
TREES = 32
ROOTS, TAIL = (4, 16, 28), 12  # values that make a region, first and for regions over the limit; values it is sorted by
LIMIT = 4096  # nodes of a region that one task sorts
BLOCK = 1 << 19  # shingles of a block of a family
FEW = 500_000  # ids that a broadcast may hold (4 MB)
TOGETHER = 500  # pairs of one node that are confirmed together
SMALL = 24  # members of a region that is paired completely
ADDED = ["n_shingles", "component_id", "kept"]

_RANDOM = np.random.default_rng(20240917)
_A = _RANDOM.integers(1, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, SIZE, dtype=np.uint64)


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted set of shingle hashes."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.unique(_mix(_weighted(hashes, min(width, len(words))) + np.uint64(min(width, len(words)))))


def signature(values: np.ndarray) -> np.ndarray:
    """The least value under each of the random functions."""
    least = np.full(SIZE, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 1024):
        least = np.minimum(least, (values[at : at + 1024, None] * _A + _B).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, sizes, signs = [], [], []
            for t in b.column("text").cast(pa.binary()).to_pylist():
                s = shingles(t, width)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "n", "digest", "sign"])

    return run


def _orders(root: int):
    """(node, n, sign[, trees]) -> (region, tail, node, n, tree): the hashed first ``root`` values in each order, and the next values as bytes that sort like them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sign = np.frombuffer(b"".join(b.column("sign").to_pylist()), np.uint32).reshape(-1, SIZE)
            wide, step = sign.astype(np.uint64), SIZE // TREES
            regions = np.empty((len(sign), TREES), np.uint64)
            tails = np.empty((len(sign), TREES, TAIL), np.uint8)
            for t in range(TREES):
                h = np.full(len(sign), t + 1, np.uint64)
                for j in range(root):
                    h = _mix(h ^ (wide[:, (t * step + j) % SIZE] + np.uint64(0x9E3779B97F4A7C15)))
                regions[:, t] = h
                tails[:, t] = sign[:, (t * step + root + np.arange(TAIL)) % SIZE] & np.uint32(0xFF)
            tree = np.tile(np.arange(TREES, dtype=np.int32), len(sign))
            keep = np.ones(len(tree), bool)
            if "trees" in b.schema.names:
                keep = (np.repeat(b.column("trees").to_numpy(zero_copy_only=False), TREES) >> tree) & 1 == 1
            node, n = (np.repeat(b.column(c).to_numpy(zero_copy_only=False), TREES)[keep] for c in ("node", "n"))
            n = n.astype(np.int32)
            raw = np.ascontiguousarray(tails.reshape(-1, TAIL)[keep])
            tail = pa.FixedSizeBinaryArray.from_buffers(pa.binary(TAIL), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(regions.ravel()[keep].view(np.int64)), tail, pa.array(node), pa.array(n), pa.array(tree[keep])], names=["region", "tail", "node", "n", "tree"])

    return run


def prefixes(region: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Of sorted rows, how many values of its tail each has in common with the row before it; -1 where a region begins."""
    same = np.cumprod(tail[1:] == tail[:-1], axis=1).sum(axis=1)
    return np.append(-1, np.where(region[1:] == region[:-1], same, -1))[: len(region)]


def candidates(node: np.ndarray, common: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of candidate pairs (i, j), and of the members of large regions with the place of the region's first node."""
    heads = np.flatnonzero(common < 0)
    size = np.diff(np.append(heads, len(common)))
    small = np.repeat(size <= few, size)
    number = np.cumsum(common < 0)
    left, right, member, first = [], [], [], []

    def whole(number: np.ndarray, at: np.ndarray) -> None:
        """All pairs of rows that stand in runs of one number."""
        for k in range(1, few):
            i = np.flatnonzero(number[k:] == number[:-k])
            if not len(i):
                break
            left.append(at[i])
            right.append(at[i + k])

    rows = np.flatnonzero(small)
    whole(number[rows], rows)
    runs = [(a, a + n, True) for a, n in zip(heads[size > few].tolist(), size[size > few].tolist())]
    while runs:
        a, z, region = runs.pop()
        at = np.arange(a, z)
        hub = a + int(node[a:z].argmin())
        own = np.append(common[a + 1 : z], -1)
        before = np.append(-1, own[:-1]) >= own  # whose common prefix is the longer one
        left.extend((at, at))
        right.extend((np.full(z - a, hub), np.where(before, at - 1, at + 1)))
        if region:  # its parts are in the same family
            member.append(at)
            first.append(np.full(z - a, hub))
        depth = int(common[a + 1 : z].min())
        if depth < TAIL:
            cut = [a, *(np.flatnonzero(common[a + 1 : z] == depth) + a + 1).tolist(), z]
            runs.extend((x, y, False) for x, y in zip(cut, cut[1:]) if y - x > few)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(left), join(right), join(member), join(first)


def _neighbours(percent: int, few: int):
    """Rows sorted by region and tail -> (a, b, kind): candidates (0) and members of large regions with their first node (1). One region is held beyond a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def found(region, tail, node, n):
            i, j, member, first = candidates(node, prefixes(region, tail), few)
            fits = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (node[i] != node[j])
            x, y = node[i[fits]], node[j[fits]]
            pair = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
            in_family = np.unique(np.stack([node[member], node[first]], axis=1), axis=0)
            a, b = np.append(pair[:, 0], in_family[:, 0]), np.append(pair[:, 1], in_family[:, 1])
            kind = np.append(np.zeros(len(pair), np.int8), np.ones(len(in_family), np.int8))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(kind)], names=["a", "b", "kind"])

        for b in batches:
            if not b.num_rows:
                continue
            tail = np.frombuffer(b"".join(b.column("tail").to_pylist()), np.uint8).reshape(-1, TAIL)
            own = [b.column("region").to_numpy(), tail, b.column("node").to_numpy(), b.column("n").to_numpy().astype(np.int64)]
            if held is not None:
                own = [np.concatenate(p) for p in zip(held, own)]
            begin = int(np.searchsorted(own[0], own[0][-1]))  # the last region may go on
            held = [x[begin:] for x in own]
            if begin:
                yield found(*(x[:begin] for x in own))
        if held is not None:
            yield found(*held)

    return run


def _asked(pairs: DataFrame) -> DataFrame:
    """(node, key, part, first): which sets meet where. A pair is looked at beside its end of more pairs, the key; a key of very many pairs has parts of ``TOGETHER``, each with its set once (first)."""
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("pairs"))
    many = save(degree.where(F.col("pairs") > TOGETHER), "hubs")
    if many.count() <= FEW:  # ids and counts of at most 2 / TOGETHER of the pairs' ends; beyond that both sides are dealt
        many = F.broadcast(many)
    found = pairs.join(many.select(F.col("node").alias("a"), F.col("pairs").alias("na")), "a", "left").join(many.select(F.col("node").alias("b"), F.col("pairs").alias("nb")), "b", "left")
    second = F.coalesce("nb", F.lit(0)) > F.coalesce("na", F.lit(0))
    turned = found.select(F.when(second, F.col("b")).otherwise(F.col("a")).alias("key"), F.when(second, F.col("a")).otherwise(F.col("b")).alias("node"), F.coalesce(F.greatest("na", "nb"), F.lit(0)).alias("n"))
    parts = F.floor(F.col("n") / TOGETHER) + 1
    dealt = save(turned.select("key", "node", F.when(F.col("n") > 0, F.pmod(F.xxhash64("node"), parts)).otherwise(0).cast("int").alias("part")), "pairs-dealt")
    keys = dealt.select(F.col("key").alias("node"), "key", "part").distinct().withColumn("first", F.lit(0).cast("byte"))
    return dealt.select("node", "key", "part", F.lit(1).cast("byte").alias("first")).unionByName(keys)


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough on full sets. A set moves once for each pair in which it isn't the key, and once for each part of a key; a part is read as a stream that holds the key's set alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, before = None, [], 1  # a doc_id of several texts has several sets
        for b in batches:
            out = []
            for k, node, first, x in zip(b.column("key").to_pylist(), b.column("node").to_pylist(), b.column("first").to_pylist(), b.column("set").to_pylist()):
                x = np.frombuffer(x, np.uint64)
                if first == 0:
                    key, own = k, [*(own if before == 0 and k == key else ()), x]
                elif k == key:
                    both = [np.intersect1d(y, x, assume_unique=True).size for y in own]
                    if any(100 * n >= percent * (len(y) + len(x) - n) for n, y in zip(both, own)):
                        out.append((min(k, node), max(k, node)))
                before = first
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    asked = _asked(pairs)
    met = asked.join(_sets(texts, pairs, width), "node").repartition("key", "part").sortWithinPartitions("key", "part", "first")
    return met.select("key", "node", "first", "set").mapInArrow(run, "a long, b long")


def _sets(texts: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(node, set) of the nodes in pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, width).tobytes() for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary())], names=["node", "set"])

    nodes = save(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "set-nodes")
    if nodes.count() <= FEW:  # ids alone, so the texts need not move; beyond that both sides are dealt
        nodes = F.broadcast(nodes)
    return texts.join(nodes, "node", "left_semi").mapInArrow(run, "node long, set binary")


def near_links(nodes: DataFrame, texts: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """nodes (node, n, sign) and their texts (node, text) -> links (u, v)."""
    spark = nodes.sparkSession
    found, open_ = [], nodes.select("node", "n", "sign")
    for root in ROOTS:
        rows = open_.mapInArrow(_orders(root), "region long, tail binary, node long, n int, tree int")
        sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("hub"))
        over = save(sizes.where(F.col("members") > LIMIT).select("region", "hub"), "large-regions")
        many = over.count()
        named = F.broadcast(over) if many <= FEW else over  # 16 bytes each; beyond that both sides are dealt
        dealt = rows.join(named, "region", "left_anti") if many else rows
        near = dealt.select("region", "tail", "node", "n").repartition("region").sortWithinPartitions("region", "tail", "node")
        found.append(save(near.mapInArrow(_neighbours(percent, SMALL), "a long, b long, kind byte"), "neighbours"))
        if not many:
            break
        members = save(rows.join(named, "region").select("node", "n", "tree", "hub"), "large-regions")
        pairs = members.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"), F.lit(0).cast("byte").alias("kind"))
        found.append(pairs.unionByName(members.select(F.col("node").alias("a"), F.col("hub").alias("b"), F.lit(1).cast("byte").alias("kind"))))
        deeper = members.groupBy("node").agg(F.expr("bit_or(shiftleft(1L, tree))").alias("trees"))
        open_ = nodes.select("node", "n", "sign").join(deeper, "node")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    pairs = save(every.where("kind = 0").select("a", "b").distinct(), "candidates")
    with small_batches(spark, 500):
        links = save(_confirm(pairs, texts, width, percent).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
        large = save(every.where("kind = 1").select(F.col("a").alias("node"), F.col("b").alias("hub")).distinct(), "large-regions")
        if large.isEmpty():
            return links
        large = large.join(nodes.select("node", "n"), "node")
        return links.unionByName(_families(large, components(links), texts, width, percent))


def _linked(percent: int):
    """One link for each two components that sets of the left and the right block link."""

    def run(table: pa.Table) -> pa.Table:
        node, part = table.column("node").to_numpy(), table.column("component").to_numpy()
        left, sets = table.column("left").to_numpy(), [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
        mine = np.flatnonzero(left)
        sizes = np.array([len(sets[i]) for i in mine], np.int64)
        out, seen = [], set()
        if len(mine):
            owner = np.repeat(np.arange(len(mine)), sizes)
            values = np.concatenate([sets[i] for i in mine])
            order = np.argsort(values, kind="stable")
            owner, (known, begin, many) = owner[order], np.unique(values[order], return_index=True, return_counts=True)
            for r in np.flatnonzero(~left):
                own = sets[r]
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                at = at[known[at] == own]
                n = many[at]
                rows = np.repeat(begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.bincount(owner[rows], minlength=len(mine))
                for k in np.flatnonzero((100 * both >= percent * (sizes + len(own) - both)) & (part[mine] != part[r])):
                    pair = (part[mine[k]], part[r])
                    if pair not in seen:
                        seen.add(pair)
                        out.append((node[mine[k]], node[r]))
        return pa.table([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["u", "v"])

    return run


def _families(large: DataFrame, joined: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components of a family that the candidates didn't show."""
    family = components(large.select(F.col("node").alias("u"), F.col("hub").alias("v"))).select(F.col("id").alias("node"), F.col("component").alias("family"))
    known = large.groupBy("node").agg(F.max("n").alias("n")).join(family, "node").join(joined.withColumnRenamed("id", "node"), "node", "left")
    known = save(known.select("node", "n", "family", F.coalesce("component", "node").alias("component")), "families")
    parts = known.groupBy("family", "component").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("size"))
    most = parts.groupBy("family").agg(F.max(F.struct("k", "component", "size")).alias("most"), F.count(F.lit(1)).alias("parts"), F.sum("size").alias("size")).where("parts > 1")
    most = most.select("family", F.col("most.component").alias("main"), F.ceil(F.col("size") / BLOCK).alias("rights"), F.ceil((F.col("size") - F.col("most.size")) / BLOCK).alias("lefts"))
    most = save(most, "families")
    if most.isEmpty():
        return known.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    open_ = known.join(most, "family")
    sets = _sets(texts, open_.select(F.col("node").alias("a"), F.col("node").alias("b")), width)
    whole = open_.join(sets, "node").withColumn("at", F.xxhash64("node"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    right = whole.select("family", every(F.col("lefts")).alias("i"), F.pmod("at", "rights").alias("j"), "node", "component", F.lit(False).alias("left"), "set")
    left = whole.where(F.col("component") != F.col("main")).select("family", F.pmod("at", "lefts").alias("i"), every(F.col("rights")).alias("j"), "node", "component", F.lit(True).alias("left"), "set")
    return save(right.unionByName(left).groupBy("family", "i", "j").applyInArrow(_linked(percent), "u long, v long"), "links")


def minhash_dedup(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_shingles, component_id (smallest doc_id reachable by links) and kept (doc_id = component_id)."""
    docs = without(docs, ADDED)
    docs = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    with small_batches(docs.sparkSession, 500):
        read = save(docs.select("doc_id", "text").mapInArrow(_describe(width), "doc_id long, n long, digest binary, sign binary"), "signatures")
    real = read.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    nodes = save(real.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sign").alias("sign")), "nodes")
    # a doc_id with several sets is one document: its sets' nodes are linked
    same = real.select("doc_id", "digest").distinct().join(nodes.select("digest", "node"), "digest").where("doc_id <> node").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    texts = docs.select(F.col("doc_id").alias("node"), "text")
    links = near_links(nodes, texts, width, percent)
    group, at, size = (unused(docs, x) for x in ("component", "id", "n"))
    part = components(links.unionByName(same)).select(F.col("id").alias(at), F.col("component").alias(group))
    facts = read.groupBy("doc_id").agg(F.max("n").alias(size)).withColumnRenamed("doc_id", at).join(part, at, "left")
    out = docs.join(facts, F.col("doc_id") == F.col(at), "left")
    found = {"n_shingles": F.coalesce(F.col(size), F.lit(0)), "component_id": F.coalesce(F.col(group), F.col("doc_id"))}
    return out.withColumns(found).withColumn("kept", F.col("doc_id") == F.col("component_id")).select(*[F.col(f"`{c}`") for c in docs.columns], *ADDED)
