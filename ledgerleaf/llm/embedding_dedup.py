"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors of cosine c or more are at a squared distance of 2 - 2c or less. After a rotation that spreads variance
evenly, the coordinates are split into blocks of about 8; at least one block then holds no more than its proportional
share of that distance. Each block is range-joined under its share: a grid on its first dimensions deals ids with the
block's coordinates, and a few more that rule out most other pairs, into cells as wide as the share's root; a cell meets
itself and its neighbours, and numpy compares tile by tile. Only rows that have a candidate in a cell send it their
vector, where the union of the candidates is confirmed with double-precision cosines; a pair that
qualifies in several blocks counts in the first of them only, so the counts add up without listing pairs.

What leaves a task is, per vector, how many vectors it links with and one edge of a spanning forest: linear, however
large a group of near copies is. Equal vectors are one node with a number of copies. A cell of more than ``CELL`` rows
or ``NUMBERS`` numbers is split on both sides, so no task holds more than two times that. The grid's dimensions follow from
the number of vectors; its occupied cells and their parts are a table. What is dealt a vector grows with its blocks,
not with their product with its length.

Defined cases: vectors that are null, empty, zero or hold null or non-finite numbers, and rows without vec_id, link with
nothing; very large and very small ones are scaled by a power of two, which changes no cosine; vectors of different lengths don't link; repeated rows are vectors of their own and link with each other, and rows that share a vec_id all show that id's most links and smallest component; an
empty table gives an empty result; input columns named like an added column give way to it.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save, unused, without
from .components import components

COSINE = 0.95
WIDTH = 8  # dimensions of a block
CELL = 32768
NUMBERS = 1 << 22  # numbers in the vectors of one side of a task at most
TILE = 1 << 22  # entries of a distance tile
BESIDE = 16  # further coordinates that travel with a block's own
CELL_KEY = ["size", "block", "cell"]
TASK = [*CELL_KEY, "l", "r"]
ADDED = ["n_links", "component_id", "kept"]


@cache
def rotation(size: int) -> np.ndarray:
    """The same orthogonal matrix for the same size everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def blocks(size: int) -> list[tuple[int, int]]:
    n = max(1, size // WIDTH)
    edges = np.linspace(0, size, n + 1).astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def budget(size: int, block: tuple[int, int], cosine: float) -> float:
    return (2 - 2 * cosine) * (block[1] - block[0]) / size * (1 + 1e-9)


def _turned(unit: np.ndarray) -> np.ndarray:
    """Rotated rows; each row's result depends on that row only, bit by bit."""
    turn = rotation(unit.shape[1])
    return np.stack([(unit * turn[:, k]).sum(axis=1) for k in range(len(turn))], axis=1) if len(unit) else unit


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding) -> (vec_id, size, digest, vector): digest and vector are null for what cannot link."""
    for b in batches:
        size, digest, vector = [], [], []
        for i, v in zip(b.column("vec_id").to_pylist(), b.column("embedding").to_pylist()):
            x = np.array([np.nan if e is None else e for e in v or []], np.float64)
            ok = i is not None and len(x) > 0 and np.isfinite(x).all() and x.any()
            raw = (np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) + 0.0).tobytes() if ok else None  # by a power of two, so that squares stay in range
            size.append(len(x))
            vector.append(raw)
            digest.append(hashlib.blake2b(raw, digest_size=16).digest() if ok else None)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(size, pa.int32()), pa.array(digest, pa.binary()), pa.array(vector, pa.binary())], names=["vec_id", "size", "digest", "vector"])


def _cells(turned: np.ndarray, span: tuple[int, int], size: int, cosine: float, dims: int) -> tuple[np.ndarray, int]:
    """Each row's cell in a block, its grid coordinates as digits of one number, and the base of that number; a block narrower than the grid has zeros."""
    width = math.sqrt(budget(size, span, cosine)) * (1 + 1e-6)
    across = int(2 / width) + 4
    at = np.floor((turned[:, span[0] : min(span[1], span[0] + dims)] + 1) / width).astype(np.int64) + 1
    out = np.zeros(len(at), np.int64)
    for k in range(dims):
        out = out * across + (at[:, k] if k < at.shape[1] else 0)
    return out, across


def _half(dims: int) -> list[tuple[int, ...]]:
    """The neighbours that come before a cell, without the cell itself."""
    zero = (0,) * dims
    return [d for d in itertools.product((-1, 0, 1), repeat=dims) if d < zero]


def _spread(df: DataFrame, dims: int) -> DataFrame:
    """(cell, across, ...) -> a row for the cell itself (home) and for each of the cells that have it as a neighbour before or behind."""
    steps = F.array(*[F.struct(F.lit(not any(d)).alias("home"), F.array(*map(F.lit, d)).alias("by")) for d in [(0,) * dims, *_half(dims)]])
    out = df.withColumn("_step", F.explode(steps))
    by = F.aggregate("_step.by", F.lit(0).cast("long"), lambda sum_, d: sum_ * F.col("across") + d)
    return out.withColumns({"cell": F.col("cell") - by, "home": F.col("_step.home")}).drop("_step")


def _by_size(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    for s in b.column("size").unique().to_pylist():
        own = np.flatnonzero(b.column("size").to_numpy() == s)
        yield s, b.take(pa.array(own))


def beside(size: int, span: tuple[int, int]) -> list[int]:
    """The coordinates that travel with a block: its own, then up to ``BESIDE`` that follow them in a ring."""
    return [k % size for k in range(span[0], min(span[1] + BESIDE, span[0] + size))]


def _in_blocks(cosine: float, dims: int):
    """(node, size, vector) -> a row a block: its cell and the coordinates that travel in single precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for size, own in _by_size(b):
                turned = _turned(_unit(own.column("vector").to_pylist()))
                n = len(turned)
                for k, span in enumerate(blocks(size)):
                    cell, across = _cells(turned, span, size, cosine, dims)
                    at = turned[:, beside(size, span)].astype(np.float32)
                    raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * at.shape[1]), n, [None, pa.py_buffer(at.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([own.column("node"), pa.array([size] * n, pa.int32()), pa.array([k] * n, pa.int32()), pa.array(cell), pa.array([across] * n, pa.int64()), raw], names=["node", "size", "block", "cell", "across", "at"])

    return run


def _splits(cells: DataFrame, dims: int) -> DataFrame:
    """(size, block, cell, across) of all rows -> occupied cells with the parts that each side of theirs is split into."""
    counts = cells.groupBy("size", "block", "cell", "across").agg(F.count(F.lit(1)).alias("n"))
    sums = _spread(counts, dims).groupBy("size", "block", "cell").agg(F.sum(F.when(F.col("home"), F.col("n")).otherwise(0)).alias("left"), F.sum("n").alias("right"))
    most = F.greatest(F.lit(1), F.least(F.lit(CELL), F.floor(F.lit(NUMBERS) / F.col("size")))).cast("long")
    return sums.where("left > 0").select("size", "block", "cell", *[F.ceil(F.col(c) / most).cast("int").alias(c + "s") for c in ("left", "right")])


def deal(rows: DataFrame, parts: DataFrame, dims: int) -> DataFrame:
    """(node, size, block, cell, across, at) -> a row for each task that compares it: left rows are of the task's cell, right rows of it and its neighbours before."""
    salt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    lefts = rows.withColumn("home", F.lit(False)).join(parts, CELL_KEY).withColumns({"l": salt("lefts"), "r": every("rights"), "right": F.lit(False)})
    rights = _spread(rows, dims).join(parts, CELL_KEY).withColumns({"r": salt("rights"), "l": every("lefts"), "right": F.lit(True)})
    return lefts.select(*TASK, "node", "right", "home", "at").unionByName(rights.select(*TASK, "node", "right", "home", "at"))


def _near(cosine: float):
    """A task's rows by what travelled of them -> those that have a partner there whose distance may be small enough."""

    def run(table: pa.Table) -> pa.Table:
        size, block = table.column("size")[0].as_py(), table.column("block")[0].as_py()
        span = blocks(size)[block]
        node = table.column("node").to_numpy()
        at = np.frombuffer(b"".join(table.column("at").to_pylist()), np.float32).reshape(len(node), -1)
        own = np.ascontiguousarray(at[:, : span[1] - span[0]])
        right, home = table.column("right").to_numpy(), table.column("home").to_numpy()
        lefts, rights = np.flatnonzero(~right), np.flatnonzero(right)
        square, whole = (own * own).sum(axis=1), (at * at).sum(axis=1)
        hit = np.zeros(len(node), bool)
        step = max(1, TILE // max(1, len(rights)))
        for k in range(0, len(lefts), step):
            x = lefts[k : k + step]
            near = square[x, None] + square[rights] - 2 * (own[x] @ own[rights].T) <= budget(size, span, cosine) + 1e-5
            i, j = np.nonzero(near)
            i, j = x[i], rights[j]
            fit = ~home[j] | (node[i] < node[j])
            i, j = i[fit], j[fit]
            for m in range(0, len(i), 1 << 16):
                u, v = i[m : m + (1 << 16)], j[m : m + (1 << 16)]
                all_ = whole[u] + whole[v] - 2 * np.einsum("ij,ij->i", at[u], at[v]) <= budget(size, (0, size), cosine) + 1e-5
                hit[u[all_]] = True
                hit[v[all_]] = True
        return table.filter(pa.array(hit)).select([*TASK, "node", "right", "home"])

    return run


def _labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest label that links reach."""
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _join(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        size, block = table.column("size")[0].as_py(), table.column("block")[0].as_py()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        raw = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(len(node), size)
        norm = np.linalg.norm(raw, axis=1)
        unit = raw / norm[:, None]
        right, home = table.column("right").to_numpy(), table.column("home").to_numpy()
        lefts, rights = np.flatnonzero(~right), np.flatnonzero(right)
        spans = blocks(size)
        most = [budget(size, s, cosine) for s in spans]
        a, z = spans[block]
        part = (unit @ rotation(size)[:, a:z]).astype(np.float32)
        square = (part * part).sum(axis=1)
        names, first = np.unique(node, return_index=True)  # a node's label is its place among the ids, so the least is the smallest id
        place = np.searchsorted(names, node)
        label, links = np.arange(len(names)), np.zeros(len(names), np.int64)
        step = max(1, TILE // max(1, len(rights)))
        for at in range(0, len(lefts), step):
            own = lefts[at : at + step]
            near = square[own, None] + square[rights] - 2 * (part[own] @ part[rights].T) <= most[block] + 1e-5
            i, j = np.nonzero(near)
            i, j = own[i], rights[j]
            fit = ~home[j] | (node[i] < node[j])  # two rows of one cell meet once
            i, j = i[fit], j[fit]
            for k in range(0, len(i), 1 << 15):
                x, y = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
                link = np.einsum("ij,ij->i", raw[x], raw[y]) / (norm[x] * norm[y]) >= cosine
                x, y = x[link], y[link]
                if not len(x):
                    continue
                rows, back = np.unique(np.concatenate([x, y]), return_inverse=True)
                turned = _turned(unit[rows])
                apart = (turned[back[: len(x)]] - turned[back[len(x) :]]) ** 2
                share = np.stack([apart[:, s[0] : s[1]].sum(axis=1) <= m for s, m in zip(spans, most)], axis=1)
                here = share.argmax(axis=1) == block
                x, y = x[here], y[here]
                np.add.at(links, place[x], copies[y])
                np.add.at(links, place[y], copies[x])
                label = _labels(label, place[x], place[y])
        seen = np.flatnonzero(links)
        return pa.table([pa.array(names[seen]), pa.array(links[seen]), pa.array(names[label[seen]])], names=["node", "n", "least"])

    return run


def grid_dims(vectors: int) -> int:
    """A cell of one dimension holds about a third of the vectors, each further dimension about a third of that."""
    return max(1, min(WIDTH // 2, math.ceil(math.log(max(vectors, 1) / CELL, 3)) + 1)) if vectors > CELL // 4 else 1


def embedding_dedup(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vectors`` (vec_id, embedding, ...) with n_links (other vectors of cosine >= ``cosine``), component_id (smallest vec_id reachable) and kept."""
    vectors = without(vectors, ADDED)
    vectors = vectors.withColumn("vec_id", F.col("vec_id").cast("long"))
    read = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_read, "vec_id long, size int, digest binary, vector binary")
    read = save(read, "vectors")
    nodes = save(read.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("vector").alias("vector")), "vector-nodes")
    dims = grid_dims(nodes.count())
    rows = save(nodes.select("node", "size", "vector").mapInArrow(_in_blocks(cosine, dims), "node long, size int, block int, cell long, across long, at binary"), "vector-blocks")
    parts = save(_splits(rows.select(*CELL_KEY, "across"), dims), "vector-cells")
    near = deal(rows, parts, dims).groupBy(*TASK).applyInArrow(_near(cosine), "size int, block int, cell long, l int, r int, node long, right boolean, home boolean")
    near = save(near, "vector-near")
    whole = near.join(nodes.select("node", "copies", "vector"), "node")
    found = save(whole.groupBy(*TASK).applyInArrow(_join(cosine), "node long, n long, least long"), "vector-links")
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    group = components(found.select(F.col("node").alias("u"), F.col("least").alias("v"))).withColumnRenamed("id", "node")
    facts = nodes.select("digest", "node", "copies").join(links, "node", "left").join(group, "node", "left")
    facts = facts.select("digest", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    # rows that share a vec_id are one vector in the result: the most links, the smallest component
    own = read.select("vec_id", "digest").join(facts, "digest", "left")
    whole = own.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    at, links, part = (unused(vectors, x) for x in ("at", "links", "part"))
    whole = whole.select(F.col("vec_id").alias(at), F.col("n_links").alias(links), F.col("component_id").alias(part))
    out = vectors.join(whole, F.col("vec_id") == F.col(at), "left")
    out = out.withColumns({"n_links": F.coalesce(F.col(links), F.lit(0)), "component_id": F.coalesce(F.col(part), F.col("vec_id"))})
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id")).select(*[F.col(f"`{c}`") for c in vectors.columns], *ADDED)
