"""Pages, blocks and chunks of Markdown documents."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.helpers import count_words, token_count

BLOCK = "doc_id long, block_no int, kind string, text string, start_line int, end_line int, token_count long, heading_path string, header string, signature string"
CHUNK = "doc_id long, chunk_index int, text string, token_count long, start_line int, end_line int, signatures array<string>"
ROWS = 256  # documents worked on at once
#: Counts tokens. Its ``seam``, if it has one: every word has a token of its own, and an empty line between two texts without white space at their ends adds so many to theirs.
Counter = Callable[[pd.Series], pd.Series]


def assemble_pages(pages: DataFrame) -> DataFrame:
    """pages (doc_id, page_no, markdown) -> (doc_id, text): trimmed pages in order, joined by line ends, trimmed.

    Null pages are empty; of pages with one number the smaller text comes first; an empty table gives an empty result. A
    document's pages meet in one row, as its text does.
    """
    page = F.struct("page_no", F.trim(F.coalesce("markdown", F.lit(""))).alias("md"))
    per = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(page)).alias("p"))
    return per.select("doc_id", F.trim(F.array_join(F.transform("p", lambda x: x["md"]), "\n")).alias("text"))


def page_pairs(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, next_no, left, right): consecutive pages of which at least one has text; a single page has no pair, gaps in the numbers don't matter."""
    w = W.partitionBy("doc_id").orderBy("page_no")
    got = pages.select("doc_id", "page_no", F.lead("page_no").over(w).alias("next_no"), F.col("markdown").alias("left"), F.lead("markdown").over(w).alias("right"))
    text = F.concat(F.coalesce("left", F.lit("")), F.coalesce("right", F.lit("")))
    return got.where(F.col("next_no").isNotNull() & (F.trim(text) != ""))


def size_gate(docs: DataFrame, threshold: int, limit: int, force: bool = False, counter: Counter = count_words) -> DataFrame:
    """Adds token_count and route: ``chunk`` above the threshold (or if forced), ``reject`` above the limit, else ``whole``. Null texts have 0 tokens. Columns of these names give way."""
    counted = docs.withColumn("token_count", token_count(F.col("text"), counter))
    return counted.withColumn("route", F.when(F.lit(force) | (F.col("token_count") > threshold), "chunk").when(F.col("token_count") > limit, "reject").otherwise("whole"))


#: What a line is, by a letter: blank, header of a table (a pipe and a word), rule below one, other line with a pipe, text.
BLANK, HEADER, RULE, PIPE, TEXT = " HRPT"
#: Blocks as runs of such letters: a table is a header, a rule and further lines with pipes; a paragraph ends at a blank line or table.
RUNS = re.compile(f"(?P<table>{HEADER}{RULE}[{HEADER}{RULE}{PIPE}]*)|(?:(?!{HEADER}{RULE})[^{BLANK}])+")


def _letter(line: str) -> str:
    if "|" not in line:
        return TEXT if line and not line.isspace() else BLANK
    cells = [c.strip() for c in line.strip().removeprefix("|").removesuffix("|").split("|")]
    dashes = [c.removeprefix(":").removesuffix(":") for c in cells]
    if len(cells) > 1 and all(len(d) > 2 and not d.strip("-") for d in dashes):
        return RULE
    return HEADER if any(ch.isalnum() or ch == "_" for ch in line) else PIPE


def _title(line: str) -> tuple[int, str] | None:
    """Depth and words of a heading: one to six number signs and white space before them."""
    line = line.strip()
    words = line.lstrip("#")
    depth = len(line) - len(words)
    return (depth, words.strip()) if 1 <= depth <= 6 and words[:1].isspace() else None


def blocks_of(text: str | None) -> list[tuple]:
    """(kind, text, first line, last line, heading path, header, signature) of a document's blocks in order.

    A heading counts where a block begins, and stays part of it; a deeper one comes under those above it.
    """
    lines = (text or "").splitlines()
    path: list[str] = []
    out = []
    for run in RUNS.finditer("".join(map(_letter, lines))):
        first, past = run.span()
        if found := _title(lines[first]):
            path = [*path[: found[0] - 1], found[1]]
        place = " > ".join(path) or None
        header = lines[first].strip() if run["table"] else None
        sign = hashlib.sha1(f"{place or ''}|{' '.join(header.lower().split())}".encode()).hexdigest()[:12] if header else None
        out.append(("table" if header else "paragraph", "\n".join(lines[first:past]).strip(), first + 1, past, place, header, sign))
    return out


_STOP = re.compile(r"(?<=[.!?])\s+")
_WORD = re.compile(r"[\S\x1c-\x1f]+")  # by Unicode these four are no white space, by Python they are


def _pieces(blocks: list[tuple], sizes: list[int | None], size: int) -> list[tuple]:
    """(text, first line, last line, signature, tokens or None): blocks, with paragraphs over the size (or None) in sentences, still uncounted."""
    out = []
    for (kind, text, a, z, _, _, sign), n in zip(blocks, sizes):
        if kind == "table" or n is not None and n <= size:
            out.append((text, a, z, sign, n))
        else:
            out.extend((x, a, z, sign, None) for x in _STOP.split(text) if x)
    return out


def _cuts(tokens: np.ndarray, size: int, overlap: int) -> Iterator[tuple[int, int, int]]:
    """(lead, first, past) of the chunks over pieces: as many pieces as fit, one at least; the lead goes back into the chunk before until it covers the overlap."""
    edge = np.append(0, np.cumsum(tokens))
    first, before = 0, 0
    while first < len(tokens):
        past = max(first + 1, int(np.searchsorted(edge, edge[first] + size, "right")) - 1)
        lead = max(before, int(np.searchsorted(edge, edge[first] - overlap, "right")) - 1) if overlap and first else first
        yield lead, first, past
        first, before = past, first


class _Counted:
    """Token counts of many texts in one call."""

    def __init__(self, counter: Counter):
        self.counter = counter
        self.seam = getattr(counter, "seam", None)

    def over(self, text: str, size: int) -> bool:
        """Its words alone say that a text has more than ``size`` tokens."""
        return self.seam is not None and len(text) > 2 * size and len(_WORD.findall(text)) > size

    def __call__(self, texts: list[str]) -> list[int]:
        return self.counter(pd.Series(texts, dtype=object)).astype("int64").tolist() if texts else []

    def each(self, groups: list[list[str]]) -> list[list[int]]:
        flat = iter(self([t for g in groups for t in g]))
        return [[next(flat) for _ in g] for g in groups]


def _chunks(texts: list[str | None], size: int, overlap: int, count: _Counted) -> list[list[tuple]]:
    """Each document's chunks: (index, text, tokens, first line, last line, signatures)."""
    blocks = [blocks_of(t) for t in texts]
    long = [[x[0] != "table" and count.over(x[1], size) for x in b] for b in blocks]
    sizes = iter(count([x[1] for b, own in zip(blocks, long) for x, over in zip(b, own) if not over]))
    pieces = [_pieces(b, [None if over else next(sizes) for over in own], size) for b, own in zip(blocks, long)]
    open_ = iter(count([p[0] for own in pieces for p in own if p[4] is None]))
    found, totals = [], []
    for own in pieces:
        tokens = np.array([next(open_) if p[4] is None else p[4] for p in own], np.int64)
        cuts = list(_cuts(tokens, size, overlap))
        found.append([("\n\n".join(p[0] for p in own[lead:past]), min(p[1] for p in own[lead:past]), max(p[2] for p in own[first:past]), list(dict.fromkeys(p[3] for p in own[lead:past] if p[3]))) for lead, first, past in cuts])
        totals.append([int(tokens[lead:past].sum()) + (past - lead - 1) * (count.seam or 0) for lead, _, past in cuts])
    if count.seam is None:
        totals = count.each([[c[0] for c in own] for own in found])
    return [[(k, text, n, a, z, signs) for k, ((text, a, z, signs), n) in enumerate(zip(own, ns))] for own, ns in zip(found, totals)]


def _mapped(docs: DataFrame, schema: str, rows: Callable[[list[str | None]], list[list[tuple]]]) -> DataFrame:
    """``rows`` of a list of texts gives each text's rows without the doc_id; a frame for each ``ROWS`` documents, no shuffle."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ids, texts = f["doc_id"].tolist(), f["text"].tolist()
            for k in range(0, len(ids), ROWS):
                got = rows(texts[k : k + ROWS])
                yield pd.DataFrame([(doc, *r) for doc, own in zip(ids[k : k + ROWS], got) for r in own], columns=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, schema)


def parse_blocks(docs: DataFrame, counter: Counter = count_words) -> DataFrame:
    """docs (doc_id, text) -> blocks with lines, tokens and heading path; null, empty and blank texts have none; repeated rows are parsed each."""

    def rows(texts):
        blocks = [blocks_of(t) for t in texts]
        counts = _Counted(counter).each([[x[1] for x in b] for b in blocks])
        return [[(k, *x[:4], n, *x[4:]) for k, (x, n) in enumerate(zip(b, ns))] for b, ns in zip(blocks, counts)]

    return _mapped(docs, BLOCK, rows)


def extract_tables(docs: DataFrame) -> DataFrame:
    """(doc_id, signature, header, heading_path, start_line, end_line) of every table; nothing is counted."""
    schema = "doc_id long, signature string, header string, heading_path string, start_line int, end_line int"
    return _mapped(docs, schema, lambda texts: [[(x[6], x[5], x[4], x[2], x[3]) for x in blocks_of(t) if x[0] == "table"] for t in texts])


def chunk_documents(docs: DataFrame, size: int, overlap: int = 0, counter: Counter = count_words) -> DataFrame:
    """Blocks packed in order up to ``size`` tokens; tables are never split; a chunk begins with the last blocks of the one before, up to ``overlap`` tokens.

    A paragraph over the size falls into its sentences; a sentence or table over it is a chunk of its own. Sizes are sums
    of the blocks' tokens; ``token_count`` is that of the joined text. Null, empty and blank texts have no chunks.
    """
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError("size must be positive and overlap smaller than it")
    return _mapped(docs, CHUNK, lambda texts: _chunks(texts, size, overlap, _Counted(counter)))


def route_and_chunk(docs: DataFrame, threshold: int, limit: int, size: int, overlap: int = 0, force: bool = False, counter: Counter = count_words) -> DataFrame:
    """Documents up to the threshold are one chunk 0 with all their tables in order; longer ones are chunked; rejected ones are left out. One pass, no shuffle; null texts are whole and empty."""
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError("size must be positive and overlap smaller than it")

    def rows(texts):
        count = _Counted(counter)
        tokens = count([t or "" for t in texts])
        out = []
        for t, n in zip(texts, tokens):
            if force or n > threshold:
                out.append(None)
            elif n > limit:
                out.append([])
            else:
                signs = list(dict.fromkeys(x[6] for x in blocks_of(t) if x[6]))
                out.append([(0, t or "", n, 1, (t or "").count("\n") + 1, signs)])
        chunked = iter(_chunks([t for t, own in zip(texts, out) if own is None], size, overlap, count))
        return [next(chunked) if own is None else own for own in out]

    return _mapped(docs, CHUNK, rows)
