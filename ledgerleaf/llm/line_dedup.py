"""Line dedup by a suffix array over line ids, DataFrame functions only.

Lines that hold a word are the letters of the corpus. Lines found once can be in no repeated run, so they cut each
document into segments of repeated lines, and suffixes end where their segment ends. Prefix doubling ranks the suffixes:
round j sorts pairs (rank of the first 2^j lines, rank of the next 2^j lines) with a range-partitioned sort, and a pair's
place is its rank for the first 2^(j+1) lines. Suffixes of equal rank stand together in the suffix array: they are its
intervals of a longest common prefix of at least that many lines. Each interval keeps its first place (smallest
doc_id, then line); every other place is a later copy of that many lines. Only intervals of two places or more go on to
the next round, which ends when none is left, so the longest repeated run is reached in about log2 of its length rounds.
The later copies' lines are deleted. Runs of fewer than ``min_lines`` lines are left alone, except that with ``min_words``
a run of one line is deleted too where the line has that many words: the first round's intervals are those runs.

Any run of lines that occurs earlier, however long, is covered by such power-of-two copies inside it, so the union of
all copies is the union of the maximal repeated runs.

Shuffles: line hashes (16 bytes a line) once; afterwards only repeated lines; texts once, to be joined with the lines to
delete, by document. Counting and ranking combine before they shuffle, and no group is collected: a line, run or document
that a third of the rows share is a count and a minimum. Keys of more than a share of the rows, at most ``HOT_KEYS`` of
them, meet their facts in a broadcast join, so their rows stay where they are; the others are dealt. Documents are joined by a row id made of doc_id and text, so
rows with one doc_id don't mix.

Defined cases: null, empty and blank texts have no lines and stay as they are; lines without a word are neither compared
nor deleted; repeated rows (equal doc_id and text) count as one document; a null doc_id counts as the smallest; an empty
table gives an empty result; input columns named like an added column give way to it, other names don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, let, packed, save, without

MIN_LINES = 2
ADDED = ["n_lines", "n_removed_lines", "clean_text"]
PLACE = ["d", "h", "n"]  # doc_id, hash of the text, number of the worded line
NO_ID = -(1 << 63)
HOT_KEYS = 20_000  # keys that a broadcast may hold: each has more than this part of the rows
HOT_ROWS = 500  # and more rows than this


def _row(docs: DataFrame) -> DataFrame:
    """``docs`` with d and h, which are equal for equal (doc_id, text) only."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "h": F.xxhash64(text, F.lit(1))})


def _worded(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(d, h, n, a, b, wide): each worded line with a 128-bit id of its text and whether it has ``min_words`` words (0: not asked)."""
    lines = F.filter(F.split(F.col("text").cast("string"), "\n", -1), _worded)
    wide = rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{min_words - 1}}}[^\x20\x09-\x0D]"
    is_wide = lambda x: x.rlike(wide) if min_words else F.lit(False)
    ids = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(7)).alias("b"), is_wide(x).alias("wide")))
    flat = _row(docs.where(F.col("text").isNotNull())).select("d", "h", F.posexplode(ids).alias("n", "id"))
    return flat.select("d", "h", F.col("n").cast("long").alias("n"), "id.a", "id.b", "id.wide")


def _intervals(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, places, first, rank) of the keys found at two places or more. The sort is dealt by ranges, so ranks rise over all partitions."""
    groups = suffixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("places"), F.min(F.struct(*PLACE)).alias("first"))
    ranked = groups.where("places > 1").repartitionByRange(*keys).sortWithinPartitions(*keys)
    return save(ranked.withColumn("rank", F.monotonically_increasing_id()), "line-ranks")


def joined_with_facts(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with the facts of their keys; facts: unique keys and places, how many rows they have (all of ``rows``)."""
    share = max(HOT_ROWS, (facts.agg(F.sum("places")).first()[0] or 0) // HOT_KEYS)
    hot = F.broadcast(facts.where(F.col("places") > share))  # fewer than HOT_KEYS: they have more than their part each
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(facts.where(F.col("places") <= share), keys)
    return rows.join(hot, keys).unionByName(rest).drop("places")


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = 0) -> DataFrame:
    """(d, h, n): the lines to delete, each once."""
    lines = save(_lines(docs.select("doc_id", "text"), min_words), "lines")
    often = save(lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("places")).where("places > 1"), "line-counts")
    level = save(joined_with_facts(lines, often, ["a", "b"]).dropDuplicates(PLACE), "line-suffixes")
    discard(lines)
    discard(often)
    keys, pairs, span, step, copies, wide = ["a", "b"], level, 0, 1, None, ["wide"]
    while True:
        ranks = _intervals(pairs, keys)
        if ranks.isEmpty():
            break
        below, level = level, save(joined_with_facts(pairs, ranks, keys).select(*PLACE, "rank", "first", *wide), "line-suffixes")
        discard(ranks)
        if copies is None:
            discard(below)
        span += step
        if span >= min_lines or min_words and wide:
            chosen = level if span >= min_lines else level.where("wide")
            later = chosen.where(F.struct(*PLACE) > F.col("first")).select(*PLACE, F.lit(span).alias("span"))
            copies = later if copies is None else copies.unionByName(later)
        wide = []
        step = min(span, min_lines - span) if span < min_lines else span
        ahead = level.select("d", "h", (F.col("n") - step).alias("n"), F.col("rank").alias("next"))
        pairs, keys = level.select(*PLACE, F.col("rank").alias("this")).join(ahead, PLACE), ["this", "next"]
    if copies is None:
        return level.select(*PLACE).limit(0)
    # a copy of more lines than that holds, at each of its lines, a copy of its own, so the lines of a long run come once each
    gone = copies.groupBy(*PLACE).agg(F.least(F.max("span"), F.lit(min_lines)).alias("span"))
    return gone.select("d", "h", F.explode(F.sequence("n", F.col("n") + F.col("span") - 1)).alias("n")).distinct()


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = 0) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_lines and n_removed_lines (lines with a word) and clean_text (null stays null).

    ``min_words``: repeated single lines of that many words go too; 0: none do.
    """
    docs = without(docs, ADDED)
    names, docs = docs.columns, packed(docs, ["doc_id", "text"])
    gone = repeated_lines(docs, min_lines, min_words).groupBy("d", "h").agg(F.collect_list(F.col("n").cast("int")).alias("gone"))
    text = F.col("text").cast("string")
    found = _row(docs).join(gone, ["d", "h"], "left").withColumn("n_removed_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long"))

    def rest(lines: Column) -> Column:
        numbered = F.filter(F.transform(lines, lambda x, i: F.when(_worded(x), i)), lambda i: i.isNotNull())
        drop = let(numbered, lambda at: F.transform("gone", lambda n: F.get(at, n)))
        keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
        return F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")

    clean = F.when(F.col("n_removed_lines") == 0, text).otherwise(let(F.split(text, "\n", -1), rest))
    n_lines = F.coalesce(F.size(F.filter(F.split(text, "\n", -1), _worded)), F.lit(0)).cast("long")
    return found.withColumns({"n_lines": n_lines, "clean_text": clean}).select(*[F.col("row").getField(c).alias(c) for c in names], *ADDED)
