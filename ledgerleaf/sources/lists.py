"""JSON list files of any size, cut into their elements by all tasks at once.

Spark reads byte ranges of a file as the pieces between commas. What a piece does to the state of the scan (inside a string
or not, depth of brackets) is known for both states it may start in, so each block of ``2^BLOCK_BITS`` pieces of a range sums them
up without knowing what lies before it; the blocks' sums, a few numbers each, give every block its true start, and commas at
depth 1 outside strings end elements. An element is put together again from its pieces and keeps its text as written: 1.10
stays 1.10. No task sorts or holds more than blocks, however long a range is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..frames import save

BLOCK_BITS = 12  # of the number of a block's pieces, at most
RANGE = ["file", "start", "block"]
PLACE = ["start", "block"]  # the order of a file's blocks
BLANK = r"[ \t\r\n]*"


def _net(text: Column) -> Column:
    """Opening brackets less closing ones."""
    return F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, block, id, value, odd, d0, d1): a row a piece. odd: quotes so far in its block, mod 2; d0, d1: brackets so far if the block starts outside or inside a string."""
    read = spark.read.option("lineSep", ",").option("recursiveFileLookup", True).text(path)
    read = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value")
    read = read.withColumn("block", F.shiftright("id", BLOCK_BITS))  # the ids of a range follow each other
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters; no comma is one
    strings = r'"[^"]*("|\z)'
    read = read.withColumn("bare", bare).withColumns(
        {
            "quotes": F.length("bare") - F.length(F.translate("bare", '"', "")),
            "net0": _net(F.regexp_replace("bare", strings, "")),
            "net1": _net(F.regexp_replace(F.concat(F.lit('"'), "bare"), strings, "")),
        }
    )
    so_far = W.partitionBy(*RANGE).orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    counted = read.withColumn("sum", F.sum("quotes").over(so_far)).withColumn("flipped", (F.col("sum") - F.col("quotes")) % 2 == 1)
    depth = lambda flipped: F.sum(F.when(F.col("flipped") == flipped, F.col("net0")).otherwise(F.col("net1"))).over(so_far)
    return counted.select(*RANGE, "id", "value", (F.col("sum") % 2).alias("odd"), depth(False).alias("d0"), depth(True).alias("d1"))


def _ranges(pieces: DataFrame) -> DataFrame:
    """(file, start, block, inside, base, first, of, ok): a block's true state at its start, elements that end before it, and whether the file's brackets make one list."""
    ends = pieces.groupBy(*RANGE).agg(
        F.max_by(F.struct("odd", "d0", "d1"), "id").alias("end"),
        F.min_by(F.col("value").rlike(rf"\A{BLANK}\["), "id").alias("opens"),
        F.max_by(F.col("value").rlike(rf"\]{BLANK}\z"), "id").alias("closes"),
    )
    before = W.partitionBy("file").orderBy(*PLACE).rowsBetween(W.unboundedPreceding, -1)  # blocks of one file
    inside = F.coalesce(F.sum("end.odd").over(before), F.lit(0)) % 2
    ends = ends.withColumn("inside", inside).withColumn("rise", F.when(F.col("inside") == 0, F.col("end.d0")).otherwise(F.col("end.d1")))
    ends = ends.withColumn("base", F.coalesce(F.sum("rise").over(before), F.lit(0)))
    seen = pieces.groupBy(*RANGE, "odd", "d0", "d1").agg(F.count(F.lit(1)).alias("n"))  # depths are few
    state = seen.join(ends, RANGE).where((F.col("odd") + F.col("inside")) % 2 == 0)
    state = state.withColumn("depth", F.col("base") + F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1")))
    cuts = state.groupBy(*RANGE).agg(F.sum(F.when(F.col("depth") == 1, F.col("n")).otherwise(0)).alias("cuts"), F.sum(F.when(F.col("depth") < 1, F.col("n")).otherwise(0)).alias("low"))
    every = W.partitionBy("file")
    last = F.max(F.struct(*PLACE, "closes", (F.col("base") + F.col("rise")).alias("depth"), ((F.col("inside") + F.col("end.odd")) % 2).alias("inside"))).over(every)
    all_ = ends.join(cuts, RANGE, "left").fillna(0, ["cuts", "low"]).withColumn("last", last)
    good = F.min(F.struct(*PLACE, "opens")).over(every)["opens"] & F.col("last.closes") & (F.col("last.depth") == 0) & (F.col("last.inside") == 0) & (F.sum("low").over(every) == 1)
    return all_.select(*RANGE, "inside", "base", F.coalesce(F.sum("cuts").over(before), F.lit(0)).alias("first"), F.sum("cuts").over(every).alias("of"), good.alias("ok"))


def list_elements(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list file or a folder of them -> (file, rec_idx, raw, ok): every element's text without blanks around; ok: it is JSON and stands in a list.

    The null element's ``raw`` is null. An empty list has no rows; a file that is no list has rows that aren't ok, whatever
    their text; one of no bytes has none, as Spark doesn't read it. An element is whole in one task.
    """
    pieces = save(_pieces(spark, path), "list-pieces")
    placed = pieces.join(_ranges(pieces), RANGE)
    outside = (F.col("odd") + F.col("inside")) % 2 == 0
    depth = F.col("base") + F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1"))
    cut = (outside & (depth == 1)).cast("long")
    so_far = W.partitionBy(*RANGE).orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumn("rec_idx", F.col("first") + F.sum(cut).over(so_far) - cut)
    joined = lambda kept: F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["value"]), ",")
    parts = placed.groupBy(*RANGE, "rec_idx").agg(joined(F.struct("id", "value")).alias("value"), F.first("of").alias("of"), F.first("ok").alias("ok"))
    whole = parts.groupBy("file", "rec_idx").agg(joined(F.struct(*PLACE, "value")).alias("raw"), F.first("of").alias("of"), F.first("ok").alias("ok"))
    bare = F.when(F.col("rec_idx") == 0, F.regexp_replace("raw", rf"\A{BLANK}\[", "")).otherwise(F.col("raw"))
    whole = whole.withColumn("raw", bare).withColumn("raw", F.when(F.col("rec_idx") == F.col("of"), F.regexp_replace("raw", rf"\]{BLANK}\z", "")).otherwise(F.col("raw")))
    whole = whole.withColumn("raw", F.btrim("raw", F.lit(" \t\r\n"))).where(~(F.col("ok") & (F.col("of") == 0) & (F.col("raw") == "")))
    fits = (F.col("raw") != "") & (F.coalesce(F.json_array_length(F.concat(F.lit("[["), "raw", F.lit("],0]"))), F.lit(0)) == 2)  # whatever follows the element's end is an error there
    return whole.select("file", "rec_idx", F.when(F.col("raw") != "null", F.col("raw")).alias("raw"), (F.col("ok") & fits).alias("ok"))
