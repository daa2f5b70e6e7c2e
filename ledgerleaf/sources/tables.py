"""Reading and writing record tables, documents and reports."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.quality import Tables, union
from ..specs import SPECS, TableSpec
from .lists import list_elements

RAW = "doc_id string, rec_idx long, raw string"


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for each call in the shared folder, ``spark.checkpoint.dir``; only a session on one machine may go without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(shared or 'file://' + tempfile.gettempdir()).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_table(spark: SparkSession, path: str, on_corrupt: str = "fail") -> DataFrame:
    """A JSON list file (or a folder of them, one a document) -> (doc_id, rec_idx, raw); doc_id is the parent folder's name.

    ``raw`` is the element's text as written, null for the null element; files of any size are read in byte ranges. A path
    that isn't there is empty, as is a file of no bytes. A file that is broken or no list fails when it is read, or is empty with ``on_corrupt="empty"``.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], RAW)
    items = list_elements(spark, path)
    if on_corrupt == "empty":
        items = items.join(items.where("NOT ok").select("file").distinct(), "file", "left_anti")
    else:
        items = items.where(F.when(F.col("ok"), True).otherwise(F.raise_error(F.concat(F.lit("no JSON list: "), F.col("file"))).cast("boolean")))
    return items.select(F.element_at(F.split("file", "/"), -2).alias("doc_id"), "rec_idx", "raw")


def read_tables(spark: SparkSession, folder: str, specs: dict[str, TableSpec] = SPECS, **more) -> Tables:
    """``folder``/<table>.json for every spec; absent ones are empty."""
    return {n: read_table(spark, f"{folder}/{n}.json", **more) for n in specs}


def read_documents(spark: SparkSession, glob: str) -> DataFrame:
    """Markdown files -> (doc_id, text, path, modified); doc_id is the parent folder's name."""
    whole = spark.read.text(glob, wholetext=True)
    return whole.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("doc_id"), F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"))


def latest_documents(files: DataFrame) -> DataFrame:
    """files (doc_id like 20240101_120000_stem, modified, ...) -> the newest of each stem; ties go to the greater doc_id."""
    stem = F.regexp_extract("doc_id", r"^\d{8}_\d{6}_(.+)$", 1)
    named = files.withColumn("stem", stem).where("stem <> ''")
    return named.withColumn("_n", F.row_number().over(W.partitionBy("stem").orderBy(F.desc("modified"), F.desc("doc_id")))).where("_n = 1").drop("_n")


def write_tables(tables: Tables, folder: str, mode: str = "overwrite", fmt: str = "parquet", dry_run: bool = False) -> None:
    """Every table of a stage to ``folder``/<table>; ``dry_run`` writes beside it."""
    for name, df in tables.items():
        df.write.mode(mode).format(fmt).save(f"{folder}{'.dry_run' if dry_run else ''}/{name}")


def write_report(counts: dict[str, DataFrame], path: str, details: dict[str, tuple[DataFrame, list[str]]] | None = None, first: int = 50) -> None:
    """JSON lines (part, total, position, row): the parts in ``counts`` whole, of those in ``details`` (frame, order) the first rows in order; ``total`` counts all rows of a part.

    A part without rows is one line with position and row null.
    """
    out = []
    for name, df in counts.items():
        out.append(_part(name, df, df.select(F.lit(None).cast("int").alias("position"), F.to_json(F.struct("*")).alias("row"))))
    for name, (df, order) in (details or {}).items():
        top = df.orderBy(*order).limit(first)  # a report names the first errors only
        ranked = top.withColumn("_at", F.row_number().over(W.orderBy(*order)))  # as many rows as a report shows
        out.append(_part(name, df, ranked.select(F.col("_at").alias("position"), F.to_json(F.struct(*df.columns)).alias("row"))))
    union(out).write.mode("overwrite").json(path)


def _part(name: str, df: DataFrame, rows: DataFrame) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("total"))  # one row
    return total.join(rows, F.lit(True), "left").select(F.lit(name).alias("part"), "total", "position", "row")
