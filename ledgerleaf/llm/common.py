"""What the operators of this subpackage share: words, shared scratch tables, chunks of documents."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters outside the six ASCII white-space characters; on UTF-8 bytes that is ``bytes.split()``.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; only a session on one machine may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder or "file://" + os.path.join(tempfile.gettempdir(), "ledgerleaf-shared")


_run: ContextVar[str | None] = ContextVar("run", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_run.get() or shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that operators save inside lie in one folder, which goes at the end: write the result before, in a place of your own."""
    folder = new_path(spark, "run")
    token = _run.set(folder)
    try:
        yield
    finally:
        _run.reset(token)
        delete(spark, folder)


def save(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back: cuts the lineage, survives lost executors. ``by``: columns whose values lie in folders of their own."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*by or ()).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table made by ``save`` that nothing will read again."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """For jobs run inside: at most so many rows in an Arrow batch, where rows hold whole texts or sets."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns whose names clash with those an operator adds."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def packed(df: DataFrame, names: list[str]) -> DataFrame:
    """All columns as one struct ``row``, and those named beside it: an operator's own columns then clash with none."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *names)


def carried(df: DataFrame, own: list[str]) -> DataFrame:
    """The columns in ``own`` as they are and all others, if any, as one struct ``row``, which passes through Arrow whatever their names."""
    more = [F.col(f"`{c}`") for c in df.columns if c not in own]
    return df.select(*own, *([F.struct(*more).alias("row")] if more else []))


def unpacked(df: DataFrame, names: list[str], own: list[str]) -> DataFrame:
    """``names`` again, of which those in ``own`` stand beside the row."""
    return df.select(*[F.col(c) if c in own else F.col("row").getField(c).alias(c) for c in names])


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores behind it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts; one scan of one column."""
    return df.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0


def chunk_of(id_column: str, chunks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_column)), F.lit(chunks)).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it in an inner function."""
    return F.element_at(F.transform(F.array(value), body), 1)


def java_words(text: Column) -> Column:
    """The words of a text as an array, without Python; null and empty texts have none."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), 0)
