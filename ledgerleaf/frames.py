"""What operators share: names that never clash, the identity of rows, tables saved on the way."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # of one key, beyond which its rows are no single window
FEW_ROWS = 100_000  # of a side of a join that Spark may send to every task

#: A row is known by its document and its number there; tables of one document may do without doc_id.
IDENTITY = ("doc_id", "rec_idx")


def col(name: str) -> Column:
    """The column of exactly that name, also with a point in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def identity(df: DataFrame) -> list[str]:
    return [c for c in IDENTITY if c in df.columns]


def place(df: DataFrame) -> Column:
    """What rows are ordered by: doc_id, then rec_idx; null comes first."""
    return F.struct(*[col(c) for c in identity(df)])


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores behind each as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns whose names clash with those an operator adds."""
    taken = {n.lower() for n in names}
    return df.select(*[col(c) for c in df.columns if c.lower() not in taken])


def also(df: DataFrame, **more: Column) -> DataFrame:
    """``df`` and more columns, whatever the names of its own."""
    return df.select(*[col(c) for c in df.columns], *[c.alias(n) for n, c in more.items()])


def replaced(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with another value in one of its columns."""
    return df.select(*[value.alias(c) if c == name else col(c) for c in df.columns])


def all_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def joined(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "left") -> DataFrame:
    """``left`` with what ``right`` says of equal keys (column of the left -> of the right); the right's keys are not returned. No other name may be on both sides."""
    side = right.select(*[col(c).alias(f"{c}\0right") if c in keys.values() else col(c) for c in right.columns])
    on = all_of([col(a) == col(f"{b}\0right") for a, b in keys.items()])
    out = left.join(side, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"{b}\0right" for b in keys.values()])


def exists(spark: SparkSession, path: str) -> bool:
    place_ = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place_.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place_)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; only a session on one machine may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder or "file://" + os.path.join(tempfile.gettempdir(), "ledgerleaf-shared")


_run: ContextVar[str | None] = ContextVar("run", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_run.get() or shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


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


def sorted_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a side of a join that isn't sent to every task if it has more than ``FEW_ROWS``: Spark goes by the bytes of files, where keys take a small part of what they take in the driver."""
    return df.hint("merge") if rows > FEW_ROWS else df


def side(df: DataFrame) -> DataFrame:
    """``sorted_side`` of a saved table, whose files tell how many rows it has."""
    return sorted_side(df, df.count())


def discard(df: DataFrame) -> None:
    """Deletes the files of a table made by ``save`` that nothing will read again."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


def numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """``df`` with the number, from 1, of each row among those of one ``by``, in the order of their places.

    Keys of more than ``HOT_ROWS`` rows, of which there are few, are sorted over many tasks: a row's number is its place in
    its range and what the ranges before hold of its key.
    """
    window = F.row_number().over(W.partitionBy(col(by)).orderBy(place(df))).cast("long")
    (mine,) = unused(df, "key")
    hot = save(df.groupBy(col(by).alias(mine)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select(mine), "hot-keys")
    if hot.isEmpty():
        return also(df, **{name: window})
    on = col(by).eqNullSafe(col(mine))
    rest = df.join(F.broadcast(hot), on, "left_anti")  # at most a HOT_ROWS-th of the rows
    part, at, first = unused(df, "part", "at", "first")
    many = df.join(F.broadcast(hot), on, "left_semi").withColumn(mine, col(by)).repartitionByRange(F.col(mine), place(df)).sortWithinPartitions(F.col(mine), place(df))
    ranged = save(many.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}), "rows-in-order")
    sizes = ranged.groupBy(mine, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(mine).orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col(mine).alias("k"), F.col(part).alias("p"), (before + 1 - F.col(first)).alias(first))
    both = ranged.join(starts, F.col(mine).eqNullSafe(F.col("k")) & (F.col(part) == F.col("p")))
    return also(rest, **{name: window}).unionByName(both.select(*[col(c) for c in df.columns], (F.col(at) + F.col(first)).alias(name)))
