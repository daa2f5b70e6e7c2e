"""References, duplicates and key quality of record tables. Tables are DataFrames with doc_id and rec_idx.

A row is known by (doc_id, rec_idx) and ordered by it; reports name both. A table without doc_id is one document, and
reports on such tables alone have no doc_id. No column of these operators clashes with the caller's.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..frames import all_of, also, col, identity, joined, place, save, unused, without
from ..functions.scalars import is_null_or_empty
from ..specs import SPECS, TableSpec

Tables = dict[str, DataFrame]


def union(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("there are no tables to put together")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fk_issues(tables: Tables, specs: dict[str, TableSpec] = SPECS) -> DataFrame:
    """(table, [doc_id,] rec_idx, field, value, kind, message): blank required references and values not in their target table.

    The distinct values of a table's references are held against their targets once; the few that are nowhere then meet the
    rows, so rows are not shuffled for values that are there. A reference whose target is not in ``tables`` is not checked;
    no tables or none with references give no rows; repeated rows give their issues each.
    """
    found = []
    for name, rows in tables.items():
        fks = [fk for fk in specs[name].fks if fk.field in rows.columns and fk.target in tables]
        if not fks:
            continue
        now = rows.select(*[col(c) for c in identity(rows)], *[col(fk.field).cast("string").alias(f"\0v{k}") for k, fk in enumerate(fks)])
        values = now.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), col(f"\0v{k}").alias("v")) for k in range(len(fks))])).alias("x")).select("x.*").where("v <> ''").distinct()
        ids = union([tables[fk.target].select(F.lit(k).alias("k"), col(specs[fk.target].pk).cast("string").alias("v")) for k, fk in enumerate(fks)])
        lost = save(values.join(ids, ["k", "v"], "left_anti"), "values-not-found")
        for k in range(len(fks)):
            now = joined(now, lost.where(F.col("k") == k).select("v", F.lit(True).alias(f"\0lost{k}")), {f"\0v{k}": "v"})
        issues = []
        for k, fk in enumerate(fks):
            value = col(f"\0v{k}")
            shape = lambda kind, text: F.struct(F.lit(fk.field).alias("field"), value.alias("value"), F.lit(kind).alias("kind"), text.alias("message"))  # noqa: B023, E731
            blank = F.lit(None) if fk.optional else shape("missing", F.lit("missing required FK value"))
            not_found = shape("not_found", F.concat(F.lit("value "), value, F.lit(f" not found in {fk.target}")))
            issues.append(F.when(is_null_or_empty(value), blank).when(col(f"\0lost{k}"), not_found))
        now = now.where(F.coalesce(*issues).isNotNull())  # most rows have none
        each = now.select(F.lit(name).alias("table"), *[col(c) for c in identity(rows)], F.explode(F.array_compact(F.array(*issues))).alias("i"))
        found.append(each.select("table", *identity(rows), "i.field", "i.value", "i.kind", "i.message"))
    return union(found) if found else _nothing("table string, rec_idx long, field string, value string, kind string, message string")


def _nothing(schema: str) -> DataFrame:
    """An empty table in the running session."""
    return SparkSession.active().createDataFrame([], schema)


def duplicate_groups(tables: Tables, rules: dict[str, list[tuple[str, ...]]], max_groups: int | None = 50) -> DataFrame:
    """(table, key_fields, key, values, first, rows[, first_doc_id, doc_ids]): rows that share a complete key; the first ``max_groups`` by table and first row (none: all).

    Rows are shuffled by their key once; groups are counted there before their row numbers are gathered, so only real
    duplicates are collected; a group's row numbers are one list, as its readers want it, in the order of (doc_id, rec_idx), and ``doc_ids`` tells each row's document. Rows
    with a null or empty part of a key are in no group; without rules, or tables they are for, there are no groups.
    """
    found = []
    for order, (name, keys) in enumerate(rules.items()):
        for key in keys if name in tables else ():
            df = tables[name]
            named = [f"\0k{k}" for k in range(len(key))]
            slim = df.where(all_of([~is_null_or_empty(col(k)) for k in key])).select(place(df).alias("\0at"), *[col(k).alias(n) for k, n in zip(key, named)])
            many = slim.withColumn("\0n", F.count(F.lit(1)).over(W.partitionBy(*map(col, named)))).where(col("\0n") > 1)
            rows = many.groupBy(*map(col, named)).agg(F.sort_array(F.collect_list(col("\0at"))).alias("at"))
            text = [col(n).cast("string") for n in named]
            doc = [F.col("at.doc_id").alias("doc_ids"), F.get("at.doc_id", F.lit(0)).alias("first_doc_id")] if "doc_id" in df.columns else []
            found.append(rows.select(F.lit(order).alias("\0t"), F.get("at", F.lit(0)).alias("\0first"), F.lit(name).alias("table"), F.lit(",".join(key)).alias("key_fields"), F.concat_ws("|", *text).alias("key"), F.array(*text).alias("values"), F.get("at.rec_idx", F.lit(0)).alias("first"), F.col("at.rec_idx").alias("rows"), *doc))
    if not found:
        return _nothing("table string, key_fields string, key string, values array<string>, first long, rows array<long>")
    if len({f.schema["\0first"].dataType.simpleString() for f in found}) > 1:  # tables of one document beside others
        found = [f.withColumn("\0first", F.struct(F.lit(None).cast("string").alias("doc_id") if "first_doc_id" not in f.columns else F.col("first_doc_id").cast("string").alias("doc_id"), F.col("first").alias("rec_idx"))) for f in found]
    out = union(found)
    if max_groups is not None:
        out = out.orderBy(col("\0t"), col("\0first"), "key").limit(max_groups)
    return out.drop("\0t", "\0first")


def key_quality(tables: Tables, specs: dict[str, TableSpec] = SPECS) -> DataFrame:
    """(table, check, records, missing, groups, rows): missing and repeated primary and unique keys; null only counts as missing. No tables: no rows."""
    found = []
    for name, df in tables.items():
        for check, key in [("pk", (specs[name].pk,)), *[(",".join(k), k) for k in specs[name].unique_keys]]:
            missing = ~all_of([col(k).isNotNull() for k in key])
            per = df.select(missing.alias("\0m"), *[col(k).alias(f"\0k{n}") for n, k in enumerate(key)]).groupBy(col("\0m"), *[col(f"\0k{n}") for n in range(len(key))]).agg(F.count(F.lit(1)).alias("n"))
            gone, again = col("\0m"), ~col("\0m") & (F.col("n") > 1)
            found.append(
                per.agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
                    F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0)).alias("missing"),
                    F.count_if(again).alias("groups"),
                    F.coalesce(F.sum(F.when(again, F.col("n"))), F.lit(0)).alias("rows"),
                ).select(F.lit(name).alias("table"), F.lit(check).alias("check"), "records", "missing", "groups", "rows")
            )
    return union(found) if found else _nothing("table string, check string, records long, missing long, groups long, rows long")


def fk_presence(tables: Tables, specs: dict[str, TableSpec] = SPECS) -> DataFrame:
    """(table, records, blank): blank required references by table. No tables: no rows; a reference that is no column is blank nowhere."""
    found = []
    for name, rows in tables.items():
        blank = [F.coalesce(F.count_if(is_null_or_empty(col(fk.field))), F.lit(0)) for fk in specs[name].fks if not fk.optional and fk.field in rows.columns]
        found.append(rows.agg(F.count(F.lit(1)).alias("records"), reduce(lambda a, b: a + b, blank, F.lit(0).cast("long")).alias("blank")).select(F.lit(name).alias("table"), "records", "blank"))
    return union(found) if found else _nothing("table string, records long, blank long")


def file_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table, bytes) of the files under each table's path; paths that aren't there are left out. Contents are not read."""
    found = []
    for name, path in paths.items():
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            found.append(files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).select(F.lit(name).alias("table"), "bytes"))
    return union(found) if found else _nothing("table string, bytes long")


def table_profile(tables: Tables, sizes: DataFrame | None = None, specs: dict[str, TableSpec] = SPECS) -> DataFrame:
    """(table, exists, records, bytes, status) for every expected table; ``sizes``: (table, bytes), as ``file_sizes`` gives them (none: 0). Tables that aren't given don't exist."""
    expected = SparkSession.active().createDataFrame([(n,) for n in specs], "table string")
    counts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("table"), "records") for n, df in tables.items()]
    out = expected.join(union(counts) if counts else _nothing("table string, records long"), "table", "left")
    out = out.join(sizes, "table", "left") if sizes is not None else out.withColumn("bytes", F.lit(None).cast("long"))
    exists = F.col("records").isNotNull()
    return out.select("table", exists.alias("exists"), F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("bytes", F.lit(0)).alias("bytes"), F.when(~exists, "missing").when(F.col("records") == 0, "empty").otherwise("ok").alias("status"))


def ready(profile: DataFrame) -> DataFrame:
    """One row of a profile: tables, found, records, bytes, ready (every expected table exists)."""
    return profile.agg(F.count(F.lit(1)).alias("tables"), F.count_if("exists").alias("found"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.every("exists"), F.lit(True)).alias("ready"))


def flag_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``first`` (rec_idx of the first row with the same keys; with doc_id, ``first_doc_id`` too) and ``is_repeat`` (a later row with them).

    First is the least (doc_id, rec_idx), whichever document a row is in. Rows with a null or empty key are never repeats:
    ``first`` is null. Least rows are combined before they are shuffled and joined back, so a key of very many rows is no
    single group. Columns named like an added one give way.
    """
    added = ["first", *["first_doc_id"] * ("doc_id" in df.columns), "is_repeat"]
    df = without(df, added)
    (least,) = unused(df, "least")
    named = {k: f"\0k{n}" for n, k in enumerate(keys)}
    falsy = ~all_of([~is_null_or_empty(col(k)) for k in keys])
    whole, rest = df.where(~falsy), df.where(falsy)  # rows without a key stay out of the join, where they would meet in one task
    firsts = whole.groupBy(*[col(k).alias(n) for k, n in named.items()]).agg(F.min(place(df)).alias(least))
    both = joined(whole, firsts, named, "inner")
    own = [col(c) for c in df.columns]
    told = [col(least).getField("rec_idx").alias("first"), *[col(least).getField("doc_id").alias("first_doc_id")] * ("doc_id" in df.columns), (place(df) > col(least)).alias("is_repeat")]
    none = [F.lit(None).cast(df.schema["rec_idx"].dataType).alias("first"), *[F.lit(None).cast(df.schema["doc_id"].dataType).alias("first_doc_id") if "doc_id" in df.columns else None] * ("doc_id" in df.columns), F.lit(False).alias("is_repeat")]
    return both.select(*own, *told).unionByName(rest.select(*own, *none))


def _in_order(rows: DataFrame, by: list[Column], name: str, keep: list[str] | None = None) -> DataFrame:
    """``rows`` (of them the columns ``keep``) with a number that rises in the order of ``by`` over all tasks, saved."""
    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    return save(sorted_.select(*[col(c) for c in keep or rows.columns], F.monotonically_increasing_id().alias(name)), "tree-order")


def _climbed(table: pa.Table) -> pa.Table:
    """Rows of one range of numbers, each as high up as the range goes: (row, id, above, to, level, lone, root, root_row).

    ``to``: the row it looks up to next, outside the range (null: ``root`` is its root); ``level``: how far that is above it,
    ``lone``: no row on the way has a sibling. Rows on or behind a cycle inside the range stay where they are.
    """
    table = table.sort_by("row")
    row, above, own = table["row"].to_numpy(), table["above"].fill_null(-1).to_numpy(), table["lone"].to_numpy()
    at = np.minimum(np.searchsorted(row, above), len(row) - 1)
    inside = row[at] == above
    top, level, lone = np.where(inside, at, np.arange(len(row))), inside.astype(np.int64), own | ~inside
    for _ in range(len(row).bit_length()):
        far = top[top]
        if (far == top).all():
            break
        level, lone, top = level + level[top], lone & lone[top], far
    ring = inside[top]
    top, level, lone = np.where(ring, np.arange(len(row)), top), np.where(ring, 0, level), lone | ring
    out = above[top] >= 0
    rise = lambda name, high: pc.if_else(pa.array(out), table[high].take(top), table[name].take(top))
    given = {"row": table["row"], "id": table["id"], "above": table["above"], "to": pa.array(above[top], mask=~out), "level": pa.array((level + out).astype(np.int32)), "lone": pa.array(lone & (own[top] | ~out))}
    return pa.table({**given, "root": rise("id", "up"), "root_row": rise("row", "above")})


def topo_sort(df: DataFrame, id_col: str, parent_col: str, position: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Parents before children: (rows with ``order``, ``level``, ``root`` and ``is_extra``, parents that are not in the table).

    ``order`` counts from 0 in the order of a breadth-first walk: roots in the order of their rows, then their children,
    parent by parent in the order of their rows, and so on; then the rows on or behind a cycle (level null) in the order of
    rows; then rows with a null, empty or repeated id (``is_extra``). Roots have no parent (null or empty) or one that is
    not there. Rows are ordered by (doc_id, rec_idx), or by ``position``, ties by id.

    Rows of one level stand in the order of their roots, those of one root in the order of their paths. Rows are numbered in
    their order; a row first climbs inside its range of numbers, then by doubling: joined with the row it looks up to, it
    sees twice as far. Only rows that others look up to are joined. A row whose way from the root has no siblings is the
    only one of its level and root; the others are ranked by doubling too, where a sort over ranges ranks each anew by (rank
    above, own rank). A chain of n rows takes log2(n) rounds at most, a row is a few numbers in each, whatever its depth,
    and rows whose path is whole take no further part. An empty table gives empty tables; columns named like an added one
    give way.
    """
    added = ["order", "level", "root", "is_extra"]
    df = without(df, added)
    again, shared, mine, first = unused(df, "again", "shared", "id", "first")
    at = place(df) if position is None else F.struct(col(position).alias("rec_idx"))
    usable = ~is_null_or_empty(col(id_col))
    many = df.where(usable).groupBy(col(id_col).alias(mine)).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(shared)).where(col(shared) > 1).drop(shared)
    keyed = joined(df.where(usable), save(many, "repeated-ids"), {id_col: mine})  # only repeated ids meet the rows
    keyed = keyed.select(*[col(c) for c in df.columns], F.coalesce(at > col(first), F.lit(False)).alias(again), col(first).isNotNull().alias(shared))
    parent = F.when(~is_null_or_empty(col(parent_col)), col(parent_col))
    own = lambda part: keyed.where(part & ~col(again)).select(col(id_col).alias("id"), parent.cast(df.schema[id_col].dataType).alias("up"), parent.alias("said"), at.alias("at"))
    start = own(~col(shared)).unionByName(own(col(shared)).dropDuplicates(["id"]))  # rows of one id at one place are one node
    nodes = _in_order(start, [F.col("at"), F.col("id")], "row", ["id", "up", "said"])
    below = nodes.where("up IS NOT NULL")
    ids = nodes.select(F.col("id").alias("up"), F.col("row").alias("above")).join(below.groupBy("up").agg(F.count(F.lit(1)).alias("n")), "up")
    with_up = below.join(ids, "up", "left")
    missing = with_up.where("above IS NULL").select(F.col("said").alias("missing_parent")).distinct()
    tops = nodes.where("up IS NULL").select("id", "up", "row", F.lit(None).cast("long").alias("above"), F.lit(True).alias("lone"))
    linked = tops.unionByName(with_up.select("id", F.when(F.col("above").isNotNull(), F.col("up")).alias("up"), "row", "above", F.coalesce(F.col("n") == 1, F.lit(True)).alias("lone")))
    id_type = nodes.schema["id"].dataType
    schema = T.StructType([T.StructField(n, t) for n, t in (("row", T.LongType()), ("id", id_type), ("above", T.LongType()), ("to", T.LongType()), ("level", T.IntegerType()), ("lone", T.BooleanType()), ("root", id_type), ("root_row", T.LongType()))])
    known = save(linked.groupBy(F.shiftright("row", 33).alias("range")).applyInArrow(_climbed, schema), "tree-climbed")  # a range is what one task sorted
    whole, left, open_ = [known.where("to IS NULL")], known.where("to IS NOT NULL"), None
    while True:
        n = left.count()
        if n in (0, open_):  # those that stay are on or behind a cycle
            break
        open_ = n
        wanted = save(left.select(F.col("to").alias("row")).distinct(), "tree-wanted")
        above = save(known.join(wanted, "row", "left_semi").select(F.col("row").alias("to"), F.col("to").alias("next"), F.col("level").alias("more"), F.col("lone").alias("still"), F.col("root").alias("top"), F.col("root_row").alias("top_row")), "tree-above")
        moved = left.join(above, "to").select("row", "id", "above", F.col("next").alias("to"), (F.col("level") + F.col("more")).alias("level"), (F.col("lone") & F.col("still")).alias("lone"), F.col("top").alias("root"), F.col("top_row").alias("root_row"))
        moved = save(moved, "tree-climbed")
        whole.append(moved.where("to IS NULL"))
        left = moved.where("to IS NOT NULL")
        known = union(whole).unionByName(left)
    trees = union(whole)
    crooked = trees.where(~F.col("lone"))
    ranked = _ranked(crooked.select("row", "above"))
    told = ["id", F.lit(0).alias("kind"), "level", "root_row", "rank", "root"]
    walk = trees.where("lone").withColumn("rank", F.lit(0).cast("long")).select(*told).unionByName(crooked.join(ranked, "row").select(*told))
    rings = left.select("id", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("level"), F.lit(0).cast("long").alias("root_row"), F.col("row").alias("rank"), F.lit(None).cast(id_type).alias("root"))
    placed = keyed.where(~col(again)).select(*[col(c) for c in df.columns])
    kind, level, root_row, rank, root, id_ = unused(df, "kind", "level", "root_row", "rank", "root", "id")
    node = walk.unionByName(rings).select(F.col("id").alias(id_), F.col("kind").alias(kind), F.col("level").alias(level), F.col("root_row").alias(root_row), F.col("rank").alias(rank), F.col("root").alias(root))
    good = joined(placed, node, {id_col: id_})
    extra = keyed.where(col(again)).select(*[col(c) for c in df.columns]).unionByName(df.where(~usable))
    extra = also(extra, **{kind: F.lit(2), level: F.lit(None).cast("int"), root_row: F.lit(0).cast("long"), rank: F.lit(0).cast("long"), root: F.lit(None).cast(id_type)})
    (no,) = unused(good, "no")
    sorted_ = _in_order(good.unionByName(extra), [col(kind), col(level), col(root_row), col(rank), at], no, [*df.columns, kind, level, root])
    part = F.shiftright(col(no), 33)
    sizes = sorted_.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # a row a task
    before = sizes.select(F.col("part").alias("\0part"), F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("\0before"))
    out = sorted_.join(F.broadcast(before), part == col("\0part"))
    order = col("\0before") + col(no) - part * (1 << 33)
    return out.select(*[col(c) for c in df.columns], order.alias("order"), col(level).alias("level"), col(root).alias("root"), (col(kind) == 2).alias("is_extra")), missing


def _ranked(rows: DataFrame) -> DataFrame:
    """(row, above) without cycles -> (row, rank): rows equally far below one that isn't among them are ranked by their paths from there."""
    known = rows.join(rows.select(F.col("row").alias("above"), F.lit(True).alias("there")), "above", "left")
    known = save(known.select("row", F.when(F.col("there"), F.col("above")).alias("up"), F.col("row").alias("rank")), "tree-order")
    whole, left = [known.where("up IS NULL")], known.where("up IS NOT NULL")
    # a row's path is known below ``up``
    while not left.isEmpty():
        above = known.select(F.col("row").alias("up"), F.col("up").alias("next"), F.col("rank").alias("high"))
        moved = left.join(above, "up").select("row", F.col("next").alias("up"), "high", F.col("rank").alias("low"))
        ranked = _in_order(moved, [F.col("high"), F.col("low")], "rank", ["row", "up"])
        whole.append(ranked.where("up IS NULL"))
        left = ranked.where("up IS NOT NULL")
        known = union(whole).unionByName(left)
    return union(whole).select("row", "rank")


def cap(df: DataFrame, order: list[str | Column], n: int = 50) -> tuple[DataFrame, DataFrame]:
    """(first n rows in order, their total)."""
    return df.orderBy(*order).limit(n), df.agg(F.count(F.lit(1)).alias("total"))


def sample_rows(tables: Tables, k: int = 1) -> DataFrame:
    """(table, total, [doc_id,] rec_idx, row): the first k rows of each table as JSON, with the number of all. No tables: no rows."""
    found = []
    for name, df in tables.items():
        total = df.agg(F.count(F.lit(1)).alias("total"))
        rows = df.orderBy(*identity(df)).limit(k).select(*identity(df), F.to_json(F.struct("*")).alias("row"))
        found.append(rows.crossJoin(F.broadcast(total)).select(F.lit(name).alias("table"), "total", *identity(df), "row"))  # one row
    return union(found) if found else _nothing("table string, total long, rec_idx long, row string")
