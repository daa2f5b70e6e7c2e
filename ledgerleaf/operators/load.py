"""Normalising, validating and loading record tables; reconciling what was loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import all_of, also, col, identity, joined, place, save, side, sorted_side, unused
from ..functions.scalars import coerce, is_null_or_empty
from ..sources.store import Store, key_value
from ..specs import CITY_CHAIN, SPECS, TableSpec
from .quality import Tables, topo_sort, union

_TYPES = {"string": "string", "int": "int", "long": "bigint", "decimal": "decimal(38,12)", "date": "date", "timestamp": "timestamp_ntz", "uuid": "string", "json": "string"}


def normalize_columns(df: DataFrame, spec: TableSpec, drop_unknown: bool = False, raw: str = "raw") -> DataFrame:
    """JSON objects in ``raw`` -> the spec's columns as text, ``present`` (columns whose key is there), ``unknown`` keys and ``kinds`` (column -> JSON type).

    ``raw`` is parsed once. A key may be the column's name or its snake-case form; the column's name wins if both are
    there. What is no JSON object has ``present`` null. Columns with the names of added ones give way.
    """
    snake = {column: name for name, column in spec.aliases().items()}
    df = df.drop(*spec.columns, "present", "unknown", "kinds")
    # a generated column: later filters on its parts are not pushed below it, where they would parse again
    read = df.withColumn("_json", F.explode(F.array(F.from_json(raw, "map<string,variant>"))))
    value = lambda c: F.when(F.map_contains_key("_json", c), F.element_at("_json", c)).otherwise(F.element_at("_json", snake[c]))
    has = lambda c: F.map_contains_key("_json", c) | F.map_contains_key("_json", snake[c])
    text = {c: F.try_variant_get(value(c), "$", "string") for c in spec.columns}
    kinds = F.map_from_arrays(F.array(*[F.lit(c) for c in spec.columns]), F.array(*[F.regexp_extract(F.schema_of_variant(value(c)), "^[A-Z]+", 0) for c in spec.columns]))
    present = F.when(F.col("_json").isNotNull(), F.array_compact(F.array(*[F.when(has(c), c) for c in spec.columns])))
    known = F.array(*[F.lit(k) for c in spec.columns for k in dict.fromkeys((c, snake[c]))])
    unknown = F.array().cast("array<string>") if drop_unknown else F.coalesce(F.array_except(F.map_keys("_json"), known), F.array().cast("array<string>"))
    return read.withColumns({**text, "present": present, "unknown": unknown, "kinds": kinds}).drop("_json")


#: JSON types that a column of a kind may have.
_JSON = {"string": ("STRING",), "uuid": ("STRING",), "date": ("STRING", "BIGINT"), "timestamp": ("STRING", "BIGINT"), "json": None}
_NUMBER = ("STRING", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def validate(df: DataFrame, spec: TableSpec, mode: str = "validate", on_error: str = "continue") -> tuple[DataFrame, DataFrame]:
    """(valid rows, typed; errors (table, [doc_id,] rec_idx, field, type)). Wants the output of ``normalize_columns``.

    ``missing``: a required key is absent; ``null``: it is there but null or blank; ``type``: the value is no such value,
    also a number or an object where text belongs, and, with field null, a record that is no object; ``extra``: an unknown
    key. ``permissive`` drops unknown keys and keeps rows whose optional fields don't convert. ``on_error="stop"``: all
    errors are found before anything is returned, and the first by row and field is raised.
    """
    now, typed = df.withColumn("_object", F.col("present").isNotNull()), {}
    kind_of = lambda c: F.coalesce(F.element_at("kinds", c), F.lit("STRING")) if "kinds" in df.columns else F.lit("STRING")
    for c, (kind, _) in spec.columns.items():
        number = kind_of(c) == "BIGINT"
        typed[f"_t_{c}"] = coerce(F.col(c), kind, number if kind in ("date", "timestamp") else None).cast(_TYPES[kind])
    now = now.withColumns(typed)
    checks = []
    for c, (kind, required) in spec.columns.items():
        allowed = _JSON.get(kind, _NUMBER)
        fits = F.lit(True) if allowed is None else kind_of(c).isin(*allowed)
        blank = F.col(c).isNull() | (F.trim(F.col(c)) == "")
        wrong = F.when(~blank & (F.col(f"_t_{c}").isNull() | ~fits), "type") if required or mode == "validate" else F.lit(None)
        problem = F.when(~F.array_contains("present", c), "missing").when(blank, "null").otherwise(wrong) if required else wrong
        checks.append(F.when(problem.isNotNull(), F.struct(F.lit(c).alias("field"), problem.alias("type"))))
    found = F.array_compact(F.array(*checks))
    if mode == "validate":
        found = F.concat(found, F.transform("unknown", lambda k: F.struct(k.alias("field"), F.lit("extra").alias("type"))))
    no_object = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit("type").alias("type")))
    marked = now.withColumn("_errors", F.explode(F.array(F.when(F.col("_object"), found).otherwise(no_object))))
    errors = marked.select(F.lit(spec.name).alias("table"), *identity(df), F.explode("_errors").alias("e")).select("table", *identity(df), "e.field", "e.type")
    if on_error == "stop":
        first = errors.orderBy(*identity(df), "field").first()
        if first:
            raise ValueError(f"{first.table}[{first.rec_idx}] {first.field}: {first.type}")
    keep = [F.col(f"_t_{c}").alias(c) if c in spec.columns else F.col(f"`{c}`") for c in df.columns if c not in ("present", "unknown", "kinds")]
    return marked.where(F.size("_errors") == 0).select(*keep), errors


def fill_pk(df: DataFrame, pk: str, generated: str) -> DataFrame:
    """A null key becomes the generated one (a deterministic one, so that retries agree)."""
    return df.withColumn(pk, F.coalesce(pk, generated)).drop(generated)


def city_ids(tables: Tables) -> DataFrame:
    """All city ids over all tables that carry the column, each once; null and empty ones are none. No such table is an error."""
    return union([df.select(F.col("cityId").cast("string").alias("cityId")) for df in tables.values() if "cityId" in df.columns]).where(~is_null_or_empty(F.col("cityId"))).distinct()


def city_scope(tables: Tables, ids: DataFrame, specs: dict[str, TableSpec] = SPECS, chain: dict[str, tuple[str, str]] = CITY_CHAIN, city: str = "cityId") -> Tables:
    """Rows that belong to the cities in ``ids``: by their own city column, or by the row they refer to; tables of neither kind whole.

    Tables may come in any order. A table that belongs to cities through one that isn't there is empty, as is one on a
    ring of such references: none of its rows is known to belong.
    """
    out: Tables = {n: df.join(ids.select(city).distinct(), city, "left_semi") for n, df in tables.items() if city in df.columns}
    out |= {n: df for n, df in tables.items() if n not in out and n not in chain}
    pending = [n for n in tables if n not in out]
    while ready := [n for n in pending if chain[n][1] in out]:
        for name in ready:
            fk, parent = chain[name]
            out[name] = tables[name].join(out[parent].select(F.col(specs[parent].pk).alias(fk)).distinct(), fk, "left_semi")
        pending = [n for n in pending if n not in out]
    out |= {n: tables[n].limit(0) for n in pending}
    return {n: out[n] for n in tables}


def filter_city(tables: Tables, city_id: str, **more) -> Tables:
    """``city_scope`` of one city; rows of shared tables come once."""
    return city_scope(tables, SparkSession.active().createDataFrame([(city_id,)], "cityId string"), **more)


def gate_by_city(tables: Tables, bad: DataFrame, **more) -> Tables:
    """Tables without the cities in ``bad`` (cityId): any error of a city keeps all of it out."""
    good = city_ids(tables).join(bad.select("cityId").distinct(), "cityId", "left_anti")
    return city_scope(tables, good, **more)


def _lost(values: DataFrame, parents: DataFrame | None, many: int, store: Store | None, target: str, pk: str, **at) -> DataFrame:
    """Those of ``values`` (value) that neither an accepted parent, of which there are up to ``many``, nor one in the store has as its key."""
    asked = values.where("value IS NOT NULL").distinct()
    if parents is not None:
        asked = asked.join(sorted_side(parents.select(key_value([col(pk)]).alias("value")), many), "value", "left_anti")
    if store is not None:
        asked = save(asked, "values-asked")
        asked = asked.join(sorted_side(store.stored(target, (pk,), asked, **at), asked.count()), "value", "left_anti")
    return save(asked, "values-lost")


def _repeated(ids: DataFrame, key: str) -> DataFrame | None:
    """(key, first): values that several rows have, with their first row; none if there are none. Hashes tell first: most tables have no such value, or few."""
    keyed = ids.where(F.col(key).isNotNull())
    twice = save(keyed.groupBy(F.xxhash64(key).alias("h")).agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("h"), "hashes-repeated")
    few = twice.count()
    if not few:
        return None
    if 8 * few < ids.count():
        keyed = keyed.join(sorted_side(twice, few), F.xxhash64(key) == F.col("h"), "left_semi")
    found = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("many"), F.min(F.struct("at", "no")).alias("first"))
    return save(found.where("many > 1").drop("many"), "keys-repeated")


def _first_wins(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(no): of rows (no, at, keys) those that come in when they are inserted one by one: none of a row's keys may be held by one that came in before.

    Only rows that share a key take part. In a round, rows that are the first of all their keys come in, and rows that
    share a key with one of them are out; what is left goes on. One key needs one round, several a few.
    """
    inside, left = [], rows
    while True:
        mine = F.struct("at", "no")
        now, many = left, left.count()
        for k in keys:
            now = now.join(sorted_side(left.where(F.col(k).isNotNull()).groupBy(k).agg(F.min(mine).alias(f"first_{k}")), many), k, "left")
        wins = all_of([F.col(k).isNull() | (F.col(f"first_{k}") == mine) for k in keys])
        judged = save(now.select("no", "at", *keys, wins.alias("wins")), "rows-judged")
        won = judged.where("wins")
        inside.append(won.select("no"))
        if len(keys) == 1:  # all others share it with one of these
            return won.select("no")
        left = judged.where("NOT wins")
        for k in keys:
            left = left.join(sorted_side(won.where(F.col(k).isNotNull()).select(k), many), k, "left_anti")
        left = save(left.select("no", "at", *keys), "rows-left")
        if left.isEmpty():
            return union(inside)


def enforce_constraints(tables: Tables, specs: dict[str, TableSpec] = SPECS, store: Store | None = None, version: int | None = None, but: str | None = None) -> tuple[Tables, DataFrame]:
    """In load order, what a database takes when rows are inserted one by one; (accepted, rejected (table, [doc_id,] rec_idx, reason)).

    A row comes in if no required column is null, its references are among accepted parents, and neither its primary key nor
    one of its unique keys is held by a row that came in before, in the order of (doc_id, rec_idx) over all documents. Null
    parts of keys never clash, null references pass. With a ``store``, its rows (of all batches but ``but``) came in before
    and are parents too. The reason named is that of the first key an earlier row has, in or not, then of a reference.

    Rows are judged by their keys alone, which are saved once; whole rows only meet the list of the rejected. Null keys and
    references stay out of the joins. A reference to a table that is neither in ``tables`` nor in a store isn't checked. No
    tables: nothing accepted or rejected.
    """
    accepted: Tables = {}
    rejected, sizes = [], {}
    at = {"version": version, "but": but}
    for name in [n for n in specs if n in tables]:
        spec, given = specs[name], tables[name]
        (no,) = unused(given, "no")
        rows = save(also(given, **{no: F.monotonically_increasing_id()}), "rows")
        sizes[name] = rows.count()
        keys = {f"k{i}": key for i, key in enumerate([(spec.pk,), *spec.unique_keys]) if all(c in given.columns for c in key)}
        fks = {f"f{i}": fk for i, fk in enumerate(spec.fks) if fk.field in given.columns and (fk.target in accepted or fk.target == name or store is not None)}
        needed = [c for c, (_, required) in spec.columns.items() if required and c in given.columns and c != spec.pk]
        null = F.coalesce(F.when(col(spec.pk).isNull(), F.lit("null primary key")), *[F.when(col(c).isNull(), F.lit(f"null in {c}")) for c in needed])
        ids = rows.select(col(no).alias("no"), place(given).alias("at"), null.alias("hole"), *[key_value([col(c) for c in k]).alias(n) for n, k in keys.items()], *[key_value([col(fk.field)]).alias(n) for n, fk in fks.items()])
        lost = F.lit(None).cast("string")
        for n, fk in reversed(fks.items()):
            if fk.target != name:
                gone = _lost(ids.select(F.col(n).alias("value")), accepted.get(fk.target), sizes.get(fk.target, 0), store, fk.target, specs[fk.target].pk, **at)
                ids = joined(ids, side(gone).withColumn(f"{n}_lost", F.lit(True)), {n: "value"})
                lost = F.when(F.col(f"{n}_lost"), f"{fk.field} not in {fk.target}").otherwise(lost)
        ids = save(ids.select("no", "at", "hole", *keys, *fks, lost.alias("lost")), "row-keys")
        held, open_, clash = F.lit(None).cast("string"), F.col("hole").isNull() & F.col("lost").isNull(), F.lit(False)
        duplicate = {n: "duplicate primary key" if n == "k0" else "duplicate " + ",".join(k) for n, k in keys.items()}
        several = {n: _repeated(ids, n) for n in keys}
        repeated = [n for n in keys if several[n] is not None]  # rows meet the repeats of such keys only
        if store is not None:
            for n, key in keys.items():
                taken = save(store.stored(name, key, ids.select(F.col(n).alias("value")), **at), "keys-taken")
                ids = joined(ids, side(taken).withColumn(f"{n}_taken", F.lit(True)), {n: "value"})
                open_ = open_ & F.col(f"{n}_taken").isNull()
        for n in repeated:
            ids = joined(ids, side(several[n]).withColumnRenamed("first", f"{n}_first"), {n: n})
            clash = clash | F.col(f"{n}_first").isNotNull()
        for n in reversed(keys):
            earlier = F.col(f"{n}_first") < F.struct("at", "no") if n in repeated else F.lit(False)
            held = F.when(earlier | F.col(f"{n}_taken") if store is not None else earlier, duplicate[n]).otherwise(held)
        # rows that nothing is said against come in and are not moved again
        judged = save(ids.where(~open_ | clash).select("no", "at", *repeated, open_.alias("open"), F.coalesce("hole", held, "lost").alias("reason")), "rows-judged")
        clashing = judged.where("open").select("no", "at", *repeated)
        out = judged.select("no", "at", "reason")
        if repeated and not clashing.isEmpty():
            out = out.join(sorted_side(_first_wins(clashing, repeated), sizes[name]), "no", "left_anti")
        out = save(out, "rows-rejected")
        for fk in fks.values():
            if fk.target == name:
                kept = save(joined(rows, side(out), {no: "no"}, "left_anti"), "rows-unique")
                lonely = _lonely(kept, no, spec.pk, fk.field, lambda asked: _lost(asked, None, 0, store, name, spec.pk, **at))  # noqa: B023
                out = save(out.unionByName(lonely.select("no", "at", F.lit(f"{fk.field} not in {name}").alias("reason"))), "rows-rejected")
        accepted[name] = joined(rows, side(out), {no: "no"}, "left_anti").select(*[col(c) for c in given.columns])
        rejected.append(out.select(F.lit(name).alias("table"), *[F.col("at").getField(c).alias(c) for c in identity(given)], "reason"))
    return accepted, union(rejected) if rejected else SparkSession.active().createDataFrame([], "table string, rec_idx long, reason string")


def _lonely(df: DataFrame, no: str, pk: str, parent: str, lost) -> DataFrame:
    """(no, at): rows not all of whose ancestors are in the table (or, of the highest, in the store), up to one without a parent."""
    rows = df.select(col(no).alias("no"), place(df).alias("at"), col(pk).alias("id"), col(parent).alias("up"))
    ordered, missing = topo_sort(rows.select("no", "at", "id", "up", F.col("no").alias("rec_idx")), "id", "up")
    ordered = save(ordered, "trees")
    gone = lost(missing.select(key_value([F.col("missing_parent")]).alias("value")))
    bad = ordered.where("level = 0 AND up IS NOT NULL").withColumn("value", key_value([F.col("up")])).join(gone, "value", "left_semi").select(F.col("id").alias("root"))
    return ordered.where("level IS NULL AND NOT is_extra").unionByName(ordered.where("level IS NOT NULL").join(bad, "root", "left_semi").select(*ordered.columns)).select("no", "at")


def with_city(tables: Tables, specs: dict[str, TableSpec] = SPECS, chain: dict[str, tuple[str, str]] = CITY_CHAIN, city: str = "cityId", name: str = "city") -> Tables:
    """Tables with the city of each row in ``name``: their own, or that of the row they refer to; null for tables of neither kind and rows that refer to nothing."""
    out: Tables = {n: also(df, **{name: col(city).cast("string")}) for n, df in tables.items() if city in df.columns}
    out |= {n: also(df, **{name: F.lit(None).cast("string")}) for n, df in tables.items() if n not in out and (n not in chain or chain[n][1] not in tables)}
    pending = [n for n in tables if n not in out]
    while ready := [n for n in pending if chain[n][1] in out]:
        for n in ready:
            fk, parent = chain[n]
            up = out[parent].where(col(name).isNotNull()).select(col(specs[parent].pk).alias("k"), col(name)).dropDuplicates(["k"])
            out[n] = joined(tables[n], up, {fk: "k"})
        pending = [n for n in pending if n not in out]
    return out | {n: also(tables[n], **{name: F.lit(None).cast("string")}) for n in pending}


def load_batch(store: Store, batch: str, tables: Tables, mode: str = "each", errors: DataFrame | None = None, chain: dict[str, tuple[str, str]] = CITY_CHAIN, city: str = "cityId") -> tuple[int | None, DataFrame]:
    """Loads a batch into a store, checked against what it holds; (version, rejected (table, [doc_id,] rec_idx, reason)).

    ``each``: every row that meets the constraints comes in. ``atomic``: all rows or, if one is rejected or ``errors`` has
    a row, none. ``city``: a city with a rejected row, or one in ``errors`` (cityId), stays out as a whole and the others
    come in; rows without a city are judged each. Without the cities that stay out the others are checked again, until no
    other is hit; of two cities in each other's way that of the earlier row stands, and if it is out for another reason,
    both are. A batch of a name that is there replaces it, and its own
    earlier rows don't count against it. Nothing is published if nothing comes in (version none), or if a check fails;
    another batch published meanwhile that touched the tables looked at is ``Conflict``: call again.
    """
    seen, specs = store.version(), store.specs
    read = sorted({n for n in specs if n in tables} | {fk.target for n in tables for fk in specs[n].fks})
    check = lambda t: enforce_constraints(t, specs, store, seen, batch)
    if mode != "city":
        good, bad = check(tables)
        bad = save(bad, "rejected")
        if mode == "atomic" and not (bad.isEmpty() and (errors is None or errors.isEmpty())):
            return None, bad
    else:
        named = {n: save(df, "rows-with-city") for n, df in with_city(tables, specs, chain, city, "\0city").items()}
        nobody = store.spark.createDataFrame([], "c string")
        out = nobody if errors is None else errors.select(F.col("cityId").cast("string").alias("c")).distinct()
        said: list[DataFrame] = []
        while True:
            good, bad = check({n: joined(df, out, {"\0city": "c"}, "left_anti") for n, df in named.items()})
            bad = save(bad, "rejected")
            said.append(bad)
            hit = union([joined(df, bad.where(F.col("table") == n).select(*identity(df)), {c: c for c in identity(df)}, "left_semi").select(col("\0city").alias("c")) for n, df in named.items()])
            hit = save(hit.where("c IS NOT NULL").distinct(), "cities-hit")
            if hit.isEmpty():
                break
            out = save(out.unionByName(hit).distinct(), "cities-out")
        good, bad = {n: df.drop("\0city") for n, df in good.items()}, union(said).distinct()
    if all(df.isEmpty() for df in good.values()) and batch not in store.batches(seen):
        return None, bad
    return store.commit(batch, store.write(batch, good), seen, read), bad


def load_tables(tables: Tables, specs: dict[str, TableSpec], target: str, fmt: str = "parquet", batch: str | None = None) -> None:
    """Adds rows that were accepted to ``target``, parents first.

    With ``batch`` a load is a transaction of a ``Store`` in that folder: all tables appear in one step, a repeated batch
    replaces its rows in one step, and a run that fails leaves what was there. Constraints are not looked at (``load_batch``
    does). Without one rows are appended to ``target``/<table>, and a repeated run adds them again.
    """
    if batch is None:
        for name in [n for n in specs if n in tables]:
            tables[name].write.mode("append").format(fmt).save(f"{target}/{name}")
    else:
        store = Store(SparkSession.active(), target, specs)
        store.commit(batch, store.write(batch, tables), store.version(), [])


def read_loaded(spark: SparkSession, target: str, name: str) -> DataFrame:
    """Rows of a table whose batches were loaded as a whole; ``batch`` tells which."""
    found = Store(spark, target).read(name)
    if found is None:
        raise ValueError(f"{target} holds no rows of {name}")
    return found


def load_report(counts: DataFrame, errors: DataFrame, limit: int = 50) -> DataFrame:
    """counts (table, loaded, validated, inserted) and errors (table, [doc_id,] rec_idx, ...) -> the counts with failed (events), failed_rows and truncated. A table without errors has 0 of both."""
    row = F.when(F.col("rec_idx").isNotNull(), F.struct(*identity(errors)))
    per = errors.groupBy("table").agg(F.count(F.lit(1)).alias("failed"), F.countDistinct(row).alias("failed_rows"))
    out = counts.join(per, "table", "left").na.fill(0, ["failed", "failed_rows"])
    return out.withColumn("truncated", F.col("failed") > limit)


def missing_fields(errors: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` fields most often missing; ties by name; none if nothing is missing."""
    return errors.where(F.col("type") == "missing").groupBy("field").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "field").limit(top)


def id_sets(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """(id, side): matched, missing (in a only) or extra (in b only), each id once; null ids are none."""
    left, right = (x.select(F.col(id_col).cast("string").alias("id")).where("id IS NOT NULL").distinct() for x in (a, b))
    joined = left.withColumn("_a", F.lit(True)).join(right.withColumn("_b", F.lit(True)), "id", "full_outer")
    return joined.select("id", F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").otherwise("matched").alias("side"))


def reconcile(source: Tables, target: Tables, specs: dict[str, TableSpec] = SPECS, shared: tuple[str, ...] = (), cities: DataFrame | None = None, city: str = "cityId") -> DataFrame:
    """(table, source_count, target_count, matched, missing, extra, ok, shared) by table in both; ok: nothing missing.

    ``cities`` (cityId): tables with a city column are compared for these cities only; tables without one, whole. Ids
    count once; null ids don't count; a table without ids has all counts 0 and is ok.
    """
    found = []
    for n in [n for n in source if n in target]:
        sides = [df.join(cities.select(city).distinct(), city, "left_semi") if cities is not None and city in df.columns else df for df in (source[n], target[n])]
        counts = [F.count_if(F.col("side") == s).alias(s) for s in ("matched", "missing", "extra")]
        found.append(id_sets(*sides, specs[n].pk).agg(*counts).select(F.lit(n).alias("table"), "*"))
    if not found:
        return SparkSession.active().createDataFrame([], "table string, source_count long, target_count long, matched long, missing long, extra long, ok boolean, shared boolean")
    per = union(found)
    return per.select("table", (F.col("matched") + F.col("missing")).alias("source_count"), (F.col("matched") + F.col("extra")).alias("target_count"), "matched", "missing", "extra", (F.col("missing") == 0).alias("ok"), F.col("table").isin(*shared).alias("shared") if shared else F.lit(False).alias("shared"))


def reconcile_store(source: Tables, store: Store, shared: tuple[str, ...] = (), version: int | None = None) -> DataFrame:
    """``reconcile`` of tables with a store by its digests: (table, source_count, target_count, matched, missing, extra, ok, shared, compared).

    Ids are read only for ranges whose digests differ; ``compared`` tells how many of the store's. Ids count once; null
    ids don't count; a table the store doesn't have is missing as a whole.
    """
    found = [store.differences(n, df, version).select(F.lit(n).alias("table"), "*") for n, df in source.items()]
    if not found:
        return SparkSession.active().createDataFrame([], "table string, source_count long, target_count long, matched long, missing long, extra long, ok boolean, shared boolean, compared long")
    per = union(found)
    return per.select("table", (F.col("matched") + F.col("missing")).alias("source_count"), (F.col("matched") + F.col("extra")).alias("target_count"), "matched", "missing", "extra", (F.col("missing") == 0).alias("ok"), F.col("table").isin(*shared).alias("shared") if shared else F.lit(False).alias("shared"), "compared")
