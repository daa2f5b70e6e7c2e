"""Deduplication, deterministic keys and rewriting of references.

Rows are ordered by (doc_id, rec_idx), so "first" means the same however many documents a table holds. No column of these
operators clashes with the caller's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import also, col, joined, numbered, place, replaced, save, unused
from ..functions.scalars import class_namespace, is_placeholder_uuid, is_uuid, uuid5
from ..specs import SPECS, TableSpec
from .quality import Tables, union


def dedupe_records(new: DataFrame, stored: DataFrame | None, key: str = "content_key") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): a record whose content key is stored already or was seen in an earlier row, of any document, is rejected.

    Only keys and places are shuffled before the joins; the least row of a key is combined first, so a key of very many
    rows is no single group. Rows with a null key are all kept; rows with one key and one place count as one row and stay
    or go together.
    """
    first, seen, mine = unused(new, "first", "seen", "key")
    whole = new.where(col(key).isNotNull())
    least = whole.groupBy(col(key).alias(mine)).agg(F.min(place(new)).alias(first))
    if stored is not None:
        least = joined(least, stored.select(col(key).alias("k")).distinct().withColumn(seen, F.lit(True)), {mine: "k"})
    else:
        least = also(least, **{seen: F.lit(None).cast("boolean")})
    marked = joined(whole, least, {key: mine}, "inner")
    again = col(seen).isNotNull() | (place(new) > col(first))
    own = [col(c) for c in new.columns]
    return marked.where(~again).select(*own).unionByName(new.where(col(key).isNull())), marked.where(again).select(*own)


def _salted(seed: Column, n: Column, first_salt: int) -> Column:
    """The n-th try of a seed: bare at first, then with ``first_salt`` and on."""
    return F.when(n == 1, seed).otherwise(F.concat(seed, F.lit("|"), (n - 2 + first_salt).cast("string")))


def _with_repeats(df: DataFrame, key: str, again: str) -> DataFrame:
    """Adds ``again``: an earlier row has the same key. Rows without a key, which may be most, meet in no group and have none."""
    mine, first = unused(df, "key", "first")
    keyed = df.where(col(key).isNotNull())
    least = keyed.groupBy(col(key).alias(mine)).agg(F.min(place(df)).alias(first))
    marked = joined(keyed, least, {key: mine}, "inner").select(*[col(c) for c in df.columns], (place(df) > col(first)).alias(again))
    return marked.unionByName(also(df.where(col(key).isNull()), **{again: F.lit(False)}))


def _free_keys(todo: DataFrame, seed: str, taken: DataFrame, name: Callable[[Column, Column], Column], new: str) -> DataFrame:
    """``todo`` with a key in ``new`` that is not in ``taken`` (k, each once): the j-th row of a seed gets the j-th of the seed's keys that is free.

    Keys of different seeds differ. First every row tries the key of its number; a seed that misses keys tries as many
    further ones, in rounds, to a fixpoint. Tries travel as seed, number and a hash of the key; where hashes meet, the keys
    decide. Rows learn the numbers of their keys only where those are not their own. A null seed has a null key.
    """
    at, mine, no, to = unused(todo, "try", "key", "no", "to")
    own = [col(c) for c in todo.columns]
    s, t, count = F.col("s"), F.col("t"), F.count(F.lit(1)).alias("n")
    tried = save(numbered(todo, seed, at), "rows-numbered")
    tries = tried.where(col(seed).isNotNull()).select(col(seed).alias("s"), col(at).alias("t"))
    held = taken.select(F.xxhash64("k").alias("h"), "k")
    key = lambda n: F.when(col(seed).isNotNull(), name(col(seed), n)).alias(new)

    def missed(tries: DataFrame) -> DataFrame:
        met = save(tries.select("s", "t", F.xxhash64(name(s, t)).alias("h")).join(held, "h").select("s", "t", "k"), "keys-met")
        return met.where(name(s, t) == F.col("k")).select("s", "t")

    misses = [missed(tries)]
    if misses[0].isEmpty():
        return tried.select(*own, key(col(at)))
    short = joined(misses[0].groupBy("s").agg(count), tries.groupBy("s").agg(F.max("t").alias("m")), {"s": "s"}, "inner")
    seeds = reach = save(short.select("s", "m", F.col("m").alias("l"), "n"), "seeds-short")
    while True:
        more = missed(reach.select("s", F.explode(F.sequence(F.col("l") + 1, F.col("l") + F.col("n"))).alias("t")))
        if more.isEmpty():
            break
        misses.append(more)
        reach = save(joined(more.groupBy("s").agg(count), reach.select("s", "m", (F.col("l") + F.col("n")).alias("l")), {"s": "s"}, "inner").select("s", "m", "l", "n"), "seeds-short")
    missing = reduce(DataFrame.unionByName, misses)
    last = joined(seeds.select("s", "m"), missing.groupBy("s").agg(count), {"s": "s"}, "inner")
    free = save(joined(last.select("s", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m") + F.col("n"))).alias("t")), missing, {"s": "s", "t": "t"}, "left_anti"), "keys-free")
    ranked = numbered(free.select("s", t.alias("rec_idx")), "s", "j").where("rec_idx <> j").select(s.alias(mine), F.col("j").alias(no), F.col("rec_idx").alias(to))
    return joined(tried, ranked, {seed: mine, at: no}).select(*own, key(F.coalesce(col(to), col(at))))


def assign_pk(df: DataFrame, table: str, pk: str, seed: str = "seed", existing: DataFrame | None = None) -> DataFrame:
    """Missing, malformed, placeholder or repeated keys, and those in ``existing`` (pk), become the UUID of the record's seed, salted from 2 on until it is free.

    Free means: not in ``existing``, not a good key of another row, not given to an earlier row; so keys are unique
    afterwards, also when a second run finds its own keys in ``existing``. Rows of one seed are copies; the k-th starts with
    the k-th salt. Rows with a null seed and a bad key get a null key; of rows with a null identity any may be first.
    """
    again, old, bad, new = unused(df, "again", "old", "bad", "new")
    marked = _with_repeats(df, pk, again)
    wrong = ~is_uuid(col(pk)) | is_placeholder_uuid(col(pk)) | col(again)
    if existing is not None:
        marked = joined(marked, existing.select(col(pk).cast("string").alias("k")).distinct().withColumn(old, F.lit(True)), {pk: "k"})
        wrong = wrong | col(old).isNotNull()
    own = [col(c) for c in df.columns]
    marked = save(marked.select(*own, F.coalesce(wrong, F.lit(True)).alias(bad)), "keys-marked")
    good = marked.where(~col(bad))
    taken = good.select(col(pk).cast("string").alias("k"))
    if existing is not None:
        taken = taken.unionByName(existing.select(col(pk).cast("string").alias("k")).where("k IS NOT NULL").distinct())
    given = _free_keys(marked.where(col(bad)).select(*own), seed, taken, lambda s, n: uuid5(class_namespace(table), F.concat(_salted(s, n, 2), F.lit(pk))), new)
    return good.select(*own).unionByName(replaced(given, pk, col(new)).select(*own))


def rewrite_pk(df: DataFrame, table: str, pk: str, seed: str = "seed", target_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """New deterministic keys for all rows, or for rows with target ids (pk) and repeats; (rows, old -> new map, the last row of an old key wins).

    A new key is none that the table had, stays in it or was given before: its salt, from 1 on, is counted up until it is
    free. Without target ids, a row whose key is among the first m of its seed, which m rows share, keeps it, so a second
    run changes nothing. Rows without a key get one, unless target ids are named.
    """
    again, hit, turn, new = unused(df, "again", "hit", "turn", "new")
    space = uuid.uuid5(uuid.UUID(int=0), f"rewrite:{table}")
    key_of = lambda s, n: uuid5(space, _salted(s, n, 1))
    own = [col(c) for c in df.columns]
    marked = _with_repeats(df, pk, again)
    if target_ids is None:
        seeds = marked.groupBy(col(seed).alias("s")).agg(F.count(F.lit(1)).alias("m"))
        tries = seeds.where("s IS NOT NULL").select(F.explode(F.sequence(F.lit(1), F.col("m"))).alias("n"), "s").select("s", key_of(F.col("s"), F.col("n")).alias("k")).withColumn(hit, F.lit(True))
        marked = joined(marked, tries, {seed: "s", pk: "k"})
        chosen = F.coalesce(col(again) | col(hit).isNull(), F.lit(True))
    else:
        marked = joined(marked, target_ids.select(col(pk).alias("k")).distinct().withColumn(hit, F.lit(True)), {pk: "k"})
        chosen = col(hit).isNotNull() | col(again)
    marked = save(marked.select(*own, chosen.alias(turn)), "keys-marked")
    taken = marked.where(col(pk).isNotNull()).select(col(pk).cast("string").alias("k")).distinct()
    given = save(_free_keys(marked.where(col(turn)).select(*own), seed, taken, key_of, new), "keys-rewritten")
    ids = given.where(col(pk).isNotNull()).groupBy(col(pk).alias("old_id")).agg(F.max_by(col(new), place(df)).alias("new_id"))
    return marked.where(~col(turn)).select(*own).unionByName(replaced(given, pk, col(new)).select(*own)), ids


def cascade_fk(tables: Tables, id_maps: Tables, specs: dict[str, TableSpec] = SPECS) -> tuple[Tables, DataFrame]:
    """References follow (old_id -> new_id) maps by target table; (tables, (table, field, changed)).

    Null references stay out of the joins. Without a reference to any of the maps the tables stay and the report is empty.
    """
    out, counts = {}, []
    for name, df in tables.items():
        for fk in specs[name].fks:
            if fk.target not in id_maps or fk.field not in df.columns:
                continue
            columns = [col(c) for c in df.columns]
            (new,) = unused(df, "new")
            both = joined(df.where(col(fk.field).isNotNull()), id_maps[fk.target].select("old_id", col("new_id").alias(new)), {fk.field: "old_id"})
            changed = col(new).isNotNull() & (col(new) != col(fk.field))
            counts.append(both.agg(F.count_if(changed).alias("changed")).select(F.lit(name).alias("table"), F.lit(fk.field).alias("field"), "changed"))
            df = replaced(both, fk.field, F.coalesce(col(new), col(fk.field))).select(*columns).unionByName(df.where(col(fk.field).isNull()))
        out[name] = df
    return out, union(counts) if counts else SparkSession.active().createDataFrame([], "table string, field string, changed long")


def absent_ids(requested: DataFrame, df: DataFrame, id_col: str) -> DataFrame:
    """Requested ids that a table doesn't have."""
    return joined(requested.select(col(id_col)).distinct(), df.select(col(id_col)), {id_col: id_col}, "left_anti")
