"""Clearing, summarising and linking references."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..frames import all_of, also, col, identity, joined, numbered, replaced, save, unused, without
from ..functions.scalars import class_namespace, is_blank, is_null_or_empty, is_placeholder_uuid, is_uuid, uuid5
from ..specs import SPECS, TableSpec
from .quality import Tables, union


def clear_fields(df: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with the fields set to null, (cleared): how many values were not null). Fields that aren't columns are passed over; an empty table has cleared 0."""
    own = [f for f in fields if f in df.columns]
    cleared = sum((F.coalesce(F.count_if(F.col(f).isNotNull()), F.lit(0)) for f in own), F.lit(0).cast("long"))
    return df.withColumns({f: F.lit(None).cast(df.schema[f].dataType) for f in own}), df.agg(cleared.alias("cleared"))


def summarise(df: DataFrame, fields: list[str], feedback: DataFrame | None = None) -> DataFrame:
    """([doc_id,] rec_idx, summary): listed fields that are present as JSON, ``misc`` if it is not empty, ``mapping_feedback`` if given as ([doc_id,] rec_idx, feedback). Null fields are left out; a row with several feedbacks gives a row for each."""
    cols = [col(f) for f in fields if f in df.columns and f != "misc"]
    if "misc" in df.columns:
        cols.append(F.when(~F.coalesce(F.trim("misc").isin("", "{}", "null"), F.lit(True)), F.col("misc")).alias("misc"))
    own = identity(df)
    if feedback is not None:
        (said,) = unused(df, "said")
        keys = [c for c in own if c in feedback.columns]
        df = joined(df, feedback.select(*keys, F.col("feedback").alias(said)), {c: c for c in keys})
        cols.append(col(said).alias("mapping_feedback"))
    return df.select(*own, F.to_json(F.struct(*cols)).alias("summary"))


def build_options(df: DataFrame, id_col: str, labels: list[str], with_index: bool = False, by: str = "doc_id") -> DataFrame:
    """(by, id, label, index): rows with an id and a label ``k=v | k=v`` of their non-empty columns; index counts from 1 in each ``by``, in the order of rows.

    Rows with a null or empty id are no options; a row without any label keeps an empty one; repeated ids stay options each.
    """
    parts = [F.when(~is_null_or_empty(col(c)), F.concat(F.lit(f"{c}="), col(c).cast("string"))) for c in labels]
    rows = df.where(~is_null_or_empty(col(id_col)))
    out = rows.select(*dict.fromkeys([by, *identity(df)]), col(id_col).cast("string").alias("id"), F.concat_ws(" | ", *parts).alias("label"))
    if with_index:
        out = numbered(out, by, "index").withColumn("index", F.col("index").cast("int"))
    return out.select(by, "id", "label", *["index"] * with_index)


def fill_default(df: DataFrame, col: str, default: str, marker: str, misc: str = "misc") -> tuple[DataFrame, DataFrame]:
    """Blank values become ``default`` and the map ``misc`` gets ``marker = 'default'`` unless it has one; (rows, (filled))."""
    blank = is_blank(F.col(col))
    base = F.coalesce(F.col(misc), F.create_map().cast("map<string,string>"))
    marked = F.when(F.map_contains_key(base, marker), base).otherwise(F.map_concat(base, F.create_map(F.lit(marker), F.lit("default"))))
    return df.withColumns({col: F.when(blank, default).otherwise(F.col(col)), misc: F.when(blank, marked).otherwise(F.col(misc))}), df.agg(F.count_if(blank).alias("filled"))


def make_batches(df: DataFrame, size: int = 15, by: str = "doc_id") -> DataFrame:
    """Adds batch_no and batch_idx: consecutive groups of ``size`` rows of each ``by``, in the order of (doc_id, rec_idx); rows of a null ``by`` form batches of their own. Columns of these names give way."""
    df = without(df, ["batch_no", "batch_idx"])
    (at,) = unused(df, "at")
    out = numbered(df, by, at)
    return out.select(*[col(c) for c in df.columns], F.floor((col(at) - 1) / size).cast("int").alias("batch_no"), ((col(at) - 1) % size).cast("int").alias("batch_idx"))


def canonical_city(cities: DataFrame, runs: DataFrame) -> DataFrame:
    """One city a run: its first row; a usable id stays, else it is derived from name, country and locode; a run without a row gets an id derived from three nulls. A run named twice counts once."""
    kept = [c for c in cities.columns if c not in ("doc_id", "rec_idx")]
    first = cities.groupBy("doc_id").agg(F.min_by(F.struct(*[col(c) for c in kept]), F.struct("rec_idx", *[col(c) for c in kept])).alias("\0row"))
    first = first.select("doc_id", *[col("\0row").getField(c).alias(c) for c in kept])
    parts = [F.coalesce(F.to_json(F.array(F.col(c))), F.lit("[null]")) for c in ("cityName", "country", "locode")]
    name = F.concat(*[x for p in zip((F.lit('{"cityName": '), F.lit(', "country": '), F.lit(', "locode": ')), (F.regexp_replace(p, r"^\[|\]$", "") for p in parts)) for x in p], F.lit("}"))
    usable = is_uuid(F.col("cityId")) & ~is_placeholder_uuid(F.col("cityId"))
    both = runs.select("doc_id").distinct().join(first, "doc_id", "left")
    return replaced(both, "cityId", F.when(usable, F.col("cityId")).otherwise(uuid5(class_namespace("City"), name)))


def apply_city(df: DataFrame, city: DataFrame) -> DataFrame:
    """Each row's cityId becomes its run's; ``changed`` tells where it was another. The join is Spark's choice: a city table is small, not bounded. A column named ``changed`` gives way."""
    df = without(df, ["changed"])
    (new,) = unused(df, "city")
    both = joined(df, city.select("doc_id", F.col("cityId").alias(new)), {"doc_id": "doc_id"})
    changed = col(new).isNotNull() & ~col(new).eqNullSafe(F.col("cityId"))
    return both.select(*[F.coalesce(col(new), F.col("cityId")).alias(c) if c == "cityId" else col(c) for c in df.columns], changed.alias("changed"))


def city_mismatch(tables: Tables, city: DataFrame) -> DataFrame:
    """(table, mismatches): rows whose cityId is not their run's. No tables: no rows."""
    found = [apply_city(df, city).agg(F.count_if("changed").alias("mismatches")).select(F.lit(n).alias("table"), "mismatches") for n, df in tables.items()]
    return union(found) if found else SparkSession.active().createDataFrame([], "table string, mismatches long")


_CHOICE = "array<map<string,string>>"
_ENTRY = f"struct<record_index:string,selections:{_CHOICE}>"


def _entries(response: Column) -> Column:
    """The answers of one response as (record_index, selections), whatever its shape.

    ``batch_results`` (or ``results``, or the response itself) is a list of answers, one answer, or a map from record
    numbers to answers; a response that only has ``selections`` answers for record 0. Anything else has no answers.
    """
    text = F.trim(response)
    inner = F.coalesce(F.get_json_object(text, "$.batch_results"), F.get_json_object(text, "$.results"))
    body = F.trim(F.coalesce(inner, F.when(text.startswith("["), text)))
    keys = F.json_object_keys(body)
    single = F.array_contains(keys, "record_index") | F.array_contains(keys, "selections")
    keyed = F.transform(
        F.map_entries(F.from_json(body, "map<string,string>")),
        lambda e: F.struct(F.coalesce(F.get_json_object(e["value"], "$.record_index"), e["key"]).alias("record_index"), F.from_json(F.get_json_object(e["value"], "$.selections"), _CHOICE).alias("selections")),
    )
    bare = F.when(inner.isNull() & F.array_contains(F.json_object_keys(text), "selections"), F.array(F.struct(F.lit("0").alias("record_index"), F.from_json(F.get_json_object(text, "$.selections"), _CHOICE).alias("selections"))))
    return F.when(body.startswith("["), F.from_json(body, f"array<{_ENTRY}>")).when(single, F.array(F.from_json(body, _ENTRY))).when(body.startswith("{"), keyed).otherwise(bare)


def apply_selections(records: DataFrame, responses: DataFrame, options: DataFrame, fields: list[str]) -> DataFrame:
    """Ids chosen for records (doc_id, batch_no, batch_idx): responses (doc_id, batch_no, response) in any of the shapes of ``_entries``; the last answer of a field counts.

    An ``id`` (also a null one) wins over an ``index``, which is looked up in options (doc_id, field, index, id); an index
    that isn't there says nothing. Fields without an answer become null; answers for records that aren't there, and
    answers that aren't whole numbers, are dropped. A broken response has no answers.
    """
    flat = responses.select("doc_id", "batch_no", F.posexplode(_entries(F.col("response"))).alias("p", "r"))
    flat = flat.select("doc_id", "batch_no", "p", F.col("r.record_index").try_cast("int").alias("batch_idx"), F.posexplode("r.selections").alias("q", "s")).where("batch_idx >= 0")
    said = flat.select("doc_id", "batch_no", "batch_idx", F.element_at("s", "field").alias("field"), F.struct("p", "q").alias("_at"), F.map_contains_key("s", "id").alias("_named"), F.element_at("s", "id").alias("_id"), F.element_at("s", "index").try_cast("int").alias("index"))
    known = options.select("doc_id", "field", "index", F.col("id").cast("string").alias("_opt"))
    looked = said.where("NOT _named").join(known, ["doc_id", "field", "index"])
    keys = ["doc_id", "batch_no", "batch_idx", "field"]
    both = said.where("_named").select(*keys, "_at", "_id").unionByName(looked.where("_opt IS NOT NULL").select(*keys, "_at", F.col("_opt").alias("_id")))
    last = both.where(F.col("field").isin(*fields)).groupBy(*keys).agg(F.max_by("_id", "_at").alias("_id"))
    chosen = last.groupBy("doc_id", "batch_no", "batch_idx").pivot("field", fields).agg(F.first("_id"))
    return records.drop(*fields).join(chosen, ["doc_id", "batch_no", "batch_idx"], "left")


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), r"(?U)[^\p{L}\p{N}]+"), lambda x: x != ""))


Scorer = Callable[[Column, Column, Column], Column]
PREFIX_FROM = 0.5  # least score from which looking at the rarest tokens alone saves more than ranking them costs


def _overlap(shared: Column, own: Column, option: Column) -> Column:
    return shared / (own + option - shared)


def _classes(df: DataFrame, keys: list[str], text: str) -> tuple[DataFrame, DataFrame]:
    """(rows (keys, c), sets (doc_id, c, s)): each set of tokens of a document once, with a number, and which row has which. Rows without a token are in neither."""
    each = df.select(*keys, F.array_sort(tokens(F.col(text))).alias("s")).where(F.size("s") > 0)
    sets = save(each.select("doc_id", "s").distinct().withColumn("c", F.monotonically_increasing_id()), "token-sets")
    return each.join(sets, ["doc_id", "s"]).select(*keys, "c"), sets


def _postings(sets: DataFrame, key: str, weights: DataFrame | None) -> DataFrame:
    """(doc_id, key, w, x, total): a row a token with its weight and the weight of all tokens of the set; ``key`` is the set's number."""
    each = sets.select("doc_id", F.col("c").alias(key), "s")
    if weights is None:
        return each.select("doc_id", key, F.size("s").cast("double").alias("total"), F.explode("s").alias("w")).withColumn("x", F.lit(1.0))
    flat = each.select("doc_id", key, F.explode("s").alias("w")).join(weights, ["doc_id", "w"], "left").withColumn("x", F.coalesce("x", F.lit(0.0)))
    return flat.join(flat.groupBy(key).agg(F.sum("x").alias("total")), key)


def idf(options: DataFrame) -> DataFrame:
    """(doc_id, w, x): a token's weight, the logarithm of how few of the document's options have it, plus one."""
    each = options.select("doc_id", "id", F.explode(tokens(F.col("label"))).alias("w")).distinct()
    many = each.groupBy("doc_id").agg(F.countDistinct("id").alias("of"))
    return each.groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n")).join(many, "doc_id").select("doc_id", "w", (F.log(F.col("of") / F.col("n")) + 1).alias("x"))


def _set_scores(own: DataFrame, opts: DataFrame, min_score: float, scorer: Scorer | None = None, weights: DataFrame | None = None) -> DataFrame:
    """(r, o, score): sets of records and of options of one document that share a token and reach the score."""
    mine, theirs = _postings(own, "r", weights), _postings(opts, "o", weights)
    other = theirs.select("doc_id", "o", "w", F.col("total").alias("of"))
    if scorer is None and weights is None and min_score >= PREFIX_FROM:
        pairs = _rarest(mine, "r", theirs, min_score).join(_rarest(theirs, "o", theirs, min_score), ["doc_id", "w"]).select("r", "o").distinct()
        both = pairs.join(mine.select("r", "w", "x", "total"), "r").join(other.drop("doc_id"), ["o", "w"])
    else:
        both = mine.join(other, ["doc_id", "w"])
    sums = both.groupBy("r", "o").agg(F.sum("x").alias("shared"), F.first("total").alias("total"), F.first("of").alias("of"))
    return sums.select("r", "o", (scorer or _overlap)(F.col("shared"), F.col("total"), F.col("of")).alias("score")).where(F.col("score") >= min_score)


class LinkSets(NamedTuple):
    """Scores of records and options by their sets of tokens, each once: rows (doc_id, rec_idx, r), ids (doc_id, id, o), scores (doc_id, r, o, score)."""

    rows: DataFrame
    ids: DataFrame
    scores: DataFrame

    def pairs(self) -> DataFrame:
        """(doc_id, rec_idx, id, score): a row for each record and option, whose sets may be shared by many of either."""
        scored = self.rows.join(self.scores.drop("doc_id"), "r")
        return scored.join(self.ids.select("id", "o"), "o").groupBy("doc_id", "rec_idx", "id").agg(F.max("score").alias("score"))


def link_sets(records: DataFrame, options: DataFrame, min_score: float = 0.2, scorer: Scorer | None = None, weights: DataFrame | None = None) -> LinkSets:
    """``link_scores`` by sets of tokens: as many scores as different sets meet, however many records and options have them."""
    rows, own = _classes(records, ["doc_id", "rec_idx"], "text")
    ids, opts = _classes(options, ["doc_id", "id"], "label")
    scores = _set_scores(own, opts, min_score, scorer, weights).join(own.select("doc_id", F.col("c").alias("r")), "r").select("doc_id", "r", "o", "score")
    return LinkSets(rows.withColumnRenamed("c", "r"), ids.withColumnRenamed("c", "o"), scores)


def link_scores(records: DataFrame, options: DataFrame, min_score: float = 0.2, scorer: Scorer | None = None, weights: DataFrame | None = None) -> DataFrame:
    """(doc_id, rec_idx, id, score): all options of a record that share a token with it and reach the score.

    The score is shared weight over all weight of both, or ``scorer`` of (shared, record's, option's); a token weighs 1, or
    as ``weights`` (doc_id, w, x) say. Records, and options, with the same tokens are scored once. Postings of both sides
    carry their totals, so one join and one sum over the shared tokens give the score. Of several texts of a record, and
    several labels of an option, the best counts.
    """
    return link_sets(records, options, min_score, scorer, weights).pairs()


def _rarest(postings: DataFrame, key: str, options: DataFrame, min_score: float) -> DataFrame:
    """Of a set's n tokens all but the commonest ``ceil(min_score * n) - 1``: two sets that reach the score share one of these."""
    seen = options.groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n"))
    ranked = postings.join(seen, ["doc_id", "w"], "left").groupBy("doc_id", key).agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("w").alias("w")))).alias("s"))
    most = F.size("s") - F.ceil(F.size("s") * F.lit(min_score) - 1e-9).cast("int") + 1
    return ranked.select("doc_id", key, F.explode(F.slice("s", F.lit(1), most)).alias("e")).select("doc_id", key, "e.w")


def _linked(records: DataFrame, options: DataFrame, not_self: bool, best: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(doc_id, rec_idx, id, score): the best option of each record, found once for all records of the same tokens.

    ``best`` of (record sets (doc_id, c, s, but), option sets (doc_id, c, s, ids)) tells the best option of each set but one
    (r, id, score). Options of one set differ by their ids alone, so its least ids stand for it: one, or with ``not_self``
    two. There a set's best option is right for all its records but the one that is that option itself, which gets the
    best of the others.
    """
    keys = ["doc_id", "rec_idx"]
    rows, own = _classes(records, [*keys, *["own_id"] * not_self], "text")
    given, sets = _classes(options, ["doc_id", "id"], "label")
    least = given.groupBy("c").agg(F.min(F.struct("id")).alias("a"))
    if not_self:
        least = least.join(given.join(least, "c").where(~F.struct("id").eqNullSafe(F.col("a"))).groupBy("c").agg(F.min(F.struct("id")).alias("b")), "c", "left")
    opts = save(sets.join(least.select("c", F.array("a", *["b"] * not_self).alias("ids")), "c"), "option-sets")
    nobody = F.lit(None).cast(opts.schema["ids"].dataType.elementType)
    found = rows.join(save(best(own.withColumn("but", nobody), opts), "best-of-sets").withColumnRenamed("r", "c"), "c")
    if not_self:
        found = save(found, "links-with-own")
        mine = F.col("id").eqNullSafe(F.col("own_id"))
        itself = found.where(mine)
        again = own.join(itself.groupBy("c").agg(F.first(F.struct("id")).alias("but")), "c")
        others = itself.drop("id", "score").join(best(again, opts).withColumnRenamed("r", "c"), "c")
        found = found.where(~mine).unionByName(others)
    return found.groupBy(*keys).agg(F.min_by(F.struct("id", "score"), F.struct(-F.col("score"), F.col("id"))).alias("best")).select(*keys, "best.id", "best.score")


def _best_of(scored: DataFrame, own: DataFrame, opts: DataFrame) -> DataFrame:
    """(r, id, score) of scored sets (r, o, score): the best option that isn't the one to leave out; ties: the smaller id."""
    both = scored.join(own.select(F.col("c").alias("r"), "but"), "r").join(opts.select(F.col("c").alias("o"), "ids"), "o")
    first = both.select("r", "score", F.when(F.get("ids", F.lit(0)).eqNullSafe(F.col("but")), F.get("ids", F.lit(1))).otherwise(F.get("ids", F.lit(0))).alias("e")).where("e IS NOT NULL")
    best = first.groupBy("r").agg(F.min_by(F.struct("e.id", "score"), F.struct(-F.col("score"), F.col("e.id"))).alias("best"))
    return best.select("r", "best.id", "best.score")


def link_bounded(records: DataFrame, options: DataFrame, min_score: float = 0.2, scorer: Scorer | None = None, weights: DataFrame | None = None, not_self: bool = False) -> tuple[DataFrame, DataFrame]:
    """The best option of each record by score bounds: ((doc_id, rec_idx, id, score), candidates looked at by round (round, candidates)).

    ``scorer`` rises with the shared weight and falls with the option's. Records, and options, with the same tokens are
    looked at once. A record's tokens are ordered by how few options have them. An option that shares none of the first j
    tokens shares at most what is left, so its score is at most the
    scorer of that; once this bound is below the best score found, or below ``min_score``, the record is done and its
    commoner tokens meet nothing. Rounds take a record's first token, the next, the next two, the next four and so on; only
    records that are still open take part, so very common tokens meet few records. Equal to comparing all pairs that share
    a token; ties go to the smaller id.
    """
    looked: list[DataFrame] = []
    options = options.withColumn("id", F.col("id").cast("string"))
    found = _linked(records, options, not_self, lambda own, opts: _bounded(own, opts, min_score, scorer or _overlap, weights, looked))
    return found, union(looked)


def _bounded(own: DataFrame, sets: DataFrame, min_score: float, score: Scorer, weights: DataFrame | None, looked: list[DataFrame]) -> DataFrame:
    """``best`` for ``_linked`` in rounds, as ``link_bounded`` tells; what it looks at is added to ``looked``."""
    opts = save(_postings(sets, "o", weights).withColumnRenamed("total", "of"), "postings")
    seen = opts.groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n"))
    mine = _postings(own, "r", weights).join(seen, ["doc_id", "w"])  # tokens that no option has meet nothing
    listed = mine.groupBy("doc_id", "r", "total").agg(F.sort_array(F.collect_list(F.struct("n", "w", "x"))).alias("t"))
    listed = listed.withColumn("left", F.transform(F.sequence(F.lit(1), F.size("t")), lambda k: F.aggregate(F.slice("t", k, F.size("t")), F.lit(0.0), lambda a, e: a + e["x"])))
    open_ = save(listed.withColumn("best", F.lit(None).cast("struct<score:double,id:string>")), "records-open")
    done, start, span = [], 0, 1
    while True:
        part = open_.select("doc_id", "r", F.explode(F.slice("t", F.lit(start + 1), F.lit(span))).alias("e")).select("doc_id", "r", F.col("e.w").alias("w"))
        pairs = save(part.join(opts.select("doc_id", "w", "o", "of"), ["doc_id", "w"]).select("r", "o", "of").distinct(), "pairs")
        looked.append(pairs.agg(F.count(F.lit(1)).alias("candidates")).select(F.lit(len(looked)).alias("round"), "candidates"))
        each = open_.select("r", "total", F.explode("t").alias("e")).select("r", "total", F.col("e.w").alias("w"), F.col("e.x").alias("x"))
        shared = pairs.join(each, "r").join(opts.select("o", "w"), ["o", "w"], "left_semi")
        sums = shared.groupBy("r", "o", "of", "total").agg(F.sum("x").alias("shared")).select("r", "o", score(F.col("shared"), F.col("total"), F.col("of")).cast("double").alias("score"))
        found = _best_of(sums.where(F.col("score") >= min_score), own, sets).select("r", F.struct("score", "id").alias("new"))
        start, span = start + span, max(1, start + span)
        now = open_.join(found, "r", "left")
        better = F.col("best").isNull() | (F.col("new.score") > F.col("best.score")) | ((F.col("new.score") == F.col("best.score")) & (F.col("new.id") < F.col("best.id")))
        now = now.withColumn("best", F.when(F.col("new").isNotNull() & better, F.col("new")).otherwise(F.col("best"))).drop("new")
        rest = F.get("left", F.lit(start))
        bound = score(rest, F.col("total"), rest)
        more = F.coalesce((bound >= min_score) & (F.col("best").isNull() | (bound >= F.col("best.score"))), F.lit(False))
        judged = save(now.withColumn("more", more), "records-judged")
        done.append(judged.where("NOT more AND best IS NOT NULL").select("r", F.col("best.id").alias("id"), F.col("best.score").alias("score")))
        open_ = judged.where("more").drop("more")
        if open_.isEmpty():
            return union(done)


def link_fk(records: DataFrame, options: DataFrame, min_score: float = 0.2, scorer: Scorer | None = None, not_self: bool = False, weights: DataFrame | None = None) -> DataFrame:
    """records (doc_id, rec_idx, text[, own_id]) × options (doc_id, id, label) of one document -> the best id or null in ``linked_id``, with its ``score``.

    Scores as in ``link_scores``; ties go to the smaller id. ``not_self`` leaves out the record's own id. Records, and
    options, with the same tokens are compared once. With a scorer or
    weights of its own a record meets its options rarest token first and stops by bounds (``link_bounded``). Records without
    a token, or without a like option, have linked_id and score null. Columns of the added names give way.
    """
    records = without(records, ["linked_id", "score"])
    keys = ["doc_id", "rec_idx"]
    if scorer is not None or weights is not None:
        top = link_bounded(records, options, min_score, scorer, weights, not_self)[0]
    else:
        top = _linked(records, options, not_self, lambda own, opts: _best_of(_set_scores(own, opts, min_score), own, opts))
    return joined(records, top.select(*keys, F.col("id").alias("linked_id"), "score"), {c: c for c in keys})


def settle_links(candidates: DataFrame, held: DataFrame | None = None, group: tuple[str, ...] = (), rounds: int | None = None) -> DataFrame:
    """One record an option: candidates (doc_id, rec_idx, id, score[, group]) -> (doc_id, rec_idx, id, score, round), by deferred acceptance.

    Every record asks for its best option (ties: the smaller id); an option keeps the record of the best score (ties: the
    smaller (doc_id, rec_idx)) and the others ask for their next one, so no record and option would both rather have each
    other. An option is one for each value of the ``group`` columns; those in ``held`` (id[, group]) are taken for good. A
    record whose options are all gone is not returned. ``round``: in which a record asked for what it got. With ``rounds``
    records ask one option after another, at most so many rounds, and what an option keeps then stands. Else they pass over
    options that have a better record already, and of those that would ask for the same option of the same options of one
    score the j-th best asks for the j-th: the better ones want these too and leave it none before. The matching is the same, in far fewer rounds.
    """
    keys, slot = ["doc_id", "rec_idx"], ["id", *group]
    live = candidates if held is None else joined(candidates, held.select(*slot).distinct(), {c: c for c in slot}, "left_anti")
    # a record's options, of one document; those of one score are a level, and levels of the same options a block
    levels = live.groupBy(*keys, "score").agg(F.array_sort(F.collect_list(F.struct(*slot))).alias("s")).withColumn("size", F.size("s"))
    before = F.coalesce(F.sum("size").over(W.partitionBy(*keys).orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    levels = levels.withColumns({"before": before, "block": F.sha2(F.to_json("s"), 256)})
    ranked = levels.select(*keys, "score", "size", "before", "block", F.posexplode("s").alias("pos", "e"))
    ranked = save(ranked.select(*keys, *[F.col("e")[c].alias(c) for c in slot], "score", (F.col("before") + F.col("pos") + 1).alias("k"), "block", "pos", "size"), "choices")
    choice, likes = [*keys, *slot, "score", "k"], F.struct(-F.col("score"), *keys)

    def spread(first: DataFrame) -> DataFrame:
        """(doc_id, rec_idx, k): the options to ask for, where ``first`` are the first that may be free."""
        j = F.row_number().over(W.partitionBy("block", "pos").orderBy(likes))
        return first.select(*keys, (F.col("k") + F.least(j - 1, F.col("size") - F.col("pos"))).alias("k"))

    asks = ranked.where("k = 1")
    asking, kept, n = (asks if rounds is not None else ranked.join(spread(asks), [*keys, "k"])).select(*choice).withColumn("round", F.lit(1)), None, 0
    while True:
        n += 1
        both = asking if kept is None else kept.unionByName(asking)
        best = both.groupBy(*slot).agg(F.min_by(F.struct(*keys), likes).alias("who"))
        judged = save(joined(both, best, {c: c for c in slot}, "inner").withColumn("wins", F.struct(*keys) == F.col("who")).drop("who"), "choices-judged")
        kept = judged.where("wins").drop("wins")
        lost = judged.where("NOT wins").select(*keys, F.col("k").alias("asked"))
        if lost.isEmpty() or n == rounds:
            return kept.drop("k")
        if rounds is not None:
            asks = ranked.join(lost.select(*keys, (F.col("asked") + 1).alias("k")), [*keys, "k"])
        else:
            left = ranked.join(lost, keys).where("k > asked").drop("asked")
            left = joined(left, kept.select(*slot, likes.alias("holder")), {c: c for c in slot}).where(F.col("holder").isNull() | (likes < F.col("holder")))
            first = left.groupBy(*keys).agg(F.min_by(F.struct("k", "block", "pos", "size", "score"), "k").alias("f")).select(*keys, "f.*")
            asks = ranked.join(save(spread(first), "choices-next"), [*keys, "k"])
        asking = asks.select(*choice).withColumn("round", F.lit(n + 1))


def settle_sets(sets: LinkSets) -> DataFrame:
    """``settle_links`` of the sets' pairs, which are never made: (doc_id, rec_idx, id, score, round).

    Both sides rank by the same score, so the one stable matching settles score by score, best first: of those still free,
    each record in its order takes the smallest id of that score. A document is settled by one task, which holds its
    records, its options and the scores of its sets. ``round``: which of the document's scores it was. Where documents share
    ids, or rec_idx is no whole number, pairs are made.
    """
    shared = sets.ids.select("doc_id", "id").distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kinds = {c: sets.rows.schema[c].dataType.simpleString() for c in ("doc_id", "rec_idx")}
    if kinds["rec_idx"] not in ("bigint", "int", "smallint", "tinyint") or not shared.isEmpty():
        return settle_links(sets.pairs())
    none = lambda kind: F.lit(None).cast(kind)
    rows = sets.rows.select("doc_id", F.lit(0).alias("kind"), F.col("rec_idx").cast("long").alias("a"), F.col("r").alias("b"), none("string").alias("id"), none("double").alias("score"))
    ids = sets.ids.select("doc_id", F.lit(1), none("long"), "o", F.col("id").cast("string"), none("double"))
    scores = sets.scores.select("doc_id", F.lit(2), "r", "o", none("string"), F.col("score").cast("double"))
    settled = rows.union(ids).union(scores).groupBy("doc_id").applyInArrow(_settled, f"doc_id {kinds['doc_id']}, rec_idx long, id string, score double, round int")
    return settled.withColumn("rec_idx", F.col("rec_idx").cast(kinds["rec_idx"]))


def _settled(table: pa.Table) -> pa.Table:
    """A document's records, ids and scores -> who gets what."""
    kind = table.column("kind").to_numpy()
    records, options, scores = (table.filter(pa.array(kind == k)) for k in range(3))
    names = pc.unique(options.column("id").drop_null())
    names = names.take(pc.sort_indices(names))
    number = pc.index_in(options.column("id"), value_set=names).combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False)
    rec_idx, place = np.unique(records.column("a").to_numpy(), return_inverse=True)

    def lists(keys: np.ndarray, values: np.ndarray) -> dict[int, np.ndarray]:
        """The values of each key, in order and each once."""
        keys, values = np.unique(np.stack([keys, values]), axis=1) if len(keys) else (keys, values)
        heads = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1 if len(keys) else 0))
        return dict(zip(keys[heads].tolist(), np.split(values, heads[1:])))

    of_set = lists(records.column("b").to_numpy(), place)
    real = number >= 0
    ids_of = {o: own.tolist() for o, own in lists(options.column("b").to_numpy()[real], number[real]).items()}
    next_, taken = dict.fromkeys(ids_of, 0), bytearray(len(names))
    got, at_score, at_round = np.full(len(rec_idx), -1), np.zeros(len(rec_idx)), np.zeros(len(rec_idx), np.int32)

    def head(o: int) -> int:
        """The smallest free id of a set, or -1."""
        own, k = ids_of[o], next_[o]
        while k < len(own) and taken[own[k]]:
            k += 1
        next_[o] = k
        return own[k] if k < len(own) else -1

    def first(heap: list[tuple[int, int]]) -> int:
        """The smallest free id of a heap of sets, or -1; ids only go, so what it has is too small at most."""
        while heap:
            was, o = heap[0]
            now = head(o)
            if now == was:
                return now
            heapq.heapreplace(heap, (now, o)) if now >= 0 else heapq.heappop(heap)
        return -1

    r, o, score = (scores.column(c).to_numpy() for c in ("a", "b", "score"))
    order = np.argsort(-score, kind="stable")
    r, o, score = r[order], o[order], score[order]
    edges = np.append(np.flatnonzero(np.diff(score, prepend=np.inf)), len(score)) if len(score) else np.zeros(1, np.int64)
    for turn, (start, end) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist()), 1):
        heaps: dict[int, list[tuple[int, int]]] = {}
        for mine, other in zip(r[start:end].tolist(), o[start:end].tolist()):
            if mine in of_set and other in ids_of and (now := head(other)) >= 0:
                heaps.setdefault(mine, []).append((now, other))
        if not heaps:
            continue
        for heap in heaps.values():
            heapq.heapify(heap)
        who = np.concatenate([of_set[x] for x in heaps])
        sets = np.repeat(np.fromiter(heaps, np.int64, len(heaps)), [len(of_set[x]) for x in heaps])
        free = np.flatnonzero(got[who] < 0)
        free = free[np.argsort(who[free], kind="stable")]
        done, best = -1, -1
        for p, s in [*zip(who[free].tolist(), sets[free].tolist()), (-1, -1)]:
            if p != done:  # a record of several sets comes once a set
                if best >= 0:
                    taken[best], got[done], at_score[done], at_round[done] = 1, best, score[start], turn
                done, best = p, -1
            if p >= 0 and (now := first(heaps[s])) >= 0:
                best = now if best < 0 else min(best, now)
    has = np.flatnonzero(got >= 0)
    doc = table.column("doc_id")
    return pa.table({"doc_id": pa.array([doc[0].as_py()] * len(has), doc.type), "rec_idx": rec_idx[has], "id": names.take(pa.array(got[has])).cast(pa.string()), "score": at_score[has], "round": pa.array(at_round[has], pa.int32())})


def retry_links(records: DataFrame, field: str, candidates: DataFrame | LinkSets, targets: DataFrame, unique: tuple[str, ...] | None = None, rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Links rows anew whose reference is bad; (rows, changes (doc_id, rec_idx, old, new, round)).

    Bad are rows whose ``field`` is blank or not among ``targets`` (id), and, where ``unique`` names the other columns of
    a unique key (maybe none), rows that share their key. Good rows stay and hold their keys. A bad row asks for its
    ``candidates`` (doc_id, rec_idx, id, score) in order, never for an id that isn't a target; of rows that share a key
    that of the best score keeps its id. With ``unique`` no key is given twice (``settle_links``), and a row without a free
    candidate gets null; without, each bad row gets its best candidate. A null in another column of the key makes the row
    unique whatever its id. Candidates of good rows, and of rows that aren't there, are passed over. Candidates may come by
    sets of tokens (``link_sets``); where the id alone is the key and ``rounds`` is none, they stay so (``settle_sets``).
    """
    sets = candidates if isinstance(candidates, LinkSets) and unique is not None and not unique and rounds is None else None
    if sets is None and isinstance(candidates, LinkSets):
        candidates = candidates.pairs()
    keys = ["doc_id", "rec_idx"]
    good_id, rows_id, many = unused(records, "good", "id", "many")
    known = targets.select(F.col("id").cast("string").alias("k")).where("k <> ''").distinct()
    value = col(field).cast("string")
    marked = joined(also(records, **{rows_id: value}), known.withColumn(good_id, F.lit(True)), {rows_id: "k"})
    good = F.coalesce(col(good_id), F.lit(False))
    if unique is not None:
        slot = {f"\0u{i}": c for i, c in enumerate((field, *unique))}
        counts = records.where(all_of([~is_null_or_empty(col(c)) for c in slot.values()])).groupBy(*[col(c).alias(n) for n, c in slot.items()]).agg(F.count(F.lit(1)).alias(many))
        marked = joined(marked, counts.where(col(many) > 1), {c: n for n, c in slot.items()})
        good = good & col(many).isNull()
    marked = save(marked.select(*[col(c) for c in records.columns], good.alias(good_id)), "links-judged")
    bad = marked.where(~col(good_id))
    others = [col(c).alias(f"u{i}") for i, c in enumerate(unique or ())]
    group = [f"u{i}" for i in range(len(unique or ()))]
    held = marked.where(col(good_id)).select(value.alias("id"), *others)
    if sets is not None:
        ids = sets.ids.withColumn("id", F.col("id").cast("string")).join(known.withColumnRenamed("k", "id"), "id", "left_semi").join(held.where("id IS NOT NULL").distinct(), "id", "left_anti")
        best = settle_sets(LinkSets(sets.rows.join(bad.select(*keys), keys, "left_semi"), save(ids, "ids-free"), sets.scores)).select(*keys, F.col("id").alias("new"), "round")
    else:
        live = candidates.select(*keys, F.col("id").cast("string").alias("id"), "score").join(known.withColumnRenamed("k", "id"), "id", "left_semi")
        asked = live.join(bad.select(*keys, *others).distinct(), keys)
    if sets is None and unique is None:
        best = asked.groupBy(*keys).agg(F.min_by("id", F.struct(-F.col("score"), F.col("id"))).alias("new")).withColumn("round", F.lit(1))
    elif sets is None:
        whole = all_of([F.col(g).isNotNull() for g in group])
        free = asked.where(~whole).groupBy(*keys).agg(F.min_by("id", F.struct(-F.col("score"), F.col("id"))).alias("new")).withColumn("round", F.lit(1))
        best = settle_links(asked.where(whole), held, tuple(group), rounds).select(*keys, F.col("id").alias("new"), "round").unionByName(free)
    best = save(best, "links-new")
    new, turn = unused(records, "new", "round")
    both = joined(bad, best.select(*keys, F.col("new").alias(new), F.col("round").alias(turn)), {c: c for c in keys})
    kind = records.schema[field].dataType
    own = [col(c) for c in records.columns]
    changes = both.where(~value.eqNullSafe(col(new))).select(*keys, value.alias("old"), col(new).alias("new"), col(turn).alias("round"))
    return marked.where(col(good_id)).select(*own).unionByName(replaced(both, field, col(new).cast(kind)).select(*own)), changes


def link_parent(df: DataFrame, id_col: str, text_col: str, label_col: str, **more) -> DataFrame:
    """``link_fk`` of a table with itself: a row is never its own parent; rows with a null id can have a parent and be none."""
    records = df.select("doc_id", "rec_idx", F.col(id_col).cast("string").alias("own_id"), F.col(text_col).alias("text"))
    options = df.select("doc_id", F.col(id_col).cast("string").alias("id"), F.col(label_col).alias("label"))
    return link_fk(records, options, not_self=True, **more)


def prior_context(items: DataFrame, chunks: DataFrame, n: int = 0) -> DataFrame:
    """(doc_id, class, signature, chunk_index, item, item_chunk, at): items of the same table in earlier chunks, each once, the first n a signature (n <= 0: all).

    Items come in the order of their first chunk, so the first n of a chunk are among the first n of all: these are
    chosen before items and chunks meet.
    """
    keys = ["doc_id", "class", "signature"]
    first = items.groupBy(*keys, "item").agg(F.min("chunk_index").alias("item_chunk"), F.min("seq").alias("seq"))
    ranked = first.withColumn("at", F.row_number().over(W.partitionBy(*keys).orderBy("item_chunk", "seq", "item")))
    if n > 0:
        ranked = ranked.where(F.col("at") <= n)
    return chunks.select(*keys, "chunk_index").distinct().join(ranked, keys).where(F.col("item_chunk") < F.col("chunk_index")).drop("seq")


def merge_items(existing: DataFrame, new: DataFrame) -> DataFrame:
    """(signature, items): lists with new items appended, exact repeats dropped, first order kept. Both: (signature, seq, item).

    Of items with one place the smaller comes first; a null item counts as an item; two empty tables give no rows. A
    signature's items are one row, as its readers want them.
    """
    sides = [df.select("signature", "seq", "item", F.lit(n).alias("new")) for n, df in enumerate((existing, new))]
    once = union(sides).groupBy("signature", "item").agg(F.min(F.struct("new", "seq")).alias("at"))
    return once.groupBy("signature").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias("items"))


#: Which step chooses a table's references anew.
RETRY_TARGETS = {
    "EmissionRecord": "emission_sector",
    "Indicator": "indicator_sector",
    "BudgetFunding": "budget_funding",
    "InitiativeStakeholder": "initiative_stakeholder",
    "InitiativeIndicator": "initiative_indicator",
    "InitiativeTef": "initiative_tef",
    "IndicatorValue": "indicator_value",
    "CityTarget": "city_target",
    "TefCategory": "tef_parent",
}
#: What is said about a repeated key.
REPEATED = "Duplicate unique key on (%s): %s. Choose a different match if possible to make this combination unique."


def retry_feedback(issues: DataFrame, groups: DataFrame, specs: dict[str, TableSpec] = SPECS, targets: dict[str, str] = RETRY_TARGETS, only: set[str] | None = None) -> DataFrame:
    """(table, [doc_id,] rec_idx, messages, text, target): a record's reference messages in the order of its references, then its repeated keys in the order of the groups.

    ``issues`` as ``fk_issues``, ``groups`` as ``duplicate_groups`` gives them; a row is known by its document and number.
    ``target``: the step that can mend the table, null if none; with ``only``, just tables whose step is named there. A
    record's messages are few: one a reference and unique key.
    """
    at = F.lit(None).cast("int")
    for name, spec in specs.items():
        for k, fk in enumerate(spec.fks):
            at = F.when((F.col("table") == name) & (F.col("field") == fk.field), k).otherwise(at)
    own = ["doc_id", "rec_idx"] if "doc_id" in issues.columns or "doc_ids" in groups.columns else ["rec_idx"]
    first = issues.select("table", *identity(issues), F.lit(0).alias("kind"), at.cast("long").alias("seq"), F.concat("field", F.lit(": "), "message").alias("message"))
    named = F.array_join(F.transform(F.split("key_fields", ","), lambda c, i: F.concat(c, F.lit("="), F.get("values", i))), ", ")
    before, between, after = REPEATED.split("%s")
    said = F.concat(F.lit(before), F.array_join(F.split("key_fields", ","), ", "), F.lit(between), named, F.lit(after))
    # groups are told in the order of their first rows, ties by the key's columns
    order = F.struct(*[c for c in ("first_doc_id", "first") if c in groups.columns], "key_fields")
    row = F.explode(F.arrays_zip("doc_ids", "rows") if "doc_ids" in groups.columns else F.transform("rows", lambda x: F.struct(x.alias("rows")))).alias("r")
    groups = groups.withColumns({"order": order, "message": said})  # once a group, not once a row
    second = groups.select("table", row, F.lit(1).alias("kind"), "order", "message")
    second = second.select("table", *[F.col("r.doc_ids").alias("doc_id")] * ("doc_ids" in groups.columns), F.col("r.rows").alias("rec_idx"), "kind", "order", "message")
    per = first.withColumn("order", F.lit(None).cast(second.schema["order"].dataType)).unionByName(second.withColumn("seq", F.lit(None).cast("long")), allowMissingColumns=True)
    # a record's messages meet in one shuffle and one sort, by what tells records apart soonest
    record = W.partitionBy(*reversed(own), "table").orderBy("kind", "seq", "order", "message")
    every = F.collect_list(F.struct("message")).over(record.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    per = per.select("table", *own, every.alias("m"), F.row_number().over(record).alias("\0n")).where(F.col("\0n") == 1)
    step = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])[F.col("table")] if targets else F.lit(None).cast("string")
    out = per.select("table", *own, F.col("m.message").alias("messages")).withColumns({"text": F.array_join("messages", " "), "target": step})
    return out if only is None else out.where(F.col("target").isin(*only))
