"""Checking values against verbatim quotes from their source."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..frames import also, col, joined, save, unused, without
from ..functions.scalars import is_blank, normalize_for_match, verified_decimal, verified_int, year_int

_COERCE = {"decimal": verified_decimal, "int": verified_int, "year": year_int, "string": lambda c: c.cast("string")}


MANY = 64  # quotes of a document, beyond which its text is scanned for all of them at once
PART = 10_000  # quotes of a document that one scan looks for
FEW = 4 << 20  # bytes of different quotes that every task may hold


def quotes_found(quotes: DataFrame, docs: DataFrame, many: int | None = None) -> DataFrame:
    """quotes (doc_id, quote, ...) with ``found``: the normalised quote is in the normalised text of its document.

    A document's text is normalised once. Where a document has few quotes, they join its text by doc_id. Where it has more
    than ``many`` (none: ``MANY``), its different quotes become one Aho-Corasick automaton and the text is scanned once, not copied to each
    quote; quotes beyond ``PART`` go to further automata, each with a copy of the text. There quotes
    travel as numbers: different ones are numbered once, and their texts go to every task as one list up to ``FEW`` bytes, else to the documents that ask for them. Blank quotes and texts, and quotes
    without a document, give false. Of several texts with one doc_id the least counts. A column named ``found`` gives way.
    """
    quotes = without(quotes, ["found"])
    own = [col(c) for c in quotes.columns]
    text, norm, hit, size, no = unused(quotes, "text", "norm", "hit", "size", "no")
    whole = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("text").alias(text)).select("doc_id", normalize_for_match(col(text)).alias(text))
    asked = also(quotes, **{norm: normalize_for_match(col("quote"))})
    most = MANY if many is None else many

    def plainly(df: DataFrame) -> DataFrame:
        both = joined(df, whole, {"doc_id": "doc_id"})
        found = F.coalesce((col(norm) != "") & (col(text) != "") & F.contains(col(text), col(norm)), F.lit(False))
        return both.select(*own, found.alias("found"))

    busy = save(asked.where(F.col("doc_id").isNotNull() & (col(norm) != "")).groupBy("doc_id").agg(F.count(F.lit(1)).alias(size)).where(col(size) > most).select("doc_id"), "documents-of-many-quotes")
    if busy.isEmpty():
        return plainly(asked)
    several = joined(asked, busy, {"doc_id": "doc_id"}, "left_semi")
    known = save(several.where(col(norm) != "").select(col(norm).alias("norm")).distinct().withColumn(no, F.monotonically_increasing_id()), "different-quotes")
    numbered = joined(several, known, {norm: "norm"})
    counts = save(numbered.where(col(no).isNotNull()).groupBy("doc_id").agg(F.countDistinct(col(no)).alias(size)).where(col(size) > most), "quotes-of-documents")
    parts = counts.select("doc_id", (F.floor((col(size) - 1) / PART) + 1).cast("int").alias("parts"))
    dealt = numbered.select("doc_id", col(no).alias("no")).where("no IS NOT NULL").distinct().join(parts, "doc_id").select("doc_id", F.pmod(F.xxhash64("no"), F.col("parts")).cast("int").alias("part"), "no")
    if (known.agg(F.sum(F.octet_length("norm") + 64)).first()[0] or 0) <= FEW:
        texts_of = quotes.sparkSession.sparkContext.broadcast({r[no]: r.norm for r in known.collect()})  # FEW bytes at most
        dealt = dealt.withColumn("norm", F.lit(None).cast("string"))
    else:
        texts_of = None
        dealt = dealt.join(known.select(col(no).alias("no"), "norm"), "no").select("doc_id", "part", "no", "norm")
    texts = whole.select("doc_id", col(text).alias("text")).where("text <> ''").join(parts, "doc_id").select(F.col("doc_id").alias("of"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("at"), "text")
    kind = quotes.schema["doc_id"].dataType.simpleString()
    seen = dealt.groupBy("doc_id", "part").cogroup(texts.groupBy("of", "at")).applyInArrow(_scanner(texts_of), f"doc_id {kind}, no long")
    scanned = joined(joined(numbered, counts, {"doc_id": "doc_id"}, "left_semi"), seen.select("doc_id", col("no").alias("n"), F.lit(True).alias(hit)), {"doc_id": "doc_id", no: "n"})
    rest = joined(asked, counts, {"doc_id": "doc_id"}, "left_anti")
    return plainly(rest).unionByName(scanned.select(*own, F.coalesce(col(hit), F.lit(False)).alias("found")))


def _scanner(texts_of: Broadcast | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(doc_id, no): the quotes that one pass over the text of their document meets. The last automaton serves the documents that ask for the same quotes."""
    last: list = [None, None]

    def scan(quotes: pa.Table, texts: pa.Table) -> pa.Table:
        found: set[int] = set()
        if quotes.num_rows and texts.num_rows:
            numbers = quotes.column("no").to_pylist()
            asked = frozenset(numbers)
            if last[0] != asked:
                machine = ahocorasick.Automaton()
                for no, q in zip(numbers, quotes.column("norm").to_pylist()):
                    machine.add_word(q if texts_of is None else texts_of.value[no], no)
                machine.make_automaton()
                last[:] = asked, machine
            found = {no for _, no in last[1].iter(texts.column("text")[0].as_py())}
        doc = quotes.column("doc_id") if quotes.num_rows else texts.column("of")
        return pa.table({"doc_id": pa.array([doc[0].as_py()] * len(found), doc.type), "no": pa.array(sorted(found), pa.int64())})

    return scan


def quotes_in_all(quotes: DataFrame, docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) x quotes (quote, ...) -> (doc_id, the quotes' columns, ``found``): whether each quote of one list is in each document, as ``quotes_found`` tells.

    Every row of ``docs`` is scanned once where it lies, for all quotes at once; nothing is shuffled, and quotes meet texts as
    numbers. The list goes to every task up to ``FEW`` bytes; beyond that documents ask for its quotes one by one.
    """
    quotes = without(quotes, ["doc_id", "found"])
    own = [col(c) for c in quotes.columns]
    norm, no, hits, row = unused(quotes, "norm", "no", "hits", "row")
    known = save(also(quotes, **{norm: normalize_for_match(col("quote")), no: F.monotonically_increasing_id()}), "quotes-of-all")
    width = sum((F.coalesce(F.octet_length(col(c).cast("string")), F.lit(0)) for c in (*[c for c, kind in quotes.dtypes if kind == "string"], norm)), F.lit(64))
    if (known.agg(F.sum(width)).first()[0] or 0) > FEW:
        rows = save(docs.select(F.monotonically_increasing_id().alias(row), "doc_id", "text"), "documents-asked")  # several may have one doc_id
        asked = rows.select(col(row).alias("doc_id"), F.struct("doc_id").alias("of")).crossJoin(known.select(F.struct(*own).alias("q"), col("quote").alias("quote")))
        got = quotes_found(asked, rows.select(col(row).alias("doc_id"), "text"))
        return got.select("of.doc_id", *[F.col("q").getField(c).alias(c) for c in quotes.columns], "found")
    numbers: dict[str, list[int]] = {}
    for r in known.where(col(norm) != "").select(col(no).alias("no"), col(norm).alias("norm")).collect():  # FEW bytes at most
        numbers.setdefault(r.norm, []).append(r.no)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scan = _scanned(quotes.sparkSession.sparkContext.broadcast(numbers), hits)
    seen = docs.select("doc_id", normalize_for_match(F.col("text")).alias("text")).mapInArrow(scan, f"doc_id {kind}, `{hits}` array<long>")
    return seen.crossJoin(F.broadcast(known)).select("doc_id", *own, F.array_contains(col(hits), col(no)).alias("found"))


def _scanned(numbers: Broadcast, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, text) -> (doc_id, numbers of the quotes that one pass over the text meets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for q, own in numbers.value.items():
            machine.add_word(q, own)
        if numbers.value:
            machine.make_automaton()
        for b in batches:
            found = []
            for text in (x.as_py() for x in b.column(1)):
                met = {own[0]: own for _, own in machine.iter(text)} if text and numbers.value else {}
                found.append([no for own in met.values() for no in own])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", name])

    return run


def verify_records(records: DataFrame, docs: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). records (doc_id, rec_idx, and f, f_quote, f_confidence of each field); fields: name -> decimal, int, year or string.

    A field whose value is null and whose proof is incomplete is skipped. Otherwise a blank quote, a confidence outside
    0 to 1, a quote that is not in the source or a value that doesn't convert is an error, and any error rejects the
    whole record. Accepted rows have converted values and ``proofs`` by field. A field may also be one struct of value,
    quote and confidence. Rows of one (doc_id, rec_idx) are judged as one: an error of either rejects both, and of two
    proofs of a field the lesser counts.
    """
    for f in fields:
        if isinstance(records.schema[f].dataType, StructType):
            records = records.withColumns({f"{f}_quote": F.col(f"{f}.quote"), f"{f}_confidence": F.col(f"{f}.confidence"), f: F.col(f"{f}.value")})
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), F.col(f"{f}_quote").alias("quote"), F.col(f"{f}_confidence").cast("double").alias("confidence")) for f in fields])
    flat = records.select("doc_id", "rec_idx", F.explode(each).alias("p")).select("doc_id", "rec_idx", "p.*")
    incomplete = is_blank(F.col("quote")) | F.col("confidence").isNull()
    checked = quotes_found(flat.where(~(F.col("value").isNull() & incomplete)), docs)
    fits = F.lit(False)
    for f, kind in fields.items():
        fits = F.when(F.col("field") == f, _COERCE[kind](F.col("value")).isNotNull()).otherwise(fits)
    problem = (
        F.when(is_blank(F.col("quote")), "blank quote")
        .when(F.col("confidence").isNull() | ~F.col("confidence").between(0, 1), "confidence outside 0 to 1")
        .when(~F.col("found"), "quote not in source")
        .when(F.col("value").isNotNull() & ~fits, "value does not convert")
    )
    judged = checked.withColumn("error", problem)
    errors = judged.where("error IS NOT NULL").groupBy("doc_id", "rec_idx").agg(F.array_sort(F.collect_list(F.struct("field", "error"))).alias("errors"))
    once = judged.groupBy("doc_id", "rec_idx", "field").agg(F.min(F.struct("quote", "confidence")).alias("proof"))
    proofs = once.groupBy("doc_id", "rec_idx").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "proof")))).alias("proofs"))
    rejected = records.select("doc_id", "rec_idx").join(errors, ["doc_id", "rec_idx"])
    good = records.join(errors.select("doc_id", "rec_idx"), ["doc_id", "rec_idx"], "left_anti").join(proofs, ["doc_id", "rec_idx"], "left")
    return good.withColumns({f: _COERCE[k](F.col(f)) for f, k in fields.items()}).drop(*[f"{f}_{x}" for f in fields for x in ("quote", "confidence")]), rejected


def audit_proofs(stored: DataFrame, docs: DataFrame, fields: dict[str, bool]) -> DataFrame:
    """(field, present, proven, missing_required): stored values with a quote that is in the source and a confidence. fields: name -> required."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), F.lit(need).alias("required"), F.element_at("proofs", f).alias("proof")) for f, need in fields.items()])
    flat = stored.select("doc_id", F.explode(each).alias("p")).select("doc_id", "p.field", "p.value", "p.required", F.col("p.proof.quote").alias("quote"), F.col("p.proof.confidence").alias("confidence"))
    got = quotes_found(flat, docs)
    return got.groupBy("field").agg(
        F.count_if(F.col("value").isNotNull()).alias("present"),
        F.count_if(F.col("value").isNotNull() & F.col("found") & F.col("confidence").isNotNull()).alias("proven"),
        F.count_if(F.col("value").isNull() & F.col("required")).alias("missing_required"),
    )


def acceptance(results: DataFrame) -> DataFrame:
    """results (class, accepted) -> (class, accepted, errors, status, stored): ``ok`` if nothing was rejected, ``partial`` otherwise. A null verdict counts as neither; an empty table gives no rows."""
    per = results.groupBy("class").agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("errors"))
    return per.select("class", "accepted", "errors", F.when(F.col("errors") == 0, "ok").otherwise("partial").alias("status"), F.col("accepted").alias("stored"))


def flatten_values(df: DataFrame, pk: str, series: str = "values") -> tuple[DataFrame, DataFrame]:
    """(parent rows, value rows with the parent's key and ``value_idx``); a null or empty series has no value rows."""
    return df.drop(series), df.select(F.col(pk), F.posexplode(series).alias("value_idx", "v")).select(pk, "value_idx", "v.*")
