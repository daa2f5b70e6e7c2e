"""A store of record tables: batches are published by a log of versions, keys are indexed.

Layout under the store's folder: ``log/v<number>.json`` (one file a version, which names all folders that it consists
of), ``data/commit=<table>-<id>`` (a batch's rows of a table as Parquet), and beside it in ``keys`` and ``bloom`` their part
of the key index.

*Transactions.* A batch is written to folders with names of their own, which nobody reads. Publishing moves one file to
the name of the next version, which fails if that name is taken (``FileContext.rename``, as Structured Streaming's own log
does): the loser reads the versions it missed and tries the next name, unless one of them changed tables it looked at, in
which case ``Conflict`` says that its checks must be made anew. Readers take the folders that their version
names, so a batch is there as a whole or not at all, a repeated batch replaces its rows in the same step, and a run that
fails leaves what was there.

*Key index.* Every commit adds (table, key, bucket, value) of its rows' primary and unique keys, dealt by the hash of the
value into ``BUCKETS`` folders, and a blocked Bloom filter of each bucket: 64-bit words with ``HASHES`` bits a key, a row
a word. ``stored`` looks values up: only the buckets they fall into are listed and read; the filters are joined first, and
what they let pass meets the keys exactly. So a batch of new keys reads words, not keys.

*Digests.* Every commit also adds the count and the sum of hashes of its primary keys by range: ``PARTS`` of each bucket,
doubled until the table's keys are about ``RANGE_KEYS`` a range, so that few differences leave most ranges alike in a table
of any size. Sums add up over batches and over ranges, so ``differences`` compares a table with a source by its digests and
reads the ids of ranges that differ, and those of small early batches whose ranges are too wide.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import FEW_ROWS, also, col, delete, exists, save, sorted_side, without
from ..operators.quality import Tables
from ..specs import SPECS, TableSpec

BUCKETS = 16  # folders of the index, more for a store of very many keys; a store keeps the number it began with
HASHES = 4  # bits of a key in its word
WORDS = 1 << 24  # words of a bucket's filter; rows are there only for words that hold a bit
PARTS = 256  # least ranges of a bucket's keys that have a digest each
RANGE_KEYS = 64  # keys of a table a range, about
SEPARATOR = "\x1f"


class Conflict(Exception):
    """Another batch was published meanwhile that changed what this one was checked against."""


def key_value(parts: list[Column]) -> Column:
    """A key as one text: parts follow their lengths, so different keys never read alike; null if a part is null."""
    texts = [p.cast("string") for p in parts]
    return F.concat(*[F.concat(F.length(t).cast("string"), F.lit(SEPARATOR), t) for t in texts])


def _part(value: Column, parts: int) -> Column:
    """The range of a key in its bucket; of half as many ranges it is the same number, modulo these."""
    return F.pmod(F.xxhash64(value, F.lit(2)), F.lit(parts)).cast("int")


def _parts(keys: int, buckets: int) -> int:
    """Ranges of a bucket for so many keys of a table."""
    parts = PARTS
    while parts * buckets * RANGE_KEYS < keys and parts < 1 << 30:
        parts *= 2
    return parts


def _common_parts(digests: list[dict]) -> int:
    """The most ranges for which batches of wider ones hold an eighth of the keys at most."""
    size = lambda e: e.get("keys", float("inf"))  # noqa: E731 (batches written before it was noted)
    whole, held = sum(map(size, digests)), 0
    for e in sorted(digests, key=lambda e: e.get("parts", PARTS)):
        held += size(e)
        if 8 * held > whole:
            return e.get("parts", PARTS)
    return max((e.get("parts", PARTS) for e in digests), default=PARTS)


def _digest(keys: DataFrame, parts: int) -> DataFrame:
    """keys (bucket, value), each once -> (bucket, part, n, h)."""
    return keys.groupBy("bucket", _part(F.col("value"), parts).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("value", F.lit(3)).cast("decimal(38,0)")).alias("h"))


def _bloom(value: Column) -> tuple[Column, Column]:
    """(word, mask) of a value in its bucket's filter."""
    h = F.xxhash64(value, F.lit(1))
    mask = F.lit(0).cast("long")
    for k in range(HASHES):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int")))
    return F.pmod(F.shiftrightunsigned(h, 24), F.lit(WORDS)), mask


class Store:
    """A store in ``folder``, for tables described by ``specs``."""

    def __init__(self, spark: SparkSession, folder: str, specs: dict[str, TableSpec] = SPECS, buckets: int = BUCKETS):
        self.spark, self.folder, self.specs = spark, folder.rstrip("/"), specs
        first = self._read(1)
        self.buckets = first["buckets"] if first else buckets

    # -- the log ----------------------------------------------------------------------------------------------------

    def _path(self, version: int) -> str:
        return f"{self.folder}/log/v{version:012d}.json"

    def _read(self, version: int) -> dict | None:
        path = self._path(version)
        if not exists(self.spark, path):
            return None
        return json.loads(self.spark.read.text(path, wholetext=True).first().value)  # names of folders, a line a batch and table

    def version(self) -> int:
        """The newest version; 0 if nothing was published."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/log")
        fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(fs_path):
            return 0
        names = [f.getPath().getName() for f in fs.listStatus(fs_path)]
        return max((int(n[1:13]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)

    def _folders(self, version: int) -> list[dict]:
        """What the store consists of at a version: entries (batch, table, kind, folder, rows). A version holds them all, so one file is read."""
        found = self._read(version) if version else None
        return found["folders"] if found else []

    def _publish(self, version: int, folders: list[dict], changed: list[str]) -> bool:
        """Writes a version; false if another writer has taken its name."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        body = json.dumps({"buckets": self.buckets, "changed": changed, "folders": folders})
        temporary, final = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/log/.{uuid.uuid4().hex}"), jvm.org.apache.hadoop.fs.Path(self._path(version))
        out = temporary.getFileSystem(conf).create(temporary)
        out.write(bytearray(body.encode()))
        out.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        qualified = temporary.getFileSystem(conf).makeQualified(temporary)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf).rename(qualified, temporary.getFileSystem(conf).makeQualified(final), options)
        except Exception as error:
            if "FileAlreadyExistsException" not in str(error):
                raise
            temporary.getFileSystem(conf).delete(temporary, False)
            return False
        return True

    # -- reading ----------------------------------------------------------------------------------------------------

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        """Rows of a table at a version (none: the newest) with their ``batch``; none if it has none."""
        folders = [e["folder"] for e in self._folders(self.version() if version is None else version) if e["table"] == table and e["kind"] == "data"]
        return self.spark.read.option("mergeSchema", True).parquet(*folders) if folders else None

    def batches(self, version: int | None = None) -> list[str]:
        return sorted({e["batch"] for e in self._folders(self.version() if version is None else version)})

    def stored(self, table: str, key: tuple[str, ...], values: DataFrame, version: int | None = None, but: str | None = None) -> DataFrame:
        """Those of ``values`` (value, as ``key_value`` makes them) that a row of ``table`` has as its ``key``; ``but``: a batch that doesn't count."""
        now = self.version() if version is None else version
        folders = [e for e in self._folders(now) if e["table"] == table and e["batch"] != but]
        if not folders:
            return values.select("value").limit(0)
        name = ",".join(key)
        word, mask = _bloom(F.col("value"))
        asked = values.where("value IS NOT NULL").select("value").distinct().select("value", F.pmod(F.xxhash64("value"), F.lit(self.buckets)).cast("int").alias("bucket"), word.alias("word"), mask.alias("mask"))
        asked = save(asked, "keys-asked")
        touched = [r.bucket for r in asked.select("bucket").distinct().collect()]  # at most as many as there are buckets
        if not touched:
            return values.select("value").limit(0)
        inside = F.col("bucket").isin(touched) & (F.col("key") == name)
        read = lambda kind, schema: self.spark.read.schema(schema).option("basePath", f"{self.folder}/{kind}").parquet(*[e["folder"] for e in folders if e["kind"] == kind]).where(inside)
        filters = read("bloom", "key string, word long, bits long, bucket int")
        many, keys = asked.count(), read("keys", "key string, value string, bucket int")
        maybe = sorted_side(asked, many).join(filters, ["bucket", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("bucket", "value").distinct()
        if many > FEW_ROWS:
            return sorted_side(maybe, many).join(keys, ["bucket", "value"], "left_semi").select("value")
        return keys.join(F.broadcast(maybe), ["bucket", "value"], "left_semi").select("value").distinct()  # few values; the store's keys, however many, aren't moved

    def differences(self, table: str, source: DataFrame, version: int | None = None) -> DataFrame:
        """One row (matched, missing, extra, compared): keys of ``source`` and of the store's table, each once; compared: how many of the store's keys were read to tell.

        Null keys are none. Ranges of one count and one sum of hashes count as equal.
        """
        pk = self.specs[table].pk
        folders = [e for e in self._folders(self.version() if version is None else version) if e["table"] == table]
        value = key_value([col(pk)])
        mine = source.select(value.alias("value")).where("value IS NOT NULL").distinct().withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(self.buckets)).cast("int"))
        if not folders:
            return mine.agg(F.lit(0).cast("long").alias("matched"), F.count(F.lit(1)).alias("missing"), F.lit(0).cast("long").alias("extra"), F.lit(0).cast("long").alias("compared"))
        mine = save(mine, "keys-of-source")
        digests = [e for e in folders if e["kind"] == "digest"]
        parts = _common_parts(digests)
        fine = [e for e in digests if e.get("parts", PARTS) >= parts]
        wide = {(e["batch"], e["table"]) for e in digests} - {(e["batch"], e["table"]) for e in fine}
        read = lambda of: self.spark.read.schema("key string, value string, bucket int").option("basePath", f"{self.folder}/keys").parquet(*of).where(F.col("key") == pk)
        noted = self.spark.read.parquet(*[e["folder"] for e in fine]).select("bucket", F.pmod("part", F.lit(parts)).alias("part"), "n", "h", F.lit(0).cast("long").alias("read"))
        if wide:
            noted = noted.unionByName(_digest(read([e["folder"] for e in folders if e["kind"] == "keys" and (e["batch"], e["table"]) in wide]), parts).withColumn("read", F.col("n")))
        theirs = noted.groupBy("bucket", "part").agg(F.sum("n").alias("m"), F.sum("h").alias("g"), F.sum("read").alias("read"))
        both = save(_digest(mine, parts).join(theirs, ["bucket", "part"], "full_outer").withColumn("same", F.col("n").eqNullSafe(F.col("m")) & F.col("h").eqNullSafe(F.col("g"))), "digests")
        apart = both.where("NOT same").select("bucket", "part")
        touched = [r.bucket for r in both.where("NOT same").select("bucket").distinct().collect()]  # at most as many as there are buckets
        equal = both.where("same").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("equal"), F.coalesce(F.sum("read"), F.lit(0)).alias("read"))
        keys = read([e["folder"] for e in folders if e["kind"] == "keys"]).where(F.col("bucket").isin(touched) if touched else F.lit(False)).withColumn("part", _part(F.col("value"), parts))
        stored = keys.join(apart, ["bucket", "part"], "left_semi").select("value").distinct().withColumn("b", F.lit(True))
        asked = mine.withColumn("part", _part(F.col("value"), parts)).join(apart, ["bucket", "part"], "left_semi").select("value", F.lit(True).alias("a"))
        counts = asked.join(stored, "value", "full_outer").agg(F.count_if(F.col("a") & F.col("b")).alias("matched"), F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("extra"), F.count("b").alias("compared"))
        return counts.join(F.broadcast(equal)).select((F.col("matched") + F.col("equal")).alias("matched"), "missing", "extra", (F.col("compared") + F.col("read")).alias("compared"))  # one row each

    # -- writing ----------------------------------------------------------------------------------------------------

    def _index(self, spec: TableSpec, rows: DataFrame) -> DataFrame:
        keys = [(spec.pk,), *spec.unique_keys]
        entries = F.array(*[F.struct(F.lit(",".join(k)).alias("key"), key_value([col(c) for c in k]).alias("value")) for k in keys if all(c in rows.columns for c in k)])
        flat = rows.select(F.explode(entries).alias("e")).select("e.*").where("value IS NOT NULL").distinct()
        return flat.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(self.buckets)).cast("int"))

    def write(self, batch: str, tables: Tables) -> list[dict]:
        """Writes a batch to folders of its own, which nobody reads before ``commit`` publishes them. A column named ``batch`` gives way to the batch's name."""
        out = []
        before = [e for e in self._folders(self.version()) if e["kind"] == "digest" and e["batch"] != batch]
        for name in [n for n in self.specs if n in tables]:
            tag = uuid.uuid4().hex
            place = {kind: f"{self.folder}/{kind}/commit={name}-{tag}" for kind in ("data", "keys", "bloom", "digest")}
            also(without(tables[name], ["batch"]), batch=F.lit(batch)).write.option("compression", "zstd").parquet(place["data"])
            rows = self.spark.read.parquet(place["data"])
            index = self._index(self.specs[name], rows)
            index.repartition("bucket").sortWithinPartitions("bucket", "key", "value").write.partitionBy("bucket").parquet(place["keys"])
            word, mask = _bloom(F.col("value"))
            keys = self.spark.read.schema("key string, value string, bucket int").parquet(place["keys"])
            words = keys.select("key", "bucket", word.alias("word"), mask.alias("mask")).groupBy("key", "bucket", "word").agg(F.bit_or("mask").alias("bits"))
            words.repartition("bucket").sortWithinPartitions("bucket", "key", "word").write.partitionBy("bucket").parquet(place["bloom"])
            n = rows.count()
            parts = _parts(n + sum(e.get("keys", 0) for e in before if e["table"] == name), self.buckets)
            _digest(keys.where(F.col("key") == self.specs[name].pk), parts).write.parquet(place["digest"])
            out += [{"batch": batch, "table": name, "kind": kind, "folder": folder, **({"parts": parts, "keys": n} if kind == "digest" else {})} for kind, folder in place.items()]
        return out

    def commit(self, batch: str, written: list[dict], seen: int, reads: list[str] | None = None) -> int:
        """Publishes a written batch in place of an earlier one of its name; the version.

        ``seen``: the version it was checked against; ``reads``: the tables that were looked at (none: those it writes). A
        later version that changed one of these is a ``Conflict``; the written folders are then of no use and go.
        """
        changed = sorted({e["table"] for e in written})
        watched = set(changed if reads is None else reads)
        while True:
            now = self.version()
            for later in range(seen + 1, now + 1):
                if watched & set((self._read(later) or {"changed": []})["changed"]):
                    for e in written:
                        delete(self.spark, e["folder"])
                    raise Conflict(f"version {later} changed {', '.join(sorted(watched))}")
            before = self._folders(now)
            kept = [e for e in before if e["batch"] != batch]
            touched = sorted({*changed, *(e["table"] for e in before if e["batch"] == batch)})
            if self._publish(now + 1, kept + written, touched):
                return now + 1
            seen = min(seen, now)

    def clean(self, keep: int = 1) -> None:
        """Deletes folders that none of the newest ``keep`` versions names; running writers must have ended."""
        now = self.version()
        alive = {e["folder"] for v in range(max(1, now - keep + 1), now + 1) for e in self._folders(v)}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for kind in ("data", "keys", "bloom", "digest"):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}")
            fs = path.getFileSystem(conf)
            for f in fs.listStatus(path) if fs.exists(path) else ():
                if f"{self.folder}/{kind}/{f.getPath().getName()}" not in alive:
                    fs.delete(f.getPath(), True)

