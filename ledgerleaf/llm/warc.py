"""WARC archives: writing, normalising monolithic gzip files to one member a record, reading back by a sidecar index.

Writing: payloads are grouped by SHA-1 (partial aggregates); the smallest page_id of equal payloads is the response, the
others are revisits without payload. Spark's text writer makes the archives, one gzip stream a file. Normalising: a task
inflates a file once, as a stream with a buffer of ``STEP`` bytes, and writes every record as a member of its own, with
an index line (record id, offset, length, type) in a sidecar file; both get their final names when whole, so a task that
is run again does no harm. Reading: index lines are dealt by archive and range of offsets; a task seeks to a member,
inflates it alone and checks the payload's length and digest against its headers.

Files are opened with pyarrow's file systems in the shared folder (``system`` says which); the input is read by Spark only.

Defined cases: null html is an empty payload; payloads under ``min_bytes`` are all responses; a null url has no target
header; rows with equal page_id are records of their own, responses all if theirs is the smallest id; a null page_id
counts as the greatest; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete, new_path, save

STEP = 1 << 20
RANGE = 64 << 20  # bytes of an archive read by one group
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
COLUMNS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
#: The digits of number base 32 and those of the base32 encoding.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and place of a URI. Object stores go by their own scheme's name; the others are those pyarrow knows (file, hdfs, s3, gs, abfs)."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def base32(digest_hex: Column) -> Column:
    """Base32 of a SHA-1 given in hex: five hex digits are four base32 digits."""
    parts = [F.lpad(F.conv(F.substring(digest_hex, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """pages (page_id, url, html) -> gzip files of WARC records under ``path``."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    clean = F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20]", "")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), clean.alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha"), F.octet_length(payload).cast("long").alias("size"))
    groups = own.where(F.col("size") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # a table of its own, so that a digest many pages share can be split in the join
    groups = save(groups.where("n > 1").select("sha", "first"), "payload-groups")
    joined = own.join(groups, "sha", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")) & (F.col("size") >= min_bytes)
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.concat(F.lit("\r\nWARC-Record-ID: <urn:page:"), number, F.lit(f">\r\nWARC-Date: {DATE}\r\n")),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.col("url"), F.lit("\r\n"))).otherwise(""),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(f">\r\nWARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha"))),
        F.concat(F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n")),
    )
    # the writer's line end is the second of the two that end a record
    joined.select(F.concat(head, block, F.lit("\r\n")).alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


class Inflated:
    """A gzip stream of any number of members, read once with a bounded buffer."""

    def __init__(self, source):
        self.source, self.member, self.buffer, self.raw = source, zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        if not self.raw:
            self.raw = self.source.read(STEP)
            if not self.raw:
                return False
        if self.member.eof:
            self.member = zlib.decompressobj(31)
        self.buffer += self.member.decompress(self.raw, STEP)
        self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before and with ``mark``; none at the end of the stream."""
        while (at := self.buffer.find(mark)) < 0:
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("a record is cut off")
                return None
        out, self.buffer = self.buffer[: at + len(mark)], self.buffer[at + len(mark) :]
        return out

    def pieces(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self.more():
                raise ValueError("a record is cut off")
            out, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(out)
            yield out


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines if x)}


def _normalised(target: str, level: int):
    """Paths of monolithic archives -> their normalised archives and index files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                store, place = system(path)
                _, folder = system(target)
                name = f"{folder}/{place.rpartition('/')[2].partition('.')[0]}"
                mine, offset, lines = f"{name}.{uuid.uuid4().hex}", 0, []
                store.create_dir(folder, recursive=True)
                with store.open_input_stream(place, compression=None) as source, store.open_output_stream(f"{mine}.tmp", compression=None) as out, store.open_output_stream(f"{mine}.idx.tmp", compression=None) as index:
                    stream = Inflated(source)
                    while (head := stream.until(b"\r\n\r\n")) is not None:
                        head = head.lstrip(b"\r\n")
                        found = fields(head)
                        press = zlib.compressobj(level, zlib.DEFLATED, 31)
                        size = out.write(press.compress(head))
                        for piece in stream.pieces(int(found["content-length"]) + 4):
                            size += out.write(press.compress(piece))
                        size += out.write(press.flush())
                        index.write(f"{found['warc-record-id']}\t{offset}\t{size}\t{found['warc-type']}\n".encode())
                        offset += size
                        lines.append(size)
                store.move(f"{mine}.tmp", f"{name}.warc.gz")
                store.move(f"{mine}.idx.tmp", f"{name}.idx")
                yield pa.RecordBatch.from_arrays([pa.array([f"{target}/{name.rpartition('/')[2]}.warc.gz"]), pa.array([len(lines)], pa.int64()), pa.array([offset], pa.int64())], names=["archive", "records", "bytes"])

    return run


def normalise_archives(spark: SparkSession, path: str, target: str, level: int = 1) -> DataFrame:
    """Rewrites every ``*.gz`` under ``path`` into ``target``; returns archive, records and bytes of each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "length")
    many = max(1, files.count())
    return save(files.repartition(many, "path").mapInArrow(_normalised(target, level), "archive string, records long, bytes long"), "archives")


def read_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one member."""
    text = zlib.decompress(raw, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    found = fields(head + b"\r\n")
    return found, rest[: int(found["content-length"])]


def _page(text: str) -> int | None:
    number = text.rpartition(":")[2].rstrip(">")
    return None if number == "null" else int(number)


def _parsed(raw: bytes) -> tuple:
    found, block = read_record(raw)
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(fields(http + b"\r\n")["content-length"]), found["warc-payload-digest"].partition(":")[2]
    if found["warc-type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {found['warc-record-id']} is not the one that was written")
    refers = found.get("warc-refers-to")
    return _page(found["warc-record-id"]), size, digest, found["warc-type"], None if refers is None else _page(refers)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    now, source = None, None
    for b in batches:
        out = []
        for archive, offset, size in zip(*(b.column(c).to_pylist() for c in ("archive", "offset", "length"))):
            if archive != now:
                if source is not None:
                    source.close()
                store, place = system(archive)
                now, source = archive, store.open_input_file(place)
            source.seek(offset)
            out.append(_parsed(source.read(size)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)
    if source is not None:
        source.close()


def read_archives(spark: SparkSession, target: str) -> DataFrame:
    """Records of the archives in ``target``, found by their index files."""
    lines = spark.read.option("pathGlobFilter", "*.idx").schema("value string").text(target)
    part = F.split("value", "\t")
    index = lines.select(
        F.regexp_replace(F.col("_metadata.file_path"), r"\.idx$", ".warc.gz").alias("archive"),
        part[1].cast("long").alias("offset"),
        part[2].cast("long").alias("length"),
    )
    dealt = index.repartition("archive", F.floor(F.col("offset") / RANGE)).sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(_read, COLUMNS)


def warc_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as monolithic archives, normalises them, and returns the records read back."""
    spark = pages.sparkSession
    path, target = new_path(spark, "warc-whole"), new_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    made = normalise_archives(spark, path, target)
    delete(spark, path)  # the normalised archives stay: what is returned reads them
    if made.isEmpty():
        return spark.createDataFrame([], COLUMNS)
    return read_archives(spark, target)
