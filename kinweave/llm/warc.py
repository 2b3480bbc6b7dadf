"""WARC archives as a PySpark Python data source.

Writing: each task writes gzip archives, one member per record, and the commit lists the
files of successful tasks in a manifest, so files of lost attempts are never read.  A
member's gzip header carries its own length (extra field `LX`).
Reading: a partition is a byte range of one file and owns the members that start in it.
Only the header of a record is inflated at first; a record that the pushed filters refuse,
or whose payload is not asked for, is skipped by its length without inflating the rest.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage,
)

from kinweave.llm.common import ship
from kinweave.session import cut, scratch_path

MANIFEST = "_manifest.json"
SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, " \
         "payload_length long, headers map<string,string>, payload binary"
FILTERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
KNOWN = {name.lower(): name for name in (*FILTERS.values(), "WARC-Payload-Length", "Content-Length")}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(headers: dict[str, str], block: bytes) -> bytes:
    """A record as one gzip member with its whole length in the header."""
    clean = lambda v: str(v).replace("\r", " ").replace("\n", " ")
    lines = [f"{k}: {clean(v)}" for k, v in headers.items() if v is not None]
    record = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    extra = b"LX" + struct.pack("<HI", 4, 10 + 2 + 8 + len(body) + 8)
    return (b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


class _Done(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceWriter):
    """Rows (record_type, record_id, target_uri, refers_to, payload_digest, payload_length, payload)."""

    def __init__(self, path: str, most: int, overwrite: bool):
        self.path, self.most, self.overwrite = path, most, overwrite

    def write(self, iterator) -> _Done:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        try:
            for row in iterator:
                if out is None or size >= self.most:
                    if out is not None:
                        out.close()
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                headers = {
                    "WARC-Type": row.record_type, "WARC-Record-ID": row.record_id, "WARC-Target-URI": row.target_uri,
                    "WARC-Refers-To": row.refers_to, "WARC-Payload-Digest": f"sha1:{row.payload_digest}",
                    "WARC-Payload-Length": row.payload_length,
                }
                data = member(headers, b"" if row.payload is None else bytes(row.payload))
                out.write(data)
                size += len(data)
        finally:
            if out is not None:
                out.close()
        return _Done(files)

    def commit(self, messages) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        before = _manifests(store, root)
        with store.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())
        for manifest, files in before.items() if self.overwrite else ():
            store.delete_file(manifest)
            for f in files:
                store.delete_file(f"{root}/{f}")

    def abort(self, messages) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        for m in messages:
            for f in m.files if m else ():
                store.delete_file(f"{root}/{f}")


def _manifests(store, root: str) -> dict[str, list[str]]:
    """The manifests of a folder, one per committed write, and the files that each names."""
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    out = {}
    for info in found:
        if info.type == fs.FileType.File and info.base_name.startswith(MANIFEST):
            with store.open_input_stream(info.path) as file:
                out[info.path] = json.loads(file.read())
    return out


class Range(InputPartition):
    def __init__(self, file: str, start: int, stop: int):
        super().__init__((file, start, stop))
        self.file, self.start, self.stop = file, start, stop


class _Inflated:
    """One gzip member of a file, inflated no further than it is read."""

    def __init__(self, source, start: int):
        self.source, self.place, self.engine, self.data = source, start, zlib.decompressobj(31), b""
        self.broken = False

    def more(self, piece: int) -> bool:
        if self.engine.eof or self.broken:
            return False
        self.source.seek(self.place)
        raw = self.source.read(piece)
        if not raw:
            self.broken = True
            return False
        try:
            self.data += self.engine.decompress(raw)
        except zlib.error:
            self.broken = True
            return False
        self.place += len(raw) - len(self.engine.unused_data)
        return True

    def until(self, mark: bytes) -> int:
        while (at := self.data.find(mark)) < 0:
            if not self.more(4096):
                return -1
        return at

    def upto(self, size: int) -> bytes:
        while len(self.data) < size and self.more(1 << 16):
            pass
        return self.data[:size]

    def end(self) -> int:
        """Where the next member starts: from the stated length, else by inflating the rest."""
        while self.more(1 << 16):
            self.data = b""
        return self.place


def _length(text: str | None) -> int | None:
    """A stated length; None where it is no number."""
    return int(text) if text and text.isascii() and text.isdigit() else None


def _headers(text: bytes) -> dict[str, str]:
    """Headers by name; names that the reader knows are told apart from others without regard to case."""
    out: dict[str, str] = {}
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            name = name.strip()
            out[KNOWN.get(name.lower(), name)] = value.strip()
    return out


class WarcReader(DataSourceReader):
    def __init__(self, path: str, width: int, payload: bool):
        self.path, self.width, self.payload = path, width, payload
        self.wanted: dict[str, set[str]] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]):
        """Equality, IN and NOT NULL on the record type and other header columns are decided here."""
        for f in filters:
            name = FILTERS.get(f.attribute[0]) if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name and isinstance(f, EqualTo):
                self._want(name, {str(f.value)})
            elif name and isinstance(f, In):
                self._want(name, {str(v) for v in f.value})
            elif name and isinstance(f, IsNotNull):
                self.present.add(name)
            else:
                yield f

    def _want(self, name: str, values: set[str]) -> None:
        values = {f"sha1:{v}" for v in values} if name == "WARC-Payload-Digest" else values
        self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self) -> list[Range]:
        store, root = fs.FileSystem.from_uri(self.path)
        if manifests := _manifests(store, root):
            found = store.get_file_info([f"{root}/{name}" for names in manifests.values() for name in names])
        else:
            every = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
            found = [i for i in every if i.type == fs.FileType.File and i.base_name.endswith((".warc", ".warc.gz"))]
        ranges = [
            Range(i.path, start, min(start + self.width, i.size))
            for i in found for start in range(0, i.size, self.width)
        ]
        return ranges or [Range("", 0, 0)]  # Spark wants a partition, if an empty one

    def read(self, partition: Range) -> Iterator[tuple]:
        if not partition.file:
            return
        store, _ = fs.FileSystem.from_uri(self.path)
        with store.open_input_file(partition.file) as file:
            plain = not partition.file.endswith(".gz")
            yield from (self._plain if plain else self._members)(file, partition)

    def _row(self, headers: dict[str, str], block) -> tuple | None:
        if any(headers.get(k) not in v for k, v in self.wanted.items()) or any(k not in headers for k in self.present):
            return None
        digest = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
        length = headers.get("WARC-Payload-Length")
        return (headers.get("WARC-Type"), headers.get("WARC-Record-ID"), headers.get("WARC-Target-URI"),
                headers.get("WARC-Refers-To"), digest, _length(length), headers,
                block() if self.payload else None)

    def _members(self, file, part: Range) -> Iterator[tuple]:
        at = part.start if part.start == 0 else self._sync(file, part)
        while at is not None and at < part.stop:
            one = _Inflated(file, at)
            split = one.until(b"\r\n\r\n")
            if split < 0 or not one.data.startswith(b"WARC/"):
                at = self._sync(file, Range(part.file, at + 1, part.stop))  # damaged: go on at the next record
                continue
            headers, begin = _headers(one.data[:split]), split + 4
            size = _length(headers.get("Content-Length", "0"))
            if size is None:
                at = self._sync(file, Range(part.file, at + 1, part.stop))
                continue
            row = self._row(headers, lambda: one.upto(begin + size)[begin:])
            if row is not None:
                yield row
            file.seek(at)
            head = file.read(20)
            stated = head[3] == 4 and head[12:16] == b"LX\x04\x00"
            at = at + struct.unpack("<I", head[16:20])[0] if stated else one.end()

    def _sync(self, file, part: Range) -> int | None:
        """The first record at or after `part.start`, before `part.stop`."""
        place, piece = part.start, 1 << 20
        while place < part.stop:
            file.seek(place)
            data = file.read(piece + 2)
            found = data.find(b"\x1f\x8b\x08")
            while 0 <= found < min(piece, part.stop - place):
                one = _Inflated(file, place + found)
                one.more(256)
                if one.data.startswith(b"WARC/"):
                    return place + found
                found = data.find(b"\x1f\x8b\x08", found + 1)
            place += piece
        return None

    def _plain(self, file, part: Range) -> Iterator[tuple]:
        """Uncompressed archives: records are found by their stated length."""
        at, size = 0, file.size()
        if part.start:  # a record starts after the blank lines of the one before
            at = self._sync_plain(file, part)
        while at is not None and at < min(part.stop, size):
            file.seek(at)
            data = b""
            while (split := data.find(b"\r\n\r\n")) < 0 and (raw := file.read(4096)):
                data += raw
            if split < 0:
                return
            headers, begin = _headers(data[:split]), at + split + 4
            length = _length(headers.get("Content-Length", "0"))
            if length is None:
                at = self._sync_plain(file, Range(part.file, begin, part.stop))
                continue

            def block() -> bytes:
                file.seek(begin)
                return file.read(length)

            row = self._row(headers, block)
            if row is not None:
                yield row
            at = begin + length + 4

    def _sync_plain(self, file, part: Range) -> int | None:
        place, piece, mark = max(part.start - 4, 0), 1 << 20, b"\r\n\r\nWARC/1."
        while place + 4 < part.stop:
            file.seek(place)
            data = file.read(piece + len(mark))
            if (found := data.find(mark)) >= 0:
                return place + found + 4 if place + found + 4 < part.stop else None
            place += piece
        return None


class WarcSource(DataSource):
    """Options: path (any file system Arrow knows), split_bytes, file_bytes, payload (false: leave it out)."""

    @classmethod
    def name(cls) -> str:
        return "kinweave_warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], int(self.options.get("split_bytes", 64 << 20)),
                          self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("file_bytes", 256 << 20)), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark hand it filters."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def write_warc(records: DataFrame, path: str, overwrite: bool = False) -> None:
    """Add the records to the archives of a folder, or put them in their place."""
    register(records.sparkSession)
    records.write.format("kinweave_warc").option("path", _uri(path)).mode("overwrite" if overwrite else "append").save()


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    register(spark)
    reader = spark.read.format("kinweave_warc").option("path", _uri(path)).option("payload", str(payload).lower())
    return reader.options(**options).load()


def record_id(key) -> F.Column:
    return F.concat(F.lit("<urn:kinweave:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def key_of(record) -> F.Column:
    return F.nullif(F.regexp_extract(record, r"^<urn:kinweave:page:(-?\d*)>$", 1), F.lit("")).cast("long")


def archive_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Records for `write_warc`: of equal payloads the row with the largest key is the
    response, the others are revisits of it, without payload.

    Payloads are compared by SHA-256 and length.  The groups come from a partial aggregate and
    are cut into a table, so that a payload which very many rows share is a skewed join that
    Spark splits.  Defined cases: NULL payloads are empty and equal; a NULL key comes below
    all others; of repeated rows each is written, those with the largest key as responses.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("k"), F.col(url).alias("u"), payload.alias("payload"))
    same = [F.sha2("payload", 256).alias("sha"), F.length("payload").cast("long").alias("size")]
    groups = cut(rows.select("k", *same).groupBy("sha", "size").agg(F.max("k").alias("top"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1").select(F.unhex("sha").alias("g_sha"), F.col("size").alias("g_size"), "top"), "payloads")
    joined = rows.withColumn("sha", F.unhex(F.sha2("payload", 256))).withColumn("size", F.length("payload").cast("long"))
    joined = joined.join(groups, (F.col("sha") == F.col("g_sha")) & (F.col("size") == F.col("g_size")), "left")
    joined = joined.withColumn("bits", _bits(F.sha1("payload")))
    again = F.col("g_sha").isNotNull() & ~F.col("k").eqNullSafe(F.col("top"))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), record_id(F.col("k")).alias("record_id"),
        F.col("u").alias("target_uri"), F.when(again, record_id(F.col("top"))).alias("refers_to"),
        _base32(F.col("bits")).alias("payload_digest"), F.col("size").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def _bits(digest) -> F.Column:
    """The 160 binary digits of a hexadecimal SHA-1."""
    return F.concat(*[F.lpad(F.conv(F.substring(digest, 4 * i + 1, 4), 16, 2), 16, "0") for i in range(10)])


def _base32(bits) -> F.Column:
    """Base32 of 160 binary digits, five at a time; it needs no padding."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    place = lambda i: F.conv(F.substring(bits, 5 * i + 1, 5), 2, 10).cast("int") + 1
    return F.concat(*[F.substring(F.lit(letters), place(i), F.lit(1)) for i in range(32)])


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
