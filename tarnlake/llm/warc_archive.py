"""WARC archives: written as one gzip stream a file, normalised to one gzip member a record.

``write_monolithic`` lets Spark's text writer put the records of each partition into one gzip stream:
what ends a WARC record, two line ends, is the writer's row separator. Such a file can only be read
from its start. ``normalise`` inflates each of these streams once, cuts it by the length in every
record's header, writes each record as a gzip member of its own, and puts an index of offsets beside
the archive. ``read_records`` deals the index out by file and offset and opens members in place, so
an archive of any size is read by many tasks.

A payload of ``min_revisit_bytes`` or more that several pages have is stored once, with the largest
page id; the other records are revisits that keep the HTTP header, the digest and a reference.

Recovery: an archive and its index are written under a hidden name of the task attempt and renamed
when complete, the index last. The bytes depend on the input alone, so a repeated task replaces a file
by an equal one. Memory holds one record. The folders may be any that both Spark and ``pyarrow.fs``
can write, local, HDFS or an object store.

Rows and edge cases: a null payload is empty; a null url gives no target; a null id is smaller than
all others and is written as no number, null when read. Rows that share the largest id of their
payload are all responses. Line ends and controls in urls are percent-encoded. An empty table gives
archives without records. A stream that ends inside a record, or is no WARC, is an error. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.session import cut_lineage

END = "\r\n\r\n"
_END = END.encode()
_INDEX = ".index.json"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FILES = "archive string, records long, bytes long"
_ENTRIES = "archive string, offset long, length long, record_id string, record_type string, uri string"
_RECORDS = (
    "record_id string, record_type string, uri string, payload_bytes long, payload_digest string, "
    "refers_to string, payload binary"
)
#: Bytes of payloads that one Arrow batch of read records holds, or one larger payload.
_BATCH_BYTES = 4 << 20
#: Bytes of members that one task reads.
_TASK_BYTES = 16 << 20


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def _safe(uri: Column) -> Column:
    """The url with ASCII controls and blanks percent-encoded."""
    for code in (*range(33), 127):
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return uri


def warc_records(
    pages: DataFrame,
    id_column: str = "page_id",
    uri_column: str = "url",
    payload_column: str = "html",
    min_revisit_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """``value``: one WARC record a page, without the two line ends behind it.

    Each payload is shuffled once, by its digest. Only digests that several ids share are joined
    back, from a written table, so that a payload of many pages can be split by rows.
    """
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(uri_column).cast("string").alias("uri"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"size": F.octet_length("payload"), "digest": F.sha1("payload")})
    shared = cut_lineage(
        rows.where(F.col("size") >= min_revisit_bytes)
        .groupBy("digest", F.xxhash64("payload").alias("check"))
        .agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("digest", "check", "last")
    )
    joined = rows.withColumn("check", F.xxhash64("payload")).join(shared, ["digest", "check"], "left")
    revisit = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    plain = F.col("uri").rlike(r"^[^\x00-\x20\x7F]*$")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", F.col("size").cast("string")),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    reference = F.concat(
        _line("WARC-Profile", F.lit(_PROFILE)), _line("WARC-Refers-To", _urn(F.col("last")))
    )
    value = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("id"))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(
            _line("WARC-Target-URI", F.when(plain, F.col("uri")).otherwise(_safe(F.col("uri")))),
            F.lit(""),
        ),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, reference).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n"),
        http,
        body,
    )
    return joined.select(value.alias("value"))


def write_monolithic(records: DataFrame, folder: str) -> None:
    """The records as archives of one gzip stream each, one for every partition."""
    records.write.option("compression", "gzip").option("lineSep", END).text(folder)


def _file_system(folder: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", folder))
    return system, path.rstrip("/")


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Stream:
    """Cuts an inflated stream, fed in pieces, into header and block of each record."""

    def __init__(self, name: str) -> None:
        self.name, self.rest, self.head, self.need = name, bytearray(), None, 0

    def feed(self, piece: bytes) -> Iterator[tuple[bytes, bytes]]:
        self.rest += piece
        while True:
            if self.head is None:
                at = next((i for i, c in enumerate(self.rest) if c not in b"\r\n"), len(self.rest))
                del self.rest[:at]
                end = self.rest.find(_END)
                if end < 0:
                    return
                head = bytes(self.rest[:end])
                length = _fields(head).get("content-length", "")
                if not head.startswith(b"WARC/") or not length.isdigit():
                    raise ValueError(f"{self.name}: no WARC record at {head[:40]!r}")
                self.head, self.need = head, int(length)
                del self.rest[: end + len(_END)]
            if len(self.rest) < self.need:
                return
            block = bytes(self.rest[: self.need])
            del self.rest[: self.need]
            head, self.head = self.head, None
            yield head, block

    def close(self) -> None:
        if self.head is not None or self.rest.strip(b"\r\n"):
            raise ValueError(f"{self.name}: the stream ends inside a record")


class _Archive:
    """One archive of members and its index, hidden until both are complete."""

    def __init__(self, system, folder: str, source: str, level: int) -> None:
        stem = re.sub(r"(\.warc|\.txt)?(\.gz)?$", "", os.path.basename(source))
        self.name = f"{stem}-{zlib.crc32(source.encode()):08x}.warc.gz"
        self.system, self.folder, self.level = system, folder, level
        self.hidden = f"{folder}/.{self.name}.{TaskContext.get().taskAttemptId()}"
        self.members = system.open_output_stream(self.hidden)
        self.index = system.open_output_stream(self.hidden + _INDEX)
        self.records = self.offset = 0

    def add(self, head: bytes, block: bytes) -> None:
        member = gzip.compress(b"".join((head, _END, block, _END)), self.level, mtime=0)
        fields = _fields(head)
        entry = {
            "archive": self.name,
            "offset": self.offset,
            "length": len(member),
            "record_id": fields.get("warc-record-id"),
            "record_type": fields.get("warc-type"),
            "uri": fields.get("warc-target-uri"),
        }
        self.members.write(member)
        self.index.write(json.dumps(entry).encode() + b"\n")
        self.records += 1
        self.offset += len(member)

    def close(self) -> tuple[str, int, int]:
        self.members.close()
        self.index.close()
        self.system.move(self.hidden, f"{self.folder}/{self.name}")
        self.system.move(self.hidden + _INDEX, f"{self.folder}/{self.name}{_INDEX}")
        return self.name, self.records, self.offset


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite the archives in ``source`` with one member a record; ``archive, records, bytes``.

    Spark's text reader inflates every stream in one pass and hands it on in pieces between double
    line ends; a stream is one task, because gzip can't be entered in its middle.
    """
    system, folder = _file_system(target)
    system.create_dir(folder, recursive=True)
    pieces = (
        spark.read.option("lineSep", END)
        .text(source)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _file_system(target)
        here = stream = archive = None
        done = []

        def close() -> None:
            if archive is not None:
                stream.close()
                done.append(archive.close())

        for batch in batches:
            for file, piece in zip(batch["file"], batch["piece"], strict=True):
                file, piece = file.as_py(), piece.as_py()
                if file != here:
                    close()
                    here, stream = file, _Stream(file)
                    archive = _Archive(system, folder, file, level)
                for head, block in stream.feed(piece + _END):
                    archive.add(head, block)
        close()
        names = ("archive", "records", "bytes")
        columns = zip(*done, strict=True) if done else ([], [], [])
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    return cut_lineage(pieces.mapInArrow(run, _FILES), "archives")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``archive, offset, length, record_id, record_type, uri`` of every record in the folder."""
    return spark.read.schema(_ENTRIES).option("pathGlobFilter", f"*{_INDEX}").json(folder)


def _parse(member: bytes, with_payload: bool) -> tuple:
    record = zlib.decompress(member, 31)
    head, _, rest = record.partition(_END)
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(_END)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type")
    if kind == "revisit":
        size, payload = int(_fields(http).get("content-length", "0")), None
    else:
        size, found = len(payload), hashlib.sha1(payload).hexdigest()
        if digest not in ("", found):
            raise ValueError(f"{fields.get('warc-record-id')}: the payload is not that of its digest")
        digest = found
    return (
        fields.get("warc-record-id"),
        kind,
        fields.get("warc-target-uri"),
        size,
        digest,
        fields.get("warc-refers-to"),
        payload if with_payload else None,
    )


def read_records(
    spark: SparkSession, folder: str, index: DataFrame | None = None, with_payload: bool = True
) -> DataFrame:
    """``record_id, record_type, uri, payload_bytes, payload_digest, refers_to, payload``.

    ``index`` may be any part of the folder's index; only the members it names are read. The digest
    is that of the payload read; for revisits size and digest are those of the header.
    """
    entries = read_index(spark, folder) if index is None else index
    kinds = (pa.string(),) * 3 + (pa.int64(),) + (pa.string(),) * 2 + (pa.binary(),)
    names = [c.split()[0] for c in _RECORDS.split(", ")]

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ([],) * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        here = file = None
        rows, held = [], 0
        for batch in batches:
            places = zip(*(batch[c].to_pylist() for c in ("archive", "offset", "length")), strict=True)
            for archive, offset, length in places:
                if archive != here:
                    if file is not None:
                        file.close()
                    here, file = archive, system.open_input_file(f"{path}/{archive}")
                file.seek(offset)
                rows.append(_parse(file.read(length), with_payload))
                held += len(rows[-1][-1] or b"") + 200
                if held >= _BATCH_BYTES:
                    yield frame(rows)
                    rows, held = [], 0
        if file is not None:
            file.close()
        yield frame(rows)

    # An entry is small whatever its member holds, so the number of tasks follows the members' bytes.
    members = entries.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = 1 + members // _TASK_BYTES
    places = entries.select("archive", "offset", "length")
    placed = places.repartitionByRange(tasks, "archive", "offset")
    return placed.sortWithinPartitions("archive", "offset").mapInArrow(run, _RECORDS)


def page_key(urn: Column) -> Column:
    """The page id in a record's name; null if it has none."""
    return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
