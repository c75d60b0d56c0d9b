"""WARC archives as a Spark data source (format ``warc``), and page archives with revisits.

Reading plans partitions of whole files (small ones together), parses the headers
of a record first and decodes its block only if the pushed filters on record type
and headers hold and a payload is asked for. Writing makes one ``.warc.gz`` per
task, one gzip member per record; a manifest written at commit names the files
that count, so files of lost or repeated tasks are never read.

Paths may be anything ``pyarrow.fs`` opens (local or shared folders, s3, gs, hdfs
where its client library is installed).
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

MANIFEST = "_manifest.json"
#: Bytes of files read by one task at least, unless fewer are there.
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20

#: Fixed values of the format: column, header.
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "warc_date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
}
#: Length of the full payload; an extension, since a revisit holds none.
LENGTH_HEADER = "X-Payload-Length"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_MESSAGE = "application/http; msgtype=response"

RECORD_SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_length long, headers map<string,string>"
WRITE_COLUMNS = ("warc_type", "record_id", "warc_date", "target_uri", "refers_to", "payload_digest")


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    file: str
    records: int


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def archive_files(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of an archive folder, in the order of names; a file is its own archive."""
    store, root = open_filesystem(path)
    info = store.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    found = {f.base_name: f for f in store.get_file_info(pafs.FileSelector(root)) if f.is_file}
    if MANIFEST in found:
        with store.open_input_stream(found[MANIFEST].path) as stream:
            names = json.loads(stream.read())
    else:
        names = [n for n in found if not n.startswith(("_", "."))]
    return [(found[n].path, found[n].size) for n in sorted(names)]


class WarcDataSource(DataSource):
    """Options: ``path``; ``payload`` (true: decode blocks into a ``payload`` column)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def wants_payload(self) -> bool:
        return self.options.get("payload", "false").lower() == "true"

    def schema(self) -> str:
        return RECORD_SCHEMA + (", payload binary" if self.wants_payload() else "")

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.wants_payload())

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool) -> None:
        self.path, self.payload = path, payload
        self.allowed: dict[str, set[str]] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take equality, membership and presence tests on the header columns."""
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.allowed[column] = self.allowed.get(column, values) & values
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.present.add(column)
            else:
                yield f

    def partitions(self) -> list[Files]:
        groups: list[list[str]] = []
        room = 0
        for path, size in archive_files(self.path):
            if not groups or size > room:
                groups.append([])
                room = PARTITION_BYTES
            groups[-1].append(path)
            room -= size
        return [Files(tuple(g)) for g in groups] or [Files(())]

    def wanted(self, headers: dict[str, str]) -> bool:
        low = {k.lower(): v for k, v in headers.items()}
        value = lambda column: low.get(HEADERS[column].lower())
        return all(value(c) in ok for c, ok in self.allowed.items()) and all(value(c) is not None for c in self.present)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = open_filesystem(self.path)
        rows: list[tuple] = []
        held = 0
        for path in partition.paths:
            with store.open_input_stream(path, compression=None) as raw:
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw, 1 << 20)
                for headers, payload in records(stream, self.wanted, self.payload, path):
                    rows.append((headers, payload))
                    held += len(payload or b"") + 500
                    if held >= BATCH_BYTES:
                        yield self.batch(rows)
                        rows, held = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        low = [{k.lower(): v for k, v in h.items()} for h, _ in rows]
        columns = {c: pa.array([x.get(n.lower()) for x in low], pa.string()) for c, n in HEADERS.items()}
        lengths = [x.get(LENGTH_HEADER.lower()) for x in low]
        columns["payload_length"] = pa.array([None if n is None else int(n) for n in lengths], pa.int64())
        columns["headers"] = pa.array([list(h.items()) for h, _ in rows], pa.map_(pa.string(), pa.string()))
        if self.payload:
            columns["payload"] = pa.array([p for _, p in rows], pa.binary())
        return pa.RecordBatch.from_pydict(columns)


def header_lines(stream: io.BufferedReader) -> Iterator[bytes]:
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        yield line


def records(stream: io.BufferedReader, wanted, payload: bool, path: str) -> Iterator[tuple[dict, bytes | None]]:
    """Headers and, if asked for, payload of the wanted records; other blocks are passed over."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: a record must begin with its WARC version, not {line[:40]!r}")
        headers: dict[str, str] = {}
        for text in (x.decode("utf-8", "replace").rstrip("\r\n") for x in header_lines(stream)):
            if text[:1] in " \t" and headers:  # a folded line goes on with the last value
                headers[next(reversed(headers))] += " " + text.strip()
            else:
                key, _, value = text.partition(":")
                headers[key.strip()] = value.strip()
        length = int(next((v for k, v in headers.items() if k.lower() == "content-length"), 0))
        if payload and wanted(headers):
            block = stream.read(length)
            if len(block) < length:
                raise ValueError(f"{path}: the file ends inside a record")
            yield headers, message_body(headers, block)
        else:
            skip(stream, length, path)
            if wanted(headers):
                yield headers, None


def skip(stream: io.BufferedReader, length: int, path: str) -> None:
    while length:
        passed = len(stream.read(min(length, 1 << 20)))
        if not passed:
            raise ValueError(f"{path}: the file ends inside a record")
        length -= passed


def message_body(headers: dict[str, str], block: bytes) -> bytes:
    kind = next((v for k, v in headers.items() if k.lower() == "content-type"), "")
    return block.partition(b"\r\n\r\n")[2] if kind.startswith("application/http") else block


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of ``WRITE_COLUMNS`` and ``payload`` (binary), ``payload_length``."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = open_filesystem(self.path)
        store.create_dir(root, recursive=True)
        name, count = f"part-{uuid.uuid4().hex}.warc.gz", 0
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in iterator:
                for at in range(0, batch.num_rows, 64):
                    for row in batch.slice(at, 64).to_pylist():
                        out.write(gzip.compress(record_bytes(row), 6, mtime=0))
                count += batch.num_rows
        return Written(name, count)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = open_filesystem(self.path)
        store.create_dir(root, recursive=True)
        kept: list[str] = []
        if store.get_file_info(f"{root}/{MANIFEST}").is_file:
            with store.open_input_stream(f"{root}/{MANIFEST}") as stream:
                kept = json.loads(stream.read())
        kept += [m.file for m in messages if m is not None and m.records]
        with store.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(kept).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = open_filesystem(self.path)
        for m in messages:
            if m is not None and store.get_file_info(f"{root}/{m.file}").is_file:
                store.delete_file(f"{root}/{m.file}")


def record_bytes(row: dict) -> bytes:
    payload, response = row.get("payload") or b"", row["warc_type"] == "response"
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = f"{head}Content-Length: {row['payload_length']}\r\n\r\n".encode() + (payload if response else b"")
    lines = [f"{HEADERS[c]}: {one_line(row[c])}" for c in WRITE_COLUMNS if row.get(c) is not None]
    if row["warc_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += [f"{LENGTH_HEADER}: {row['payload_length']}", f"Content-Type: {HTTP_MESSAGE}"]
    text = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    return text.encode("utf-8", "replace") + block + b"\r\n\r\n"


def one_line(value: str) -> str:
    """Header values can't hold line ends or outer blanks; those are percent-encoded."""
    value = value.replace("\r", "%0D").replace("\n", "%0A")
    inner = value.strip()
    at = value.find(inner) if inner else len(value)
    code = lambda s: "".join(f"%{ord(c):02X}" for c in s)
    return code(value[:at]) + inner + code(value[at + len(inner) :])


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_warc(records_table: DataFrame, path: str) -> None:
    records_table.sparkSession.dataSource.register(WarcDataSource)
    records_table.write.format("warc").mode("append").save(path)


# --- page archives -----------------------------------------------------------

#: The base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID_PREFIX = "urn:newsloom:page:"
SALTS = 32


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of ``data``: five hex digits make four letters."""
    digits = F.sha1(data)
    parts = [F.conv(F.substring(digits, at, 5), 16, 10).cast("int") for at in range(1, 41, 5)]
    letters = [
        F.substring(F.lit(BASE32), F.shiftright(part, shift).bitwiseAND(31) + 1, F.lit(1))
        for part in parts
        for shift in (15, 10, 5, 0)
    ]
    return F.concat(*letters)


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def page_of(identifier: Column) -> Column:
    return F.regexp_extract(identifier, f"^<{ID_PREFIX}(-?[0-9]+)>$", 1).try_cast("long")


def page_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """A WARC record per row of ``pages`` (page_id, url, html); other columns are not read.

    Of equal payloads of at least ``min_revisit_bytes`` bytes that with the smallest
    page_id is a response and the others are revisits of it; a row without page_id
    is a revisit if any equal payload has one. Rows that share the smallest id of a
    payload are all responses. A null html is an empty payload, a null url leaves
    its header out. Decisions are made on digests: the smallest id of each repeated
    payload, copied to ``SALTS`` keys so that a payload of very many pages is
    joined by as many tasks; only then do they meet the pages, by page_id.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    facts = pages.select("page_id", F.unhex(F.sha1(payload)).alias("d"), F.octet_length(payload).alias("n"))
    firsts = (
        facts.filter(F.col("n") >= min_revisit_bytes)
        .groupBy("d")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("c"))
        .filter("c > 1")
        .select("d", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    revisits = (
        facts.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
        .join(firsts, ["d", "salt"])
        .filter(F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))))
        .select(F.col("page_id").alias("r_id"), F.col("d").alias("r_d"), "first")
        .distinct()
    )
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("d", F.unhex(F.sha1("payload")))
    joined = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("d") == F.col("r_d")), "left")
    first = F.col("first")
    return joined.select(
        F.when(first.isNull(), "response").otherwise("revisit").alias("warc_type"),
        record_id(F.col("page_id")).alias("record_id"),
        F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
        F.col("url").alias("target_uri"),
        F.when(first.isNotNull(), record_id(first)).alias("refers_to"),
        F.concat(F.lit("sha1:"), sha1_base32(F.col("payload"))).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(first.isNull(), F.col("payload")).alias("payload"),
    )


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """A row per archived page: sizes and digests of responses are those of the payload read."""
    seen = read_warc(spark, path, payload=True).filter("warc_type = 'response'")
    again = read_warc(spark, path).filter("warc_type = 'revisit'")
    common = [page_of(F.col("record_id")).alias("page_id")]
    return seen.select(
        *common,
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        again.select(
            *common,
            F.col("payload_length").alias("payload_bytes"),
            F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
            F.col("warc_type").alias("record_type"),
            page_of(F.col("refers_to")).alias("refers_to"),
        )
    )
