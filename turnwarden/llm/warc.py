"""WARC archives: written by Spark's text writer, read by a Python data source.

Writing: one record per page. Of pages with equal payloads of at least ``least`` bytes the one with the smallest id becomes a
``response``, the others ``revisit`` records without the payload that name it; smaller payloads are always responses. Every
record is text, and the line separator of the writer is the one that ends a record, so the files are plain WARC on whatever
store Spark writes to.

Reading: files are planned into partitions by size. A record's header block is parsed first; if its type or another header
is not asked for, or no payload is wanted, the reader steps over the block without reading it. Predicates come as options, or
from ``filter`` where ``spark.sql.python.filterPushdown.enabled`` is on.

Defined results: a null payload is empty; a null id is written as ``none``, is never revisited and never revisits; rows of one
id and one payload are all responses if that id is the smallest; a null address has no header; line ends in an address are
written in percent form. An empty table gives files without records.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from turnwarden.sources.shared import settle

END = "\r\n"
#: The base32 alphabet, and the profile of a revisit that has the payload of another record.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "<urn:x-page:"
#: Bytes that a partition reads, and that a batch of records holds, at about the most (one record may be larger).
SPLIT, BATCH = 64 << 20, 8 << 20


def base32(hexadecimal: Column) -> Column:
    """Forty hexadecimal digits in base 32: every five digits are four characters."""
    out = []
    for k in range(8):
        number = F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substr(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
            date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the WARC records without the final empty lines.

    Only ids and digests of payloads are compared, summed up before they are shuffled; a digest that many pages share meets the
    pages in a join that adaptive execution can split.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"), body.alias("_body"))
    rows = rows.withColumns({"_sha": F.sha1(F.col("_body").cast("binary")), "_n": F.octet_length("_body").cast("long")})
    firsts = rows.select("_id", "_sha", "_n").filter(F.col("_n") >= least).groupBy("_sha", "_n").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_copies")).filter("_copies > 1").drop("_copies")
    # Written first, so that its size is known when the join is planned and the pages stay where they are if it is small.
    firsts = settle(firsts, "warc-firsts")
    rows = rows.join(firsts, ["_sha", "_n"], "left")
    again = F.coalesce(F.col("_id") != F.col("_first"), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("_n"), F.lit(END + END))

    def name(number: Column) -> Column:
        return F.concat(F.lit(ID), F.coalesce(number.cast("string"), F.lit("none")), F.lit(">"))

    def header(key: str, value: Column) -> Column:  # nothing where the value is null
        return F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit(END)), F.lit(""))

    safe = F.regexp_replace(F.regexp_replace("_url", "\r", "%0D"), "\n", "%0A")
    return rows.select(F.concat(
        F.lit(f"WARC/1.1{END}"), header("WARC-Type", F.when(again, "revisit").otherwise("response")), header("WARC-Record-ID", name(F.col("_id"))),
        header("WARC-Date", F.lit(date)), header("WARC-Target-URI", safe), header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("_sha")))),
        F.when(again, F.concat(header("WARC-Refers-To", name(F.col("_first"))), header("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", (F.octet_length(http) + F.when(again, 0).otherwise(F.col("_n"))).cast("string")),
        F.lit(END), http, F.when(again, "").otherwise(F.col("_body"))).alias("value"))


def write(pages: DataFrame, path: str, records_per_file: int = 100_000, compression: str = "none", **named) -> None:
    """Archives of at most ``records_per_file`` records in ``path``."""
    records(pages, **named).write.option("lineSep", END * 2).option("maxRecordsPerFile", records_per_file).option(
        "compression", compression).text(path)


FIELDS = {"record_type": "warc-type", "record_id": "warc-record-id", "date": "warc-date", "target_uri": "warc-target-uri",
          "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type"}
SCHEMA = ", ".join(f"{c} string" for c in FIELDS) + ", content_length long, payload_length long, payload binary, file string"
ARROW = pa.schema([*[(c, pa.string()) for c in FIELDS], ("content_length", pa.int64()), ("payload_length", pa.int64()),
                   ("payload", pa.binary()), ("file", pa.string())])


class Files(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class Record(NamedTuple):
    headers: dict[str, str]
    length: int


def parse_headers(stream) -> Record | None:
    """The next record's headers, with names in lower case; None at the end. Empty lines before it are skipped."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record where one should begin: {line[:80]!r}")
    headers: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError("the file ends within the headers of a record")
        key, _, value = line.decode("utf-8", "replace").partition(":")
        headers[key.strip().lower()] = value.strip()
    return Record(headers, int(headers["content-length"]))


class WarcReader(DataSourceReader):
    """Options: ``path``; ``recordTypes`` (comma-joined, empty for all); ``header.<column>`` (the value it must have);
    ``payload`` (false: no payload is read); ``split`` (bytes of files in a partition)."""

    def __init__(self, options):
        self.path = options["path"]
        self.types = {x for x in options.get("recordTypes", "").split(",") if x}
        self.payload = options.get("payload", "true").lower() != "false"
        self.split = int(options.get("split", SPLIT))
        wanted = {key[7:].lower(): value for key, value in options.items() if key.lower().startswith("header.")}
        self.headers = {FIELDS[column]: {value} for column, value in wanted.items()}

    def partitions(self) -> list[Files]:
        """Files in order of name, gathered until they make up ``split`` bytes."""
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(root)
        infos = [found] if found.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((i.path, i.size) for i in infos if i.is_file and not i.base_name.startswith((".", "_")))
        out: list[Files] = []
        held = 0
        for path, size in files:
            if not out or held + size > self.split:
                out.append(Files([]))
                held = 0
            out[-1].files.append(path)
            held += size
        return out or [Files([])]

    def wanted(self, headers: dict[str, str]) -> bool:
        return (not self.types or headers.get("warc-type") in self.types) and all(headers.get(k) in v for k, v in self.headers.items())

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        for path in partition.files:
            with store.open_input_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 18)
                while (record := parse_headers(stream)) is not None:
                    after = stream.tell() + record.length
                    if self.wanted(record.headers):
                        row = self.row(stream, record, path)
                        rows.append(row)
                        held += 200 + len(row["payload"] or b"")
                    stream.seek(after)
                    if held > BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    def row(self, stream, record: Record, path: str) -> dict:
        """An HTTP block is split into its own headers, which tell the length of the payload, and the payload."""
        out = {c: record.headers.get(h) for c, h in FIELDS.items()}
        out |= {"content_length": record.length, "payload_length": record.length, "payload": None, "file": path}
        left = record.length
        if record.headers.get("content-type", "").startswith("application/http"):
            while left > 0:
                line = stream.readline(left)
                left -= len(line)
                if line in (b"\r\n", b"\n", b""):
                    break
                if m := re.match(rb"content-length:\s*(\d+)", line, re.I):
                    out["payload_length"] = int(m[1])
        if self.payload and record.headers.get("warc-type") != "revisit":
            out["payload"] = stream.read(left)
        return out


class PushingWarcReader(WarcReader):
    """Takes equality with, and membership in, literals on header columns out of the filters; the rest is left to Spark."""

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column not in FIELDS:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            known = self.headers.get(FIELDS[column])
            self.headers[FIELDS[column]] = values if known is None else known & values


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (PushingWarcReader if self.options.get("pushdown") == "true" else WarcReader)(self.options)


def read_warc(spark: SparkSession, path: str, record_types=(), payload: bool = True, **headers: str) -> DataFrame:
    """The records in ``path``. ``record_types`` and the values of header columns are applied before payloads are read."""
    spark.dataSource.register(WarcSource)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format("warc").option("recordTypes", ",".join(record_types)).option("payload", str(payload).lower()).option("pushdown", pushdown)
    for column, value in headers.items():
        reader = reader.option(f"header.{column}", value)
    return reader.load(path)


def page_number(record_id: Column) -> Column:
    """The id that a record was written with; null for ``none``."""
    return F.nullif(F.regexp_extract(record_id, f"^{ID}(-?[0-9]+)>$", 1), F.lit("")).cast("long")
