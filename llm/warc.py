"""Monolithic gzip WARC archives, and their rewriting into one gzip member per record with an offset index.

``write_monolithic`` writes records with Spark's text writer: the gzip codec makes
every part file one gzip stream, and the line separator is the pair of line
breaks that ends a WARC record.  ``normalise`` gives each file to one task,
which inflates the stream once, writes every record as a member of its own and
beside the archive a sidecar of JSON lines (``offset, length`` of each member).
Both files are written under a temporary name and then moved, so a repeated
task replaces them by the same bytes.  ``read_records`` opens archives through
their sidecars only, member by member.  Memory holds one record at a time: a
stream is inflated a megabyte at a time however well it was compressed.  An archive
that does not end with the end of a gzip member and of a record is an error, never
a shorter archive.

Equal payloads (SHA-1, pre-aggregated before the shuffle) of at least
``min_bytes`` bytes are stored once, by the record of the smallest ``page_id``;
the others are revisit records with its id.  The join that tells them apart is
by digest, with one row per digest on the small side, so a payload held by a
third of all pages is split like any skewed join.

Defined results: null html is an empty payload; a null url has no target line,
and line breaks inside a url are left out of it; all rows of the smallest
``page_id`` of a payload are responses; a null ``page_id`` counts as the largest
(a payload of such rows only is a response each time); an empty table gives no
records.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship

CHUNK = 1 << 20
READ_BYTES = 32 << 20
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hexadecimal digits make four base32 digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, first_id``: of equal payloads, ``first_id`` is the smallest ``page_id``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload")
                        ).withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
    first = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"))
    return rows.join(first, "digest", "left")


def write_monolithic(rows: DataFrame, folder: str) -> None:
    """One gzip stream of WARC records per part file."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    size = F.octet_length("payload").cast("string")
    block = F.concat(F.lit(HTTP), size, F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", "")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("first_id"))),
                                 line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"))
    (rows.select("*", block.alias("block")).select(F.concat(head, F.col("block")).alias("value"))
     .write.mode("overwrite").option("compression", "gzip").option("lineSep", "\r\n\r\n").text(folder))


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a location as Spark writes it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of any number of members, at most ``CHUNK`` at a time; an error unless the last one ends properly."""
    inflate, begun = zlib.decompressobj(31), False
    while data := stream.read(CHUNK):
        while data:
            if inflate.eof:
                data = data.lstrip(b"\0")  # padding between or behind members
                if not data:
                    break
                inflate = zlib.decompressobj(31)
            begun = True
            yield inflate.decompress(data, CHUNK)
            data = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
    while begun and not inflate.eof and (data := inflate.decompress(b"", CHUNK)):
        yield data
    if not inflate.eof:
        raise ValueError("the archive ends inside a gzip member")


class _Reader:
    """Records of a stream of byte chunks."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.kept = chunks, bytearray()

    def _more(self) -> bool:
        data = next(self.chunks, None)
        if data is not None:
            self.kept += data
        return data is not None

    def __iter__(self) -> Iterator[bytes]:
        while True:
            searched = 0
            while (end := self.kept.find(b"\r\n\r\n", searched)) < 0:
                searched = max(0, len(self.kept) - 3)
                if not self._more():
                    if self.kept.strip():
                        raise ValueError("the archive ends inside a record head")
                    return
            total = end + 4 + int(_fields(bytes(self.kept[:end]))["content-length"]) + 4
            while len(self.kept) < total:
                if not self._more():
                    raise ValueError("the archive ends inside a record")
            yield bytes(self.kept[:total])
            del self.kept[:total]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)  # a header without a time: equal records give equal bytes
    return deflate.compress(data) + deflate.flush()


def files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``path`` of the files of a folder, without reading them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive of ``source`` into ``target``; ``archive, records, bytes`` of each new archive.

    The frame is lazy: writing it (or any other action) does the work.
    """
    ship(spark)

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = path.rsplit("/", 1)[1].split(".")[0]
                source_fs, at = _open(path)
                target_fs, folder = _open(target)
                target_fs.create_dir(folder, recursive=True)
                attempt = TaskContext.get().taskAttemptId()
                temporary = [f"{folder}/_{name}.{attempt}.{kind}" for kind in ("warc", "index")]
                offset = count = 0
                with source_fs.open_input_stream(at, compression=None) as stream, \
                        target_fs.open_output_stream(temporary[0], compression=None) as archive, \
                        target_fs.open_output_stream(temporary[1], compression=None) as index:
                    for record in _Reader(_inflated(stream)):
                        member = _member(record)
                        archive.write(member)
                        index.write(json.dumps({"archive": f"{name}.warc.gz", "offset": offset, "length": len(member)}).encode() + b"\n")
                        offset += len(member)
                        count += 1
                target_fs.move(temporary[0], f"{folder}/{name}.warc.gz")
                target_fs.move(temporary[1], f"{folder}/{name}.index.jsonl")
                yield pa.RecordBatch.from_pylist([{"archive": f"{name}.warc.gz", "records": count, "bytes": offset}])

    paths = files(spark, source, "*.gz")
    return paths.repartitionByRange(max(1, min(len(paths.inputFiles()), 1 << 14)), "path").mapInArrow(
        run, "archive string, records long, bytes long")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest`` of every indexed member.

    ``payload`` is what the record holds (empty for a revisit); bytes and digest are those of the full payload.
    The digest of a stored payload is computed from its bytes and must equal its header.
    """
    ship(spark)
    index = (spark.read.schema("archive string, offset long, length long").option("pathGlobFilter", "*.index.jsonl").json(folder))
    # the sidecars are a thousandth of the archives: tasks are ranges of about READ_BYTES of members, not of the sidecars
    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // READ_BYTES))
    index = index.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")

    def run(batches):
        handle, name = None, None
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                if x["archive"] != name:
                    fs, at = _open(folder)
                    name = x["archive"]
                    handle = fs.open_input_file(f"{at}/{name}")
                handle.seek(x["offset"])
                record = zlib.decompress(handle.read(x["length"]), 31)
                head, _, rest = record.partition(b"\r\n\r\n")
                field = _fields(head)
                http, _, payload = rest[:int(field["content-length"])].partition(b"\r\n\r\n")
                digest = field["warc-payload-digest"].removeprefix("sha1:")
                revisit = field["warc-type"] == "revisit"
                if not revisit and b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"{name}, {x['offset']}: the payload does not have the digest of its header")
                of = lambda key: int(field[key][10:-1]) if len(field.get(key, "")) > 11 else None  # noqa: E731, B023
                out.append((of("warc-record-id"), field.get("warc-target-uri"), field["warc-type"],
                            of("warc-refers-to") if revisit else None, payload,
                            int(http.rsplit(b": ", 1)[1]), digest))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(_TYPES)], _NAMES)

    return index.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload binary, "
                                 "payload_bytes long, payload_digest string")


_NAMES = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
