"""Round trip through the archives; every index entry is a gzip member that holds one record."""

import glob
import gzip
import hashlib
import io
import json
import os
import tracemalloc
import zlib
from base64 import b32encode
from collections import Counter

import pytest

from llm import warc


def archives(spark, frame, workdir, pages):
    df = frame(pages, "page_id long, url string, html string, digest int")
    warc.write_monolithic(warc.records(df, 3), f"{workdir}/mono")
    done = warc.normalise(spark, f"{workdir}/mono", f"{workdir}/members").collect()
    return done, warc.read_records(spark, f"{workdir}/members").collect()


def test_round_trip(spark, frame, workdir):
    texts = ["<p>a</p>", None, "", "é\r\n\r\nWARC/1.0\r\n\r\n", "x" * 3_000_000, "<p>a</p>", "ab", "ab", "\r\n", "abc", "abc\0"]
    pages = [(i, f"http://h/{i}\r\nX: y", t, 0) for i, t in enumerate(texts)]
    pages += [(20, None, "<p>a</p>", 0), (None, "u", "<p>a</p>", 0), (None, None, "lonely", 0), (9, "again", "abc", 0)]
    done, rows = archives(spark, frame, workdir, pages)
    smallest = {}
    for i, _, t, _ in pages:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    want = Counter()
    for i, url, t, _ in pages:
        data = (t or "").encode()
        first = smallest.get(t or "")
        again = len(data) >= 3 and first is not None and i != first
        digest = b32encode(hashlib.sha1(data).digest()).decode()
        want[i, url and url.replace("\r", "").replace("\n", ""), "revisit" if again else "response", first if again else None,
             b"" if again else data, len(data), digest] += 1
    got = Counter((r.page_id, r.url, r.record_type, r.refers_to, bytes(r.payload), r.payload_bytes, r.payload_digest) for r in rows)
    assert got == want
    assert sum(d.records for d in done) == len(pages)
    for path in glob.glob(f"{workdir}/members/*.index.jsonl"):
        data = open(path.replace(".index.jsonl", ".warc.gz"), "rb").read()
        at = 0
        for x in map(json.loads, open(path)):
            assert x["offset"] == at
            record = gzip.decompress(data[at:at + x["length"]])
            assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n")
            at += x["length"]
        assert at == len(data)
    for path in glob.glob(f"{workdir}/mono/*.gz"):  # a single stream per file
        import zlib
        d = zlib.decompressobj(31)
        d.decompress(open(path, "rb").read())
        assert d.eof and not d.unused_data


def test_empty_table(spark, workdir):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_monolithic(warc.records(df), f"{workdir}/mono")
    assert warc.normalise(spark, f"{workdir}/mono", f"{workdir}/members").agg({"records": "sum"}).first()[0] in (None, 0)


def _records(n):
    body = lambda i: b"x%d " % i * 50
    return [b"WARC/1.0\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body(i)), body(i)) for i in range(n)]


def _read(data):
    return list(warc._Reader(warc._inflated(io.BytesIO(data))))


def test_members_and_padding():
    parts = _records(9)
    assert _read(gzip.compress(b"".join(parts))) == parts
    assert _read(b"".join(gzip.compress(p) for p in parts)) == parts
    assert _read(gzip.compress(b"".join(parts[:4])) + b"\0" * 700 + gzip.compress(b"".join(parts[4:])) + b"\0" * 9) == parts


@pytest.mark.parametrize("kind", ["flush point", "trailer", "second member", "head of the second member", "empty"])
def test_damaged_archives_are_errors(kind):
    parts = _records(400)
    flushed = zlib.compressobj(6, zlib.DEFLATED, 31)
    first = flushed.compress(b"".join(parts[:100])) + flushed.flush(zlib.Z_FULL_FLUSH)
    whole = gzip.compress(b"".join(parts))
    two = gzip.compress(b"".join(parts[:200])) + gzip.compress(b"".join(parts[200:]))
    damaged = {"flush point": first, "trailer": whole[:-8], "second member": two[:-30], "empty": b"",
               "head of the second member": gzip.compress(b"".join(parts[:200])) + b"\x1f\x8b\x08"}[kind]
    with pytest.raises((ValueError, zlib.error)):
        _read(damaged)


def test_damaged_archive_fails_the_job(spark, workdir):
    os.mkdir(f"{workdir}/mono")
    with open(f"{workdir}/mono/part-0.txt.gz", "wb") as f:
        f.write(gzip.compress(b"".join(_records(50)))[:-8])
    with pytest.raises(Exception, match="ends inside a gzip member"):
        warc.normalise(spark, f"{workdir}/mono", f"{workdir}/members").collect()
    assert not glob.glob(f"{workdir}/members/*.warc.gz")


def test_a_run_of_zeros_is_inflated_in_steps():
    data = gzip.compress(b"\0" * 200_000_000)
    tracemalloc.start()
    sizes = [len(c) for c in warc._inflated(io.BytesIO(data))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 200_000_000 and max(sizes) <= warc.CHUNK and peak < 16 << 20
