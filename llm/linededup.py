"""Line-level deduplication across documents.

Each document's lines are normalised and hashed to 128 bits in the scan; only
its distinct keys are exploded, as ``(key, doc_id)`` rows.  Documents per key
are counted by a distinct count, which Spark spreads over ``(key, doc_id)``
before it sums per key, so a key found in a third of all documents is summed
from partial counts.  The keys over the threshold are written as a table of their
own, so that its join with the documents' keys can be broadcast or split like any
skewed join, and go back to the documents that hold them.  One pass
rebuilds every text from the remaining lines in order.
Only the rebuilding shuffles texts, once, by ``doc_id``.

Defined results: null or empty text is one empty line; a key of fewer code
points than ``min_key_chars`` is never dropped; a text that loses all lines
becomes empty; rows with the same ``doc_id`` (null included) count as one
document; an empty table stays empty.  Other columns pass through unless they
have the name of a result column, which then replaces them.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, ship

_BLANKS = b" \t\n\x0b\x0c\r"
_KEYS = "__line_dedup_keys"


def _key(line: bytes, min_chars: int) -> bytes | None:
    line = line.strip(_BLANKS).lower()  # bytes.lower() is A-Z only
    if len(line) < 4 * min_chars and len(line.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line)


def line_keys(docs: DataFrame, min_key_chars: int = 1) -> DataFrame:
    """``doc_id, key``: the distinct line keys of each row."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = {_key(line, min_key_chars) for line in (text.as_py() or b"").split(b"\n")}
                found.discard(None)
                ids.extend([doc_id] * len(found))
                keys.extend(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")
                       ).mapInArrow(run, "doc_id long, key binary")


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_key_chars: int = 1) -> DataFrame:
    """The rows of ``docs`` with the remaining lines as ``text``, and ``n_lines`` (before), ``n_dropped``."""
    ship(docs.sparkSession)
    keys = line_keys(docs, min_key_chars)
    frequent = cut_lineage(keys.groupBy("key").agg(F.count_distinct(F.struct("doc_id")).alias("n"))
                           .where(F.col("n") >= min_docs).select("key"))
    of_doc = (keys.join(frequent, "key").groupBy(F.col("doc_id").alias("__line_dedup_id"))
              .agg(F.collect_set("key").alias(_KEYS)))
    docs = docs.drop("n_lines", "n_dropped")
    joined = docs.join(of_doc, F.col("doc_id").cast("long").eqNullSafe(F.col("__line_dedup_id")), "left").drop("__line_dedup_id")
    joined = joined.withColumn("text", F.col("text").cast("string"))
    kept = [f for f in joined.schema.fields if f.name != _KEYS]
    schema = T.StructType([*kept, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches):
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(batch.column("text").cast(pa.binary()), batch.column(_KEYS), strict=True):
                lines = (text.as_py() or b"").split(b"\n")
                drop = set(drop.as_py() or ())
                left = [x for x in lines if _key(x, min_key_chars) not in drop] if drop else lines
                texts.append(b"\n".join(left))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
            columns = [pa.array(texts, pa.binary()).cast(pa.string()) if f.name == "text" else batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                             [f.name for f in schema.fields])

    return joined.mapInArrow(run, schema)
