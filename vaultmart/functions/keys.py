"""Hash keys and hashdiffs of the vault.

``md5`` over the business key columns: each value as fixed text, trimmed,
upper-cased, with a backslash before every backslash, pipe and caret, NULL as
'^^' (``concat_ws`` would skip it and merge ('A', NULL, 'B') with ('A', 'B')),
joined by a double pipe.  No text can imitate the separator or a NULL.  No central counter is needed,
so hub, link and satellite keys are computed in parallel on every executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .casts import as_text

# fixed values: key text for NULL and the column separator
NULL_TEXT = "^^"
SEPARATOR = "||"
PLAIN_TYPES = ("tinyint", "smallint", "int", "bigint", "decimal", "date", "timestamp")


def hash_columns(df: DataFrame, columns: tuple[str, ...] | list[str]) -> Column:
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return _hash([(F.col(c), types[c]) for c in columns])


def business_key(df: DataFrame, columns: tuple[str, ...] | list[str]) -> Column:
    """The values that ``hash_columns`` tells apart, as a struct: equal structs have equal hashes and the other way round.

    Numbers and dates stay as they are, texts are trimmed and upper-cased.  Rows
    grouped and joined by it are a fraction as wide as rows with their hashes.
    """
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return F.struct(*[(F.upper(F.trim(F.col(c))) if types[c] == "string" else F.col(c)).alias(c) for c in columns])


def hash_key(df: DataFrame, key: str, columns: tuple[str, ...] | list[str]) -> Column:
    """``hash_columns`` of fields of the business key in column ``key``."""
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema[key].dataType.fields)
    return _hash([(F.col(f"{key}.{c}"), types[c]) for c in columns])


def _hash(values: list[tuple[Column, str]]) -> Column:
    parts = [F.coalesce(_key_text(c, kind), F.lit(NULL_TEXT)) for c, kind in values]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def _key_text(value: Column, kind: str) -> Column:
    """A value as key text; numbers and dates are digits and signs, which trimming, upper case and marks leave as they are."""
    text = as_text(value, kind)
    return text if kind.startswith(PLAIN_TYPES) else _escaped(F.upper(F.trim(text)))


def _escaped(text: Column) -> Column:
    for mark in "\\|^":
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text
