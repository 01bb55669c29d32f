"""Table IO: declared-schema staging reads and year-partitioned Parquet tables.

Only this module writes.  Tables are Parquet folders partitioned by a string
column (``year``); a year is replaced as a whole, the other years are never
touched:

* ``replace_slice``   INSERT OVERWRITE ... PARTITION (year=Y) / DELETE year + INSERT
* ``write_slices``    the same for every year present in one job (dynamic overwrite)
* ``append``          INSERT INTO
* ``reload``          TRUNCATE + INSERT
* ``list_partitions`` SHOW PARTITIONS
* ``drop_partitions`` ALTER TABLE ... DROP PARTITION (year > 2012), any predicate
* ``read_bucketed``   a partitioned table whose files are bucketed and sorted by a
  key, read through the session catalog: two of them with the same key and number
  of buckets join without a shuffle

A builder that reads the table it replaces (satellites, marts) is cut from its
input with a reliable checkpoint before the old files go.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType)

from ..session import CODEC, cut_lineage

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name of a NULL partition value

# Declared staging schemas.  `sum` and `timestamp` are renamed to pay_sum /
# billing_sum / traffic_ms so that no column needs quoting.
STG_SCHEMAS: dict[str, StructType] = {
    "billing": StructType([
        StructField("user_id", IntegerType()), StructField("billing_period", StringType()),
        StructField("service", StringType()), StructField("tariff", StringType()),
        StructField("billing_sum", StringType()), StructField("created_at", StringType())]),
    "issue": StructType([
        StructField("user_id", StringType()), StructField("start_time", StringType()),
        StructField("end_time", StringType()), StructField("title", StringType()),
        StructField("description", StringType()), StructField("service", StringType())]),
    "payment": StructType([
        StructField("user_id", IntegerType()), StructField("pay_doc_type", StringType()),
        StructField("pay_doc_num", StringType()), StructField("account", StringType()),
        StructField("phone", StringType()), StructField("billing_period", StringType()),
        StructField("pay_date", StringType()), StructField("pay_sum", StringType())]),
    "traffic": StructType([
        StructField("user_id", IntegerType()), StructField("traffic_ms", LongType()),
        StructField("device_id", StringType()), StructField("device_ip_addr", StringType()),
        StructField("bytes_sent", IntegerType()), StructField("bytes_received", IntegerType())]),
}


def read_stg(spark: SparkSession, path: str, name: str) -> DataFrame:
    """External table over Parquet with a declared schema."""
    return spark.read.schema(STG_SCHEMAS[name]).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def read_partitioned(spark: SparkSession, path: str, schema: StructType | None = None,
                     column: str = "year") -> DataFrame:
    """Read a partitioned table; the partition column stays a string."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        if column not in schema.fieldNames():
            schema = StructType(schema.fields + [StructField(column, StringType())])
        reader = reader.schema(schema)
    if not path_exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    df = reader.parquet(path)
    # partition discovery would type `year=1997` as int; the column is declared string
    return df.withColumn(column, F.col(column).cast("string")) if column in df.columns else df


def _files(spark: SparkSession, path: str) -> set[str]:
    fs, p = _fs(spark, path)
    return {st.getPath().getName() for st in fs.listStatus(p)}


def _work_folder(path: str) -> str:
    """Folder beside a table for slices on their way; its name starts with a dot, so no read of the table sees it."""
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/.slices_{name}"


def _rename(fs, source, target) -> None:
    """Hadoop's rename reports failure as False."""
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def recover_slice(spark: SparkSession, path: str, value: str, column: str = "year") -> None:
    """Undo what a killed replacement of the slice left: a slice that was moved aside and not replaced comes back."""
    fs, work = _fs(spark, _work_folder(path))
    if not fs.exists(work):
        return
    target = _fs(spark, f"{path.rstrip('/')}/{column}={value}")[1]
    for status in fs.listStatus(work):
        name = status.getPath().getName()
        if name.startswith(f"{column}={value}.") and name.endswith(".old") and not fs.exists(target):
            _rename(fs, status.getPath(), target)
        elif name.startswith(f"{column}={value}."):
            fs.delete(status.getPath(), True)


@dataclass(frozen=True)
class Buckets:
    """File layout of a vault table: rows of a key lie in one of ``number`` files of their partition, sorted by it if asked."""

    key: str
    number: int
    dealt: bool = False  # rows to be written lie in the tasks of their buckets already
    ordered: bool = True


def _dealt(df: DataFrame, buckets: Buckets) -> DataFrame:
    return df if buckets.dealt else df.repartition(buckets.number, buckets.key)


def _write(df: DataFrame, path: str, buckets: Buckets | None) -> None:
    """Rows as Parquet files in a new folder, bucketed if asked."""
    if buckets is None:
        df.write.mode("overwrite").options(**CODEC).parquet(path)
        return
    spark, name = df.sparkSession, f"slice_{uuid.uuid4().hex}"
    writer = _dealt(df, buckets).write.options(**CODEC).bucketBy(buckets.number, buckets.key)
    (writer.sortBy(buckets.key) if buckets.ordered else writer).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table names their folder


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _register(spark: SparkSession, path: str, schema: StructType, buckets: Buckets, column: str) -> str:
    """The folder as a bucketed table of the session catalog, with the partitions that it has now."""
    name = "vault_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    fields = StructType([f for f in schema.fields if f.name != column] + [StructField(column, StringType())])
    fs, folder = _fs(spark, path)
    fs.mkdirs(folder)
    ordered = f"SORTED BY (`{buckets.key}`) " if buckets.ordered else ""
    options = ", ".join(f"'{k}' '{v}'" for k, v in CODEC.items())
    spark.sql(f"CREATE TABLE {name} ({_ddl(fields)}) USING parquet PARTITIONED BY (`{column}`) CLUSTERED BY (`{buckets.key}`) "
              f"{ordered}INTO {buckets.number} BUCKETS OPTIONS ({options}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def read_bucketed(spark: SparkSession, path: str, schema: StructType, buckets: Buckets, column: str = "year") -> DataFrame | None:
    """A bucketed, partitioned table (``None`` if it was never written); the partition column is a string."""
    return spark.table(_register(spark, path, schema, buckets, column)) if path_exists(spark, path) else None


def append_bucketed(df: DataFrame, path: str, buckets: Buckets, column: str) -> None:
    """Add rows to the partitions that they name, bucketed."""
    name = _register(df.sparkSession, path, df.schema, buckets, column)
    df.select(*[c for c in df.columns if c != column], column).transform(_dealt, buckets).write.insertInto(name)


def replace_slice(df: DataFrame, path: str, value: str, column: str = "year",
                  reads_target: bool = False, buckets: Buckets | None = None) -> None:
    """Replace the partition ``column=value`` by ``df`` (empty ``df`` empties it).

    The slice is written outside the table, the old one is moved aside, the new
    one moved in, and only then the old one is deleted.  A job that fails while
    writing leaves the table as it was; a failed move puts the old slice back;
    after a kill between the moves the next replacement (or ``recover_slice``) does.
    """
    spark = df.sparkSession
    if reads_target:
        df = cut_lineage(df)
    data = df.drop(column) if column in df.columns else df
    recover_slice(spark, path, value, column)
    stem = f"{_work_folder(path)}/{column}={value}.{uuid.uuid4().hex}"
    _write(data, f"{stem}.new", buckets)
    fs, target = _fs(spark, f"{path.rstrip('/')}/{column}={value}")
    new, old = _fs(spark, f"{stem}.new")[1], _fs(spark, f"{stem}.old")[1]
    fs.mkdirs(target.getParent())
    had = bool(fs.exists(target))
    if had:
        _rename(fs, target, old)
    try:
        _rename(fs, new, target)
    except Exception:
        if had:
            _rename(fs, old, target)
        raise
    if had:
        fs.delete(old, True)


def write_slices(df: DataFrame, path: str, column: str = "year", whole: bool = False) -> None:
    """Replace every partition present in ``df`` in one job; others stay.

    With ``whole`` the table holds exactly the partitions of ``df`` afterwards
    (a backfill: a year that has vanished from staging goes).
    """
    spark = df.sparkSession
    before = {v: _files(spark, f"{path.rstrip('/')}/{column}={v}") for v in list_partitions(spark, path, column)} if whole else {}
    (df.write.mode("overwrite").options(**CODEC).option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))
    # a partition whose files are those of before was not written: the data no longer have it
    drop_partitions(spark, path, lambda v: v in before and before[v] == _files(spark, f"{path.rstrip('/')}/{column}={v}"), column)


def append(df: DataFrame, path: str, column: str | None = None) -> None:
    writer = df.write.mode("append").options(**CODEC)
    if column:
        writer = writer.partitionBy(column)
    writer.parquet(path)


def reload(df: DataFrame, path: str, reads_target: bool = False) -> None:
    """Full reload (TRUNCATE + INSERT)."""
    if reads_target:
        df = cut_lineage(df)
    df.write.mode("overwrite").options(**CODEC).parquet(path)


def list_partitions(spark: SparkSession, path: str, column: str = "year") -> list[str]:
    """Partition values present in the folder, sorted (SHOW PARTITIONS)."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    prefix = f"{column}="
    values = [st.getPath().getName()[len(prefix):] for st in fs.listStatus(root)
              if st.isDirectory() and st.getPath().getName().startswith(prefix)]
    return sorted(values)


def drop_partitions(spark: SparkSession, path: str, predicate: Callable[[str], bool],
                    column: str = "year") -> list[str]:
    """Drop every partition whose value satisfies ``predicate``; returns the dropped ones.

    ``DROP PARTITION (year > 2012)`` takes a range; Spark's DDL takes only
    equality, so the values are listed and dropped one by one.  The partition
    of NULL values fits no predicate and stays.
    """
    dropped = []
    for value in list_partitions(spark, path, column):
        if value != NULL_PARTITION and predicate(value):
            fs, p = _fs(spark, f"{path.rstrip('/')}/{column}={value}")
            fs.delete(p, True)
            dropped.append(value)
    return dropped
