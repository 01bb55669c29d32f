"""Consecutive numbers without a single task: range-partitioned sort, rows per partition, prefix sums."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

_ROW_BITS = 33  # fixed value: low bits of monotonically_increasing_id() that number the rows of a partition


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place in ``order`` (from 1) as ``name``.

    Every partition holds one range of the order and is sorted by itself; the
    places before it are the sums of the partitions before it.  The driver sees
    one count per partition, never a row.
    """
    spark = rows.sparkSession
    placed = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    sizes = sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_part long, _before long")
    inside = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (placed.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")  # one row per partition
            .select(*rows.columns, (F.col("_before") + inside + 1).alias(name)))
