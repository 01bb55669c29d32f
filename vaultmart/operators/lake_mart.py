"""Per-group min / max / average mart of the lake.

``INSERT OVERWRITE TABLE dm_<t> PARTITION (year=Y) SELECT g, min(x), max(x),
avg(x), current_timestamp, current_user() FROM ods_<t> WHERE year=Y GROUP BY g``.
The average lands in an int column: Hive truncates, so does ``cast``.
One hash aggregate with map-side combine; the year filter is a partition filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def min_max_avg_mart(ods: DataFrame, measure: str = "bytes_received", group: str = "user_id",
                     year: int | None = None, prefix: str = "bts_received",
                     stamp: bool = False, updated_at: dt.datetime | None = None,
                     updated_by: str | None = None) -> DataFrame:
    """One row per group and year.  ``year=None`` builds every year in one job."""
    rows = ods if year is None else ods.filter(F.col("year") == F.lit(str(year)))
    out = (rows.groupBy(group, "year")
           .agg(F.min(measure).alias(f"{prefix}_min"),
                F.max(measure).alias(f"{prefix}_max"),
                F.avg(measure).cast("int").alias(f"{prefix}_avg")))
    if stamp:
        out = out.withColumn(
            "updated_at", F.lit(updated_at) if updated_at else F.current_timestamp())
        out = out.withColumn(
            "updated_by", F.lit(updated_by) if updated_by else F.current_user())
    cols = [group, f"{prefix}_min", f"{prefix}_max", f"{prefix}_avg"]
    if stamp:
        cols += ["updated_at", "updated_by"]
    return out.select(*cols, "year")
