"""Data checks of the load, as queries (V1-V7).

Each check is one aggregate job; distinct counts plan as two-phase
aggregates (partial distinct per task, then count), so no value is gathered in
one place.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.casts import epoch_ms_to_ts, lenient, year_of
from ..plans.specs import ODS_SPECS


def _stg_year(stg: DataFrame, source: str):
    spec = ODS_SPECS[source]
    if spec.epoch_ms_field:
        return year_of(epoch_ms_to_ts(spec.epoch_ms_field))
    typ = dict(spec.columns)[spec.date_field]
    return year_of(lenient(spec.date_field, typ))


# Bins of a histogram.  Bins of one year, which each task adds, are merged before any others, and exactly, so fewer
# distinct years than bins are counted exactly.
MOST_YEARS = 10_000


def counted_by_year(stg: DataFrame, source: str, seen: Observation) -> DataFrame:
    """``stg``, its rows per year counted into ``seen`` (``bins``) while it is loaded."""
    return (stg.withColumn("_loaded_year", _stg_year(stg, source))
            .observe(seen, F.histogram_numeric("_loaded_year", F.lit(MOST_YEARS)).alias("bins")).drop("_loaded_year"))


def rows_by_year(seen: Observation, ods: DataFrame, source: str) -> DataFrame:
    """V1: rows per year in staging, counted by the load itself, and in the stored ODS (by partition)."""
    spark = ods.sparkSession
    counts: Counter = Counter()
    for b in seen.get["bins"] or []:  # a year has a bin from each task, or one of several tasks
        counts[round(b["x"])] += round(b["y"])
    if len(counts) >= MOST_YEARS:
        raise ValueError(f"{source} has more years than the load counts")
    s = spark.createDataFrame(sorted(counts.items()), "year int, stg_rows long")
    o = (ods.select(F.col("year").cast("int").alias("year"))
         .groupBy("year").agg(F.count(F.lit(1)).alias("ods_rows")))
    return (s.join(o, "year", "full")
            .select(F.lit(source).alias("source"), "year",
                    F.coalesce("stg_rows", F.lit(0)).alias("stg_rows"),
                    F.coalesce("ods_rows", F.lit(0)).alias("ods_rows")))


def partition_check(ods: DataFrame, source: str) -> DataFrame:
    """Partitions present, rows in each, and rows whose date falls in it."""
    date_field = ODS_SPECS[source].date_field
    match = (year_of(date_field).cast("string") == F.col("year")).cast("int")
    return (ods.groupBy("year")
            .agg(F.count(F.lit(1)).alias("row_count"), F.sum(match).alias("matching_rows"))
            .select(F.lit(source).alias("source"), "year", "row_count", "matching_rows"))


def date_bounds(ods: DataFrame, source: str) -> DataFrame:
    """V3: first and last value of the date field, as fixed text."""
    field = ODS_SPECS[source].date_field
    return ods.agg(
        F.lit(source).alias("source"),
        F.min(field).cast("string").alias("min_value"), F.max(field).cast("string").alias("max_value"))


def period_bounds(stg_billing: DataFrame) -> DataFrame:
    """V3: first and last billing period."""
    return stg_billing.agg(F.min("billing_period").alias("min_period"),
                           F.max("billing_period").alias("max_period"))


def epoch_bounds(stg_traffic: DataFrame) -> DataFrame:
    """V3: raw epoch bounds and the same bounds converted to whole seconds."""
    return stg_traffic.agg(
        F.min("traffic_ms").alias("min_ms"), F.max("traffic_ms").alias("max_ms"),
        epoch_ms_to_ts(F.min("traffic_ms")).alias("min_time"),
        epoch_ms_to_ts(F.max("traffic_ms")).alias("max_time"))


def distinct_users(stg: DataFrame, source: str) -> DataFrame:
    """V4: number of distinct users of a staging source."""
    return stg.agg(F.lit(source).alias("source"),
                   F.count_distinct("user_id").alias("distinct_users"))


def distinct_user_ids(stg: DataFrame, source: str) -> DataFrame:
    """The distinct users of a staging source, one row each."""
    return stg.select(F.lit(source).alias("source"),
                      lenient("user_id", "int").alias("user_id")).distinct()


def distinct_devices(stg_traffic: DataFrame) -> DataFrame:
    """V4: devices seen in traffic and how many rows each produced."""
    return stg_traffic.groupBy("device_id").agg(F.count(F.lit(1)).alias("row_count"))


def castability(stg: DataFrame, source: str) -> DataFrame:
    """V5: per staging text column, rows whose text does not cast to the ODS type."""
    spec = ODS_SPECS[source]
    text_cols = [(c, t) for c, t in spec.columns
                 if c in stg.columns and dict(stg.dtypes)[c] == "string" and t != "string"]
    aggs = []
    for c, t in text_cols:
        bad = (F.col(c).isNotNull() & lenient(c, t).isNull()).cast("int")
        aggs += [F.sum(bad).alias(f"bad_{c}")]
    if not aggs:
        return None
    wide = stg.agg(F.count(F.lit(1)).alias("row_count"), *aggs)
    parts = [wide.select(F.lit(source).alias("source"), F.lit(c).alias("column_name"),
                         F.lit(t).alias("target_type"), "row_count",
                         F.col(f"bad_{c}").alias("uncastable"))
             for c, t in text_cols]
    return reduce(lambda a, b: a.unionByName(b), parts)


def years_after(ods: DataFrame, bound: int) -> DataFrame:
    """V6: ``GROUP BY year HAVING year > bound``."""
    return (ods.groupBy("year").agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("year").cast("int") > F.lit(bound)))


def mart_row_count(mart: DataFrame) -> DataFrame:
    """V7: rows, distinct users and years of the mart."""
    return mart.agg(F.count(F.lit(1)).alias("row_count"),
                    F.count_distinct("user_id").alias("distinct_users"),
                    F.count_distinct("year").alias("years"))
