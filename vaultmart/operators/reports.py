"""Analyst queries over the traffic mart and the ODS (Q1-Q10).

Every top-k orders by the measure and then by the key columns, so ties are
broken the same way everywhere.  ``orderBy(...).limit(k)`` plans as
TakeOrderedAndProject: each task keeps its own top k, only k rows per task
reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _year(df: DataFrame, year: int) -> DataFrame:
    return df.filter(F.col("year") == F.lit(str(year)))


def top_users(mart: DataFrame, year: int, k: int = 20) -> DataFrame:
    """Q2: the year's k heaviest users by average download."""
    return (_year(mart, year)
            .orderBy(F.desc("bts_received_avg"), F.asc("user_id")).limit(k))


def top_users_all_years(mart: DataFrame, k: int = 100) -> DataFrame:
    """Q9: top k (user, year) rows over all years."""
    return mart.orderBy(F.desc("bts_received_avg"), F.asc("user_id"), F.asc("year")).limit(k)


def bottom_users(mart: DataFrame, year: int, k: int = 10) -> DataFrame:
    """Q7: the year's k lightest users."""
    return (_year(mart, year)
            .orderBy(F.asc("bts_received_avg"), F.asc("user_id")).limit(k))


def min_of_max_user(mart: DataFrame, year: int) -> DataFrame:
    """Q4: the user with the smallest yearly maximum (one row)."""
    return (_year(mart, year).select("user_id", "bts_received_max", "year")
            .orderBy(F.asc("bts_received_max"), F.asc("user_id")).limit(1))


def min_user_payments(mart: DataFrame, ods_payment: DataFrame, year: int) -> DataFrame:
    """Q5: that user's payments of the year, largest first.

    ``user_id = (SELECT ... ORDER BY ... LIMIT 1)``: a scalar subquery, run
    once; the payments are then a plain filter.
    """
    who = min_of_max_user(mart, year).select("user_id").scalar()
    return (_year(ods_payment, year).filter(F.col("user_id") == who)
            .orderBy(F.desc("pay_sum"), F.asc("pay_doc_num")))


def above_average_users(mart: DataFrame, year: int) -> DataFrame:
    """Q3: users whose yearly average is above the average of all users.

    The set comes back as rows, one user per row, rather than as one
    ``collect_set`` array: an array of all qualifying users would be built in a
    single task and grows with the user base.  The average is a scalar subquery,
    run once.
    """
    rows = _year(mart, year)
    avg = rows.agg(F.avg("bts_received_avg")).scalar()
    return rows.filter(F.col("bts_received_avg") > avg).select("user_id").distinct()


def max_avg_by_year(mart: DataFrame) -> DataFrame:
    """Q6: highest yearly average per year."""
    return mart.groupBy("year").agg(F.max("bts_received_avg").alias("max_bts_received_avg"))


def users_over_years(mart: DataFrame, users: list[int]) -> DataFrame:
    """Q8: the chosen users' rows over all years, newest year first per user."""
    return (mart.filter(F.col("user_id").isin(users))
            .orderBy(F.asc("user_id"), F.desc("year")))


def user_row_counts(ods_traffic: DataFrame, users: list[int], year: int) -> DataFrame:
    """Q10: traffic rows per chosen user in one year."""
    return (_year(ods_traffic, year).filter(F.col("user_id").isin(users))
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("row_count")))


def top_users_issues(mart: DataFrame, ods_issue: DataFrame, year: int, service: str,
                     k: int = 20) -> DataFrame:
    """Q1: the year's heaviest downloaders joined to their issues on one service.

    ``t LEFT JOIN i ... WHERE i.year = Y AND i.service = S`` keeps only matched
    rows, so it is an inner join; both sides are filtered before the shuffle.
    """
    t = _year(mart, year)
    i = (_year(ods_issue, year).filter(F.col("service") == F.lit(service))
         .withColumnRenamed("user_id", "issue_user_id").withColumnRenamed("year", "issue_year"))
    joined = t.join(i, t.user_id == i.issue_user_id, "inner")
    return (joined.orderBy(F.desc("bts_received_avg"), F.asc("user_id"), F.asc("start_time"),
                           F.asc("description"))
            .limit(k))
