"""Staging -> typed ODS, and the hashed ODS rows the vault is loaded from.

``ods_slice`` is one yearly ``INSERT OVERWRITE ... PARTITION (year=Y) SELECT
... WHERE year(date_field) = Y``; ``ods_all_years`` is every year in one pass
(one scan of staging, written with dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import epoch_ms_to_ts, lenient, year_bounds_ms, year_of
from ..functions.keys import hash_columns
from ..plans.specs import HUBS, LINKS, ODS_SPECS, SAT_USER_MDM, SATS, USERS_PER_TASK, OdsSpec, SatSpec

# Business-key columns of each link key (the link's own hash key).
LINK_KEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "payment": ("user_id", "account", "billing_period", "pay_doc_type", "pay_doc_num"),
    "billing": ("user_id", "billing_period", "service", "tariff"),
    "issue": ("user_id", "service", "start_time"),
    "traffic": ("user_id", "device_id", "traffic_time"),
}

# Column holding each hub's business key in the staging sources.
HUB_KEY_COLUMN: dict[str, str] = {
    "user": "user_id", "account": "account", "billing_period": "billing_period",
    "paysys": "pay_doc_type", "service": "service", "tariff": "tariff", "device": "device_id",
}

MDM_COLUMNS = ("user_id", "legal_type", "district", "billing_mode", "is_vip", "registered_at")


def typed(stg: DataFrame, spec: OdsSpec) -> DataFrame:
    """Typed rows of a staging source; text that does not parse becomes NULL."""
    cols: list[Column] = []
    for name, spark_type in spec.columns:
        if spec.epoch_ms_field and name == spec.date_field:
            cols.append(epoch_ms_to_ts(spec.epoch_ms_field).alias(name))
        else:
            cols.append(lenient(name, spark_type).alias(name))
    return stg.select(*cols)


def _year_prefilter(stg: DataFrame, spec: OdsSpec, year: int) -> DataFrame:
    """A range on the raw column that Parquet statistics can prune.

    The epoch column has an exact one.  A text whose first character is one of
    ``1`` to ``9`` parses to the year only if it lies between the year and the next
    as text; every other text (blanks, signs, zeros) passes.  The cast decides
    afterwards, so no row is lost.
    """
    if spec.epoch_ms_field:
        lo, hi = year_bounds_ms(year)
        c = F.col(spec.epoch_ms_field)
        return stg.filter((c >= F.lit(lo)) & (c < F.lit(hi)))
    if dict(stg.dtypes)[spec.date_field] == "string" and 1000 <= year < 9999:
        c = F.col(spec.date_field)
        return stg.filter(((c >= F.lit(str(year))) & (c < F.lit(str(year + 1)))) | (c < F.lit("1")) | (c >= F.lit(":")))
    return stg


def ods_slice(stg: DataFrame, spec: OdsSpec | str, year: int) -> DataFrame:
    """One year of the ODS table: staging rows whose date field falls in ``year``."""
    spec = ODS_SPECS[spec] if isinstance(spec, str) else spec
    rows = typed(_year_prefilter(stg, spec, year), spec)
    return (rows.filter(year_of(spec.date_field) == F.lit(year))
            .withColumn("year", F.lit(str(year))))


def ods_all_years(stg: DataFrame, spec: OdsSpec | str) -> DataFrame:
    """Every year at once; rows without a valid date belong to no year and drop out."""
    spec = ODS_SPECS[spec] if isinstance(spec, str) else spec
    rows = typed(stg, spec)
    return (rows.filter(F.col(spec.date_field).isNotNull())
            .withColumn("year", year_of(spec.date_field).cast("string")))


def load_date(year: int) -> dt.date:
    """Run date of the yearly schedule: 1 January of the run year."""
    return dt.date(year, 1, 1)


def _hash_layout(source: str) -> tuple[dict[str, tuple[str, ...]], dict[str, tuple[str, ...]]]:
    keys: dict[str, tuple[str, ...]] = {}
    for hub in HUBS:
        for feed in hub.sources:
            if feed.source == source:
                keys[hub.name] = (feed.key_column,)
    for link in LINKS:
        if link.source == source:
            for member in link.hubs:
                keys.setdefault(member, (HUB_KEY_COLUMN[member],))
            keys[link.name] = LINK_KEY_COLUMNS[link.name]
    diffs = {s.name: s.context for s in SATS + (SAT_USER_MDM,) if s.source == source}
    return keys, diffs


def hashed(rows: DataFrame, source: str, load_dts: Column | dt.date | None = None,
           more: tuple[SatSpec, ...] = ()) -> DataFrame:
    """Hash staging: business keys -> ``<name>_pk``, contexts -> ``<name>_hashdiff``.

    ``load_dts`` is the run date of the batch; when None each row gets
    1 January of the year of its own ``effective_from`` (every yearly run at once).
    ``more`` names satellites whose hashdiff is added to the usual ones.  A key that the rows have already is kept.
    """
    keys, diffs = _hash_layout(source)
    diffs |= {s.name: s.context for s in more}
    date_field = "registered_at" if source == "mdm" else ODS_SPECS[source].date_field
    out = rows
    for name, cols in keys.items():
        if f"{name}_pk" not in rows.columns:
            out = out.withColumn(f"{name}_pk", hash_columns(rows, cols))
    for name, cols in diffs.items():
        out = out.withColumn(f"{name}_hashdiff", hash_columns(rows, cols))
    out = out.withColumn("effective_from", F.col(date_field))
    if load_dts is None:
        ld = F.make_date(F.year("effective_from"), F.lit(1), F.lit(1))
    elif isinstance(load_dts, Column):
        ld = load_dts
    else:
        ld = F.lit(load_dts)
    return (out.withColumn("load_dts", ld.cast("date"))
            .withColumn("rec_source", F.lit(source)))


def hashed_slice(ods_rows: DataFrame, source: str, year: int) -> DataFrame:
    """``ods_t_<source>_hashed`` rows of one run."""
    rows = ods_rows.drop("year") if "year" in ods_rows.columns else ods_rows
    h = hashed(rows, source, load_date(year))
    return h.filter(year_of("effective_from") == F.lit(year))


def spread(mdm: DataFrame) -> DataFrame:
    """Master data dealt by user, ``USERS_PER_TASK`` to a task: it comes in few splits, and each
    user becomes one row per run in the task that reads them."""
    return mdm.repartition(1 + mdm.count() // USERS_PER_TASK, "user_id")


def mdm_reload(mdm: DataFrame, year: int) -> DataFrame:
    """Master data copied in full and hashed; no year filter."""
    return hashed(mdm.select(*MDM_COLUMNS), "mdm", load_date(year))


def mdm_hashed(snapshots: DataFrame, year_column: str = "_year") -> DataFrame:
    """Hashed master data of every run; ``year_column`` is the year of the run that reloads the row."""
    rows = hashed(snapshots.select(*MDM_COLUMNS, year_column), "mdm", F.make_date(year_column, F.lit(1), F.lit(1)))
    return rows.drop(year_column)
