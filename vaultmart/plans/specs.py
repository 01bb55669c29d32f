"""Metadata records that drive every builder.

The warehouse is described by small frozen records, one per staging source,
hub, link, satellite and mart measure.  Builders read these records; adding a
source or a measure is a metadata change, not a code change.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F


@dataclass(frozen=True)
class OdsSpec:
    """One staging source and its typed ODS table."""

    name: str
    date_field: str                       # typed column whose year selects the slice
    columns: tuple[tuple[str, str], ...]  # (column, Spark SQL type) of the ODS table
    epoch_ms_field: str | None = None     # raw epoch-ms column turned into ``date_field``


@dataclass(frozen=True)
class HubSource:
    """One feed of a hub: a hashed table and the column holding the business key."""

    view: str
    source: str
    key_column: str


@dataclass(frozen=True)
class HubSpec:
    name: str
    sources: tuple[HubSource, ...]        # in priority order: earlier feeds win a tie


@dataclass(frozen=True)
class LinkSpec:
    name: str
    source: str
    hubs: tuple[str, ...]


@dataclass(frozen=True)
class SatSpec:
    name: str
    source: str
    context: tuple[str, ...]
    parent: str                           # hub or link whose key the satellite hangs on
    first_only: bool                      # keep the first row per (pk, hashdiff) of the year


@dataclass(frozen=True)
class MeasureSpec:
    """One fact measure of the report mart."""

    link: str
    from_billing: bool                    # report date = billing period (else link date)
    fields: tuple[str, ...]
    name: str
    value: callable = field(compare=False)  # () -> per-row Column; the measure is its sum


# --- fixed values: names, date fields and groupings of the warehouse -------------
# ODS sources and the field that decides the year of a row:
#   billing -> created_at, issue -> start_time, payment -> pay_date, traffic -> traffic_time
# Hubs and their feeds, in load order:
#   user <- user_mdm, user_payment; account; billing_period; paysys;
#   service <- service_issue, service_billing; tariff; device
# Links: billing, issue, payment, traffic
# Satellites and context columns:
#   user (payment): phone; payment (payment): pay_doc_num, pay_sum;
#   issue (issue): title, description, end_time; billing (billing): billing_sum;
#   traffic (traffic): bytes_sent, bytes_received; device (traffic): device_ip_addr
# Mart dimensions: report_year, legal_type, district, billing_mode, registration_year (+ is_vip)
# Mart measures: payment_sum = sum(pay_sum), billing_sum = sum(billing_sum),
#   issue_cnt = count(*), traffic_amount = sum(bigint bytes_sent + bigint bytes_received)
# Small mart (first version) dimensions: billing_year, legal_type, district, registration_year
# Stored tables: ods_<source>, ods_t_<source>, ods_t_<source>_hashed, ods_t_user, ods_t_user_hashed,
#   dds_t_hub_<hub>, dds_t_lnk_<link>, dds_t_sat_<satellite>, dm_traffic,
#   dm_report_dim_<dimension>, dm_report_fct, dm_payment_dim_<dimension>, dm_payment_fct
# ----------------------------------------------------------------------------------

ODS_SPECS: dict[str, OdsSpec] = {
    "billing": OdsSpec("billing", "created_at", (
        ("user_id", "int"), ("billing_period", "string"), ("service", "string"),
        ("tariff", "string"), ("billing_sum", "decimal(10,2)"), ("created_at", "date"))),
    "issue": OdsSpec("issue", "start_time", (
        ("user_id", "int"), ("start_time", "timestamp_ntz"), ("end_time", "timestamp_ntz"),
        ("title", "string"), ("description", "string"), ("service", "string"))),
    "payment": OdsSpec("payment", "pay_date", (
        ("user_id", "int"), ("pay_doc_type", "string"), ("pay_doc_num", "int"),
        ("account", "string"), ("phone", "string"), ("billing_period", "string"),
        ("pay_date", "date"), ("pay_sum", "decimal(10,2)"))),
    "traffic": OdsSpec("traffic", "traffic_time", (
        ("user_id", "int"), ("traffic_time", "timestamp_ntz"), ("device_id", "string"),
        ("device_ip_addr", "string"), ("bytes_sent", "int"), ("bytes_received", "int")),
        epoch_ms_field="traffic_ms"),
}

HUBS: tuple[HubSpec, ...] = (
    HubSpec("user", (HubSource("user_mdm", "mdm", "user_id"),
                     HubSource("user_payment", "payment", "user_id"))),
    HubSpec("account", (HubSource("account", "payment", "account"),)),
    HubSpec("billing_period", (HubSource("billing_period", "payment", "billing_period"),)),
    HubSpec("paysys", (HubSource("paysys", "payment", "pay_doc_type"),)),
    HubSpec("service", (HubSource("service_issue", "issue", "service"),
                        HubSource("service_billing", "billing", "service"))),
    HubSpec("tariff", (HubSource("tariff", "billing", "tariff"),)),
    HubSpec("device", (HubSource("device", "traffic", "device_id"),)),
)
HUB_BY_NAME = {h.name: h for h in HUBS}

LINKS: tuple[LinkSpec, ...] = (
    LinkSpec("billing", "billing", ("user", "billing_period", "service", "tariff")),
    LinkSpec("issue", "issue", ("user", "service")),
    LinkSpec("payment", "payment", ("user", "account", "billing_period", "paysys")),
    LinkSpec("traffic", "traffic", ("user", "device")),
)
LINK_BY_NAME = {lk.name: lk for lk in LINKS}
LINK_BY_SOURCE = {lk.source: lk for lk in LINKS}  # each event source has one

SATS: tuple[SatSpec, ...] = (
    SatSpec("user", "payment", ("phone",), "user", True),
    SatSpec("payment", "payment", ("pay_doc_num", "pay_sum"), "payment", False),
    SatSpec("issue", "issue", ("title", "description", "end_time"), "issue", False),
    SatSpec("billing", "billing", ("billing_sum",), "billing", False),
    SatSpec("traffic", "traffic", ("bytes_sent", "bytes_received"), "traffic", False),
    SatSpec("device", "traffic", ("device_ip_addr",), "device", True),
)
# The master-data satellite follows the rule of the non-link satellites.
SAT_USER_MDM = SatSpec("user_mdm", "mdm", ("legal_type", "district", "billing_mode", "is_vip"),
                       "user", True)
SAT_BY_NAME = {s.name: s for s in SATS + (SAT_USER_MDM,)}

# First warehouse version: the user satellite kept every effective date, and the
# document type was context of a payment.
SAT_USER_V1 = SatSpec("user", "payment", ("phone",), "user", False)
SAT_PAYMENT_V1 = SatSpec("payment_v1", "payment", ("pay_doc_type", "pay_doc_num", "pay_sum"), "payment", False)

DM_DIMENSIONS: tuple[str, ...] = ("report_year", "legal_type", "district", "billing_mode",
                                  "registration_year")
DM_V1_DIMENSIONS: tuple[str, ...] = ("billing_year", "legal_type", "district",
                                     "registration_year")

MEASURES: tuple[MeasureSpec, ...] = (
    MeasureSpec("payment", True, ("pay_sum",), "payment_sum",
                lambda: F.col("pay_sum")),
    MeasureSpec("billing", True, ("billing_sum",), "billing_sum",
                lambda: F.col("billing_sum")),
    MeasureSpec("issue", False, (), "issue_cnt",
                lambda: F.lit(1).cast("long")),
    MeasureSpec("traffic", False, ("bytes_sent", "bytes_received"), "traffic_amount",
                lambda: F.col("bytes_sent").cast("long") + F.col("bytes_received").cast("long")),
)
MEASURE_BY_LINK = {m.link: m for m in MEASURES}


# Partition column of the stored links: the report year of the measure that reads them.
LINK_YEAR = "link_year"
# Files per partition of a stored link or satellite, the same for all: at full size, such that one holds about
# 128 MB.  A warehouse keeps its number; spark.vaultmart.buckets sets it for a new one.
BUCKETS = 8
# Users of the master data in a task, which makes some hundred bytes of each for every yearly run.
USERS_PER_TASK = 20_000
# Events in a task that groups and joins them by business key: the keys take a tenth of their memory as bytes of
# a shuffle, so a size in bytes does not bound it.
EVENTS_PER_TASK = 200_000


def measure_type(m: MeasureSpec) -> str:
    """Declared type of a measure: money as decimal(38,2), counts and bytes as bigint."""
    return "decimal(38,2)" if m.name in ("payment_sum", "billing_sum") else "bigint"
