"""Yearly pipelines: the builders run in order and their results are stored.

Each function is one scheduled run for one year; tables live as Parquet
folders under ``root`` (``<root>/<table>/year=<Y>/``).  Re-running a year
replaces that year's slices and leaves the other years alone.

* ``run_lake_year``   staging -> ODS slices -> traffic mart slice
* ``run_lake_all``    every year of the lake in one job per table (backfill)
* ``run_vault_year``  ODS + hashed slices, MDM reload, hubs, links, satellites
* ``run_mart_year``   aggregates -> dimension fills -> dense fact slice
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StringType, StructField, StructType

from ..functions.casts import period_year
from ..functions.keys import hash_columns
from ..operators import ods as ods_ops
from ..operators import report_mart as rm
from ..operators import vault
from ..operators.lake_mart import min_max_avg_mart
from ..operators.ods import LINK_KEY_COLUMNS
from ..session import cut_lineage, scratch_scope
from ..sources import tables
from ..sources.fixtures import Staging
from .specs import (BUCKETS, DM_DIMENSIONS, DM_V1_DIMENSIONS, HUBS, LINK_BY_NAME, LINK_BY_SOURCE, LINK_YEAR, LINKS, MEASURE_BY_LINK, MEASURES,
                    ODS_SPECS, SAT_BY_NAME, SAT_USER_MDM, SATS, HubSpec, LinkSpec, MeasureSpec, SatSpec)

LAKE_SOURCES = ("billing", "issue", "payment", "traffic")


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _read(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    path = _path(root, name)
    if not tables.path_exists(spark, path):
        return None
    return spark.read.option("basePath", path).parquet(path)


# ------------------------------------------------------------------ lake

def run_lake_year(stg: Staging, root: str, year: int,
                  updated_at: dt.datetime | None = None, updated_by: str | None = None,
                  sources: tuple[str, ...] = LAKE_SOURCES) -> None:
    """ODS slices of the sources, then the traffic mart slice (it reads the ODS)."""
    spark = stg.payment.sparkSession
    for source in sources:
        tables.replace_slice(ods_ops.ods_slice(stg.source(source), source, year),
                             _path(root, f"ods_{source}"), str(year))
    ods_traffic = tables.read_partitioned(spark, _path(root, "ods_traffic"))
    mart = min_max_avg_mart(ods_traffic, year=year, stamp=True,
                            updated_at=updated_at, updated_by=updated_by)
    tables.replace_slice(mart, _path(root, "dm_traffic"), str(year))


def run_lake_all(stg: Staging, root: str) -> None:
    """Backfill: every year of every ODS table and of the mart, one job per table."""
    spark = stg.payment.sparkSession
    for source in LAKE_SOURCES:
        tables.write_slices(ods_ops.ods_all_years(stg.source(source), source),
                            _path(root, f"ods_{source}"), whole=True)
    ods_traffic = tables.read_partitioned(spark, _path(root, "ods_traffic"))
    tables.write_slices(min_max_avg_mart(ods_traffic, stamp=True), _path(root, "dm_traffic"), whole=True)


# ------------------------------------------------------------------ vault

def _slice_of_load_year(df: DataFrame | None, year: int) -> DataFrame | None:
    return None if df is None else df.filter(F.year("load_dts") != F.lit(year))


def _buckets(spark: SparkSession, key: str) -> tables.Buckets:
    return tables.Buckets(key, int(spark.conf.get("spark.vaultmart.buckets", str(BUCKETS))))


def _text() -> StructField:
    return StructField("rec_source", StringType())


def _sat_schema(sat: SatSpec) -> StructType:
    """Columns of a stored satellite, from the metadata."""
    if sat.source == "mdm":
        kinds, effective = {"is_vip": BooleanType()}, DateType()
    else:
        spec = dict(ODS_SPECS[sat.source].columns)
        kinds = {c: StructType.fromDDL(f"x {spec[c]}")[0].dataType for c in sat.context}
        effective = StructType.fromDDL(f"x {spec[ODS_SPECS[sat.source].date_field]}")[0].dataType
    return StructType([*[StructField(c, StringType()) for c in vault.sat_keys(sat)],
                       *[StructField(c, kinds.get(c, StringType())) for c in sat.context],
                       StructField("effective_from", effective), StructField("load_dts", DateType()), _text()])


def _link_schema(link: LinkSpec) -> StructType:
    effective = StructType.fromDDL(f"x {dict(ODS_SPECS[link.source].columns)[ODS_SPECS[link.source].date_field]}")[0].dataType
    return StructType([StructField(f"{n}_pk", StringType()) for n in (link.name, *link.hubs)]
                      + [StructField("effective_from", effective), StructField("load_dts", DateType()), _text()])


def read_satellite(spark: SparkSession, root: str, sat: SatSpec) -> DataFrame | None:
    """A stored satellite, partitioned by ``year`` of the load and bucketed by its key."""
    return tables.read_bucketed(spark, _path(root, f"dds_t_sat_{sat.name}"), _sat_schema(sat), _buckets(spark, vault.sat_keys(sat)[0]))


def read_link(spark: SparkSession, root: str, link: LinkSpec) -> DataFrame | None:
    """A stored link, partitioned by report year (``link_year``) and bucketed by its key."""
    return tables.read_bucketed(spark, _path(root, f"dds_t_lnk_{link.name}"), _link_schema(link), _buckets(spark, f"{link.name}_pk"), LINK_YEAR)


def _link_year(link: LinkSpec) -> Column:
    """Report year of a link (partition value): its billing period's, else its event's; a function of the link's key."""
    return period_year(F.upper(F.trim("billing_period"))) if MEASURE_BY_LINK[link.name].from_billing else F.year("effective_from")


def _link_years(batch: DataFrame, link: LinkSpec, year: int) -> set[str | None]:
    """Report years of a batch's links, one value each: its periods', else the year of the run."""
    if not MEASURE_BY_LINK[link.name].from_billing:
        return {str(year)}
    return {r[0] for r in batch.select("billing_period").distinct().select(_link_year(link).cast("string")).distinct().collect()}


def _chosen(only: frozenset[str] | None) -> tuple[list[HubSpec], list[LinkSpec], list[SatSpec]]:
    return ([x for x in HUBS if only is None or f"hub_{x.name}" in only], [x for x in LINKS if only is None or f"lnk_{x.name}" in only],
            [x for x in SATS + (SAT_USER_MDM,) if only is None or f"sat_{x.name}" in only])


def vault_sources(only: frozenset[str] | None) -> set[str]:
    """The sources of a yearly vault run of all tables or of those named."""
    hubs, links, sats = _chosen(only)
    return {f.source for x in hubs for f in x.sources} | {x.source for x in (*links, *sats)}


def run_vault_year(stg: Staging, root: str, year: int, only: frozenset[str] | None = None) -> None:
    with scratch_scope(stg.payment.sparkSession):
        _run_vault_year(stg, root, year, only)


def _together(spark: SparkSession, jobs: list) -> None:
    """Run independent jobs side by side; the first error is raised."""
    with ThreadPoolExecutor(4) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]:
            done.result()


def _run_vault_year(stg: Staging, root: str, year: int, only: frozenset[str] | None) -> None:
    """One yearly vault run, of all tables or of those named (``hub_user``, ``lnk_issue``, ``sat_device``).

    The hashed ODS slice of each source is replaced (partitioned by the year of
    ``effective_from``); MDM is reloaded in full; hubs and links get the keys
    they do not hold yet; each satellite replaces its own load-year slice with
    the rows that differ from the latest stored versions.  Tables that do not
    depend on each other are loaded side by side, those of the events first.

    A hashed slice lies in the buckets of its link's key: events are dealt once, and
    the loads of the link and of its satellite neither move nor hash them again.
    """
    spark = stg.payment.sparkSession
    hashed: dict[str, DataFrame] = {}
    hubs, links, sats = _chosen(only)
    needed = vault_sources(only)

    def load_source(source: str) -> None:
        rows = ods_ops.ods_slice(stg.source(source), source, year)
        tables.replace_slice(rows, _path(root, f"ods_t_{source}"), str(year))
        stored = tables.read_partitioned(spark, _path(root, f"ods_t_{source}")).filter(F.col("year") == F.lit(str(year))).drop("year")
        path, buckets = _path(root, f"ods_t_{source}_hashed"), replace(_buckets(spark, f"{LINK_BY_SOURCE[source].name}_pk"), ordered=False)
        # dealt to their buckets before the other hashes are made
        dealt = stored.withColumn(buckets.key, hash_columns(stored, LINK_KEY_COLUMNS[LINK_BY_SOURCE[source].name])).repartition(buckets.number, buckets.key)
        rows = ods_ops.hashed_slice(dealt, source, year)
        tables.replace_slice(rows, path, str(year), buckets=replace(buckets, dealt=True))
        hashed[source] = tables.read_bucketed(spark, path, rows.schema, buckets).filter(F.col("year") == F.lit(str(year))).drop("year")

    def load_master() -> None:
        tables.reload(ods_ops.spread(stg.mdm_user), _path(root, "ods_t_user"))
        tables.reload(ods_ops.mdm_reload(spark.read.parquet(_path(root, "ods_t_user")), year), _path(root, "ods_t_user_hashed"))
        hashed["mdm"] = spark.read.parquet(_path(root, "ods_t_user_hashed"))

    def load_hub(hub: HubSpec) -> None:
        stored = _read(spark, root, f"dds_t_hub_{hub.name}")
        delta = vault.hub_delta(hashed, hub, stored)
        tables.append(cut_lineage(delta) if stored is not None else delta, _path(root, f"dds_t_hub_{hub.name}"))

    def load_link(link: LinkSpec) -> None:
        path, buckets, pk = _path(root, f"dds_t_lnk_{link.name}"), _buckets(spark, f"{link.name}_pk"), f"{link.name}_pk"
        rows = vault.link_candidates(hashed[link.source], link, _link_year(link))
        # stored links can meet the batch only in partitions of its report years
        batch = _link_years(hashed[link.source], link, year)
        met = [v for v in tables.list_partitions(spark, path, LINK_YEAR) if (None if v == tables.NULL_PARTITION else v) in batch]
        if met:
            held = F.col(LINK_YEAR)
            stored = read_link(spark, root, link).where(held.isin(met) | (held.isNull() if tables.NULL_PARTITION in met else F.lit(False)))
            rows = cut_lineage(rows.join(stored.select(pk), pk, "left_anti"))
        tables.append_bucketed(rows, path, replace(buckets, dealt=not met), LINK_YEAR)

    _together(spark, [lambda s=s: load_source(s) for s in LAKE_SOURCES if s in needed] + ([load_master] if "mdm" in needed else []))
    _together(spark, [lambda x=x: load_link(x) for x in links] + [lambda x=x: _load_satellite(spark, root, x, hashed[x.source], year) for x in sats]
              + [lambda x=x: load_hub(x) for x in hubs])


def _load_satellite(spark: SparkSession, root: str, sat: SatSpec, batch: DataFrame, year: int) -> None:
    """Replace a satellite's slice of the year, and the table of its current versions.

    ``dds_c_sat_<name>/run=<year>`` holds (key, hashdiff) of every key's latest
    inserting run after the run of that year.  A run that follows it compares its
    batch with that table alone; a run of an earlier year reads the history, and
    the table is built anew from it.  A link's satellite has no such table, see
    ``_load_link_satellite``.
    """
    if sat.parent in LINK_KEY_COLUMNS:
        _load_link_satellite(spark, root, sat, batch, year)
        return
    path, side = _path(root, f"dds_t_sat_{sat.name}"), _path(root, f"dds_c_sat_{sat.name}")
    key, columns = _buckets(spark, vault.sat_keys(sat)[0]), list(vault.sat_keys(sat))
    loads = [int(v) for v in tables.list_partitions(spark, path) if v != str(year)]
    newest = max(loads, default=None)
    current = None
    if newest is not None and newest < year and str(newest) in tables.list_partitions(spark, side, "run"):
        current = spark.read.schema(StructType([StructField(c, StringType()) for c in columns])).parquet(f"{side}/run={newest}")
    stored = read_satellite(spark, root, sat) if loads and current is None else None
    if stored is not None:
        # only loads up to this run can be "latest": prune later partitions
        stored = _slice_of_load_year(stored.filter(F.col("year").cast("int") <= F.lit(year)).drop("year"), year)
    delta = cut_lineage(vault.satellite_delta(batch, sat, stored, ods_ops.load_date(year), current))
    tables.replace_slice(delta.withColumn("year", F.lit(str(year))), path, str(year), buckets=key)
    if current is not None:
        latest = vault.current_versions(sat, delta, current)
    elif not loads:
        latest = vault.current_versions(sat, delta, delta.limit(0))
    else:
        latest = vault.latest_versions(read_satellite(spark, root, sat).drop("year").where(
            " and ".join(f"{c} is not null" for c in columns)), sat, ods_ops.load_date(max(*loads, year)))
    last = str(max([*loads, year]))
    tables.replace_slice(latest, side, last, "run")  # reads the run before and the history, never this folder
    tables.drop_partitions(spark, side, lambda v: v != last, "run")


def _load_link_satellite(spark: SparkSession, root: str, sat: SatSpec, batch: DataFrame, year: int) -> None:
    """Replace the slice of the year of a link's satellite.

    Nearly every event is new, so a table of current versions would be the satellite
    once more, written anew by every run.  Where the key holds the date, no other run
    has it; else the stored satellite's history passes by the batch's keys.  Both are
    bucketed by key and not moved, and a bucket of the batch is looked up as a hash
    table, so the history is not sorted.
    """
    path, pk, hd = _path(root, f"dds_t_sat_{sat.name}"), *vault.sat_keys(sat)
    buckets = _buckets(spark, pk)
    # distinct rows, their context's hash beside it; grouped by sort, which the write needs anyway
    rows = batch.groupBy(pk, *sat.context, "effective_from").agg(F.min(hd).alias(hd))
    loads = [] if vault.one_run(sat) else [int(v) for v in tables.list_partitions(spark, path) if v != str(year)]
    again = False
    if any(v <= year for v in loads):
        stored = _slice_of_load_year(read_satellite(spark, root, sat).filter(F.col("year").cast("int") <= F.lit(year)).drop("year"), year)
        met = stored.join(batch.select(pk).hint("shuffle_hash"), pk, "left_semi")
        latest = cut_lineage(vault.latest_versions(met, sat, ods_ops.load_date(year)))
        again = bool(latest.limit(1).count())
        if again:
            rows = rows.join(latest, [pk, hd], "left_anti")
    rows = rows.withColumns({"load_dts": F.lit(ods_ops.load_date(year)), "rec_source": F.lit(sat.source)}).select(*vault.sat_columns(sat))
    tables.replace_slice(rows.withColumn("year", F.lit(str(year))), path, str(year), buckets=replace(buckets, dealt=not again))


# ------------------------------------------------------------------ mart

def read_vault(spark: SparkSession, root: str, measures: tuple[MeasureSpec, ...] = MEASURES) -> rm.VaultView:
    return rm.VaultView(
        hub_user=_read(spark, root, "dds_t_hub_user"),
        hub_billing_period=_read(spark, root, "dds_t_hub_billing_period"),
        links={m.link: read_link(spark, root, LINK_BY_NAME[m.link]) for m in measures},
        sats={m.link: read_satellite(spark, root, SAT_BY_NAME[m.link]) for m in measures},
        sat_user_mdm=read_satellite(spark, root, SAT_USER_MDM),
    )


def run_mart_year(spark: SparkSession, root: str, year: int, measures: tuple[MeasureSpec, ...] = MEASURES) -> None:
    with scratch_scope(spark):
        _run_mart_year(spark, root, year, measures)


def _fill_dimensions(spark: SparkSession, root: str, prefix: str, names: tuple[str, ...], payment: DataFrame) -> dict[str, DataFrame]:
    """Append the new members of each dimension and read the dimensions back."""
    stored = {n: d for n in names if (d := _read(spark, root, f"{prefix}{n}")) is not None}
    for name, rows in rm.new_members(payment, names, stored).items():
        tables.append(cut_lineage(rows), _path(root, f"{prefix}{name}"))
    return {n: _read(spark, root, f"{prefix}{n}") for n in names}


def run_payment_mart_year(spark: SparkSession, root: str, year: int) -> None:
    """First mart version: payment aggregate of the year, its dimensions, the sparse fact slice."""
    with scratch_scope(spark):
        m = MEASURE_BY_LINK["payment"]
        agg = cut_lineage(rm.report_aggregate(read_vault(spark, root, (m,)), m, year, DM_V1_DIMENSIONS, "billing_year"))
        dims = _fill_dimensions(spark, root, "dm_payment_dim_", DM_V1_DIMENSIONS, agg)
        fact = rm.sparse_fact(agg, dims, DM_V1_DIMENSIONS, m.name)
        tables.replace_slice(fact.withColumn("billing_year", F.lit(str(year))),
                             _path(root, "dm_payment_fct"), str(year), column="billing_year")


def _run_mart_year(spark: SparkSession, root: str, year: int, measures: tuple[MeasureSpec, ...]) -> None:
    """Totals of the year in one pass, dimension fills from its payments, and the
    dense fact slice of the year (replaced, so a rerun does not double it)."""
    v = read_vault(spark, root, measures)
    totals = cut_lineage(rm.report_totals(v, measures, year))
    dims = _fill_dimensions(spark, root, "dm_report_dim_", DM_DIMENSIONS, totals.filter(F.col(rm.PAYMENT_ROWS) > 0))
    vip = v.sat_user_mdm.select("is_vip").distinct()
    fact = rm.dense_fact(dims, vip, totals, DM_DIMENSIONS, measures, year)
    tables.replace_slice(fact.withColumn("report_year", F.lit(str(year))),
                         _path(root, "dm_report_fct"), str(year), column="report_year")
