"""Yearly runs against the one-job backfill forms, on the smallest test tables."""

from dataclasses import replace

from pyspark.sql import functions as F

from vaultmart.operators import ods as ods_ops
from vaultmart.operators import report_mart as rm
from vaultmart.operators import vault
from vaultmart.plans import pipeline
from vaultmart.plans.catalog import Vault
from vaultmart.plans.specs import HUB_BY_NAME, MEASURE_BY_LINK, SAT_BY_NAME
from vaultmart.sources import tables
from vaultmart.sources.fixtures import staging_from_testdata

SMALL = "/root/testdata/sf0.001"
YEARS = (1995, 1996, 1997)


def rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_hub_backfill_equals_yearly_appends(spark):
    v = Vault(spark, SMALL)
    spec = HUB_BY_NAME["user"]
    stored = None
    for y in YEARS:
        feeds = {"mdm": ods_ops.mdm_reload(v.hashed("mdm").select(*ods_ops.MDM_COLUMNS), y),
                 "payment": v.hashed("payment").filter(F.year("load_dts") == y)}
        delta = vault.hub_delta(feeds, spec, stored)
        stored = delta if stored is None else stored.unionByName(delta)
    payment = v.hashed("payment").filter(F.year("load_dts").isin(list(YEARS)))
    backfill = vault.hub_candidates({"mdm": v.hashed("mdm"), "payment": payment}, spec)
    assert rows(stored) == rows(backfill)


def test_mart_backfill_equals_yearly_runs(spark):
    v = Vault(spark, SMALL).view()
    dims_a, fact_a = rm.marts_backfill(v)
    dims_b, fact_b = rm.marts_over_years(v, range(1995, 2002))
    assert rows(fact_a) == rows(fact_b)
    for name in dims_a:
        assert rows(dims_a[name]) == rows(dims_b[name])


def test_lake_year_rerun_replaces_only_its_year(spark, workdir):
    stg = staging_from_testdata(spark, SMALL)
    for y in (1995, 1996):
        pipeline.run_lake_year(stg, workdir, y)
    before = rows(spark.read.parquet(f"{workdir}/ods_payment"))
    pipeline.run_lake_year(stg, workdir, 1995)
    assert rows(spark.read.parquet(f"{workdir}/ods_payment")) == before
    assert tables.list_partitions(spark, f"{workdir}/dm_traffic") == ["1995", "1996"]
    pipeline.run_lake_all(stg, f"{workdir}/all")
    assert tables.list_partitions(spark, f"{workdir}/all/ods_payment") == \
        [str(y) for y in range(1995, 2002)]


def test_vault_and_mart_runs(spark, workdir):
    stg = staging_from_testdata(spark, SMALL)
    for y in YEARS:
        pipeline.run_vault_year(stg, workdir, y)
    pipeline.run_vault_year(stg, workdir, 1996)  # rerun of the middle year
    stored = pipeline.read_satellite(spark, workdir, SAT_BY_NAME["user"]).drop("year")
    payment = Vault(spark, SMALL).hashed("payment").filter(F.year("load_dts").isin(list(YEARS)))
    expected = vault.satellite_backfill(payment, SAT_BY_NAME["user"])
    assert rows(stored) == rows(expected)
    hub = spark.read.parquet(f"{workdir}/dds_t_hub_user")
    assert hub.count() == hub.select("user_pk").distinct().count()
    pipeline.run_mart_year(spark, workdir, 1997)
    pipeline.run_mart_year(spark, workdir, 1997)  # rerun replaces the fact year
    fact = spark.read.parquet(f"{workdir}/dm_report_fct")
    sizes = [spark.read.parquet(f"{workdir}/dm_report_dim_{n}").count()
             for n in ("legal_type", "district", "billing_mode", "registration_year")]
    vip = pipeline.read_satellite(spark, workdir, SAT_BY_NAME["user_mdm"]).select("is_vip").distinct().count()
    expected_rows = vip
    for s in sizes:
        expected_rows *= s
    assert fact.count() == expected_rows


def test_yearly_run_reads_current_versions_and_one_report_year(spark, workdir, monkeypatch):
    """A run that follows the newest reads no history; a rerun does; the mart lists one year of the links."""
    stg = staging_from_testdata(spark, SMALL)
    only = frozenset({"hub_user", "hub_billing_period", "lnk_payment", "sat_payment", "sat_user", "sat_user_mdm"})
    used = []
    real = vault.satellite_delta

    def seen(batch, sat, stored, load, current=None):
        used.append((sat.name, load.year, stored is not None, current is not None))
        return real(batch, sat, stored, load, current)
    monkeypatch.setattr(vault, "satellite_delta", seen)
    for y in (*YEARS, 1996, 1997):
        pipeline.run_vault_year(stg, workdir, y, only)
    user = [u[1:] for u in used if u[0] == "user"]
    assert user == [(1995, False, False), (1996, False, True), (1997, False, True), (1996, True, False), (1997, True, False)]
    monkeypatch.undo()
    payment = Vault(spark, SMALL).hashed("payment").filter(F.year("load_dts").isin(list(YEARS)))
    assert rows(pipeline.read_satellite(spark, workdir, SAT_BY_NAME["user"]).drop("year")) == rows(vault.satellite_backfill(payment, SAT_BY_NAME["user"]))
    latest = spark.read.parquet(f"{workdir}/dds_c_sat_user/run=1997")
    history = pipeline.read_satellite(spark, workdir, SAT_BY_NAME["user"]).drop("year")
    assert rows(latest) == rows(vault.latest_versions(history, SAT_BY_NAME["user"], ods_ops.load_date(1997)))
    v = pipeline.read_vault(spark, workdir, (MEASURE_BY_LINK["payment"],))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = MEASURE_BY_LINK["payment"]
        facts = rm._facts(v, m, None, "report_year")
        plan = v.links["payment"].join(v.sats["payment"], "payment_pk")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        plan = rm.report_aggregate(v, m, 1996)._jdf.queryExecution().executedPlan().toString()
        assert "(link_year#" in plan and "= 1996)" in plan
        assert facts.where("report_year = 1996").count() == rm._facts(v, m, 1996, "report_year").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def first_version(v):
    """The view with one version of each user's master data: a second one doubles the user's measures."""
    return replace(v, sat_user_mdm=v.sat_user_mdm.filter(F.year("load_dts") == 1995))


def test_flagship_golden_values_sf001(spark):
    """FIXTURES.md section 4: dense fact of 1997 at sf0.01, first mart fill."""
    from decimal import Decimal
    _, fact = rm.marts_backfill(first_version(Vault(spark, "/root/testdata/sf0.01").view()))
    year_1997 = fact.filter(F.col("report_year_id") == 3)
    got = year_1997.agg(F.count(F.lit(1)).alias("n"), F.sum("payment_sum").alias("s")).first()
    assert got.n == 1728
    assert got.s == Decimal("538148013.80")


def test_unknown_users_give_null_members(spark):
    """Users unknown to master data: a NULL member in each user dimension; its
    dense fact rows are all zero, the sparse fact drops them, and a null-safe
    fact (keep_unknown) reconciles with every payment of the year."""
    from decimal import Decimal
    from vaultmart.plans.specs import DM_V1_DIMENSIONS, MEASURE_BY_LINK
    v = first_version(Vault(spark, SMALL).view())
    dims, fact = rm.marts_backfill(v)
    null_ids = {n: [r.id for r in dims[n].filter(F.col(f"{n}_key").isNull()).collect()]
                for n in ("legal_type", "district", "billing_mode", "registration_year")}
    assert all(len(ids) == 1 for ids in null_ids.values())
    on_null = fact.filter(F.col("legal_type_id") == null_ids["legal_type"][0])
    totals = on_null.agg(F.sum("payment_sum"), F.sum("billing_sum"), F.sum("issue_cnt"),
                         F.sum("traffic_amount")).first()
    assert on_null.count() > 0 and all(t == 0 for t in totals)

    v1_dims, v1_fact = rm.marts_backfill(v, DM_V1_DIMENSIONS,
                                         (MEASURE_BY_LINK["payment"],), sparse=True)
    null_lt = v1_dims["legal_type"].filter(F.col("legal_type_key").isNull()).first().id
    assert v1_fact.filter(F.col("legal_type_id") == null_lt).count() == 0

    _, kept = rm.marts_backfill(v, keep_unknown=True)
    year_id = dims["report_year"].filter(F.col("report_year_key") == 1997).first().id
    in_fact = kept.filter(F.col("report_year_id") == year_id).agg(F.sum("payment_sum")).first()[0]
    paid = (Vault(spark, SMALL).ods("payment").filter(F.year("pay_date") == 1997)
            .agg(F.sum("pay_sum")).first()[0])
    assert in_fact == paid and paid > Decimal(0)
