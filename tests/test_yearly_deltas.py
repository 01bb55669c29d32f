"""Hub and satellite loads of one run: rows grouped by business key against the forms that group hashed rows."""

import re
from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import functions as F

from vaultmart.operators import ods as ods_ops
from vaultmart.operators import report_mart as rm
from vaultmart.operators import vault
from vaultmart.plans import pipeline
from vaultmart.plans.catalog import Vault
from vaultmart.plans.specs import HUB_BY_NAME, MEASURE_BY_LINK, SAT_BY_NAME
from vaultmart.session import cut_lineage
from vaultmart.sources.fixtures import staging_from_testdata

from test_business_keys import SMALL, odd_rows


def exchanges(spark, df):
    """Rows of every shuffle of the plan without broadcasts: (dealt by, columns)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)\nArguments: (\w+\(?.*)", plan)


def hashed_batch(spark, sat, year):
    if sat.source == "mdm":
        mdm = staging_from_testdata(spark, SMALL).mdm_user
        none = mdm.limit(2).withColumn("user_id", F.lit(None).cast("int")).withColumn("legal_type", F.lit(None).cast("string"))
        spaced = mdm.limit(3).withColumn("legal_type", F.concat(F.lit(" "), F.lower("legal_type")))
        return ods_ops.mdm_reload(mdm.unionByName(none).unionByName(spaced), year)
    rows = odd_rows(spark, sat.source)
    return ods_ops.hashed_slice(rows, sat.source, year)


@pytest.mark.parametrize("name", ["user", "device", "user_mdm"])
def test_first_versions_equal_the_grouped_hashes(spark, name):
    sat, year = SAT_BY_NAME[name], 2014
    batch = hashed_batch(spark, sat, year)
    plain = batch.select(*vault.sat_columns(sat))  # without the business key: grouped and joined by hashes
    every = vault.satellite_delta(plain, sat, None, ods_ops.load_date(year))
    assert Counter(vault.satellite_delta(batch, sat, None, ods_ops.load_date(year)).collect()) == Counter(every.collect())
    pk, hd = vault.sat_keys(sat)
    least = every.agg(F.min(pk)).first()[0]
    some = every.select(pk, hd).where(F.col(pk) == least)
    want = vault.satellite_delta(plain, sat, None, ods_ops.load_date(year), some)
    got = vault.satellite_delta(batch, sat, None, ods_ops.load_date(year), some)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert Counter(got.collect()) == Counter(want.collect()) and 0 < want.count()
    stored = every.withColumn("load_dts", F.lit(ods_ops.load_date(2013)))
    assert vault.satellite_delta(batch, sat, stored, ods_ops.load_date(year)).count() == 0


def test_master_data_are_dealt_once_without_hashes(spark):
    sat = SAT_BY_NAME["user_mdm"]
    batch = cut_lineage(hashed_batch(spark, sat, 2014))
    current = cut_lineage(vault.satellite_delta(batch, sat, None, ods_ops.load_date(2014)).select(*vault.sat_keys(sat)))
    delta = vault.satellite_delta(batch, sat, None, ods_ops.load_date(2015), current)
    assert len(exchanges(spark, delta)) == 1


@pytest.mark.parametrize("name", ["user", "service", "paysys"])
def test_hub_keys_equal_the_grouped_hashes(spark, name):
    hub = HUB_BY_NAME[name]
    feeds = {f.source: hashed_batch(spark, SAT_BY_NAME["user_mdm" if f.source == "mdm" else f.source], 2014) for f in hub.sources}
    pk, key = f"{name}_pk", f"{name}_key"
    rows = reduce(lambda a, b: a.unionByName(b), [feeds[f.source].select(pk, F.col(f.key_column).alias(key), "load_dts", F.lit(i).alias("_priority"), F.lit(f.view).alias("rec_source"))
                                                  for i, f in enumerate(hub.sources)])
    want = rows.groupBy(pk).agg(F.min(F.struct("load_dts", "_priority", key, "rec_source")).alias("_first")).select(
        pk, f"_first.{key}", "_first.load_dts", "_first.rec_source")
    got = vault.hub_candidates(feeds, hub)
    assert got.dtypes == want.dtypes and Counter(got.collect()) == Counter(want.collect())
    stored = cut_lineage(want.where(F.col(pk) > "7"))
    assert Counter(vault.hub_delta(feeds, hub, stored).collect()) == Counter(want.join(stored, pk, "left_anti").collect())
    assert not [e for e in exchanges(spark, vault.hub_delta(feeds, hub, stored)) if f"{name}_pk" in " ".join(e)]


def test_sums_of_one_year_are_moved_once(spark, workdir):
    m = MEASURE_BY_LINK["payment"]
    pipeline.run_vault_year(staging_from_testdata(spark, SMALL), workdir, 1997,
                            frozenset({"hub_user", "hub_billing_period", "lnk_payment", "sat_payment", "sat_user_mdm"}))
    v = pipeline.read_vault(spark, workdir, (m,))
    one = rm.report_aggregate(v, m, 1997)
    assert Counter(one.collect()) == Counter(rm.report_aggregate(v, m).where("report_year = 1997").select(*one.columns).collect())
    moved = [e for e in exchanges(spark, one) if "user_pk" in e[1]]
    assert len([e for e in moved if "sum#" in e[0] or "_part" in e[0]]) == 1
