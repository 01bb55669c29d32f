"""Links and satellites built from business keys against the forms that group hashed rows."""

import datetime as dt
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vaultmart.operators import ods as ods_ops
from vaultmart.operators import report_mart as rm
from vaultmart.operators import vault
from vaultmart.plans.catalog import Vault
from vaultmart.plans.specs import LINK_BY_NAME, MEASURE_BY_LINK, SAT_BY_NAME, SAT_PAYMENT_V1, SAT_USER_V1

SMALL = "/root/testdata/sf0.001"


def odd_rows(spark, source):
    """Rows whose keys differ as text but not as keys, NULL members, keys met in several runs, versions that flap."""
    day, at = dt.date, dt.datetime
    rows = {
        "billing": [(u, m, s, t, Decimal(p), day(y, 3, 1)) for u, m, s, t in ((1, "2013-01", "a", "x"), (1, "2013-01", " A", "X "), (None, None, None, None),
                                                                              (2, "2013-01", "a||x", "^^"), (2, "2013-01", "a", "x||^^"))
                    for y, p in ((2013, "1.00"), (2014, "1.00"), (2014, "2.00"), (2015, "2.00"), (2017, "1.00"))],
        "issue": [(u, at(y, 1, 2, 3, 4, 5, us), at(y, 2, 2), "t", d, s) for u in (1, None) for y in (2013, 2014) for us in (0, 1)
                  for d, s in (("d", "a"), ("d ", "A "), (None, None))],
        "payment": [(u, k, 5, "FL", p, "2013-01", day(y, 1, 5), Decimal("1.00")) for u in (1, 2, None) for k in ("card", " Card", None)
                    for y, p in ((2013, "+7"), (2013, " +7"), (2014, "+7"), (2015, "+8"), (2016, "+7"))],
        "traffic": [(u, at(y, 1, 2, 3, 4, 5), dev, "ip" + str(b % 2), b, b) for u in (1, None) for y in (2013, 2014) for dev in ("d1", "D1 ", None) for b in (1, 2, 2)],
    }[source]
    columns = ods_ops.ODS_SPECS[source].columns
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in columns))


@pytest.mark.parametrize("name", ["billing", "issue", "payment", "traffic", "user", "device", "user_v1", "payment_v1"])
def test_rows_grouped_by_business_key_equal_hashed_rows(spark, name):
    sat = {"user_v1": SAT_USER_V1, "payment_v1": SAT_PAYMENT_V1}.get(name) or SAT_BY_NAME[name]
    rows = odd_rows(spark, sat.source)
    hashed = ods_ops.hashed(rows, sat.source, more=(sat,))
    want = vault.satellite_backfill(hashed.select(*vault.sat_columns(sat)), sat)
    got = vault.satellite_of_rows(rows, sat).select(*vault.sat_columns(sat))
    assert Counter(got.collect()) == Counter(want.collect())
    if name in LINK_BY_NAME:
        want = vault.link_candidates(hashed, LINK_BY_NAME[name])
        got = vault.link_of_rows(rows, LINK_BY_NAME[name]).select(*want.columns)
        assert got.dtypes == want.dtypes and Counter(got.collect()) == Counter(want.collect())


@pytest.mark.parametrize("link", ["billing", "traffic"])
def test_no_hash_of_an_event_is_shuffled(spark, link):
    """Link and satellite meet dealt by their key: two shuffles of events, none of their md5 texts; users are summed before they are hashed."""
    view, m = Vault(spark, SMALL).view([link]), MEASURE_BY_LINK[link]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        plan = rm.report_aggregate(view, m)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert not [d for d in dealt if f"{link}_pk" in d or f"{link}_hashdiff" in d or "billing_period_pk" in d]
    assert len([d for d in dealt if re.fullmatch(r"_(key|groupingexpression)#\d+", d)]) == 2
    assert [d for d in dealt if d.startswith(("_user#", "_groupingexpression#")) and "report_year" in d]
    # the same sums as over the hashes
    plain = rm.VaultView(view.hub_user, view.hub_billing_period, {k: x.drop(vault.KEY) for k, x in view.links.items()},
                         {k: x.drop(vault.KEY) for k, x in view.sats.items()}, view.sat_user_mdm)
    assert Counter(rm.report_aggregate(view, m).collect()) == Counter(rm.report_aggregate(plain, m).collect())


def test_yearly_loads_of_a_link_keep_no_second_satellite(spark, workdir):
    """Keys met in several runs, one of them run again: what the loads in one job give, and no table of all current versions."""
    import os
    from dataclasses import replace

    from vaultmart.plans import pipeline
    from vaultmart.sources.fixtures import staging_from_testdata

    typed = odd_rows(spark, "billing")
    stg = replace(staging_from_testdata(spark, SMALL), billing=typed.select(
        "user_id", *[F.col(c).cast("string").alias(c) for c in typed.columns[1:]]))
    only = frozenset({"lnk_billing", "sat_billing", "sat_traffic"})
    for year in (2013, 2014, 2015, 2017, 2014):
        pipeline.run_vault_year(stg, workdir, year, only)
    sat, link = SAT_BY_NAME["billing"], LINK_BY_NAME["billing"]
    hashed = ods_ops.hashed(typed, "billing")
    want = vault.satellite_backfill(hashed.select(*vault.sat_columns(sat)), sat)
    got = pipeline.read_satellite(spark, workdir, sat).select(*want.columns)
    assert Counter(got.collect()) == Counter(want.collect())
    want = vault.link_candidates(hashed, link)
    got = pipeline.read_link(spark, workdir, link).select(*want.columns)
    assert Counter(got.collect()) == Counter(want.collect())
    assert not [f for f in os.listdir(workdir) if f.startswith("dds_c_sat_")]


def test_master_data_are_dealt_by_user(spark, monkeypatch):
    mdm = Vault(spark, SMALL)
    monkeypatch.setattr(ods_ops, "USERS_PER_TASK", 10)
    runs = mdm.mdm_runs()
    per_task = runs.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("user_id").alias("n")).collect()
    assert len(per_task) > 8 and max(r.n for r in per_task) < 40


def test_events_are_dealt_by_number_of_rows(spark, monkeypatch):
    """A task of a report holds a bounded number of events, however few bytes they are in a shuffle."""
    monkeypatch.setattr(vault, "EVENTS_PER_TASK", 50, raising=False)
    v = Vault(spark, SMALL)
    for rows in (v._link("issue"), v._satellite(SAT_BY_NAME["issue"])):
        tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) > 20 and max(tasks) < 120
