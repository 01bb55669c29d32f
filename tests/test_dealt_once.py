"""Yearly vault loads: staging derived once, events dealt to the buckets of their link once, history looked up unsorted."""

import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vaultmart.functions.casts import period_year
from vaultmart.functions.keys import hash_columns
from vaultmart.operators import vault
from vaultmart.plans import catalog, pipeline
from vaultmart.plans.specs import LINK_BY_NAME, SAT_BY_NAME
from vaultmart.sources import tables
from vaultmart.sources.fixtures import staging_from_testdata

from test_business_keys import SMALL, odd_rows

ONLY = frozenset({"hub_user", "hub_billing_period", "sat_user_mdm"}) | {f"{k}_{x}" for k in ("lnk", "sat") for x in ("payment", "billing", "issue", "traffic")}


def final_plan(df) -> str:
    """The plan after its run, without the plan it began with."""
    df.collect()
    return re.sub(r"\+- == Initial Plan ==.*", "", df._jdf.queryExecution().executedPlan().toString(), flags=re.S)


def test_runs_read_stored_staging(spark, monkeypatch):
    """Lines and orders are joined when the query begins, not by each of its runs; the rows are the same."""
    seen = []
    monkeypatch.setattr(pipeline, "run_vault_year", lambda stg, root, year, only: seen.append((stg, root)))
    catalog._loaded_vault(spark, SMALL, None)
    plain = staging_from_testdata(spark, SMALL)
    assert len(seen) > 1
    for stg, root in seen:
        for source in catalog.SOURCES:
            files = stg.source(source).inputFiles()
            assert files and all(f"{root.split('/tables/')[1]}/stg_{source}/" in f for f in files)
    for source in catalog.SOURCES:
        assert seen[0][0].source(source).dtypes == plain.source(source).dtypes
        assert Counter(seen[0][0].source(source).collect()) == Counter(plain.source(source).collect())


@pytest.fixture(scope="module")
def loaded(spark):
    """A vault of odd rows after three yearly runs."""
    root = catalog._scratch(spark, "vault")
    typed = {s: odd_rows(spark, s) for s in catalog.SOURCES}
    text = {s: df.select("user_id", *[F.col(c).cast("string").alias(c) for c in df.columns[1:]]) for s, df in typed.items() if s != "traffic"}
    stg = replace(staging_from_testdata(spark, SMALL), **text)
    for year in (2013, 2014, 2015):
        pipeline.run_vault_year(stg, root, year, ONLY)
    return root


def test_loads_of_a_link_move_no_row(spark, loaded):
    """A hashed slice lies in the buckets of its link: neither link nor satellite shuffles or sorts it by another key."""
    for source in ("payment", "billing", "issue"):
        link, pk = LINK_BY_NAME[source], f"{source}_pk"
        path = f"{loaded}/ods_t_{source}_hashed"
        schema = spark.read.parquet(f"{path}/year=2013").schema
        batch = tables.read_bucketed(spark, path, schema, replace(pipeline._buckets(spark, pk), ordered=False)).where("year = '2013'").drop("year")
        assert batch.count()
        assert "Exchange" not in final_plan(vault.link_candidates(batch, link, pipeline._link_year(link)))
        stored = pipeline.read_satellite(spark, loaded, SAT_BY_NAME[source]).drop("year")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = final_plan(stored.join(batch.select(pk).hint("shuffle_hash"), pk, "left_semi"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "Exchange" not in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan


def test_year_of_a_period_is_that_of_the_parser(spark):
    odd = ["2013-01", "2013-12", "2013-13", "2013-00", "2013-1", " 2013-01", "2013-01 ", "2013-01\n", "0000-01", "0001-01", "20130-01", "+12013-01", "-2013-01",
           "2013-01-05", "201-01", "", "abc", "٢٠١٣-٠١", None]
    df = spark.createDataFrame([(x,) for x in odd], "p string")
    got = df.select("p", period_year("p").alias("y"), F.year(F.try_to_date("p", "yyyy-MM")).alias("w")).collect()
    assert [r for r in got if r.y != r.w] == []


def test_key_text_of_numbers_and_dates(spark):
    """Numbers and dates are hashed as they were: trimming, upper case and escapes leave their text as it is."""
    df = spark.sql("""select * from values (1, -2L, 0.10BD, cast(null as decimal(38,18)), date'2013-01-02', timestamp_ntz'2013-01-02 03:04:05.000006'),
                      (null, null, 1E-7BD, cast('0.000000000000000001' as decimal(38,18)), date'9999-12-31', null) as t(a, b, c, d, e, f)""")
    from vaultmart.functions.casts import as_text
    from vaultmart.functions.keys import _escaped
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = F.md5(F.concat_ws("||", *[F.coalesce(_escaped(F.upper(F.trim(as_text(c, k)))), F.lit("^^")) for c, k in kinds.items()]))
    assert all(r.got == r.want for r in df.select(hash_columns(df, df.columns).alias("got"), want.alias("want")).collect())
