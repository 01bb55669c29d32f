"""Hand-made frames for the rules that the test tables do not reach."""

import datetime as dt
import re
from collections import Counter
from decimal import Decimal
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, IntegerType, StringType, StructField, StructType)

from vaultmart.functions.casts import epoch_ms_to_ts
from vaultmart.operators import checks, ods as ods_ops, vault
from vaultmart.plans.specs import MEASURE_BY_LINK, SatSpec
from vaultmart.sources import tables

LINK_SAT = SatSpec("thing", "src", ("v",), "thing", first_only=False)
FIRST_SAT = SatSpec("thing", "src", ("v",), "thing", first_only=True)
SCHEMA = StructType([
    StructField("thing_pk", StringType()), StructField("thing_hashdiff", StringType()),
    StructField("v", StringType()), StructField("effective_from", DateType()),
    StructField("load_dts", DateType()), StructField("rec_source", StringType())])


def d(y, m=1, day=1):
    return dt.date(y, m, day)


def batch(spark, year, *rows):
    """rows: (pk, hashdiff, effective month)"""
    return spark.createDataFrame(
        [(pk, hd, hd, d(year, month), d(year), "src") for pk, hd, month in rows], SCHEMA)


def run_years(spark, batches, sat=LINK_SAT, stored=None):
    return vault.satellite_over_years(lambda y: batches[y], sat, sorted(batches), stored=stored)


def keys(df):
    return sorted((r.thing_pk, r.thing_hashdiff, r.load_dts.year) for r in df.collect())


def test_ties_keep_every_latest_version(spark):
    first = {2013: batch(spark, 2013, ("K", "A", 1), ("K", "B", 2)),
             2014: batch(spark, 2014, ("K", "A", 3))}
    assert keys(run_years(spark, first)) == [("K", "A", 2013), ("K", "B", 2013)]
    other = {2013: first[2013], 2014: batch(spark, 2014, ("K", "C", 3))}
    assert keys(run_years(spark, other)) == [("K", "A", 2013), ("K", "B", 2013), ("K", "C", 2014)]


def test_flap_back_is_inserted(spark):
    b = {2013: batch(spark, 2013, ("K", "A", 1)), 2014: batch(spark, 2014, ("K", "B", 1)),
         2015: batch(spark, 2015, ("K", "A", 1))}
    assert keys(run_years(spark, b)) == [("K", "A", 2013), ("K", "A", 2015), ("K", "B", 2014)]


def test_rerun_of_middle_year_is_stable(spark):
    b = {2013: batch(spark, 2013, ("K", "A", 1), ("J", "X", 1)),
         2014: batch(spark, 2014, ("K", "B", 1), ("J", "X", 2)),
         2015: batch(spark, 2015, ("K", "A", 1), ("J", "Y", 1))}
    once = run_years(spark, b)
    again = vault.satellite_over_years(lambda y: b[y], LINK_SAT, [2014], stored=once)
    assert keys(once) == keys(again)
    assert ("J", "X", 2014) not in keys(once)


def test_null_key_never_matches(spark):
    rows = [(None, "A", "A", d(2013), d(2013), "src")]
    b = {2013: spark.createDataFrame(rows, SCHEMA),
         2014: spark.createDataFrame([(None, "A", "A", d(2014), d(2014), "src")], SCHEMA)}
    assert len(run_years(spark, b).collect()) == 2


def test_first_only_keeps_earliest_row_link_keeps_all(spark):
    b = {2013: batch(spark, 2013, ("K", "A", 3), ("K", "A", 2))}
    first = run_years(spark, b, FIRST_SAT).collect()
    assert [r.effective_from for r in first] == [d(2013, 2)]
    assert len(run_years(spark, b, LINK_SAT).collect()) == 2


def test_backfill_equals_runs_in_order(spark):
    b = {2013: batch(spark, 2013, ("K", "A", 1), ("K", "B", 2), ("S", "Z", 1)),
         2014: batch(spark, 2014, ("K", "A", 3), ("T", "Q", 1)),
         2015: batch(spark, 2015, ("K", "C", 1), ("K", "A", 1))}
    allb = b[2013].unionByName(b[2014]).unionByName(b[2015])
    for sat in (LINK_SAT, FIRST_SAT):
        assert keys(vault.satellite_backfill(allb, sat)) == \
            keys(run_years(spark, b, sat))


def test_backfill_keeps_a_hot_key_as_rows(spark, monkeypatch):
    """One key holds most versions, new and old ones in every run: no step gathers them into one value, and
    a window over a key sees one row for each of its runs."""
    plans, cut = [], vault.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    b = {y: batch(spark, y, *[("HOT", f"{(n * (y - 2010)) % 5000}", 1) for n in range(4000)], ("ONCE", f"{y}", 1), (f"K{y}", "A", 1),
                  ("COLD", "AB"[y % 2], 1), ("SAME", "A", 1), ("GAP", "A" if y != 2014 else "B", 1))
         for y in (2013, 2014, 2015, 2017)}
    allb = reduce(lambda x, y: x.unionByName(y), b.values()).unionByName(spark.createDataFrame([(None, "A", "A", d(2014), d(2014), "src")] * 2, SCHEMA))
    b[2014] = b[2014].unionByName(spark.createDataFrame([(None, "A", "A", d(2014), d(2014), "src")], SCHEMA))
    for sat in (LINK_SAT, FIRST_SAT):
        expected = run_years(spark, b, sat).collect()
        with monkeypatch.context() as m:
            m.setattr(vault, "cut_lineage", seen)
            result = vault.satellite_backfill(allb, sat)
        plans.append(result._jdf.queryExecution().executedPlan().toString())
        assert Counter(result.collect()) == Counter(expected)
    assert plans and not [p for p in plans if "collect_" in p or "array" in p.lower()]
    windows = [p for p in plans if "Window" in p]
    assert windows
    for p in windows:
        below = p[p.rindex("Window"):]
        assert re.search(r"Aggregate\(key(s)?=\[thing_pk#\d+, load_dts#\d+\]", below)


def test_one_version_per_run_needs_no_rounds(spark, monkeypatch):
    b = {y: batch(spark, y, ("FLAP", "AB"[y % 2], 1), ("SAME", "A", 1), (f"K{y}", "A", 1), *([("GAP", "A", 1)] if y != 2014 else []))
         for y in (2013, 2014, 2015, 2017)}
    allb = reduce(lambda x, y: x.unionByName(y), b.values())
    expected = keys(run_years(spark, b))
    monkeypatch.setattr(vault, "_stored_again", None)  # must not be called
    assert keys(vault.satellite_backfill(allb, LINK_SAT)) == expected


def test_rounds_beyond_the_kept_ones(spark, monkeypatch):
    monkeypatch.setattr(vault, "_KEEP", 2)
    b = {y: batch(spark, y, ("K", "ABC"[y % 3], 1), ("K", "ABC"[(y + y // 3) % 3], 1), ("L", "A", 1), ("L", "B" if y % 4 else "C", 2)) for y in range(2010, 2018)}
    allb = reduce(lambda x, y: x.unionByName(y), b.values())
    assert keys(vault.satellite_backfill(allb, LINK_SAT)) == keys(run_years(spark, b))


def test_numbers_are_consecutive_without_one_task(spark, monkeypatch):
    from vaultmart.operators import numbering
    plans, cut = [], numbering.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(numbering, "cut_lineage", seen)
    rows = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v"), F.lit("x").alias("place_")).unionByName(
        spark.sql("select cast(null as bigint) as v, 'n' as place_"))
    out = numbering.numbered(rows, [F.col("v").asc_nulls_last()], "n")
    got = sorted((r.n, r.v) for r in out.collect())
    assert [n for n, _ in got] == list(range(1, 5002)) and [v for _, v in got] == [*range(5000), None]
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert not [p for p in plans if "SinglePartition" in p or "Window" in p] and "rangepartitioning" in plans[0]
    assert numbering.numbered(rows.limit(0), [F.col("v")], "n").count() == 0


def test_bucketed_slices_join_without_exchange(spark, workdir):
    b = tables.Buckets("pk", 4)
    rows = spark.range(300).select(F.md5(F.col("id").cast("string")).alias("pk"), F.col("id").alias("v"), (F.col("id") % 3 + 2012).cast("string").alias("year"))
    tables.append_bucketed(rows.where("v < 200"), f"{workdir}/a", b, "year")
    tables.append_bucketed(rows.where("v >= 200"), f"{workdir}/a", b, "year")
    for y in ("2012", "2013", "2014"):
        tables.replace_slice(rows.where(F.col("year") == y), f"{workdir}/b", y, buckets=b)
    tables.replace_slice(rows.where("year = '2013' and v > 100"), f"{workdir}/b", "2013", buckets=b)
    tables.replace_slice(rows.limit(0), f"{workdir}/b", "2014", buckets=b)
    left = tables.read_bucketed(spark, f"{workdir}/a", rows.schema, b)
    right = tables.read_bucketed(spark, f"{workdir}/b", rows.schema, b)
    assert sorted(left.collect()) == sorted(rows.select("pk", "v", "year").collect())
    assert right.groupBy("year").count().orderBy("year").collect() == [("2012", 100), ("2013", 66)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.where("year = '2013'").select("pk", "v").join(right.select("pk", F.col("v").alias("w")), "pk")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "(year#" in plan.split("PartitionFilters")[1]
        assert joined.count() == 66
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tables.read_bucketed(spark, f"{workdir}/none", rows.schema, b) is None


def test_load_counts_years_and_shows_a_loss(spark, workdir):
    from pyspark.sql import Observation
    stg = spark.createDataFrame([(1, "card", "1", "FL", "+7", "1997-01", d, "1.00") for d in ["1997-01-01", "1997-02-01", "1998-01-01", "zz", None]],
                                tables.STG_SCHEMAS["payment"])
    seen = Observation()
    tables.write_slices(ods_ops.ods_all_years(checks.counted_by_year(stg, "payment", seen), "payment"), f"{workdir}/t")
    compare = lambda: sorted(tuple(r) for r in checks.rows_by_year(seen, tables.read_partitioned(spark, f"{workdir}/t"), "payment").collect())
    assert compare() == [("payment", 1997, 2, 2), ("payment", 1998, 1, 1)]
    tables.drop_partitions(spark, f"{workdir}/t", lambda v: v == "1998")
    assert compare() == [("payment", 1997, 2, 2), ("payment", 1998, 1, 0)]


def test_epoch_golden_values(spark):
    df = spark.createDataFrame([(1357150951268,), (1615144951268,)], "ms long")
    got = [r.t for r in df.select(epoch_ms_to_ts("ms").alias("t")).collect()]
    assert got == [dt.datetime(2013, 1, 2, 18, 22, 31), dt.datetime(2021, 3, 7, 19, 22, 31)]


def test_bad_text_becomes_null(spark):
    stg = spark.createDataFrame(
        [(1, "card", 7, "FL-1", "+7", "2013-01", "2013-01-05", "abc"),
         (2, "card", 8, "FL-2", "+7", "2013-01", "zz", "10.50"),
         (3, "card", 9, "FL-3", "+7", "2013-02", "2013-02-01", "12.345")],
        "user_id int, pay_doc_type string, pay_doc_num int, account string, phone string, "
        "billing_period string, pay_date string, pay_sum string")
    rows = {r.user_id: r for r in ods_ops.ods_slice(stg, "payment", 2013).collect()}
    assert set(rows) == {1, 3}
    assert rows[1].pay_sum is None
    assert rows[3].pay_sum == Decimal("12.35")
    bad = {r.column_name: r.uncastable for r in checks.castability(stg, "payment").collect()}
    assert bad == {"pay_date": 1, "pay_sum": 1}


def test_traffic_amount_sums_as_long(spark):
    df = spark.createDataFrame([(2147483647, 1), (2147483647, 2147483647)],
                               StructType([StructField("bytes_sent", IntegerType()),
                                           StructField("bytes_received", IntegerType())]))
    m = MEASURE_BY_LINK["traffic"]
    assert df.agg(F.sum(m.value())).first()[0] == 2147483648 + 4294967294


def test_slice_replace_and_partition_drops(spark, workdir):
    path = f"{workdir}/t"
    for y in (2012, 2013, 2014):
        tables.replace_slice(spark.createDataFrame([(y, "x")], "v int, s string"), path, str(y))
    tables.replace_slice(spark.createDataFrame([(2013, "y"), (2013, "z")], "v int, s string"),
                         path, "2013")
    got = sorted((r.year, r.s) for r in spark.read.parquet(path).collect())
    assert got == [(2012, "x"), (2013, "y"), (2013, "z"), (2014, "x")]
    tables.replace_slice(spark.createDataFrame([], "v int, s string"), path, "2014")
    assert sorted(r.year for r in spark.read.parquet(path).collect()) == [2012, 2013, 2013]
    assert tables.list_partitions(spark, path) == ["2012", "2013", "2014"]
    assert tables.drop_partitions(spark, path, lambda v: int(v) > 2012) == ["2013", "2014"]
    assert tables.list_partitions(spark, path) == ["2012"]


def test_declared_schema_staging_read(spark, workdir):
    SMALL = "/root/testdata/sf0.001"
    from vaultmart.sources.fixtures import staging_from_testdata
    stg = staging_from_testdata(spark, SMALL).traffic
    stg.write.parquet(f"{workdir}/stg_traffic")
    read = tables.read_stg(spark, f"{workdir}/stg_traffic", "traffic")
    assert read.schema == tables.STG_SCHEMAS["traffic"]
    a = ods_ops.ods_slice(read, "traffic", 1997)
    b = ods_ops.ods_slice(stg, "traffic", 1997)
    assert a.count() == b.count() == a.intersectAll(b).count()


def slices(spark, path):
    return sorted((r.year, r.s) for r in tables.read_partitioned(spark, path).collect())


def three_slices(spark, path):
    for y in (2012, 2013, 2014):
        tables.replace_slice(spark.createDataFrame([(y, "x")], "v int, s string"), path, str(y))
    return [(str(y), "x") for y in (2012, 2013, 2014)]


def test_failed_write_leaves_the_slice(spark, workdir):
    path = f"{workdir}/t"
    before = three_slices(spark, path)
    bad = spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("v"), F.lit("y").alias("s"))
    try:
        tables.replace_slice(bad, path, "2013")
        raise AssertionError("the write must fail")
    except Exception as e:
        assert "no" in str(e)
    assert slices(spark, path) == before
    tables.replace_slice(spark.createDataFrame([(1, "y")], "v int, s string"), path, "2013")
    assert slices(spark, path) == [("2012", "x"), ("2013", "y"), ("2014", "x")]


def test_failed_rename_and_kill_between_renames(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    before = three_slices(spark, path)
    new = spark.createDataFrame([(1, "y")], "v int, s string")
    real, calls = tables._rename, []

    def second_fails(fs, a, b):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("rename")
        real(fs, a, b)

    monkeypatch.setattr(tables, "_rename", second_fails)
    try:
        tables.replace_slice(new, path, "2013")
        raise AssertionError("the rename must fail")
    except OSError:
        pass
    assert slices(spark, path) == before
    calls.clear()

    def killed(fs, a, b):  # after the old slice went aside: not even the way back runs
        calls.append(1)
        if len(calls) > 1:
            raise OSError("killed")
        real(fs, a, b)

    monkeypatch.setattr(tables, "_rename", killed)
    try:
        tables.replace_slice(new, path, "2013")
    except OSError:
        pass
    monkeypatch.setattr(tables, "_rename", real)
    assert slices(spark, path) == [("2012", "x"), ("2014", "x")]  # readable, other years whole
    tables.recover_slice(spark, path, "2013")
    assert slices(spark, path) == before


def test_reader_sees_no_staging(spark, workdir):
    path = f"{workdir}/t"
    before = three_slices(spark, path)
    work = tables._work_folder(path)
    spark.createDataFrame([(9, "z")], "v int, s string").write.parquet(f"{work}/year=2013.abc.new")
    assert slices(spark, path) == before
    assert sorted((str(r.year), r.s) for r in spark.read.parquet(path).collect()) == before


def test_null_partition_and_vanished_year(spark, workdir):
    path = f"{workdir}/t"
    rows = spark.createDataFrame([(1, "a", "2012"), (2, "b", None), (3, "c", "2014")], "v int, s string, year string")
    tables.write_slices(rows, path)
    assert tables.drop_partitions(spark, path, lambda v: int(v) > 2013) == ["2014"]
    tables.write_slices(rows.filter("year = '2014'"), path, whole=True)
    assert "2012" not in tables.list_partitions(spark, path) and "2014" in tables.list_partitions(spark, path)


def test_keys_keep_fractions_and_separators_apart(spark):
    from vaultmart.functions.keys import hash_columns
    df = spark.sql("select timestamp_ntz'2013-01-01 00:00:00.1' t, 'a||b' x, 'c' y, '^^' z union all "
                   "select timestamp_ntz'2013-01-01 00:00:00.9', 'a', 'b||c', null")
    for cols in (("t",), ("x", "y"), ("z",)):
        assert df.select(hash_columns(df, cols).alias("h")).distinct().count() == 2


def test_text_year_range_is_pushed_and_loses_no_row(spark, workdir):
    dates = ["1997-01-01", " 1997-02-03", "+1997-02-03", "01997-02-03", "1997", "1997-5", "1997-12-31", "1998-01-01", "1996-12-31",
             "zz", "", None, "9997-01-01", "-1997-01-01", "1997-01-01 10:00:00", "1997-06-01T00:00:00"]
    rows = [(1, "card", str(i), "FL", "+7", "1997-01", d, "1.00") for i, d in enumerate(dates)]
    stg = spark.createDataFrame(rows, tables.STG_SCHEMAS["payment"])
    stg.write.parquet(f"{workdir}/stg_payment")
    read = tables.read_stg(spark, f"{workdir}/stg_payment", "payment")
    got = ods_ops.ods_slice(read, "payment", 1997)
    spec = ods_ops.ODS_SPECS["payment"]
    want = ods_ops.typed(read, spec).filter(F.year("pay_date") == 1997)
    assert sorted(r.pay_doc_num for r in got.collect()) == sorted(r.pay_doc_num for r in want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(pay_date,1997)" in plan


def test_a_year_outside_the_usual_range_is_kept(spark):
    from vaultmart.operators import report_mart as rm
    from vaultmart.plans.catalog import Vault
    from vaultmart.plans.specs import SAT_BY_NAME
    v = Vault(spark, "/root/testdata/sf0.001")
    ods = v.ods("payment")
    late = ods.orderBy("pay_doc_num").limit(3).withColumn("pay_date", F.lit(d(2005, 3))).withColumn("billing_period", F.lit("2005-03"))
    v._ods["payment"] = ods.unionByName(late)
    assert v.satellite(SAT_BY_NAME["payment"]).filter("year(load_dts) = 2005").count() == 3
    view = v.view(["payment"])
    assert rm.report_aggregate(view, MEASURE_BY_LINK["payment"]).filter("report_year = 2005").count() > 0
    dims, fact = rm.marts_backfill(view, measures=(MEASURE_BY_LINK["payment"],))
    year = dims["report_year"].filter("report_year_key = 2005").first().id
    assert fact.filter((F.col("report_year_id") == year) & (F.col("payment_sum") > 0)).count() > 0
