"""Report marts on top of the vault.

* ``report_aggregate``: one measure per (report year, legal type, district,
  billing mode, registration year, is_vip).  The link is joined to its
  satellite (every stored version, as the warehouse does), summed per user
  first, and only then joined to the user's master data: the big join input
  shrinks to one row per user and year before the second shuffle, and a user
  holding a third of all facts costs one partial row per task.
* ``report_totals``: all measures at once.  The facts of the measures are rows
  with one filled slot each, summed together per user and year, so hubs and
  master data are joined once whatever the number of measures.
* ``new_members``: members of the dimensions not stored yet get the next ids, all
  dimensions in one distributed numbering.
* ``dense_fact``: every combination of the members of a report year and the
  ``is_vip`` values, missing measures as 0.  A dimension's ids are 1 to n in the
  order of their first years, so the grid is a range of numbers whose digits (div
  and mod by the members of each dimension) are the ids; no dimension is joined
  to it.  The totals get the same number from their ids, and one join on it fills
  the grid.
* ``sparse_fact`` (first mart version): aggregate rows looked up in the
  dimensions by inner joins, so rows with a NULL member drop out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import period_year
from ..functions.keys import hash_key
from ..plans.specs import DM_DIMENSIONS, LINK_YEAR, MEASURES, SAT_BY_NAME, MeasureSpec, measure_type
from ..session import cut_lineage
from .numbering import numbered
from .vault import KEY, one_run

USER = "_user"  # business key of a user whose hash waits for the sums
PAYMENT_ROWS = "_payment_rows"  # payments of a cell: the dimension members come from cells that have some


@dataclass(frozen=True)
class VaultView:
    """The vault tables a mart reads."""

    hub_user: DataFrame
    hub_billing_period: DataFrame
    links: dict[str, DataFrame]
    sats: dict[str, DataFrame]
    sat_user_mdm: DataFrame


def _user_attributes(v: VaultView) -> DataFrame:
    return v.sat_user_mdm.select(
        "user_pk", "legal_type", "district", "billing_mode",
        F.year("effective_from").alias("registration_year"), "is_vip")


def _keyed(v: VaultView, measures: tuple[MeasureSpec, ...]) -> bool:
    """Whether links and satellites carry the business key beside its hash (stored tables have the hash only)."""
    return all(KEY in v.links[m.link].columns and KEY in v.sats[m.link].columns for m in measures)


def _facts(v: VaultView, m: MeasureSpec, year: int | None, year_column: str, keyed: bool = False) -> DataFrame:
    """``user_pk`` (``keyed``: the user's business key as ``USER``), report year and the measure's value of
    every stored version of an event."""
    pk = KEY if keyed else f"{m.link}_pk"
    user = F.struct(f"{KEY}.user_id").alias(USER) if keyed else F.col("user_pk")
    link = v.links[m.link]
    if year is not None and LINK_YEAR in link.columns:
        link = link.filter(F.col(LINK_YEAR) == F.lit(str(year)))  # stored links: other years' files are not listed
    if m.from_billing:
        periods = v.hub_billing_period.select(
            "billing_period_pk", period_year("billing_period_key").alias(year_column))
        if year is not None:
            # the months of one year: at most twelve rows, a proven bound
            periods = F.broadcast(periods.filter(F.col(year_column) == F.lit(year)))
        rows = link.select(pk, user, "billing_period_pk").join(periods, "billing_period_pk")
    else:
        rows = link.select(pk, user, F.year("effective_from").alias(year_column))
        if year is not None:
            rows = rows.filter(F.col(year_column) == F.lit(year))
    sat = v.sats[m.link]
    if year is not None and LINK_YEAR in link.columns:
        if "year" in sat.columns and not m.from_billing and one_run(SAT_BY_NAME[m.link]):
            sat = sat.filter(F.col("year") == F.lit(str(year)))  # the key holds the date: its rows are those of the report year's run
        # the year's links in a bucket as a hash table: the satellite, of all years, passes by unsorted
        rows = rows.hint("shuffle_hash")
    return rows.join(sat.select(pk, *m.fields), pk).select(USER if keyed else "user_pk", year_column, m.value().alias(m.name))


def _per_user(facts: DataFrame, year: int | None, year_column: str, sums: list[Column]) -> DataFrame:
    """Sums per user (first column) and year; those of one year stay dealt by user alone, so the joins that follow move no sum again."""
    user = facts.columns[0]
    if year is None:
        return facts.groupBy(user, year_column).agg(*sums)
    return facts.groupBy(user).agg(*sums).withColumn(year_column, F.lit(year))


def _by_members(v: VaultView, per_user: DataFrame, dims: tuple[str, ...], year_column: str, sums: list[Column]) -> DataFrame:
    """Sums per user and year -> sums by the mart dimensions: users of the hub, every version of their master data."""
    if USER in per_user.columns:
        per_user = per_user.withColumn("user_pk", hash_key(per_user, USER, ["user_id"])).drop(USER)
    per_user = per_user.join(v.hub_user.select("user_pk"), "user_pk")
    enriched = per_user.join(_user_attributes(v), "user_pk", "left")
    return enriched.groupBy(year_column, *[d for d in dims if d != year_column], "is_vip").agg(*sums)


def report_aggregate(v: VaultView, m: MeasureSpec, year: int | None = None,
                     dims: tuple[str, ...] = DM_DIMENSIONS,
                     year_column: str = "report_year") -> DataFrame:
    """One measure by the mart dimensions; ``year=None`` gives every report year."""
    facts = _facts(v, m, year, year_column, _keyed(v, (m,)))
    per_user = _per_user(facts, year, year_column, [F.sum(m.name).alias("_part")])
    return _by_members(v, per_user, dims, year_column, [F.sum("_part").cast(measure_type(m)).alias(m.name)])


def report_totals(v: VaultView, measures: tuple[MeasureSpec, ...] = MEASURES, year: int | None = None,
                  dims: tuple[str, ...] = DM_DIMENSIONS, year_column: str = "report_year") -> DataFrame:
    """Every measure by the mart dimensions in one pass, with the number of payments (``PAYMENT_ROWS``)."""
    facts = [_facts(v, m, year, year_column, _keyed(v, measures)) for m in measures]
    user = facts[0].columns[0]
    kinds = {m.name: f.schema[m.name].dataType for m, f in zip(measures, facts, strict=True)}
    rows = reduce(lambda a, b: a.unionByName(b), [
        f.select(user, year_column, F.lit(int(m.link == "payment")).cast("long").alias(PAYMENT_ROWS),
                 *[(F.col(n) if n == m.name else F.lit(None).cast(kind)).alias(n) for n, kind in kinds.items()])
        for m, f in zip(measures, facts, strict=True)])
    slots = [PAYMENT_ROWS, *kinds]
    per_user = _per_user(rows, year, year_column, [F.sum(c).alias(c) for c in slots])
    return _by_members(v, per_user, dims, year_column, [
        F.sum(PAYMENT_ROWS).alias(PAYMENT_ROWS), *[F.sum(m.name).cast(measure_type(m)).alias(m.name) for m in measures]])


# ------------------------------------------------------------------ dimensions

def _as_members(df: DataFrame, column: str) -> tuple[Column, Column]:
    """A member as (number, text): one of them holds the value, so members of all dimensions fit one table."""
    text = df.schema[column].dataType.simpleString() == "string"
    return (F.lit(None).cast("long") if text else F.col(column).cast("long"),
            F.col(column) if text else F.lit(None).cast("string"))


def new_members(payment: DataFrame, names: tuple[str, ...], stored: dict[str, DataFrame] | None = None,
                year_column: str | None = None) -> dict[str, DataFrame]:
    """Per dimension, ``id`` and ``<name>_key`` of the members of ``payment`` that are not stored.

    Ids follow the stored maximum, in the order of the key, NULL last; with
    ``year_column`` first in the order of the year in which the member appears
    (also returned, as ``first_year``): then the ids from empty are those that a
    run per year gives.  A NULL member is added once (the anti join is null-safe).
    """
    first = F.col(year_column) if year_column else F.lit(None).cast("int")
    parts = [F.struct(F.lit(i).alias("dimension"), *[c.alias(k) for c, k in zip(_as_members(payment, n), ("number", "text"), strict=True)])
             for i, n in enumerate(names)]
    rows = payment.select(first.alias("first_year"), F.explode(F.array(*parts)).alias("m"))
    if year_column:
        rows = rows.filter(F.col("first_year").isNotNull())
    members = rows.groupBy("m.dimension", "m.number", "m.text").agg(F.min("first_year").alias("first_year"))
    base = F.lit(0).cast("long")
    if stored:
        held = reduce(lambda a, b: a.unionByName(b), [
            stored[n].select(F.lit(i).alias("dimension"), "id", *[c.alias(k) for c, k in zip(_as_members(stored[n], f"{n}_key"), ("number", "text"), strict=True)])
            for i, n in enumerate(names) if n in stored])
        members = members.join(held, (members.dimension == held.dimension) & members.number.eqNullSafe(held.number)
                               & members.text.eqNullSafe(held.text), "left_anti")
        highest = {r.dimension: r.id for r in held.groupBy("dimension").agg(F.max("id").alias("id")).collect()}  # one row per dimension
        base = reduce(lambda e, d: e.when(F.col("dimension") == d, F.lit(highest[d])), highest, F).otherwise(base) if highest else base
    place = numbered(members, [F.col("dimension").asc(), F.col("first_year").asc_nulls_last(), F.col("number").asc_nulls_last(),
                               F.col("text").asc_nulls_last()], "place")
    starts = {r.dimension: r.start for r in place.groupBy("dimension").agg(F.min("place").alias("start")).collect()}
    out = {}
    for i, n in enumerate(names):
        kind = payment.schema[n].dataType
        key = F.col("text") if kind.simpleString() == "string" else F.col("number").cast(kind)
        out[n] = place.filter(F.col("dimension") == i).select(
            (base + F.col("place") - F.lit(starts.get(i, 1)) + 1).cast("long").alias("id"), key.alias(f"{n}_key"),
            *(["first_year"] if year_column else []))
    return out


# ------------------------------------------------------------------ dense fact

def _flags(vip: DataFrame, keep_unknown: bool) -> list[bool | None]:
    """Distinct ``is_vip`` values of the grid, three at most; with ``keep_unknown`` also NULL,
    the flag of users unknown to master data, so their money finds a cell."""
    flags = {r[0] for r in vip.select("is_vip").distinct().collect()} | ({None} if keep_unknown else set())
    return sorted(flags, key=lambda f: (f is None, f or False))


def dense_fact(dims: dict[str, DataFrame], vip: DataFrame, totals: DataFrame, dim_names: tuple[str, ...] = DM_DIMENSIONS,
               measures: tuple[MeasureSpec, ...] = MEASURES, year: int | None = None, keep_unknown: bool = False) -> DataFrame:
    """All member combinations of a report year (of all of them without ``year``), every measure, NULL -> 0.

    Members count from their ``first_year`` on where the dimensions have one.
    The driver sees the report years and, per dimension, the number of members of
    each first year; rows of the grid are made where they are needed.
    """
    spark, year_dim, others = totals.sparkSession, dim_names[0], dim_names[1:]
    years = dims[year_dim].select("id", F.col(f"{year_dim}_key").alias("key")).filter(F.col("key").isNotNull())
    years = sorted((r.key, r.id) for r in (years if year is None else years.filter(F.col("key") == F.lit(year))).collect())
    since = {n: dims[n].groupBy(*(["first_year"] if "first_year" in dims[n].columns else [])).agg(F.count("*").alias("n")).collect() for n in others}
    sizes = {n: sum(r.n for r in since[n]) for n in others}
    flags = _flags(vip, keep_unknown)
    valid = [(i, id_, key, *[sum(r.n for r in since[n] if len(r) == 1 or r.first_year <= key) for n in others])
             for i, (key, id_) in enumerate(years)]
    slots = spark.createDataFrame(valid, ", ".join(["_year int", "_year_id long", "_year_key int", *[f"_of_{n} long" for n in others]]))

    grid = [None] * len(others)
    flag = F.expr(f"cast(cell % {max(1, len(flags))} as int)")
    step = max(1, len(flags))
    for k in range(len(others) - 1, -1, -1):
        n = max(1, sizes[others[k]])
        grid[k] = F.expr(f"(cell div {step}) % {n} + 1").alias(f"{others[k]}_id")
        step *= n
    cells = len(years) * step if len(flags) and all(sizes.values()) else 0
    rows = spark.range(cells).withColumnRenamed("id", "cell").select("cell", F.expr(f"cast(cell div {step} as int)").alias("_year"), flag.alias("_flag"), *grid)
    rows = rows.join(F.broadcast(slots), "_year")  # one row per report year
    for n in others:
        rows = rows.filter(F.col(f"{n}_id") <= F.col(f"_of_{n}"))

    found = totals.join(F.broadcast(slots.select("_year", F.col("_year_key").alias(year_dim))), year_dim)
    number = F.col("_year").cast("long")
    for n in others:
        d = dims[n].select(F.col("id").alias(f"{n}_id"), F.col(f"{n}_key").alias("_key"))
        found = found.join(d, found[n].eqNullSafe(d["_key"]) if keep_unknown else found[n] == d["_key"]).drop("_key")
        number = number * F.lit(max(1, sizes[n])) + F.col(f"{n}_id") - 1
    which = reduce(lambda e, f: e.when(F.col("is_vip").eqNullSafe(F.lit(f[1]).cast("boolean")), F.lit(f[0])),
                   [(i, f) for i, f in enumerate(flags) if f is not None or keep_unknown], F)
    which = which.otherwise(F.lit(None).cast("int")) if which is not F else F.lit(None).cast("int")
    found = found.select((number * F.lit(max(1, len(flags))) + which).alias("cell"), *[m.name for m in measures]).filter(F.col("cell").isNotNull())
    vip_of = reduce(lambda e, f: e.when(F.col("_flag") == f[0], F.lit(f[1]).cast("boolean")), enumerate(flags), F)
    vip_of = F.lit(None).cast("boolean") if vip_of is F else vip_of
    return rows.join(found, "cell", "left").select(
        F.col("_year_id").alias(f"{year_dim}_id"), *[f"{n}_id" for n in others], vip_of.alias("is_vip"),
        *[F.coalesce(F.col(m.name), F.lit(0).cast(measure_type(m))).alias(m.name) for m in measures])


def sparse_fact(aggregate: DataFrame, dims: dict[str, DataFrame], dim_names: tuple[str, ...],
                measure: str) -> DataFrame:
    """Aggregate rows with their dimension ids (inner lookups; NULL members drop out)."""
    out = aggregate
    for name in dim_names:
        d = dims[name].select(F.col("id").alias(f"{name}_id"), f"{name}_key")
        out = out.join(d, out[name] == d[f"{name}_key"], "inner")
    return out.select(*[f"{n}_id" for n in dim_names], "is_vip", measure)


def marts_over_years(v: VaultView, years, dim_names: tuple[str, ...] = DM_DIMENSIONS,
                     measures: tuple[MeasureSpec, ...] = MEASURES,
                     stored_dims: dict[str, DataFrame] | None = None,
                     sparse: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """The yearly mart runs for ``years`` in order: totals, dimension fills
    (from the payments only), fact.  Returns (dimensions, fact rows).

    The totals of all years are built in one job and reused by every run;
    each run's new members and fact rows go to the reliable checkpoint folder.
    """
    year_col = dim_names[0]
    totals = cut_lineage(report_totals(v, measures, None, dim_names, year_col))
    dims = dict(stored_dims or {})
    vip = v.sat_user_mdm.select("is_vip").distinct()
    facts = []
    for year in years:
        of_year = totals.filter(F.col(year_col) == F.lit(year))
        pay = of_year.filter(F.col(PAYMENT_ROWS) > 0)
        new = {n: cut_lineage(d) for n, d in new_members(pay, dim_names, dims).items()}
        dims = {n: dims[n].unionByName(new[n]) if n in dims else new[n] for n in dim_names}
        if sparse:
            fact = sparse_fact(pay, dims, dim_names, measures[0].name)
        else:
            fact = dense_fact(dims, vip, of_year, dim_names, measures, year)
        facts.append(cut_lineage(fact))
    return dims, reduce(lambda a, b: a.unionByName(b), facts)


def dimensions_table(dims: dict[str, DataFrame], dim_names: tuple[str, ...]) -> DataFrame:
    """All dimensions in one frame: (dimension, id, member_key as text)."""
    parts = [dims[n].select(F.lit(n).alias("dimension"), "id",
                            F.col(f"{n}_key").cast("string").alias("member_key"))
             for n in dim_names]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------ backfill (many years at once)

def marts_backfill(v: VaultView, dim_names: tuple[str, ...] = DM_DIMENSIONS,
                   measures: tuple[MeasureSpec, ...] = MEASURES, sparse: bool = False,
                   keep_unknown: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Same result as ``marts_over_years`` from empty dimensions, without the
    run-by-run chain: totals once, all dimensions in one numbering, one fact job."""
    year_col = dim_names[0]
    totals = cut_lineage(report_totals(v, measures, None, dim_names, year_col))
    pay = totals.filter(F.col(PAYMENT_ROWS) > 0)
    dims = new_members(pay, dim_names, None, year_col)
    if sparse:
        fact = sparse_fact(pay, dims, dim_names, measures[0].name)
    else:
        fact = dense_fact(dims, v.sat_user_mdm.select("is_vip").distinct(), totals, dim_names, measures, None, keep_unknown)
    return {n: d.drop("first_year") for n, d in dims.items()}, fact
