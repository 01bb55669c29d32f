"""Data Vault loads: hubs, links and satellite deltas.

Design for scale:

* keys are md5 hashes, so no step needs a central counter;
* "first row per key" is an aggregate (``min`` of a struct ordered by the
  deciding columns), which Spark combines map-side before the shuffle, so a
  key holding a third of all rows costs one partial row per task, not one hot
  task;
* "latest stored versions per key, ties kept" (``rank() = 1``) is computed as
  two aggregates joined back (max load date per (pk, hashdiff) and per pk),
  again map-side combined, instead of a window that would buffer a hot key's
  whole history in one task;
* "insert what is not there yet" is a ``left_anti`` join (Spark keeps a
  LEFT JOIN + IS NULL as an outer join plus filter);
* rows are grouped and joined by the values of their business key (``KEY``) and
  hashed afterwards: several md5 texts of 32 characters a row, which no codec
  of a shuffle makes smaller, would be most of what is written to disk.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions.keys import business_key, hash_columns, hash_key
from ..plans.specs import EVENTS_PER_TASK, LINK_YEAR, ODS_SPECS, HubSpec, LinkSpec, SatSpec
from ..session import cut_lineage, scratch_folder
from .ods import HUB_KEY_COLUMN, LINK_KEY_COLUMNS

KEY = "_key"  # business key values of a link, beside their hash
HUB_KEY = "_hub_key"  # business key value of a hub
_KEEP = 8  # rounds after which the stored versions are written anew


# ---------------------------------------------------------------- hubs

def hub_candidates(hashed_by_source: dict[str, DataFrame], hub: HubSpec) -> DataFrame:
    """One row per business key from all feeds of the hub; earlier load, then
    earlier feed wins (the feeds of one hub are loaded one after another)."""
    return _hub_hashed(_hub_keys(hashed_by_source, hub), hub)


def _hub_keys(hashed_by_source: dict[str, DataFrame], hub: HubSpec) -> DataFrame:
    """``KEY`` and the first row of every business key, before it is hashed."""
    key = f"{hub.name}_key"
    feeds = reduce(lambda a, b: a.unionByName(b), [
        hashed_by_source[feed.source].select(F.col(feed.key_column).alias(key), "load_dts", F.lit(priority).alias("_priority"))
        for priority, feed in enumerate(hub.sources)])
    # Feeds repeat a key on every row (each payment carries its user): a hash
    # aggregate collapses the repeats map-side, so the sort-based struct
    # minimum below only sees each (key, feed) once.
    per_feed = feeds.groupBy(key, "_priority").agg(F.min("load_dts").alias("load_dts"))
    first = per_feed.select(business_key(per_feed, [key]).alias(HUB_KEY), F.struct("load_dts", "_priority", key).alias("_row"))
    return first.groupBy(HUB_KEY).agg(F.min("_row").alias("_first"))


def _hub_hashed(keys: DataFrame, hub: HubSpec) -> DataFrame:
    key = f"{hub.name}_key"
    view = F.element_at(F.array(*[F.lit(feed.view) for feed in hub.sources]), F.col("_first._priority") + 1)
    return keys.select(hash_key(keys, HUB_KEY, [key]).alias(f"{hub.name}_pk"), F.col(f"_first.{key}").alias(key), "_first.load_dts",
                       view.alias("rec_source"))


def hub_delta(hashed_by_source: dict[str, DataFrame], hub: HubSpec,
              stored: DataFrame | None) -> DataFrame:
    """Hub rows to append: business keys not in the hub yet, looked up by their values (a few bytes, where two hashes are 64)."""
    keys = _hub_keys(hashed_by_source, hub)
    if stored is not None:
        keys = keys.join(stored.select(business_key(stored, [f"{hub.name}_key"]).alias(HUB_KEY)), HUB_KEY, "left_anti")
    return _hub_hashed(keys, hub)


# --------------------------------------------------------------- links

def link_candidates(hashed_rows: DataFrame, link: LinkSpec, year: Column | None = None) -> DataFrame:
    """One row per link key: its earliest load and earliest ``effective_from``.

    ``year`` (a function of the key's columns) adds the partition column of a stored link.
    """
    pk = f"{link.name}_pk"
    members = [f"{h}_pk" for h in link.hubs]
    added = [] if year is None else [year.cast("string").alias(LINK_YEAR)]
    first = hashed_rows.groupBy(pk).agg(
        F.min(F.struct("load_dts", "effective_from", *members, "rec_source", *added)).alias("_first"))
    return first.select(pk, *[F.col(f"_first.{m}").alias(m) for m in members],
                        "_first.effective_from", "_first.load_dts", "_first.rec_source",
                        *([F.col(f"_first.{LINK_YEAR}").alias(LINK_YEAR)] if added else []))


def event_tasks(rows: DataFrame) -> int:
    """Tasks for typed ODS rows (a written table) dealt by business key, ``EVENTS_PER_TASK`` to each or less; equal for link and satellite."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, 1 + rows.count() // EVENTS_PER_TASK)


def link_keys(rows: DataFrame, link: LinkSpec, tasks: int | None = None) -> DataFrame:
    """Business key (``KEY``) and earliest date of every link in typed ODS rows, dealt to ``tasks`` if given."""
    date = F.col(ODS_SPECS[link.source].date_field)
    keys = rows.where(date.isNotNull()).select(business_key(rows, LINK_KEY_COLUMNS[link.name]).alias(KEY), date.alias("effective_from"))
    keys = keys if tasks is None else keys.repartition(tasks, KEY)
    return keys.groupBy(KEY).agg(F.min("effective_from").alias("effective_from"))


def link_hash(keys: DataFrame, link: LinkSpec) -> Column:
    """The link's own hash key."""
    return hash_key(keys, KEY, LINK_KEY_COLUMNS[link.name])


def link_hashed(keys: DataFrame, link: LinkSpec) -> DataFrame:
    """``KEY`` and the link's columns; the hubs are told by columns of the key, so they are hashed once per link."""
    return keys.select(KEY, link_hash(keys, link).alias(f"{link.name}_pk"),
                       *[hash_key(keys, KEY, [HUB_KEY_COLUMN[h]]).alias(f"{h}_pk") for h in link.hubs],
                       "effective_from", _load("effective_from").alias("load_dts"), F.lit(link.source).alias("rec_source"))


def link_of_rows(rows: DataFrame, link: LinkSpec) -> DataFrame:
    """``link_candidates`` of typed ODS rows of every yearly run, with the business key as ``KEY``."""
    return link_hashed(link_keys(rows, link, event_tasks(rows)), link)


def link_delta(hashed_rows: DataFrame, link: LinkSpec, stored: DataFrame | None, year: Column | None = None) -> DataFrame:
    """Link rows to append: keys not stored yet, looked for in the partitions of the batch's years only."""
    rows = link_candidates(hashed_rows, link, year)
    if stored is None:
        return rows
    pk = f"{link.name}_pk"
    if year is not None:
        years = [r[0] for r in hashed_rows.select(year.cast("string")).distinct().collect()]  # one value per report year
        stored = stored.filter(F.col(LINK_YEAR).isin([y for y in years if y is not None])
                               | (F.col(LINK_YEAR).isNull() if None in years else F.lit(False)))
    return rows.join(stored.select(pk), pk, "left_anti")


# ---------------------------------------------------------- satellites

def sat_keys(sat: SatSpec) -> tuple[str, str]:
    """(key, hashdiff) column names: the key is the parent's, the hashdiff the satellite's."""
    return f"{sat.parent}_pk", f"{sat.name}_hashdiff"


def sat_columns(sat: SatSpec) -> list[str]:
    return [*sat_keys(sat), *sat.context, "effective_from", "load_dts", "rec_source"]


def _load(column: str) -> Column:
    """Date of the yearly run that loads a row."""
    return F.make_date(F.year(column), F.lit(1), F.lit(1))


def one_run(sat: SatSpec) -> bool:
    """Whether a key of the satellite belongs to one yearly run: the date that tells the run is part of the key."""
    return ODS_SPECS[sat.source].date_field in LINK_KEY_COLUMNS.get(sat.parent, ()) if sat.source in ODS_SPECS else False


def _first_rows(rows: DataFrame, sat: SatSpec, group: list[str]) -> DataFrame:
    """Earliest row per ``group`` (W2): ``effective_from`` decides, the other
    columns break ties.  A hash aggregate first collapses repeated versions
    (same context, many dates) map-side; the sort-based struct minimum then
    sees each distinct version once."""
    cols = sat_columns(sat)
    rest = [c for c in cols if c not in group and c != "effective_from"]
    versions = rows.groupBy(*group, *rest).agg(F.min("effective_from").alias("effective_from"))
    first = versions.groupBy(*group).agg(
        F.min(F.struct("effective_from", *rest)).alias("_first"))
    return first.select(*group, *[F.col(f"_first.{c}").alias(c) for c in cols if c not in group]
                        ).select(*cols)


def satellite_source(hashed_batch: DataFrame, sat: SatSpec) -> DataFrame:
    """The batch's candidate rows.  Non-link satellites keep only the earliest
    row per (pk, hashdiff) of the batch (W2); link satellites keep all."""
    src = hashed_batch.select(*sat_columns(sat))
    if not sat.first_only:
        return src
    return _first_rows(src, sat, list(sat_keys(sat)))


def latest_versions(stored: DataFrame, sat: SatSpec, bound: dt.date) -> DataFrame:
    """(pk, hashdiff) pairs of each key's latest load at or before ``bound``.

    Equals ``rank() over (partition by pk order by load_dts desc) = 1`` with
    ties kept: every version stored by the key's latest run counts.
    """
    pk, hd = sat_keys(sat)
    rows = stored.filter(F.col("load_dts") <= F.lit(bound))
    pairs = rows.groupBy(pk, hd).agg(F.max("load_dts").alias("_pair_dts"))
    keys = pairs.groupBy(pk).agg(F.max("_pair_dts").alias("_key_dts"))
    return (pairs.join(keys, pk)
            .filter(F.col("_pair_dts") == F.col("_key_dts"))
            .select(pk, hd))


def satellite_delta(hashed_batch: DataFrame, sat: SatSpec, stored: DataFrame | None,
                    load_dts: dt.date, current: DataFrame | None = None) -> DataFrame:
    """Rows the run inserts: distinct batch rows whose (pk, hashdiff) is not
    among the key's latest stored versions.  ``stored`` must not hold the
    run's own year (the run deletes it first).  ``current`` (key, hashdiff), where
    it is kept, is what the latest stored versions are, and no history is read.  A
    NULL key never matches, so such rows are always inserted."""
    if stored is not None and current is None:
        current = batch_versions(hashed_batch, sat, stored, load_dts)
    if sat.first_only and HUB_KEY_COLUMN.get(sat.parent) in hashed_batch.columns:
        return _first_versions(hashed_batch, sat, current)
    # distinct first: repeated rows of a hot key collapse map-side, before
    # the anti join's shuffle on (pk, hashdiff)
    src = satellite_source(hashed_batch, sat).distinct()
    if current is None:
        return src
    return src.join(current.select(*sat_keys(sat)), list(sat_keys(sat)), "left_anti").select(*sat_columns(sat))


def _first_versions(batch: DataFrame, sat: SatSpec, current: DataFrame | None) -> DataFrame:
    """``satellite_source`` of a batch that holds its business key, without the pairs (key, hashdiff) of ``current``.

    The batch's rows and those pairs, the hashes as bytes, are dealt once, by 64 bits
    of the pair, and meet in one aggregate.  Rows of the batch are hashed for their
    task number and again behind the shuffle, so their hashes do not go through it.
    """
    pk, hd = sat_keys(sat)
    rest = [*sat.context, "load_dts", "rec_source"]
    rows = batch.select(business_key(batch, _key_columns(sat)).alias(KEY), *rest, "effective_from", *([pk, hd] if sat.source == "mdm" else []))
    if sat.source != "mdm":  # events repeat a version, master data do not
        rows = rows.groupBy(KEY, *rest).agg(F.min("effective_from").alias("effective_from"))
    # master data come with their hashes, grouped events make them anew
    hashes = [F.unhex(pk), F.unhex(hd)] if sat.source == "mdm" else [F.unhex(sat_hash(rows, sat)), F.unhex(hash_columns(rows, sat.context))]
    row = F.struct("effective_from", *rest).alias("_row")
    met = rows.select(F.xxhash64(*hashes).alias("_deal"), F.lit(None).cast("binary").alias(pk), F.lit(None).cast("binary").alias(hd), KEY, row)
    if current is not None:
        pair = [F.unhex(pk), F.unhex(hd)]
        none = [F.lit(None).cast(met.schema[c].dataType).alias(c) for c in (KEY, "_row")]
        met = met.unionByName(current.where(F.col(pk).isNotNull() & F.col(hd).isNotNull())
                              .select(F.xxhash64(*pair).alias("_deal"), pair[0].alias(pk), pair[1].alias(hd), *none))
    met = met.repartition("_deal")
    context = met.select(KEY, "_row.*")
    held = F.col(pk).isNotNull()
    mine = [F.unhex(sat_hash(met, sat)), F.unhex(hash_columns(context, sat.context))]
    met = met.select("_deal", held.alias("_held"), KEY, "_row", pk, hd, "_row.*").select(
        "_deal", "_held", F.coalesce(pk, mine[0]).alias(pk), F.coalesce(hd, mine[1]).alias(hd), "_row")
    first = met.groupBy("_deal", pk, hd).agg(F.min("_row").alias("_row"), F.max("_held").alias("_held")).where("not _held")
    return first.select(F.lower(F.hex(pk)).alias(pk), F.lower(F.hex(hd)).alias(hd), "_row.*").select(*sat_columns(sat))


def batch_versions(hashed_batch: DataFrame, sat: SatSpec, stored: DataFrame, load_dts: dt.date) -> DataFrame:
    """``latest_versions`` of the batch's keys: the stored history of all others is not aggregated."""
    pk = sat_keys(sat)[0]
    return latest_versions(stored.join(hashed_batch.select(pk).distinct(), pk, "left_semi"), sat, load_dts)


def current_versions(sat: SatSpec, delta: DataFrame, current: DataFrame) -> DataFrame:
    """The (key, hashdiff) pairs of each key's latest inserting run after a run that inserted ``delta``."""
    pk, hd = sat_keys(sat)
    new = delta.where(F.col(pk).isNotNull() & F.col(hd).isNotNull()).select(pk, hd).distinct()
    return current.select(pk, hd).join(new.select(pk).distinct(), pk, "left_anti").unionByName(new)


# -------------------------------------------------------- several yearly runs

def satellite_over_years(batch_of_year: Callable[[int], DataFrame], sat: SatSpec,
                         years: Iterable[int], stored: DataFrame | None = None,
                         load_date: Callable[[int], dt.date] = lambda y: dt.date(y, 1, 1),
                         materialize: bool = True) -> DataFrame:
    """Run the yearly satellite load for ``years`` in order, as the schedule does.

    Each run depends on what the earlier runs stored, so runs are sequential;
    each run itself is one distributed job.  Every year's delta is written to
    the reliable checkpoint folder, so the plan stays one delta deep.
    """
    result = stored
    for year in years:
        kept = None if result is None else result.filter(F.year("load_dts") != F.lit(year))
        delta = satellite_delta(batch_of_year(year), sat, kept, load_date(year))
        if materialize:
            delta = cut_lineage(delta)
        result = delta if kept is None else kept.unionByName(delta)
    return result


def satellite_backfill(batches: DataFrame, sat: SatSpec) -> DataFrame:
    """Every run that ``batches`` holds, in the order of ``load_dts``, on an empty satellite.

    A version is inserted unless the key's latest inserting run stored it.  The
    triples (key, hashdiff, load) found stored (``_again``) leave the rows, so context
    columns enter no step before.  Rows with a NULL key never match a stored version
    and are always inserted.
    """
    pk, hd = sat_keys(sat)
    batches = batches.where(F.col("load_dts").isNotNull())  # rows without a date belong to no run
    rows = batches.select(*sat_columns(sat))
    rows = _first_rows(rows, sat, [pk, hd, "load_dts"]) if sat.first_only else rows.distinct()
    again = _again(batches.select(pk, hd, "load_dts"), pk, hd)
    return rows.join(again, [pk, hd, "load_dts"], "left_anti").select(*sat_columns(sat))


def _key_columns(sat: SatSpec) -> tuple[str, ...]:
    return LINK_KEY_COLUMNS.get(sat.parent) or (HUB_KEY_COLUMN[sat.parent],)


def sat_narrow(rows: DataFrame, sat: SatSpec) -> DataFrame:
    """Business key (``KEY``), context and date of typed ODS rows: what a satellite row is made of."""
    date = ODS_SPECS[sat.source].date_field
    return rows.where(F.col(date).isNotNull()).select(business_key(rows, _key_columns(sat)).alias(KEY), *sat.context, F.col(date).alias("effective_from"))


def sat_hash(narrow: DataFrame, sat: SatSpec) -> Column:
    """The hash of the satellite's key."""
    return hash_key(narrow, KEY, _key_columns(sat))


def sat_hashed(narrow: DataFrame, sat: SatSpec) -> DataFrame:
    """``KEY`` and the satellite's columns."""
    pk, hd = sat_keys(sat)
    return narrow.select(KEY, sat_hash(narrow, sat).alias(pk), hash_columns(narrow, sat.context).alias(hd), *sat.context, "effective_from",
                         _load("effective_from").alias("load_dts"), F.lit(sat.source).alias("rec_source"))


def satellite_of_rows(rows: DataFrame, sat: SatSpec) -> DataFrame:
    """``satellite_backfill`` of typed ODS rows; a link's satellite also has the business key as ``KEY``.

    Rows become distinct before they are hashed.  A key met in one run has nothing
    stored before: such keys leave by the bounds of their dates (grouped by 64 bits of
    the key; where two keys share them, both are looked at), and where the key holds
    the date there are no others.
    """
    pk, hd = sat_keys(sat)
    of_link = sat.parent in LINK_KEY_COLUMNS
    narrow = sat_narrow(rows, sat)
    if sat.first_only:
        # one row per version and run before anything is hashed
        return satellite_backfill(sat_hashed(narrow.groupBy(KEY, *sat.context, F.year("effective_from").alias("_run"))
                                             .agg(F.min("effective_from").alias("effective_from")), sat), sat)
    # dealt by the key, as the link is: their join moves no row again
    stored = sat_hashed((narrow.repartition(event_tasks(rows), KEY) if of_link else narrow).distinct(), sat)
    if not one_run(sat):
        same = F.xxhash64(KEY).alias("_same")
        run = F.year("effective_from")
        many = cut_lineage(narrow.groupBy(same).agg(F.min(run).alias("_first"), F.max(run).alias("_last")).where("_first < _last").select("_same"))
        if many.limit(1).count():
            again = _again(sat_hashed(narrow.join(many, F.xxhash64(KEY) == many["_same"], "left_semi"), sat).select(pk, hd, "load_dts"), pk, hd)
            stored = stored.join(again, [pk, hd, "load_dts"], "left_anti")
    return stored.select(*([KEY] if of_link else []), *sat_columns(sat))


def _again(versions: DataFrame, pk: str, hd: str) -> DataFrame:
    """The triples (key, hashdiff, load) that the key's latest inserting run stored.

    Where a key has one version in each of its runs that is the version of its run
    before, so one pass over the runs of a key (one row per key and run) tells.  Keys
    with several versions in a run go through the runs in rounds (``_stored_again``).
    """
    versions = versions.where(F.col(pk).isNotNull() & F.col(hd).isNotNull())
    # one row per key and run, however many versions the run has: a key's window holds its runs
    runs = versions.groupBy(pk, "load_dts").agg(F.min(hd).alias(hd), F.max(hd).alias("_other"))
    of_key = Window.partitionBy(pk)
    runs = cut_lineage(runs.select(
        pk, hd, "load_dts", F.lag(hd).over(of_key.orderBy("load_dts")).alias("_before"),
        F.max(F.col(hd) != F.col("_other")).over(of_key).alias("_several"), F.count("*").over(of_key).alias("_runs"))
        .where("_several or _before = " + hd))
    again = runs.where("not _several").select(pk, hd, "load_dts")
    several = runs.where("_several and _runs > 1").select(pk).distinct()
    if several.limit(1).count():
        again = again.unionByName(_stored_again(versions.distinct().join(several, pk, "left_semi"), pk, hd))
    return again


def _stored_again(versions: DataFrame, pk: str, hd: str) -> DataFrame:
    """The triples of ``versions`` that the latest inserting run of their key stored, run by run.

    A key's versions stay rows, never one value: a round joins them on (key,
    hashdiff), which spreads a hot key, with what is stored, the versions of each
    key's latest inserting run only.  A round writes its triples into a folder of
    one table, read once at the end; what is stored is written every ``_KEEP``
    rounds.  There is one round per distinct load date.
    """
    versions = cut_lineage(versions)
    spark, folder = versions.sparkSession, scratch_folder(versions.sparkSession)
    stored: DataFrame | None = None
    for n, (load,) in enumerate(sorted(versions.select("load_dts").distinct().collect())):
        found = versions.where(F.col("load_dts") == F.lit(load))
        if stored is None:
            judged = found.withColumn("_again", F.lit(False))
        else:
            judged = found.join(stored.withColumn("_again", F.lit(True)), [pk, hd], "left").withColumn("_again", F.col("_again").isNotNull())
        path = f"{folder}/round={n}"
        judged.write.parquet(path)
        new = spark.read.schema(judged.schema).parquet(path).where("not _again").select(pk, hd)
        stored = new if stored is None else stored.join(new.select(pk).distinct(), pk, "left_anti").unionByName(new)
        if n % _KEEP == _KEEP - 1:
            stored = cut_lineage(stored)
    table = StructType([*versions.schema.fields, StructField("_again", BooleanType())])
    return spark.read.schema(table).parquet(f"{folder}/round=*").where("_again").select(pk, hd, "load_dts")
