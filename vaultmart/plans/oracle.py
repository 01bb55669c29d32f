"""Oracle SQL (DuckDB dialect) for every registered query.

Satellites are one recursive statement over the runs of each key; the report
marts are computed from the typed sources, past hubs, links and satellites, so
they are a second opinion on the whole chain.  Column names and types are
aligned with the Spark results.
"""

from __future__ import annotations

from . import params as P

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


def with_(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order) + "\n"


# ------------------------------------------------------------------ staging fixtures
# orders of low priority in status P belong to guests, whom master data do not know
_USER = "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END"
cte("stg_payment", f"""
SELECT CAST({_USER} AS INTEGER) AS user_id,
       o_orderpriority AS pay_doc_type,
       CASE WHEN o_orderkey % 97 = 0 THEN 'N/A-' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS pay_doc_num,
       'FL-' || CAST(o_custkey AS VARCHAR) AS account,
       '+7' || lpad(CAST(o_custkey * 7 + year(o_orderdate) % 2 AS VARCHAR), 10, '0') AS phone,
       strftime(o_orderdate, '%Y-%m') AS billing_period,
       strftime(o_orderdate, '%Y-%m-%d') AS pay_date,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS pay_sum
FROM orders""")

cte("stg_billing", f"""
SELECT CAST({_USER} AS INTEGER) AS user_id,
       strftime(l.l_shipdate, '%Y-%m') AS billing_period,
       l.l_returnflag AS service,
       l.l_linestatus AS tariff,
       CAST(CAST(l.l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS billing_sum,
       strftime(l.l_shipdate, '%Y-%m-%d') AS created_at
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

cte("stg_issue", f"""
SELECT CAST({_USER} AS VARCHAR) AS user_id,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS end_time,
       o_orderstatus AS title,
       'order ' || CAST(o_orderkey AS VARCHAR) AS description,
       CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS service
FROM orders""")

cte("stg_traffic", f"""
SELECT CAST({_USER} AS INTEGER) AS user_id,
       epoch_ms(l.l_shipdate) + l.l_partkey * 1000 + l.l_linenumber AS traffic_ms,
       'd00' || CAST(l.l_suppkey % 9 + 1 AS VARCHAR) AS device_id,
       '10.0.' || CAST(l.l_suppkey % 9 + 1 AS VARCHAR) || '.' || CAST(l.l_orderkey % 5 AS VARCHAR) AS device_ip_addr,
       CAST(floor(l.l_quantity * 1000) AS INTEGER) AS bytes_sent,
       CAST(floor(l.l_extendedprice) AS INTEGER) AS bytes_received
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

cte("mdm_user", """
SELECT CAST(c.c_custkey AS INTEGER) AS user_id,
       c.c_mktsegment AS legal_type,
       r.r_name AS district,
       CASE WHEN c.c_nationkey % 2 = 0 THEN 'prepaid' ELSE 'postpaid' END AS billing_mode,
       c.c_acctbal > 5000 AS is_vip,
       make_date(CAST(1995 + c.c_custkey % 7 AS INTEGER), 1, 1) AS registered_at
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")

# ------------------------------------------------------------------ typed ODS, all years
cte("ods_payment", """
SELECT user_id, pay_doc_type, TRY_CAST(pay_doc_num AS INTEGER) AS pay_doc_num, account, phone, billing_period,
       TRY_CAST(pay_date AS DATE) AS pay_date,
       TRY_CAST(pay_sum AS DECIMAL(10,2)) AS pay_sum,
       CAST(year(TRY_CAST(pay_date AS DATE)) AS VARCHAR) AS year
FROM stg_payment WHERE TRY_CAST(pay_date AS DATE) IS NOT NULL""", "stg_payment")

cte("ods_billing", """
SELECT user_id, billing_period, service, tariff,
       TRY_CAST(billing_sum AS DECIMAL(10,2)) AS billing_sum,
       TRY_CAST(created_at AS DATE) AS created_at,
       CAST(year(TRY_CAST(created_at AS DATE)) AS VARCHAR) AS year
FROM stg_billing WHERE TRY_CAST(created_at AS DATE) IS NOT NULL""", "stg_billing")

cte("ods_issue", """
SELECT TRY_CAST(user_id AS INTEGER) AS user_id,
       TRY_CAST(start_time AS TIMESTAMP) AS start_time,
       TRY_CAST(end_time AS TIMESTAMP) AS end_time,
       title, description, service,
       CAST(year(TRY_CAST(start_time AS TIMESTAMP)) AS VARCHAR) AS year
FROM stg_issue WHERE TRY_CAST(start_time AS TIMESTAMP) IS NOT NULL""", "stg_issue")

cte("ods_traffic", """
SELECT user_id,
       epoch_ms(CAST(floor(traffic_ms / 1000.0) * 1000 AS BIGINT)) AS traffic_time,
       device_id, device_ip_addr, bytes_sent, bytes_received,
       CAST(year(epoch_ms(CAST(floor(traffic_ms / 1000.0) * 1000 AS BIGINT))) AS VARCHAR) AS year
FROM stg_traffic WHERE traffic_ms IS NOT NULL""", "stg_traffic")

cte("dm_traffic", """
SELECT user_id,
       min(bytes_received) AS bts_received_min,
       max(bytes_received) AS bts_received_max,
       CAST(trunc(avg(bytes_received)) AS INTEGER) AS bts_received_avg,
       year
FROM ods_traffic GROUP BY user_id, year""", "ods_traffic")

ORACLE: dict[str, str] = {}

_DATE_FIELD = {"billing": "created_at", "issue": "start_time", "payment": "pay_date",
               "traffic": "traffic_time"}
_SOURCES = ("billing", "issue", "payment", "traffic")

for _s in _SOURCES:
    ORACLE[f"ods_{_s}_slice"] = with_(f"ods_{_s}") + (
        f"SELECT * FROM ods_{_s} WHERE year = '{P.SLICE_YEAR}'")

ORACLE["traffic_mart"] = with_("dm_traffic") + "SELECT * FROM dm_traffic"

_STG_YEAR = {
    "billing": "year(TRY_CAST(created_at AS DATE))",
    "issue": "year(TRY_CAST(start_time AS TIMESTAMP))",
    "payment": "year(TRY_CAST(pay_date AS DATE))",
    "traffic": "year(epoch_ms(CAST(floor(traffic_ms / 1000.0) * 1000 AS BIGINT)))",
}

ORACLE["ods_rows_by_year"] = with_(*[f"ods_{s}" for s in _SOURCES]) + "\nUNION ALL\n".join(
    f"""SELECT '{s}' AS source, CAST(coalesce(a.y, b.y) AS INTEGER) AS year,
       coalesce(a.n, 0) AS stg_rows, coalesce(b.n, 0) AS ods_rows
FROM (SELECT {_STG_YEAR[s]} AS y, count(*) AS n FROM stg_{s}
      WHERE {_STG_YEAR[s]} IS NOT NULL GROUP BY 1) a
FULL JOIN (SELECT CAST(year AS INTEGER) AS y, count(*) AS n FROM ods_{s} GROUP BY 1) b
  ON a.y = b.y""" for s in _SOURCES)

cte("stored_issue", f"""
SELECT * FROM ods_issue UNION ALL SELECT * REPLACE ('{P.BETWEEN_YEARS[0] + 1}' AS year) FROM ods_issue WHERE year = '{P.BETWEEN_YEARS[0]}'""",
    "ods_issue")
for _s in ("billing", "payment", "traffic"):
    cte(f"stored_{_s}", f"SELECT * FROM ods_{_s}", f"ods_{_s}")
ORACLE["partition_values"] = with_(*[f"stored_{s}" for s in _SOURCES]) + "\nUNION ALL\n".join(
    f"""SELECT '{s}' AS source, year, count(*) AS row_count,
       CAST(sum(CASE WHEN CAST(year({_DATE_FIELD[s]}) AS VARCHAR) = year THEN 1 ELSE 0 END) AS BIGINT) AS matching_rows
FROM stored_{s} GROUP BY year""" for s in _SOURCES)

_TEXT = {"date": "'%Y-%m-%d'", "ts": "'%Y-%m-%d %H:%M:%S'"}
_BOUND_FMT = {"billing": _TEXT["date"], "payment": _TEXT["date"], "issue": _TEXT["ts"],
              "traffic": _TEXT["ts"]}
ORACLE["ods_date_bounds"] = with_(*[f"ods_{s}" for s in _SOURCES]) + "\nUNION ALL\n".join(
    f"""SELECT '{s}' AS source, strftime(min({_DATE_FIELD[s]}), {_BOUND_FMT[s]}) AS min_value,
       strftime(max({_DATE_FIELD[s]}), {_BOUND_FMT[s]}) AS max_value FROM ods_{s}"""
    for s in _SOURCES)

ORACLE["period_bounds"] = with_("stg_billing") + (
    "SELECT min(billing_period) AS min_period, max(billing_period) AS max_period FROM stg_billing")

ORACLE["epoch_bounds"] = with_("stg_traffic") + """
SELECT min(traffic_ms) AS min_ms, max(traffic_ms) AS max_ms,
       epoch_ms(CAST(floor(min(traffic_ms) / 1000.0) * 1000 AS BIGINT)) AS min_time,
       epoch_ms(CAST(floor(max(traffic_ms) / 1000.0) * 1000 AS BIGINT)) AS max_time
FROM stg_traffic"""

ORACLE["distinct_users"] = with_(*[f"stg_{s}" for s in _SOURCES]) + "\nUNION ALL\n".join(
    f"SELECT '{s}' AS source, count(DISTINCT user_id) AS distinct_users FROM stg_{s}"
    for s in _SOURCES)

ORACLE["distinct_user_ids"] = with_(*[f"stg_{s}" for s in _SOURCES]) + "\nUNION ALL\n".join(
    f"SELECT DISTINCT '{s}' AS source, TRY_CAST(user_id AS INTEGER) AS user_id FROM stg_{s}"
    for s in _SOURCES)

ORACLE["issue_dates"] = with_("stg_issue") + """
SELECT CAST(TRY_CAST(start_time AS TIMESTAMP) AS DATE) AS start_date,
       CAST(TRY_CAST(end_time AS TIMESTAMP) AS DATE) AS end_date, description
FROM stg_issue ORDER BY start_date, description LIMIT 20"""

ORACLE["distinct_device_count"] = with_("stg_traffic") + (
    "SELECT device_id, count(*) AS row_count FROM stg_traffic GROUP BY device_id")

_CAST_COLUMNS = (
    ("billing", "billing_sum", "decimal(10,2)", "DECIMAL(10,2)"),
    ("billing", "created_at", "date", "DATE"),
    ("issue", "user_id", "int", "INTEGER"),
    ("issue", "start_time", "timestamp_ntz", "TIMESTAMP"),
    ("issue", "end_time", "timestamp_ntz", "TIMESTAMP"),
    ("payment", "pay_doc_num", "int", "INTEGER"),
    ("payment", "pay_date", "date", "DATE"),
    ("payment", "pay_sum", "decimal(10,2)", "DECIMAL(10,2)"),
)
ORACLE["castability"] = with_("stg_billing", "stg_issue", "stg_payment") + "\nUNION ALL\n".join(
    f"""SELECT '{s}' AS source, '{c}' AS column_name, '{t}' AS target_type, count(*) AS row_count,
       CAST(sum(CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {d}) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uncastable
FROM stg_{s}""" for s, c, t, d in _CAST_COLUMNS)

ORACLE["ods_years_after"] = with_("ods_issue") + f"""
SELECT year, count(*) AS row_count FROM ods_issue GROUP BY year HAVING CAST(year AS INTEGER) > {P.YEARS_AFTER}"""

ORACLE["issue_between_years"] = with_("ods_issue") + f"""
SELECT * FROM ods_issue WHERE year(start_time) BETWEEN {P.BETWEEN_YEARS[0]} AND {P.BETWEEN_YEARS[1]}
ORDER BY start_time, description LIMIT 20"""

ORACLE["mart_row_count"] = with_("dm_traffic") + """
SELECT count(*) AS row_count, count(DISTINCT user_id) AS distinct_users, count(DISTINCT year) AS years
FROM dm_traffic"""

# ------------------------------------------------------------------ analyst queries
ORACLE["top_users"] = with_("dm_traffic") + f"""
SELECT * FROM dm_traffic WHERE year = '{P.TOP_YEAR}'
ORDER BY bts_received_avg DESC, user_id LIMIT 20"""

ORACLE["top_users_all_years"] = with_("dm_traffic") + """
SELECT * FROM dm_traffic ORDER BY bts_received_avg DESC, user_id, year LIMIT 100"""

ORACLE["bottom_users"] = with_("dm_traffic") + f"""
SELECT * FROM dm_traffic WHERE year = '{P.BOTTOM_YEAR}'
ORDER BY bts_received_avg, user_id LIMIT 10"""

ORACLE["min_of_max_user"] = with_("dm_traffic") + f"""
SELECT user_id, bts_received_max, year FROM dm_traffic WHERE year = '{P.MIN_YEAR}'
ORDER BY bts_received_max, user_id LIMIT 1"""

ORACLE["min_user_payments"] = with_("dm_traffic", "ods_payment") + f"""
SELECT * FROM ods_payment WHERE year = '{P.MIN_YEAR}' AND user_id = (
  SELECT user_id FROM dm_traffic WHERE year = '{P.MIN_YEAR}'
  ORDER BY bts_received_max, user_id LIMIT 1)
ORDER BY pay_sum DESC, pay_doc_num"""

ORACLE["above_average_users"] = with_("dm_traffic") + f"""
SELECT DISTINCT user_id FROM dm_traffic WHERE year = '{P.AVG_YEAR}'
  AND bts_received_avg > (SELECT avg(bts_received_avg) FROM dm_traffic WHERE year = '{P.AVG_YEAR}')"""

ORACLE["max_avg_by_year"] = with_("dm_traffic") + """
SELECT year, max(bts_received_avg) AS max_bts_received_avg FROM dm_traffic GROUP BY year"""

_USERS = ", ".join(str(u) for u in P.CHOSEN_USERS)
ORACLE["users_over_years"] = with_("dm_traffic") + f"""
SELECT * FROM dm_traffic WHERE user_id IN ({_USERS}) ORDER BY user_id, year DESC"""

ORACLE["user_row_counts"] = with_("ods_traffic") + f"""
SELECT user_id, count(*) AS row_count FROM ods_traffic
WHERE user_id IN ({_USERS}) AND year = '{P.COUNT_YEAR}' GROUP BY user_id"""

ORACLE["top_users_issues"] = with_("dm_traffic", "ods_issue") + f"""
SELECT t.*, i.user_id AS issue_user_id, i.start_time, i.end_time, i.title, i.description,
       i.service, i.year AS issue_year
FROM dm_traffic t LEFT JOIN ods_issue i ON t.user_id = i.user_id
WHERE t.year = '{P.TOP_YEAR}' AND i.year = '{P.TOP_YEAR}' AND i.service = '{P.TOP_SERVICE}'
ORDER BY t.bts_received_avg DESC, t.user_id, i.start_time, i.description LIMIT 20"""


# ------------------------------------------------------------------ vault
def _text(col: str, kind: str) -> str:
    if kind == "date":
        return f"strftime({col}, '%Y-%m-%d')"
    if kind == "ts":
        return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"CAST({col} AS VARCHAR)"


def h(*cols: tuple[str, str]) -> str:
    """md5 over fixed text of the columns; (name, kind) with kind in '', 'date', 'ts'."""
    def part(c: str, k: str) -> str:
        text = f"upper(trim({_text(c, k)}))"
        for mark in "\\|^":
            text = f"replace({text}, '{mark}', '\\{mark}')"
        return f"coalesce({text}, '^^')"

    parts = [part(c, k) for c, k in cols]
    return f"md5(concat_ws('||', {', '.join(parts)}))"


def _c(*names: str) -> tuple[tuple[str, str], ...]:
    kinds = {"pay_date": "date", "created_at": "date", "registered_at": "date",
             "start_time": "ts", "end_time": "ts", "traffic_time": "ts"}
    return tuple((n, kinds.get(n, "")) for n in names)


def _load(col: str) -> str:
    return f"make_date(CAST(year({col}) AS INTEGER), 1, 1)"


cte("hashed_payment", f"""
SELECT p.* EXCLUDE (year),
       {h(*_c('user_id'))} AS user_pk,
       {h(*_c('account'))} AS account_pk,
       {h(*_c('billing_period'))} AS billing_period_pk,
       {h(*_c('pay_doc_type'))} AS paysys_pk,
       {h(*_c('user_id', 'account', 'billing_period', 'pay_doc_type', 'pay_doc_num'))} AS payment_pk,
       {h(*_c('phone'))} AS user_hashdiff,
       {h(*_c('pay_doc_num', 'pay_sum'))} AS payment_hashdiff,
       pay_date AS effective_from, {_load('pay_date')} AS load_dts, 'payment' AS rec_source
FROM ods_payment p""", "ods_payment")

cte("hashed_payment_v1", f"SELECT *, {h(*_c('pay_doc_type', 'pay_doc_num', 'pay_sum'))} AS payment_v1_hashdiff FROM hashed_payment",
    "hashed_payment")

cte("hashed_billing", f"""
SELECT b.* EXCLUDE (year),
       {h(*_c('user_id'))} AS user_pk,
       {h(*_c('billing_period'))} AS billing_period_pk,
       {h(*_c('service'))} AS service_pk,
       {h(*_c('tariff'))} AS tariff_pk,
       {h(*_c('user_id', 'billing_period', 'service', 'tariff'))} AS billing_pk,
       {h(*_c('billing_sum'))} AS billing_hashdiff,
       created_at AS effective_from, {_load('created_at')} AS load_dts, 'billing' AS rec_source
FROM ods_billing b""", "ods_billing")

cte("hashed_issue", f"""
SELECT i.* EXCLUDE (year),
       {h(*_c('user_id'))} AS user_pk,
       {h(*_c('service'))} AS service_pk,
       {h(*_c('user_id', 'service', 'start_time'))} AS issue_pk,
       {h(*_c('title', 'description', 'end_time'))} AS issue_hashdiff,
       start_time AS effective_from, {_load('start_time')} AS load_dts, 'issue' AS rec_source
FROM ods_issue i""", "ods_issue")

cte("hashed_traffic", f"""
SELECT t.* EXCLUDE (year),
       {h(*_c('user_id'))} AS user_pk,
       {h(*_c('device_id'))} AS device_pk,
       {h(*_c('user_id', 'device_id', 'traffic_time'))} AS traffic_pk,
       {h(*_c('bytes_sent', 'bytes_received'))} AS traffic_hashdiff,
       {h(*_c('device_ip_addr'))} AS device_hashdiff,
       traffic_time AS effective_from, {_load('traffic_time')} AS load_dts, 'traffic' AS rec_source
FROM ods_traffic t""", "ods_traffic")


def _mdm_hashed(source: str, load_dts: str) -> str:
    return f"""
SELECT m.user_id, m.legal_type, m.district, m.billing_mode, m.is_vip, m.registered_at,
       {h(*_c('user_id'))} AS user_pk,
       {h(*_c('legal_type', 'district', 'billing_mode', 'is_vip'))} AS user_mdm_hashdiff,
       registered_at AS effective_from, {load_dts} AS load_dts, 'mdm' AS rec_source
FROM {source} m"""


# every yearly run reloads master data; from 1999 on, users whose id is a multiple of 50 are on another billing mode
cte("mdm_runs", """
SELECT m.* REPLACE (CASE WHEN user_id % 50 = 0 AND y.run >= 1999 THEN
                         CASE billing_mode WHEN 'prepaid' THEN 'postpaid' ELSE 'prepaid' END
                         ELSE billing_mode END AS billing_mode), y.run
FROM mdm_user m, (SELECT DISTINCT CAST(year(pay_date) AS INTEGER) AS run FROM ods_payment) y""", "mdm_user", "ods_payment")
cte("hashed_mdm", _mdm_hashed("mdm_runs", "make_date(run, 1, 1)"), "mdm_runs")

ORACLE["hashed_payment"] = with_("hashed_payment") + f"""
SELECT * REPLACE (DATE '{P.SLICE_YEAR}-01-01' AS load_dts) FROM hashed_payment
WHERE year(effective_from) = {P.SLICE_YEAR}"""
ORACLE["hashed_traffic"] = with_("hashed_traffic") + f"""
SELECT * REPLACE (DATE '{P.SLICE_YEAR}-01-01' AS load_dts) FROM hashed_traffic
WHERE year(effective_from) = {P.SLICE_YEAR}"""
ORACLE["hashed_billing"] = with_("hashed_billing") + f"""
SELECT * REPLACE (DATE '{P.SLICE_YEAR}-01-01' AS load_dts) FROM hashed_billing
WHERE year(effective_from) = {P.SLICE_YEAR}"""
ORACLE["hashed_issue"] = with_("hashed_issue") + f"""
SELECT * REPLACE (DATE '{P.SLICE_YEAR}-01-01' AS load_dts) FROM hashed_issue
WHERE year(effective_from) = {P.SLICE_YEAR}"""
ORACLE["hashed_user"] = with_("mdm_user") + _mdm_hashed("mdm_user", f"DATE '{P.SLICE_YEAR}-01-01'")

# hubs: keys in the order the feeds are loaded (earlier year, then earlier feed)
_HUB_FEEDS = {
    "user": (("user_mdm", "hashed_mdm", "user_id"), ("user_payment", "hashed_payment", "user_id")),
    "account": (("account", "hashed_payment", "account"),),
    "billing_period": (("billing_period", "hashed_payment", "billing_period"),),
    "paysys": (("paysys", "hashed_payment", "pay_doc_type"),),
    "service": (("service_issue", "hashed_issue", "service"),
                ("service_billing", "hashed_billing", "service")),
    "tariff": (("tariff", "hashed_billing", "tariff"),),
    "device": (("device", "hashed_traffic", "device_id"),),
}
for _hub, _feeds in _HUB_FEEDS.items():
    _union = "\n  UNION ALL\n".join(
        f"  SELECT {_hub}_pk, {col} AS {_hub}_key, load_dts, {i} AS prio, '{view}' AS rec_source FROM {src}"
        for i, (view, src, col) in enumerate(_feeds))
    cte(f"hub_{_hub}", f"""
SELECT {_hub}_pk, {_hub}_key, load_dts, rec_source FROM (
  SELECT *, row_number() OVER (PARTITION BY {_hub}_pk
                               ORDER BY load_dts, prio, {_hub}_key, rec_source) AS rn
  FROM (
{_union}
  ) feeds) f
WHERE rn = 1""", *sorted({src for _, src, _ in _feeds}))
    ORACLE[f"hub_{_hub}"] = with_(f"hub_{_hub}") + f"SELECT * FROM hub_{_hub}"

_LINK_HUBS = {
    "billing": ("user", "billing_period", "service", "tariff"),
    "issue": ("user", "service"),
    "payment": ("user", "account", "billing_period", "paysys"),
    "traffic": ("user", "device"),
}
for _link, _hubs in _LINK_HUBS.items():
    _members = ", ".join(f"{m}_pk" for m in _hubs)
    cte(f"lnk_{_link}", f"""
SELECT {_link}_pk, {_members}, effective_from, load_dts, rec_source FROM (
  SELECT *, row_number() OVER (PARTITION BY {_link}_pk
                               ORDER BY load_dts, effective_from, {_members}, rec_source) AS rn
  FROM hashed_{_link}) x
WHERE rn = 1""", f"hashed_{_link}")
    ORACLE[f"lnk_{_link}"] = with_(f"lnk_{_link}") + f"SELECT * FROM lnk_{_link}"


def _sat(name: str, source: str, context: tuple[str, ...], first_only: bool, parent: str | None = None, where: str = "TRUE") -> str:
    """A satellite after all runs: per key, each run in turn adds the hashdiffs that the
    key's latest adding run did not add.  ``current`` is what that run added."""
    pk, hd = f"{parent or name}_pk", f"{name}_hashdiff"
    cols = ", ".join([pk, hd, *context, "effective_from", "load_dts", "rec_source"])
    pick = f"DISTINCT ON ({pk}, {hd}, load_dts)" if first_only else "DISTINCT"
    by = f"ORDER BY {pk}, {hd}, load_dts, effective_from, {', '.join(context)}" if first_only else ""
    return f"""
WITH RECURSIVE candidate AS (SELECT {pick} {cols} FROM {source} WHERE {where} {by}),
run AS (
  SELECT {pk} AS k, load_dts AS loaded, list(DISTINCT {hd}) AS found, row_number() OVER (PARTITION BY {pk} ORDER BY load_dts) AS nth
  FROM candidate GROUP BY {pk}, load_dts),
state AS (
  SELECT k, loaded, nth, found AS added, found AS current FROM run WHERE nth = 1
  UNION ALL
  SELECT k, loaded, nth, added, CASE WHEN len(added) > 0 THEN added ELSE current END
  FROM (SELECT run.k, run.loaded, run.nth, state.current, list_filter(run.found, lambda x: NOT list_contains(state.current, x)) AS added
        FROM state JOIN run ON run.k = state.k AND run.nth = state.nth + 1) step)
SELECT {cols} FROM candidate
WHERE ({pk}, {hd}, load_dts) IN (SELECT (k, v, loaded) FROM (SELECT k, loaded, unnest(added) AS v FROM state) a)"""


_SATS = {  # query: (satellite, source, context, first row per hashdiff and run only, parent)
    "user": ("user", "hashed_payment", ("phone",), True, None),
    "user_v1": ("user", "hashed_payment", ("phone",), False, None),
    "payment": ("payment", "hashed_payment", ("pay_doc_num", "pay_sum"), False, None),
    "payment_v1": ("payment_v1", "hashed_payment_v1", ("pay_doc_type", "pay_doc_num", "pay_sum"), False, "payment"),
    "issue": ("issue", "hashed_issue", ("title", "description", "end_time"), False, None),
    "billing": ("billing", "hashed_billing", ("billing_sum",), False, None),
    "traffic": ("traffic", "hashed_traffic", ("bytes_sent", "bytes_received"), False, None),
    "device": ("device", "hashed_traffic", ("device_ip_addr",), True, None),
    "user_mdm": ("user_mdm", "hashed_mdm", ("legal_type", "district", "billing_mode", "is_vip"), True, "user"),
}
for _name, (_s, _src, _ctx, _first, _parent) in _SATS.items():
    cte(f"sat_{_name}", _sat(_s, _src, _ctx, _first, _parent), _src)
    ORACLE[f"sat_{_name}"] = with_(f"sat_{_name}") + f"SELECT * FROM sat_{_name}"

# a rerun of the middle year changes nothing: the three runs in order
_few = f"year(load_dts) IN ({', '.join(map(str, P.RERUN_YEARS))})"
cte("sat_rerun", _sat("user", "hashed_payment", ("phone",), True, where=_few), "hashed_payment")
ORACLE["sat_rerun_year"] = with_("sat_rerun") + "SELECT * FROM sat_rerun"


# ------------------------------------------------------------------ marts
# A fact is a distinct version of a business event; its user must be known to payments or master data, and a
# billed period to payments.  Every distinct version of a user's master data counts.
_PERIOD = "CAST(year(TRY_STRPTIME(billing_period, '%Y-%m')) AS INTEGER)"
_FACTS = {  # source: (distinct columns, report year, measure, its sum over the facts)
    "payment": ("user_id, account, billing_period, pay_doc_type, pay_doc_num, pay_sum, pay_date", _PERIOD,
                "payment_sum", "CAST(sum(pay_sum) AS DECIMAL(38,2))"),
    "billing": ("user_id, billing_period, service, tariff, billing_sum, created_at", _PERIOD,
                "billing_sum", "CAST(sum(billing_sum) AS DECIMAL(38,2))"),
    "issue": ("user_id, service, start_time, title, description, end_time", "CAST(year(start_time) AS INTEGER)",
              "issue_cnt", "count(*)"),
    "traffic": ("user_id, device_id, traffic_time, bytes_sent, bytes_received", "CAST(year(traffic_time) AS INTEGER)",
                "traffic_amount", "CAST(sum(CAST(bytes_sent AS BIGINT) + bytes_received) AS BIGINT)"),
}
_DIMS = ("report_year", "legal_type", "district", "billing_mode", "registration_year")
_DIMS_V1 = ("billing_year", "legal_type", "district", "registration_year")

cte("versions", """
SELECT DISTINCT user_id, legal_type, district, billing_mode, is_vip, CAST(year(registered_at) AS INTEGER) AS registration_year
FROM mdm_runs""", "mdm_runs")
for _m, (_what, _year, _measure, _sum) in _FACTS.items():
    _billed = "AND billing_period IN (SELECT billing_period FROM ods_payment)" if _m == "billing" else ""
    cte(f"fact_{_m}", f"""
SELECT * EXCLUDE (user_id), {_year} AS report_year
FROM (SELECT DISTINCT {_what} FROM ods_{_m}) f LEFT JOIN versions USING (user_id)
WHERE user_id IN (SELECT user_id FROM ods_payment UNION ALL SELECT user_id FROM mdm_user) {_billed}""",
        f"ods_{_m}", "ods_payment", "mdm_user", "versions")
    cte(f"total_{_m}", f"SELECT {', '.join(_DIMS)}, is_vip, {_sum} AS {_measure} FROM fact_{_m} GROUP BY ALL", f"fact_{_m}")
    ORACLE[f"report_{_m}"] = with_(f"total_{_m}") + f"SELECT * FROM total_{_m}"


def _members(dims: tuple[str, ...], source: str, prefix: str) -> None:
    """Members numbered by the first report year that shows them, then by themselves, NULL last."""
    for d in dims:
        cte(f"{prefix}{d}", f"""
SELECT row_number() OVER (ORDER BY since, {d} NULLS LAST) AS {d}_id, {d}, since
FROM (SELECT {d}, min({dims[0]}) AS since FROM {source} WHERE {dims[0]} IS NOT NULL GROUP BY {d}) m""", source)


def _listed(dims: tuple[str, ...], prefix: str) -> str:
    return with_(*[f"{prefix}{d}" for d in dims]) + "\nUNION ALL\n".join(
        f"SELECT '{d}' AS dimension, {d}_id AS id, CAST({d} AS VARCHAR) AS member_key FROM {prefix}{d}" for d in dims)


_members(_DIMS, "total_payment", "dim_")
ORACLE["report_dims"] = _listed(_DIMS, "dim_")
# all measures in one table of cells, then one lookup per cell of the grid
cte("cells", f"SELECT {', '.join(_DIMS)}, is_vip, {', '.join(f'any_value({f[2]}) AS {f[2]}' for f in _FACTS.values())} FROM (\n"
    + "\nUNION ALL BY NAME\n".join(f"SELECT * FROM total_{m}" for m in _FACTS) + "\n) c GROUP BY ALL", *[f"total_{m}" for m in _FACTS])
cte("flags", "SELECT DISTINCT is_vip FROM mdm_user", "mdm_user")
_grid = "dim_report_year y\n" + "\n".join(f"JOIN dim_{d} ON dim_{d}.since <= y.report_year" for d in _DIMS[1:]) + "\nJOIN flags ON TRUE"
_zero = {"payment_sum": "CAST(0 AS DECIMAL(38,2))", "billing_sum": "CAST(0 AS DECIMAL(38,2))"}
ORACLE["report_fct_dense"] = with_(*[f"dim_{d}" for d in _DIMS], "cells", "flags") + f"""
SELECT {', '.join(f'{d}_id' for d in _DIMS)}, is_vip, {', '.join(f"coalesce({f[2]}, {_zero.get(f[2], 'CAST(0 AS BIGINT)')}) AS {f[2]}" for f in _FACTS.values())}
FROM (SELECT * EXCLUDE (since) FROM {_grid}) g
LEFT JOIN cells USING ({', '.join(_DIMS)}, is_vip)"""

# first mart version: payment only, billing year, sparse fact
cte("total_v1", f"""
SELECT {', '.join(_DIMS_V1)}, is_vip, CAST(sum(pay_sum) AS DECIMAL(38,2)) AS payment_sum
FROM (SELECT * RENAME (report_year AS billing_year) FROM fact_payment) f GROUP BY ALL""", "fact_payment")
ORACLE["payment_report_tmp"] = with_("total_v1") + "SELECT * FROM total_v1"
_members(_DIMS_V1, "total_v1", "dim1_")
ORACLE["payment_report_dims"] = _listed(_DIMS_V1, "dim1_")
ORACLE["payment_report_fct"] = with_("total_v1", *[f"dim1_{d}" for d in _DIMS_V1]) + f"""
SELECT {', '.join(f'{d}_id' for d in _DIMS_V1)}, is_vip, payment_sum
FROM total_v1 {' '.join(f'JOIN dim1_{d} USING ({d})' for d in _DIMS_V1)}"""

# ------------------------------------------------------------------ table IO
ORACLE["replace_slice_rerun"] = with_("ods_payment") + "SELECT * FROM ods_payment"
ORACLE["drop_partitions_after"] = with_("ods_issue") + (
    f"SELECT * FROM ods_issue WHERE CAST(year AS INTEGER) <= {P.YEARS_AFTER}")
ORACLE["mdm_reload"] = with_("mdm_user") + "SELECT * FROM mdm_user"

# ------------------------------------------------------------------ scheduled runs: the same rows as in one go
ORACLE["pipeline_lake"] = with_("dm_traffic") + """
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS updated_at, 'scheduler' AS updated_by FROM dm_traffic"""
ORACLE["pipeline_vault_sat_user"] = ORACLE["sat_user"]
ORACLE["pipeline_vault_hub_user"] = ORACLE["hub_user"]
ORACLE["pipeline_mart_dims"] = ORACLE["report_dims"]
ORACLE["pipeline_mart_fct"] = with_(*[f"dim_{d}" for d in _DIMS], "total_payment", "flags") + f"""
SELECT {', '.join(f'{d}_id' for d in _DIMS)}, is_vip, coalesce(payment_sum, CAST(0 AS DECIMAL(38,2))) AS payment_sum
FROM (SELECT * EXCLUDE (since) FROM {_grid}) g
LEFT JOIN total_payment USING ({', '.join(_DIMS)}, is_vip)"""
ORACLE["pipeline_payment_v1"] = ORACLE["payment_report_fct"]

# every table of the scheduled runs: rows by year or load, and their keys
ORACLE["pipeline_lake_tables"] = with_(*[f"ods_{s}" for s in _SOURCES], "dm_traffic") + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, year, count(*) AS row_count, TRUE AS stamped FROM {t} GROUP BY year"
    for t in (*[f"ods_{s}" for s in _SOURCES], "dm_traffic"))
_STORED = {**{f"hub_{x}": f"{x}_pk" for x in _HUB_FEEDS}, **{f"lnk_{x}": f"{x}_pk" for x in _LINK_HUBS},
           **{f"sat_{n}": f"{parent or s}_pk" for n, (s, _, _, _, parent) in _SATS.items() if not n.endswith("_v1")}}
ORACLE["pipeline_vault_tables"] = with_(*_STORED) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, load_dts, count(*) AS row_count, count(DISTINCT {k}) AS key_count, min({k}) AS first_key, max({k}) AS last_key "
    f"FROM {t} GROUP BY load_dts" for t, k in _STORED.items())
ORACLE["pipeline_mart_all"] = ORACLE["report_fct_dense"]
