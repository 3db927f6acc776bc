"""The same results as plain SQL over the given tables, to check the queries against.

Written from the rules of each operation, without the library's operators.
"""

from __future__ import annotations

from millrace.crosscheck.inputs import CHECKED_FEEDS, FIRST_LOAD, IDLE_CHECK, LINES, SECOND_LOAD, lines_sql, raw_sql, run_rows_sql
from millrace.feeds import FEEDS, Feed
from millrace.operators.governance import TAGS
from millrace.operators.quality import Accepted, Matches, NotNull, Parses, Rule
from millrace.operators.runlog import JOBS

FIRST, SECOND = f"TIMESTAMP '{FIRST_LOAD}'", f"TIMESTAMP '{SECOND_LOAD}'"
CHECKED = "2024-03-02 08:00:00"
DATE_SHAPE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
TIME_SHAPE = f"{DATE_SHAPE} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}"

# -- pieces ----------------------------------------------------------------------------


def parsed(c: str, kind: str) -> str:
    if kind == "string":
        return c
    if kind == "date":
        return f"CASE WHEN regexp_full_match({c}, '{DATE_SHAPE}') THEN try_cast({c} AS DATE) END"
    if kind == "timestamp":
        return f"CASE WHEN regexp_full_match({c}, '{TIME_SHAPE}') THEN try_cast({c} AS TIMESTAMP) END"
    if kind == "flag":
        return f"coalesce(upper({c}) IN ('Y', 'TRUE', '1'), false)"
    return f"try_cast({c} AS {kind})"


def shown(c: str, kind: str) -> str:
    """A typed column in the plain form results are compared in."""
    if kind == "date":
        return f"strftime({c}, '%Y-%m-%d') AS {c}"
    if kind == "timestamp":
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
    if kind.startswith("decimal"):
        return f"CAST({c} AS {'BIGINT' if kind.endswith(',0)') else 'DOUBLE'}) AS {c}"
    return c


def shown_fields(feed: Feed, **masked: str) -> str:
    return ", ".join(f"{masked[f.name]} AS {f.name}" if f.name in masked else shown(f.name, f.kind) for f in feed.fields)


def staged_sql(feed: Feed, loads: str) -> str:
    """Newest usable row per key, typed."""
    usable = f"{feed.key} IS NOT NULL"
    columns = ", ".join(f"{parsed(f.name, f.kind)} AS {f.name}" for f in feed.fields)
    if feed.insert_only:
        usable += f" AND {parsed('call_start_ts', 'timestamp')} IS NOT NULL"
        return f"SELECT {columns} FROM raw_{feed.name} WHERE {usable} AND {loads}"
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in ("_load_ts", "source_file_name", *feed.columns))
    picked = (
        f"SELECT * FROM raw_{feed.name} WHERE {usable} AND {loads} "
        f"QUALIFY row_number() OVER (PARTITION BY {feed.key} ORDER BY {newest}) = 1"
    )
    return f"SELECT {columns} FROM ({picked})"


def merged_sql(old: str, new: str, key: str, columns: list[str], update: list[str], stamp: str, at: str, gate: str = "true") -> str:
    inserted = f"o.{key} IS NULL"
    updated = f"(o.{key} IS NOT NULL AND n.{key} IS NOT NULL AND coalesce({gate}, false))"

    def value(c: str) -> str:
        if c == key:
            return f"coalesce(o.{c}, n.{c}) AS {c}"
        takes = f"{inserted} OR {updated}" if c in update else inserted
        return f"CASE WHEN {takes} THEN n.{c} ELSE o.{c} END AS {c}"

    return (
        f"SELECT {', '.join(value(c) for c in columns)}, "
        f"CASE WHEN {inserted} OR {updated} THEN {at} ELSE o.{stamp} END AS {stamp}, "
        f"CASE WHEN {inserted} THEN 'insert' WHEN {updated} THEN 'update' ELSE 'keep' END AS _op "
        f"FROM {old} o FULL JOIN {new} n ON o.{key} = n.{key}"
    )


def gate_sql(feed: Feed) -> str:
    return "(" + " OR ".join(f"o.{c} <> n.{c}" for c in feed.gate) + ")" if feed.gate else "true"


def derived(feed: Feed) -> str:
    return {"support_tickets": ", date_diff('minute', opened_at, closed_at) AS resolution_minutes"}.get(feed.name, "")


def feed_ctes(feed: Feed) -> dict[str, str]:
    """All stages of one feed as named queries."""
    n, key = feed.name, feed.key
    out = {
        f"lines_{n}": lines_sql(n),
        f"raw_{n}": raw_sql(n),
        f"s1_{n}": f"SELECT *, {FIRST} AS updated_at FROM ({staged_sql(feed, 'load = 1')})",
        f"s2_{n}": staged_sql(feed, "true"),
    }
    if feed.insert_only:
        out[f"m_{n}"] = (
            f"SELECT *, {SECOND} AS updated_at, 'insert' AS _op FROM s2_{n} s "
            f"WHERE NOT EXISTS (SELECT 1 FROM s1_{n} t WHERE t.{key} = s.{key})"
        )
        out[f"t_{n}"] = (
            f"SELECT * EXCLUDE (updated_at), CAST(call_start_ts AS DATE) AS usage_date, {FIRST} AS loaded_at FROM s1_{n} UNION ALL BY NAME "
            f"SELECT * EXCLUDE (updated_at, _op), CAST(call_start_ts AS DATE) AS usage_date, {SECOND} AS loaded_at FROM m_{n}"
        )
        return out
    updates = list(feed.update or feed.columns)
    out[f"m_{n}"] = merged_sql(f"s1_{n}", f"s2_{n}", key, feed.columns, updates, "updated_at", SECOND, gate_sql(feed))
    if feed.target.kind == "upsert":
        stamp = feed.target.stamp
        extra = ["resolution_minutes"] if n == "support_tickets" else []
        out[f"t1_{n}"] = f"SELECT * EXCLUDE (updated_at){derived(feed)}, {FIRST} AS {stamp} FROM s1_{n}"
        out[f"c2_{n}"] = f"SELECT * EXCLUDE (updated_at, _op){derived(feed)} FROM m_{n} WHERE _op <> 'keep'"
        target_updates = list(feed.target.update or feed.columns)
        out[f"t_{n}"] = merged_sql(f"t1_{n}", f"c2_{n}", key, feed.columns + extra, target_updates, stamp, SECOND)
    else:
        cols = ", ".join(feed.columns)
        out[f"t_{n}"] = (
            f"SELECT {', '.join('s.' + c for c in feed.columns)}, {FIRST} AS eff_start_ts, "
            f"CASE WHEN m._op = 'update' THEN {SECOND} END AS eff_end_ts, m._op <> 'update' AS is_current "
            f"FROM s1_{n} s JOIN m_{n} m USING ({key}) UNION ALL "
            f"SELECT {cols}, {SECOND}, NULL, true FROM m_{n} WHERE _op <> 'keep'"
        )
    return out


def with_feeds(names: tuple[str, ...], body: str) -> str:
    ctes: dict[str, str] = {}
    for name in names:
        ctes.update(feed_ctes(FEEDS[name]))
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in ctes.items()) + f" {body}"


# -- staging, merges, targets ----------------------------------------------------------

ORACLES: dict[str, str] = {}

for _f in FEEDS.values():
    _n, _cols = _f.name, shown_fields(_f)
    _stamp = shown("updated_at", "timestamp")
    ORACLES[f"stg_{_n}"] = with_feeds((_n,), f"SELECT {_cols} FROM s2_{_n}")
    ORACLES["stg_cdr_insert_absent" if _f.insert_only else f"stg_{_n}_merge"] = with_feeds(
        (_n,), f"SELECT {_cols}, {_stamp}, _op FROM m_{_n}"
    )
    if _f.target.kind == "upsert":
        _extra = ", CAST(resolution_minutes AS BIGINT) AS resolution_minutes" if _n == "support_tickets" else ""
        ORACLES[_f.target.table] = with_feeds(
            (_n,), f"SELECT {_cols}{_extra}, {shown(_f.target.stamp, 'timestamp')}, _op FROM t_{_n}"
        )

ORACLES["stg_cdr_insert_absent_small"] = ORACLES["stg_cdr_insert_absent"]
ORACLES["stg_customers_merge_small"] = ORACLES["stg_customers_merge"]

_cdr, _cust = FEEDS["cdr"], FEEDS["customers"]
_cdr_newest = ", ".join(f"{c} DESC NULLS LAST" for c in _cdr.columns)
ORACLES["stg_cdr_insert_absent_deduped"] = with_feeds(
    ("cdr",),
    f"SELECT {shown_fields(_cdr)} FROM (SELECT * FROM m_cdr QUALIFY row_number() OVER (PARTITION BY cdr_id ORDER BY {_cdr_newest}) = 1)",
)
ORACLES["cdc_cdr_appended"] = with_feeds(
    ("cdr",),
    f"SELECT {shown_fields(_cdr)}, {shown('updated_at', 'timestamp')}, 'INSERT' AS _action, false AS _is_update FROM m_cdr",
)
ORACLES["merge_counts"] = with_feeds(
    tuple(n for n in FEEDS if n != "cdr"),
    " UNION ALL ".join(
        f"SELECT '{n}' AS feed_name, count(*) FILTER (_op = 'insert') AS rows_inserted, "
        f"count(*) FILTER (_op = 'update') AS rows_updated, count(*) FILTER (_op = 'keep') AS rows_kept FROM m_{n}"
        for n in FEEDS
        if n != "cdr"
    ),
)


def diff_sql(feed: Feed) -> str:
    n, key = feed.name, feed.key
    names = ", ".join([*feed.columns, "updated_at"])
    differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in [*feed.columns, "updated_at"] if c != key)
    changed = f"SELECT a.{key} FROM s1_{n} a JOIN m_{n} b USING ({key}) WHERE {differs}"
    shown_all = f"{shown_fields(feed)}, {shown('updated_at', 'timestamp')}, _action, _is_update"
    return with_feeds(
        (n,),
        f"SELECT {shown_all} FROM ("
        f"SELECT {names}, 'DELETE' AS _action, true AS _is_update FROM s1_{n} WHERE {key} IN ({changed}) UNION ALL "
        f"SELECT {names}, 'INSERT', true FROM m_{n} WHERE {key} IN ({changed}) UNION ALL "
        f"SELECT {names}, 'INSERT', false FROM m_{n} WHERE {key} NOT IN (SELECT {key} FROM s1_{n}) UNION ALL "
        f"SELECT {names}, 'DELETE', false FROM s1_{n} WHERE {key} NOT IN (SELECT {key} FROM m_{n}))",
    )


for _f in FEEDS.values():
    if not _f.insert_only:
        ORACLES[f"cdc_{_f.name}"] = diff_sql(_f)

VALIDITY = f"{shown('eff_start_ts', 'timestamp')}, {shown('eff_end_ts', 'timestamp')}, is_current"
ORACLES["dim_customer_scd2"] = with_feeds(("customers",), f"SELECT {shown_fields(_cust)}, {VALIDITY} FROM t_customers")
ORACLES["customer_current"] = ORACLES["dim_customer_scd2"] + " WHERE is_current"
USAGE_TAIL = f"{shown('usage_date', 'date')}, {shown('loaded_at', 'timestamp')}"
ORACLES["fact_cdr_usage"] = with_feeds(("cdr",), f"SELECT {shown_fields(_cdr)}, {USAGE_TAIL} FROM t_cdr")
ORACLES["surrogate_keys"] = with_feeds(
    ("billing",),
    "SELECT 1000 + row_number() OVER (ORDER BY invoice_id) AS invoice_sk, invoice_id, CAST(total_amount AS DOUBLE) AS total_amount FROM m_billing",
)

# -- reports ---------------------------------------------------------------------------

PAID = "SELECT invoice_id, sum(amount) AS paid_amount FROM t_payments WHERE payment_status = 'SUCCESS' GROUP BY 1"


def monthly_sql(visible: str = "true") -> str:
    return with_feeds(
        ("customers", "cdr", "billing", "payments"),
        f"""SELECT b.customer_id, b.billing_period, c.region, c.customer_segment,
        CAST(b.total_amount AS DOUBLE) AS invoice_amount, CAST(p.paid_amount AS DOUBLE) AS paid_amount,
        CAST(coalesce(u.mb, 0) AS DOUBLE) AS total_data_mb, CAST(coalesce(u.secs, 0) AS BIGINT) AS total_voice_seconds,
        CAST(coalesce(u.sms, 0) AS BIGINT) AS total_sms
        FROM t_billing b
        JOIN (SELECT * FROM t_customers WHERE is_current AND {visible}) c ON c.customer_id = b.customer_id
        LEFT JOIN ({PAID}) p ON p.invoice_id = b.invoice_id
        LEFT JOIN (SELECT customer_id, strftime(usage_date, '%Y-%m') AS month,
            sum(CASE WHEN call_type = 'DATA' THEN data_volume_mb ELSE 0 END) AS mb,
            sum(CASE WHEN call_type = 'VOICE' THEN duration_seconds ELSE 0 END) AS secs,
            count(*) FILTER (call_type = 'SMS') AS sms
            FROM t_cdr WHERE {visible} GROUP BY 1, 2) u
        ON u.customer_id = b.customer_id AND u.month = b.billing_period""",
    )


def revenue_sql(visible: str = "true") -> str:
    return with_feeds(
        ("customers", "billing", "payments"),
        f"""SELECT b.billing_period, c.region, c.customer_segment, count(DISTINCT b.customer_id) AS billed_customers,
        CAST(sum(b.total_amount) AS DOUBLE) AS total_billed, CAST(sum(p.paid_amount) AS DOUBLE) AS total_collected
        FROM t_billing b
        JOIN (SELECT * FROM t_customers WHERE is_current AND {visible}) c ON c.customer_id = b.customer_id
        LEFT JOIN ({PAID}) p ON p.invoice_id = b.invoice_id GROUP BY 1, 2, 3""",
    )


def usage_sql(visible: str = "true") -> str:
    return with_feeds(
        ("cdr",),
        f"""SELECT strftime(usage_date, '%Y-%m-%d') AS usage_date, region, call_type, count(*) AS session_count,
        CAST(sum(duration_seconds) AS BIGINT) AS total_duration_seconds, CAST(sum(data_volume_mb) AS DOUBLE) AS total_data_mb,
        count(DISTINCT customer_id) AS distinct_customers FROM t_cdr WHERE {visible} GROUP BY t_cdr.usage_date, region, call_type""",
    )


def towers_sql(visible: str = "true") -> str:
    return with_feeds(
        ("towers",),
        f"SELECT tower_id, region, CAST(capacity_mbps AS BIGINT) AS capacity_mbps, tower_status FROM t_towers WHERE {visible}",
    )


ORACLES["monthly_summary"] = monthly_sql()
ORACLES["monthly_summary_north"] = monthly_sql("region = 'NORTH'")
ORACLES["revenue_monthly"] = revenue_sql()
ORACLES["revenue_monthly_north_mapped"] = revenue_sql("region = 'NORTH'")
ORACLES["usage_daily"] = usage_sql()
ORACLES["usage_daily_south"] = usage_sql("region = 'SOUTH'")
ORACLES["tower_status"] = towers_sql()
ORACLES["tower_status_unmapped_role"] = towers_sql("false")

# -- governance ------------------------------------------------------------------------

HIDDEN = {
    "national_id": "'XXX-XX-' || right(national_id, 4)",
    "email": "'***MASKED***'",
    "phone_number": "left(phone_number, 3) || '-XXX-' || right(phone_number, 2)",
    "address_line1": "'***ADDRESS REDACTED***'",
    "date_of_birth": "CAST(NULL AS VARCHAR)",
}
FOR_ANALYSTS = {
    **HIDDEN,
    "email": "'***@' || split_part(email, '@', 2)",
    "date_of_birth": "strftime(make_date(year(date_of_birth), 1, 1), '%Y-%m-%d')",
}


def masked_customers(masks: dict[str, str], visible: str = "true") -> str:
    return with_feeds(("customers",), f"SELECT {shown_fields(_cust, **masks)}, {VALIDITY} FROM t_customers WHERE {visible}")


ORACLES["masked_customers_compliance_officer"] = masked_customers({})
ORACLES["masked_customers_analyst_global"] = masked_customers(FOR_ANALYSTS)
ORACLES["masked_customers_analyst_north"] = masked_customers(FOR_ANALYSTS, "region = 'NORTH'")
ORACLES["masked_customers_data_engineer"] = masked_customers(HIDDEN)
ORACLES["masked_payments"] = with_feeds(
    ("payments",),
    f"SELECT {shown_fields(FEEDS['payments'], card_last4=chr(39) + '**' + chr(39) + ' || right(card_last4, 2)')}, "
    f"{shown('loaded_at', 'timestamp')} FROM t_payments",
)
ORACLES["masked_cdr"] = with_feeds(
    ("cdr",),
    "SELECT "
    + shown_fields(
        _cdr,
        origin_number="left(origin_number, 3) || '-XXX-' || right(origin_number, 2)",
        destination_number="left(destination_number, 3) || '-XXX-' || right(destination_number, 2)",
    )
    + f", {USAGE_TAIL} FROM t_cdr WHERE region = 'SOUTH'",
)
ORACLES["rounded_billing"] = with_feeds(
    ("billing",), "SELECT invoice_id, CAST(round(total_amount, -1) AS DOUBLE) AS total_amount FROM s2_billing"
)
_TAGGED = {"dim_customer": "customers", "fact_payments": "payments", "fact_cdr_usage": "cdr", "fact_billing": "billing"}
ORACLES["pii_inventory"] = with_feeds(
    tuple(_TAGGED.values()),
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{level}' AS data_classification, "
        f"{'CAST(NULL AS VARCHAR)' if kind is None else chr(39) + kind + chr(39)} AS pii_category, "
        f"count({c}) AS values_held FROM t_{_TAGGED[t]}"
        for t, c, level, kind in TAGS
    ),
)

# -- data quality ----------------------------------------------------------------------


def broken_sql(rule: Rule) -> str:
    c = rule.column
    if isinstance(rule, NotNull):
        return f"{c} IS NULL"
    if isinstance(rule, Parses):
        return f"({c} IS NOT NULL AND {parsed(c, rule.kind)} IS NULL)"
    if isinstance(rule, Matches):
        return f"({c} IS NOT NULL AND NOT regexp_full_match({c}, '[0-9]{{4}}-(0[1-9]|1[0-2])'))"
    assert isinstance(rule, Accepted)
    values = ", ".join(f"'{v}'" for v in rule.values)
    return f"({c} IS NOT NULL AND {f'upper({c})' if rule.any_case else c} NOT IN ({values}))"


def head(feed: Feed, run_id: int = 7, job: bool = True) -> str:
    job_name = f"'{feed.validate_job}' AS job_name, " if job else ""
    return f"CAST({run_id} AS BIGINT) AS run_id, {job_name}'{feed.name}' AS feed_name, '{feed.raw_table}' AS table_name"


def summary_sql(feed: Feed, where: str = "true", run_id: int = 7, at: str = CHECKED) -> str:
    return " UNION ALL ".join(
        f"SELECT {head(feed, run_id)}, '{r.rule_type}' AS rule_type, '{r.column}' AS column_name, count(*) AS records_checked, "
        f"count(*) FILTER ({broken_sql(r)}) AS records_failed, "
        f"CASE WHEN count(*) FILTER ({broken_sql(r)}) = 0 THEN 'PASS' ELSE 'FAIL' END AS check_status, '{at}' AS checked_at "
        f"FROM raw_{feed.name} WHERE {where}"
        for r in feed.rules
    )


def errors_sql(feed: Feed, job: bool = True, keep: tuple[str, ...] = ()) -> str:
    """Error rows; `keep` are columns of the record added as they are, named raw_ and the column."""
    kept = "".join(f", {c if c in feed.columns else 'NULL'} AS raw_{c}" for c in keep)
    return " UNION ALL ".join(
        f"SELECT {head(feed, job=job)}, '{r.rule_type}' AS rule_type, '{r.column}' AS column_name, {feed.key} AS record_key, "
        f"{r.column} AS failed_value, '{r.reason}' AS error_reason, source_file_name, "
        f"strftime(_load_ts, '%Y-%m-%d %H:%M:%S') AS load_ts, '{CHECKED}' AS logged_at"
        f"{', false AS is_resolved' if job else ''}{kept} "
        f"FROM raw_{feed.name} WHERE {broken_sql(r)}"
        for r in feed.rules
    )


for _f in FEEDS.values():
    ORACLES[f"dq_summary_{_f.name}"] = with_feeds((_f.name,), summary_sql(_f))
    ORACLES[f"dq_errors_{_f.name}"] = with_feeds((_f.name,), errors_sql(_f))

ORACLES["dq_errors_since"] = with_feeds(("billing",), summary_sql(FEEDS["billing"], "load = 2"))
ORACLES["dq_open_errors"] = with_feeds(
    tuple(FEEDS),
    " UNION ALL ".join(f"SELECT * FROM ({errors_sql(f, job=False)}) WHERE column_name <> 'region'" for f in FEEDS.values()),
)


def load_check(feed: Feed, name: str, broken: str) -> str:
    return (
        f"SELECT CAST(7 AS BIGINT) AS run_id, '{feed.stage_job}' AS job_name, '{name}' AS check_name, '{feed.raw_table}' AS table_name, "
        f"count(*) AS records_checked, count(*) FILTER ({broken}) AS records_failed, "
        f"CASE WHEN count(*) FILTER ({broken}) = 0 THEN 'PASS' ELSE 'FAIL' END AS check_status, '{CHECKED}' AS checked_at FROM raw_{feed.name}"
    )


ORACLES["dq_staging_checks"] = with_feeds(
    ("customers", "cdr"),
    load_check(_cust, "NULL_CUSTOMER_ID", "customer_id IS NULL")
    + " UNION ALL "
    + load_check(_cdr, "NULL_KEY_OR_BAD_TS", f"cdr_id IS NULL OR {parsed('call_start_ts', 'timestamp')} IS NULL"),
)


def reconcile_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT {head(f, job=False)}, r.source_file_name, s.n AS source_row_count, r.n AS target_row_count, "
        f"r.n - s.n AS row_count_variance, "
        f"CASE WHEN s.n IS NULL THEN 'SKIPPED' WHEN s.n = r.n THEN 'MATCH' ELSE 'MISMATCH' END AS check_status, '{CHECKED}' AS checked_at "
        f"FROM (SELECT source_file_name, count(*) AS n FROM raw_{f.name} GROUP BY 1) r LEFT JOIN "
        f"(SELECT source_file_name, count(*) AS n FROM lines_{f.name} WHERE source_file_name <> 'customers_1_3.csv' GROUP BY 1) s "
        f"ON r.source_file_name = s.source_file_name"
        for f in FEEDS.values()
    )


ORACLES["dq_reconcile"] = with_feeds(tuple(FEEDS), reconcile_sql())
ORACLES["dq_mismatches"] = with_feeds(
    tuple(FEEDS), f"SELECT * EXCLUDE (run_id, check_status) FROM ({reconcile_sql()}) WHERE check_status = 'MISMATCH'"
)
ORACLES["dq_reconcile_summary"] = with_feeds(
    tuple(FEEDS),
    f"SELECT {head(_cust)}, 'ROW_COUNT_RECONCILIATION' AS rule_type, CAST(NULL AS VARCHAR) AS column_name, "
    "count(*) FILTER (check_status <> 'SKIPPED') AS records_checked, count(*) FILTER (check_status = 'MISMATCH') AS records_failed, "
    "CASE WHEN count(*) FILTER (check_status = 'MISMATCH') = 0 THEN 'PASS' ELSE 'FAIL' END AS check_status, "
    f"'{CHECKED}' AS checked_at FROM ({reconcile_sql()}) WHERE feed_name = 'customers'",
)
ORACLES["dq_summary_today"] = with_feeds(
    tuple(FEEDS),
    "SELECT feed_name, table_name, rule_type, column_name, CAST(sum(records_checked) AS BIGINT) AS records_checked, "
    "CAST(sum(records_failed) AS BIGINT) AS records_failed, "
    "round(100.0 * sum(records_failed)::DOUBLE / nullif(sum(records_checked), 0), 3) AS pct_failed, max(checked_at) AS last_checked_at FROM ("
    + " UNION ALL ".join(
        summary_sql(FEEDS[n], where, run_id, at)
        for n in FEEDS
        for run_id, at, where in (
            (1, "2024-03-01 08:00:00", "load = 1"),
            (2, CHECKED, "load = 1"),
            (3, "2024-03-02 09:00:00", "true"),
        )
    )
    + ") WHERE left(checked_at, 10) = '2024-03-02' GROUP BY 1, 2, 3, 4",
)

# -- run log ---------------------------------------------------------------------------

RUNS = f"""runs AS (SELECT *, CASE outcome WHEN 'NONE' THEN 'RUNNING' WHEN 'FAIL' THEN 'FAILED'
    ELSE CASE WHEN rows_rejected > 0 THEN 'WARNING' ELSE 'SUCCESS' END END AS status,
    CAST(started AS DATE) AS run_date, CASE WHEN outcome <> 'NONE' THEN ended END AS end_time,
    CASE WHEN outcome <> 'NONE' THEN date_diff('second', started, ended) END AS secs,
    CASE WHEN outcome = 'END' THEN rows_read ELSE 0 END AS n_read, CASE WHEN outcome = 'END' THEN rows_inserted ELSE 0 END AS n_ins,
    CASE WHEN outcome = 'END' THEN rows_updated ELSE 0 END AS n_upd, CASE WHEN outcome = 'END' THEN rows_rejected ELSE 0 END AS n_rej
    FROM ({run_rows_sql()}))"""
START_END = "strftime(started, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time"

ORACLES["run_log"] = f"""WITH {RUNS} SELECT run_id, job_name, strftime(run_date, '%Y-%m-%d') AS run_date, {START_END}, status,
    n_read AS rows_read, n_ins AS rows_inserted, n_upd AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted, n_rej AS rows_rejected,
    secs AS duration_seconds, 'TASK' AS triggered_by,
    CASE WHEN outcome <> 'NONE' THEN 'run ' || run_id || ' closed' END AS comments FROM runs"""


def stats_sql(where: str) -> str:
    return f"""WITH {RUNS} SELECT strftime(run_date, '%Y-%m-%d') AS run_date, job_name, count(*) AS total_runs,
    count(*) FILTER (status = 'SUCCESS') AS successful_runs, count(*) FILTER (status = 'FAILED') AS failed_runs,
    count(*) FILTER (status = 'WARNING') AS warning_runs, CAST(sum(n_read) AS BIGINT) AS total_rows_read,
    CAST(sum(n_ins) AS BIGINT) AS total_rows_inserted, CAST(sum(n_upd) AS BIGINT) AS total_rows_updated,
    CAST(sum(n_rej) AS BIGINT) AS total_rows_rejected, round(avg(secs), 1) AS avg_duration_seconds, max(secs) AS max_duration_seconds
    FROM runs WHERE {where} GROUP BY runs.run_date, job_name"""


ORACLES["daily_run_stats"] = stats_sql("true")
ORACLES["daily_summary"] = stats_sql("runs.run_date = (SELECT max(run_date) FROM runs)")
ORACLES["latest_run_status"] = f"""WITH {RUNS} SELECT job_name, status, {START_END}, secs AS duration_seconds,
    n_read AS rows_read, n_ins AS rows_inserted, n_upd AS rows_updated, n_rej AS rows_rejected
    FROM (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY job_name ORDER BY started DESC, run_id DESC) = 1)"""


def open_errors_sql(tail: str) -> str:
    return f"""WITH {RUNS} SELECT run_id AS error_id, run_id, job_name, strftime(ended, '%Y-%m-%d %H:%M:%S') AS error_time,
    'SQL_ERROR' AS error_type, 'CRITICAL' AS severity, 'failed after ' || rows_read || ' rows' AS error_message,
    status AS run_status FROM runs WHERE outcome = 'FAIL' AND NOT resolved {tail}"""


ORACLES["open_errors"] = open_errors_sql("")
ORACLES["newest_open_errors"] = open_errors_sql("ORDER BY ended DESC, run_id DESC LIMIT 20")
_JOBS = ", ".join("(" + ", ".join(f"'{v}'" for v in job) + ")" for job in JOBS)
ORACLES["job_registry"] = f"""WITH {RUNS}, known(job_name, layer, source_object, target_object, schedule_cron) AS (VALUES {_JOBS}),
    ran AS (SELECT job_name, count(*) AS runs FROM runs GROUP BY 1)
    SELECT job_name, coalesce(layer, 'AD_HOC') AS layer, source_object, target_object, schedule_cron, true AS is_active,
    CASE WHEN layer IS NULL THEN '{SECOND_LOAD}' ELSE '{FIRST_LOAD}' END AS created_at, ran.runs
    FROM known FULL JOIN ran USING (job_name)"""

for _stored, _same in (("layers_run_days", "daily_run_stats"), ("layers_latest_runs", "latest_run_status"), ("layers_job_registry", "job_registry")):
    ORACLES[_stored] = ORACLES[_same]

# -- files and streams -----------------------------------------------------------------


def landed_sql(feed: str) -> str:
    columns = ", ".join(FEEDS[feed].columns)
    return with_feeds((feed,), f"SELECT {columns}, '{SECOND_LOAD}' AS _load_ts FROM raw_{feed}")


ORACLES["raw_load_customers"] = landed_sql("customers")
ORACLES["raw_load_json_plans"] = landed_sql("plans")
ORACLES["raw_load_report"] = with_feeds(
    tuple(LINES),
    " UNION ALL ".join(
        f"SELECT '{n}' AS feed_name, (SELECT count(*) FROM lines_{n}) AS rows_parsed, (SELECT count(*) FROM raw_{n}) AS rows_loaded, "
        f"(SELECT count(*) FROM lines_{n}) - (SELECT count(*) FROM raw_{n}) AS errors_seen"
        for n in LINES
    ),
)
ORACLES["stream_cdr_fact"] = with_feeds(
    ("cdr",),
    f"SELECT {shown_fields(_cdr)}, strftime(call_start_ts, '%Y-%m-%d') AS usage_date FROM "
    f"(SELECT * FROM s2_cdr QUALIFY row_number() OVER (PARTITION BY cdr_id ORDER BY {_cdr_newest}) = 1)",
)
# Each load opens at most one version of a customer, numbered in the order of loads and ids.
ORACLES["layers_dim_customer"] = with_feeds(
    ("customers",),
    f"SELECT row_number() OVER (ORDER BY eff_start_ts, customer_id) AS customer_sk, {shown_fields(_cust)}, {VALIDITY} FROM t_customers",
)
ORACLES["stream_customers_dim"] = with_feeds(("customers",), f"SELECT {shown_fields(_cust)}, is_current FROM t_customers")
ORACLES["stream_raw_towers"] = with_feeds(("towers",), f"SELECT {', '.join(FEEDS['towers'].columns)} FROM raw_towers")
# A key is numbered in the load it first comes in.
_dev = FEEDS["devices"]
ORACLES["layers_dim_device"] = with_feeds(
    ("devices",),
    f"SELECT row_number() OVER (ORDER BY device_id NOT IN (SELECT device_id FROM s1_devices), device_id) AS device_sk, {shown_fields(_dev)} FROM t_devices",
)
_LOADS = [("load = 1", FIRST_LOAD), ("load = 2", SECOND_LOAD), ("false", IDLE_CHECK)]
_checked = [FEEDS[n] for n in CHECKED_FEEDS]
ORACLES["layers_validation_errors"] = with_feeds(
    CHECKED_FEEDS,
    "SELECT job_name, feed_name, table_name, rule_type, column_name, record_key, failed_value, error_reason, load_ts, load_ts AS logged_at, "
    "raw_region, raw_invoice_status FROM ("
    + " UNION ALL ".join(
        f"SELECT * FROM ({errors_sql(f, keep=('region', 'invoice_status'))})" for f in _checked
    )
    + ")",
)
ORACLES["layers_validation_summary"] = with_feeds(
    CHECKED_FEEDS,
    "SELECT * EXCLUDE (run_id) FROM ("
    + " UNION ALL ".join(summary_sql(f, where, at=f"{at:%Y-%m-%d %H:%M:%S}") for f in _checked for where, at in _LOADS)
    + ")",
)
ORACLES["layers_file_counts"] = with_feeds(
    CHECKED_FEEDS,
    " UNION ALL ".join(
        f"SELECT '{f.name}' AS feed_name, '{at:%Y-%m-%d %H:%M:%S}' AS checked_at, "
        f"CAST((SELECT count(*) FROM lines_{f.name} WHERE {where}) AS BIGINT) AS source_rows, "
        f"CAST((SELECT count(*) FROM raw_{f.name} WHERE {where}) AS BIGINT) AS target_rows, CAST(0 AS BIGINT) AS files_with_more"
        for f in _checked
        for where, at in _LOADS[:2]
    ),
)
_tow = FEEDS["towers"]
_in_second = ", ".join("CASE WHEN tower_id LIKE '%5' THEN 777 ELSE capacity_mbps END AS capacity_mbps" if c == "capacity_mbps" else c for c in _tow.columns)
ORACLES["layers_net_changes"] = with_feeds(
    ("towers",),
    f"SELECT {shown_fields(_tow)}, _action, _is_update FROM ("
    f"WITH l2 AS ({staged_sql(_tow, 'load = 2')}), "
    f"three AS (SELECT * FROM l2 UNION ALL SELECT * EXCLUDE (updated_at) FROM s1_towers WHERE tower_id LIKE '%5' AND tower_id NOT IN (SELECT tower_id FROM l2)), "
    f"after AS (SELECT {_in_second} FROM three WHERE tower_id NOT LIKE '%7'), "
    f"touched AS (SELECT tower_id FROM three UNION SELECT tower_id FROM s1_towers WHERE tower_id LIKE '%7') "
    f"SELECT {', '.join(_tow.columns)}, 'DELETE' AS _action, tower_id IN (SELECT tower_id FROM after) AS _is_update "
    f"FROM s1_towers WHERE tower_id IN (SELECT tower_id FROM touched) UNION ALL "
    f"SELECT {', '.join(_tow.columns)}, 'INSERT', tower_id IN (SELECT tower_id FROM s1_towers) FROM after)",
)
