"""SQL for the registered queries, written against the shared tables alone."""

from __future__ import annotations

VIEWS = {
    "src_transactions": """
        SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS user_id,
          CAST(o_custkey % 25 AS VARCHAR) AS business_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
          CASE o_orderstatus WHEN 'O' THEN 'debit' WHEN 'F' THEN 'credit' ELSE 'other' END AS transaction_type,
          o_orderpriority AS type, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created_at,
          CAST(o_orderdate AS DATE) AS day
        FROM orders""",
    "src_users": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(c_custkey % 25 AS VARCHAR) AS business_id,
          CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey % 6 AS VARCHAR) END AS rating,
          strftime(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%Y-%m-%dT00:00:00') AS created_at
        FROM customer""",
    "src_analytics": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y%m%d') AS event_date, event_type AS category,
          'brand_' || CAST(user_id % 5 AS VARCHAR) AS mobile_brand_name,
          'model_' || CAST(user_id % 3 AS VARCHAR) AS mobile_model_name,
          'hw' || CAST(user_id % 4 AS VARCHAR) || ',1' AS mobile_os_hardware_model,
          CASE WHEN user_id % 2 = 0 THEN 'ANDROID' ELSE 'IOS' END AS operating_system,
          CAST(user_id % 10 AS VARCHAR) AS operating_system_version,
          'city_' || CAST(user_id % 7 AS VARCHAR) AS city, 'country_' || CAST(user_id % 3 AS VARCHAR) AS country,
          json_extract_string(props, '$.k') AS appversion,
          CAST(year(ts) AS INTEGER) AS cryear, CAST(month(ts) AS INTEGER) AS crmonth, CAST(day(ts) AS INTEGER) AS crday,
          ts AS event_ts, event_id
        FROM events""",
    "profile": """
        SELECT user_id,
          CAST(SUM(CASE WHEN transaction_type = 'debit' THEN 1 ELSE 0 END) AS BIGINT) AS debit_count,
          CAST(SUM(CASE WHEN transaction_type = 'credit' THEN 1 ELSE 0 END) AS BIGINT) AS credit_count,
          CAST(SUM(CASE WHEN transaction_type IN ('debit', 'credit') THEN 1 ELSE 0 END) AS BIGINT) AS total_trans_count,
          ROUND(CAST(SUM(CASE WHEN transaction_type = 'debit' THEN amount ELSE 0 END) AS DOUBLE) / 1000000, 2)
            AS debitamount_inmillion,
          ROUND(CAST(SUM(CASE WHEN transaction_type = 'credit' THEN amount ELSE 0 END) AS DOUBLE) / 1000000, 2)
            AS creditamount_inmillion,
          ROUND(CAST(SUM(CASE WHEN transaction_type IN ('debit', 'credit') THEN amount ELSE 0 END) AS DOUBLE)
            / 1000000, 2) AS totaltransamount_inmillion
        FROM src_transactions GROUP BY user_id""",
    "cur_users": """
        SELECT user_id, business_id, COALESCE(rating, '0') AS rating, created_at,
          TIMESTAMP '2002-01-01 06:00:00' AS processed_at,
          CAST(DATE '2002-01-01' - CAST(created_at AS DATE) AS INTEGER) AS signup_since_days,
          CAST(year(CAST(created_at AS DATE)) AS INTEGER) AS cryear,
          CAST(month(CAST(created_at AS DATE)) AS INTEGER) AS crmonth,
          CAST(day(CAST(created_at AS DATE)) AS INTEGER) AS crday
        FROM src_users""",
    "cur_trans": """
        SELECT t.user_id, transaction_id, business_id, CAST(amount AS VARCHAR) AS amount, transaction_type, type,
          created_at, TIMESTAMP '2002-01-01 06:00:00' AS processed_at, CAST(year(day) AS INTEGER) AS cryear,
          CAST(month(day) AS INTEGER) AS crmonth, CAST(day(day) AS INTEGER) AS crday,
          CAST(year(day) AS VARCHAR) || '-' || CAST(month(day) AS VARCHAR) || '-' || CAST(day(day) AS VARCHAR)
            AS trans_date,
          debit_count, credit_count, total_trans_count, debitamount_inmillion, creditamount_inmillion,
          totaltransamount_inmillion
        FROM src_transactions t LEFT JOIN profile p ON t.user_id = p.user_id""",
    "latest": """
        SELECT user_id, event_date, category, mobile_brand_name, mobile_model_name, mobile_os_hardware_model,
          operating_system, operating_system_version, city, country, appversion, cryear, crmonth, crday
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                ORDER BY cryear DESC, crmonth DESC, crday DESC, event_ts DESC, event_id DESC) AS rn
              FROM src_analytics) x
        WHERE rn = 1""",
    "dates": """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY d) AS INTEGER) AS date_id_pk, d AS trans_date,
          CAST(year(d) AS INTEGER) AS trans_year, CAST(month(d) AS INTEGER) AS trans_month,
          CAST(quarter(d) AS INTEGER) AS trans_quarter, CAST(day(d) AS INTEGER) AS trans_day,
          CAST(isodow(d) - 1 AS INTEGER) AS trans_dayofweek, dayname(d) AS trans_dayname,
          CAST(day(d) AS INTEGER) AS trans_dayofmonth,
          CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS trans_weekday
        FROM (SELECT CAST(UNNEST(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
              FROM orders) s""",
    "gmv": """
        SELECT CAST(year(t.day) AS INTEGER) AS trans_year, CAST(month(t.day) AS INTEGER) AS trans_month,
          CAST(SUM(t.amount) AS DOUBLE) AS gmv_per_month,
          CAST(SUM(t.amount) AS DOUBLE) / COUNT(t.amount) AS avgtranspermonth
        FROM src_transactions t JOIN src_users u ON t.user_id = u.user_id
        JOIN (SELECT DISTINCT user_id FROM src_analytics) a ON t.user_id = a.user_id
        GROUP BY 1, 2""",
    "udim": """
        SELECT ROW_NUMBER() OVER (ORDER BY user_id) AS user_id_pk, *, 'Y' AS isActive FROM cur_users""",
    "tdim": """
        SELECT ROW_NUMBER() OVER (ORDER BY user_id, transaction_id) AS trans_id_pk, *, 'Y' AS isActive
        FROM cur_trans""",
    "adim": """
        SELECT ROW_NUMBER() OVER (ORDER BY user_id) AS analytics_id_pk, *,
          TIMESTAMP '2002-01-01 06:00:00' AS processed_at, 'Y' AS isActive
        FROM latest""",
    "fact": """
        SELECT ROW_NUMBER() OVER (ORDER BY t.transaction_id) AS profile_id_pk, u.user_id_pk AS user_id_fk,
          t.trans_id_pk AS trans_id_fk, a.analytics_id_pk AS analytics_id_fk, d.date_id_pk AS date_id_fk,
          g.gmv_per_month, g.avgtranspermonth
        FROM tdim t JOIN adim a ON t.user_id = a.user_id JOIN udim u ON t.user_id = u.user_id
        JOIN dates d ON CAST(t.created_at AS DATE) = d.trans_date
        LEFT JOIN gmv g ON d.trans_year = g.trans_year AND d.trans_month = g.trans_month""",
    "report": """
        SELECT f.profile_id_pk, u.user_id, u.rating, u.signup_since_days, f.gmv_per_month, f.avgtranspermonth,
          d.trans_date, d.trans_year, d.trans_month, d.trans_quarter, d.trans_weekday, d.trans_dayname,
          d.trans_dayofmonth, CAST(t.amount AS DOUBLE) AS amount, t.debit_count, t.credit_count,
          t.total_trans_count, t.debitamount_inmillion, t.creditamount_inmillion, t.totaltransamount_inmillion,
          a.category, a.mobile_brand_name, a.city, a.appversion
        FROM fact f JOIN udim u ON f.user_id_fk = u.user_id_pk JOIN tdim t ON f.trans_id_fk = t.trans_id_pk
        JOIN dates d ON f.date_id_fk = d.date_id_pk JOIN adim a ON f.analytics_id_fk = a.analytics_id_pk""",
}

_PARTS = "cryear, crmonth, crday"
_FLAT = """user_id, event_date, category, mobile_brand_name, mobile_model_name, mobile_os_hardware_model,
    operating_system, operating_system_version, city, country, appversion"""
_LANDED = f"TIMESTAMP '2002-01-01 06:00:00' AS processed_at, {_PARTS}"
_UPPER_ON_15TH = _FLAT.replace(
    "category", "CASE WHEN event_date = '20240115' THEN upper(category) ELSE category END AS category"
)

_USES = {
    "profile": ["src_transactions"],
    "cur_users": ["src_users"],
    "cur_trans": ["profile", "src_transactions"],
    "latest": ["src_analytics"],
    "gmv": ["src_transactions", "src_users", "src_analytics"],
    "udim": ["cur_users"],
    "tdim": ["cur_trans"],
    "adim": ["latest"],
    "fact": ["udim", "tdim", "adim", "dates", "gmv"],
    "report": ["fact", "udim", "tdim", "adim", "dates"],
}


def _with(select: str, *views: str) -> str:
    """``select`` after the views it needs, each defined before its users."""
    order: list[str] = []

    def need(view: str) -> None:
        for other in _USES.get(view, []):
            need(other)
        if view not in order:
            order.append(view)

    for view in views:
        need(view)
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in order) + "\n" + select


def _repeated(table: str, key: str, name: str) -> str:
    return f"""SELECT '{name} repeated keys' AS check_name, COUNT(*) AS violations
        FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING COUNT(*) > 1) x"""


def _orphans(table: str, key: str, parent: str, parent_key: str, name: str) -> str:
    return f"""SELECT '{name}' AS check_name, COUNT(*) AS violations FROM {table} t
        WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = t.{key})"""


def _key_audit() -> str:
    checks = [_repeated("fact", "profile_id_pk", "profile_fact")]
    for table, dim, name in (("udim", "user", "user_dim"), ("tdim", "trans", "trans_dim"),
                             ("adim", "analytics", "analytics_dim"), ("dates", "date", "date_dim")):
        checks.append(_repeated(table, f"{dim}_id_pk", name))
        checks.append(_orphans("fact", f"{dim}_id_fk", table, f"{dim}_id_pk", f"profile_fact rows without {name}"))
    for table, key, name in (("udim", "user_id", "user_dim repeated users"), ("tdim", "transaction_id", "trans_dim repeated transactions"),
                             ("adim", "user_id", "analytics_dim repeated users")):
        checks.append(f"""SELECT '{name}' AS check_name, COUNT(*) AS violations
        FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING COUNT(*) > 1) x""")
    checks.append("SELECT 'transactions without day' AS check_name, COUNT(*) AS violations FROM src_transactions WHERE day IS NULL")
    checks.append(_orphans("src_transactions", "user_id", "src_users", "user_id", "transactions without user"))
    checks.append(_orphans("src_transactions", "user_id", "src_analytics", "user_id", "transactions without events"))
    return "\nUNION ALL\n".join(checks)


def _row_counts() -> str:
    tables = {
        "raw.users": "src_users",
        "raw.transactions": "src_transactions",
        "raw.analytics": "src_analytics",
        "curated.users": "cur_users",
        "curated.transactions": "cur_trans",
        "curated.trans_profile": "profile",
        "curated.analytics": "src_analytics",
        "consumption.date_dim": "dates",
        "consumption.user_dim": "udim",
        "consumption.trans_dim": "tdim",
        "consumption.analytics_dim": "adim",
        "consumption.profile_fact": "fact",
        "consumption.gmv_per_month": "gmv",
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {view}" for name, view in tables.items()
    )


_DAY_PARTS_OF = """CAST(year(day) AS INTEGER) AS cryear, CAST(month(day) AS INTEGER) AS crmonth,
    CAST(day(day) AS INTEGER) AS crday"""
_TRANS_FEED = "transaction_id, user_id, business_id, CAST(amount AS VARCHAR) AS amount, transaction_type, type, created_at"
_DIM_ANALYTICS = f"analytics_id_pk, {_FLAT}, processed_at, {_PARTS}, isActive"
_REPORT = """user_id, rating, signup_since_days, gmv_per_month, avgtranspermonth, trans_date, trans_year,
    trans_month, trans_quarter, trans_weekday, trans_dayname, trans_dayofmonth, amount, debit_count, credit_count,
    total_trans_count, debitamount_inmillion, creditamount_inmillion, totaltransamount_inmillion, category,
    mobile_brand_name, city, appversion"""
_SAME_EVENT = " AND ".join(
    f"e.{c} = n.{c}" for c in _FLAT.replace("\n", " ").replace(" ", "").split(",")
)

# Leaf fields of the event feed that the shared tables have nothing for.
_UNSENT = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}"
    for c in """event_previous_timestamp event_bundle_sequence_id event_server_timestamp_offset user_pseudo_id
        user_properties user_first_touch_timestamp device_mobile_marketing_name device_advertising_id device_language
        device_is_limited_ad_tracking device_time_zone_offset_seconds geo_continent geo_region geo_sub_continent
        geo_metro app_info_id app_info_firebase_app_id app_info_install_source traffic_source_name
        traffic_source_medium traffic_source_source stream_id platform items""".split()
)
_LOADED = """SELECT t.transaction_id, t.user_id, t.user_id AS event_user_id, d.trans_date, f.gmv_per_month, f.avgtranspermonth
    FROM fact f JOIN tdim t ON f.trans_id_fk = t.trans_id_pk JOIN dates d ON f.date_id_fk = d.date_id_pk"""


def _rejected_rows() -> str:
    counts = []
    for feed, table, key in (("users", "customer", "c_custkey"), ("transactions", "orders", "o_orderkey"), ("analytics", "events", "event_id")):
        kind = f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 4) AS INTEGER) % 10)"
        for name, which in (("landed", f"{kind} > 1"), ("lines", f"{kind} = 0"), ("undated", f"{kind} = 1")):
            counts.append(f"SELECT '{feed} {name}' AS table_name, COUNT(*) AS row_count FROM {table} WHERE {which}")
    return "\nUNION ALL\n".join(counts)


def _cast_rejects() -> str:
    def count(which: str) -> str:
        return f"SUM(CASE WHEN {which} THEN 1 ELSE 0 END)::BIGINT"

    def row(feed: str, column: str, table: str, key: str, missing: str, not_cast: str, beyond: str) -> str:
        kind = f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 4) AS INTEGER) % 10"
        return f"""SELECT 'full' AS run, '{feed}' AS feed, '{column}' AS column_name, COUNT(*) AS rows_read,
            {count(missing)} AS missing, {count(not_cast)} AS not_cast, {count(beyond)} AS out_of_range
          FROM (SELECT *, {kind} AS kind FROM {table})"""

    empty = "kind = 3 OR (kind NOT IN (1, 2) AND rating IS NULL)"
    return "\nUNION ALL\n".join(
        [
            row("users", "rating", "src_users", "user_id", empty, "kind = 1", "kind = 2"),
            row("users", "created_at", "src_users", "user_id", "FALSE", "kind = 5", "kind = 4"),
            row("transactions", "amount", "src_transactions", "transaction_id", "kind = 3", "kind = 1", "kind = 2"),
            row("transactions", "created_at", "src_transactions", "transaction_id", "FALSE", "kind = 5", "kind = 4"),
            row("analytics", "event_date", "src_analytics", "event_id", "FALSE", "kind = 5", "kind = 4"),
            row("analytics", "operating_system_version", "src_analytics", "event_id", "FALSE", "FALSE", "FALSE"),
        ]
    )


def _landed_arrivals() -> str:
    def digits(first: int) -> str:
        return f"CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), {first}, 4) AS INTEGER)"

    return f"""SELECT {", ".join(f"CASE WHEN kind > 1 THEN {p} END AS {p}" for p in _PARTS.split(", "))}, COUNT(*) AS row_count,
      COUNT(DISTINCT CASE WHEN kind > 1 THEN user_id END) AS users,
      SUM(CASE WHEN kind = 0 THEN 1 ELSE 0 END)::BIGINT AS bad_lines, COUNT(DISTINCT lot) AS runs
    FROM (SELECT *, {digits(1)} % 10 AS kind, {digits(5)} % 3 AS lot FROM src_analytics)
    GROUP BY ALL"""


def _table_contracts() -> str:
    months, days = ("cryear", "crmonth"), ("cryear", "crmonth", "crday")
    columns = {
        "users": ("src_users", "user_id business_id rating created_at", months),
        "transactions": ("src_transactions", "transaction_id user_id business_id amount transaction_type type created_at", months),
        "analytics": ("src_analytics", _FLAT.replace(",", " "), days),
    }
    rows = []
    for feed, (view, texts, parts) in columns.items():
        typed = [(c, "string", c) for c in texts.split()] + [("processed_at", "timestamp", "1")]
        typed += [(c, "int", "1") for c in days]
        for name, kind, counted in typed:
            placed = "true" if name in parts else "false"
            rows.append(
                f"""SELECT '{feed}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, {placed} AS is_partition,
                COUNT({counted}) AS values, 0 AS tables_left FROM {view}"""
            )
    return "\nUNION ALL\n".join(rows)


ORACLES: dict[str, str] = {
    "compacted_months": _with(
        """SELECT CAST(year(day) AS INTEGER) AS cryear, CAST(month(day) AS INTEGER) AS crmonth, COUNT(*) AS row_count,
          MIN(transaction_id) AS first_id, MAX(transaction_id) AS last_id, COUNT(DISTINCT transaction_id) AS ids,
          CAST(1 AS BIGINT) AS files
        FROM src_transactions GROUP BY ALL""",
        "src_transactions",
    ),
    "new_transactions_by_filter": _with(
        f"""SELECT transaction_id, user_id, {_DAY_PARTS_OF} FROM src_transactions
        WHERE CAST('0x' || substr(md5(transaction_id), 1, 4) AS INTEGER) % 6 = 3""",
        "src_transactions",
    ),
    "rows_by_user": _with(
        """SELECT user_id, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS most_files FROM src_transactions
        GROUP BY user_id""",
        "src_transactions",
    ),
    "run_clock_roundtrip": _with(
        """SELECT 1 AS datetoday_pk, CAST(day(t) AS VARCHAR) AS todayday, CAST(month(t) AS VARCHAR) AS todaymonth,
          CAST(year(t) AS VARCHAR) AS todayyear, CAST(day(y) AS VARCHAR) AS "yesterdayDay",
          CAST(month(y) AS VARCHAR) AS "yesterDayMonth", CAST(year(y) AS VARCHAR) AS "yesterDayYear",
          t AS today, y AS yesterday
        FROM (SELECT CAST(MAX(day) + INTERVAL 1 DAY AS DATE) AS t, CAST(MAX(day) AS DATE) AS y FROM src_transactions)""",
        "src_transactions",
    ),
    "table_contracts": _with(_table_contracts(), "src_users", "src_transactions", "src_analytics"),
    "ingest_users": _with("SELECT * FROM src_users", "src_users"),
    "ingest_transactions": _with(f"SELECT {_TRANS_FEED} FROM src_transactions", "src_transactions"),
    "ingest_analytics": _with(
        f"""SELECT user_id, event_date, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
          category AS event_name, 'k.int_value=' || appversion AS event_params, category AS device_category,
          mobile_brand_name AS device_mobile_brand_name, mobile_model_name AS device_mobile_model_name,
          mobile_os_hardware_model AS device_mobile_os_hardware_model, operating_system AS device_operating_system,
          operating_system_version AS device_operating_system_version, city AS geo_city, country AS geo_country,
          appversion AS app_info_version, {_UNSENT}
        FROM src_analytics""",
        "src_analytics",
    ),
    "rejected_rows": _rejected_rows(),
    "cast_rejects": _with(_cast_rejects(), "src_users", "src_transactions", "src_analytics"),
    "landed_arrivals": _with(_landed_arrivals(), "src_analytics"),
    "dedupe_transactions": _with(f"SELECT {_TRANS_FEED} FROM src_transactions", "src_transactions"),
    "full_load_fact": _with(_LOADED, "fact", "tdim", "udim", "dates"),
    "incremental_load_fact": _with(_LOADED, "fact", "tdim", "udim", "dates"),
    "day_slice_scan": _with(
        f"SELECT {_FLAT}, {_LANDED} FROM src_analytics WHERE cryear = 2024 AND crmonth = 1 AND crday = 15",
        "src_analytics",
    ),
    "partitioned_roundtrip": _with(f"SELECT {_FLAT}, {_LANDED} FROM src_analytics", "src_analytics"),
    "day_partition_refresh": _with(
        f"SELECT {_UPPER_ON_15TH}, {_LANDED} FROM src_analytics WHERE event_date <> '20240116'", "src_analytics"
    ),
    "register_partitions": _with(
        f"SELECT {_PARTS}, COUNT(*) AS row_count FROM src_analytics GROUP BY {_PARTS}", "src_analytics"
    ),
    "swap_day_partition": _with(f"SELECT {_UPPER_ON_15TH}, {_LANDED} FROM src_analytics", "src_analytics"),
    "append_new_rows": _with("SELECT * FROM src_users", "src_users"),
    "date_parts_iso": _with(
        f"SELECT transaction_id, created_at, {_DAY_PARTS_OF} FROM src_transactions", "src_transactions"
    ),
    "date_parts_compact": _with(f"SELECT event_id, event_date, {_PARTS} FROM src_analytics", "src_analytics"),
    "incremental_slice_today": _with(
        f"SELECT {_TRANS_FEED} FROM src_transactions WHERE day = DATE '1998-05-14'", "src_transactions"
    ),
    "incremental_slice_yesterday": _with(
        f"SELECT {_TRANS_FEED} FROM src_transactions WHERE day = DATE '1998-05-13'", "src_transactions"
    ),
    "incremental_slice_events": _with(
        f"SELECT {_FLAT} FROM src_analytics WHERE CAST(event_ts AS DATE) = DATE '2024-01-15'", "src_analytics"
    ),
    "flatten_analytics": _with(f"SELECT {_FLAT} FROM src_analytics", "src_analytics"),
    "curate_analytics": _with(f"SELECT {_FLAT}, {_LANDED} FROM src_analytics", "src_analytics"),
    "anti_join_new_users": _with(
        """SELECT s.user_id FROM src_users s
        WHERE NOT EXISTS (SELECT 1 FROM src_analytics a WHERE a.user_id = s.user_id)""",
        "src_users", "src_analytics",
    ),
    "incremental_new_rows": _with(
        f"""SELECT {_FLAT}, {_PARTS}, event_id FROM src_analytics n
        WHERE event_date = '20240115' AND NOT EXISTS (
          SELECT 1 FROM src_analytics e WHERE e.event_ts < TIMESTAMP '2024-01-15 12:00:00' AND {_SAME_EVENT})""",
        "src_analytics",
    ),
    "curate_users": _with("SELECT * FROM cur_users", "cur_users"),
    "dedupe_users": _with(
        """SELECT user_id, business_id, rating, created_at FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
            ORDER BY created_at DESC, business_id ASC NULLS FIRST, rating ASC NULLS FIRST) AS rn
          FROM (SELECT user_id, business_id, rating, created_at FROM src_users UNION ALL
                SELECT user_id, business_id, type, created_at FROM src_transactions) s) x
        WHERE rn = 1""",
        "src_users", "src_transactions",
    ),
    "trans_type_counts": _with(
        """SELECT user_id, transaction_type, COUNT(*) AS "userTotalTransCount", COUNT(*) AS "TransTypeCount",
          CAST(SUM(amount) AS DOUBLE) AS "totalAmount"
        FROM src_transactions GROUP BY user_id, transaction_type""",
        "src_transactions",
    ),
    "trans_profile": _with("SELECT * FROM profile", "profile"),
    "trans_profile_by_merge": _with("SELECT * FROM profile", "profile"),
    "curate_transactions": _with("SELECT * FROM cur_trans", "cur_trans"),
    "gmv_per_month": _with("SELECT * FROM gmv ORDER BY trans_year, trans_month", "gmv"),
    "trans_date_bounds": _with(
        """SELECT MIN(created_at) AS min_trans_dt, MAX(created_at) AS max_trans_dt, MIN(day) AS min_trans_date,
          MAX(day) AS max_trans_date
        FROM src_transactions""",
        "src_transactions",
    ),
    "layer_row_counts": _with(_row_counts(), "src_analytics", "report"),
    "key_audit": _with(_key_audit(), "report"),
    "surrogate_key_dense": _with("SELECT user_id, transaction_id, trans_id_pk FROM tdim", "tdim"),
    "analytics_latest": _with("SELECT * FROM latest", "latest"),
    "date_dim": _with("SELECT * FROM dates", "dates"),
    "user_dim": _with("SELECT * FROM udim", "udim"),
    "trans_dim": _with("SELECT * FROM tdim", "tdim"),
    "analytics_dim": _with(f"SELECT {_DIM_ANALYTICS} FROM adim", "adim"),
    "profile_fact": _with("SELECT * FROM fact", "fact"),
    "star_report": _with(f"SELECT {_REPORT} FROM report", "report"),
    "star_report_top20": _with(
        f"SELECT profile_id_pk, {_REPORT} FROM report ORDER BY profile_id_pk LIMIT 20", "report"
    ),
    "late_day_refresh": _with(f"SELECT {_FLAT}, {_LANDED} FROM src_analytics", "src_analytics"),
}
