"""Column contracts of every feed and table.

Surrogate keys are BIGINT: a 32-bit key runs out after 2.1 billion rows.  The calendar key stays INT.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "amount": T.DecimalType(28, 6),
    "total": T.DecimalType(38, 6),
}

# Amounts are parsed once to this type, so sums do not depend on the order of the rows.
MONEY = "decimal(28,6)"

DAY_PARTS = ("cryear", "crmonth", "crday")
# Above the raw layer a table has a folder per month; within it rows lie by day, so that the minima and maxima of
# Parquet row groups find a day. A folder per day would make as many files as there are days, however few the rows.
DAY_MONTHS = DAY_PARTS[:2]
DAY_IN_MONTH = DAY_PARTS[2:]


def _contract(text: str) -> T.StructType:
    fields = (item.split() for item in text.replace("\n", " ").split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


# --- feeds ---------------------------------------------------------------------------------------------

USERS_FEED = _strings("user_id", "business_id", "rating", "created_at")

TRANSACTIONS_FEED = _strings(
    "transaction_id", "user_id", "business_id", "amount", "transaction_type", "type", "created_at"
)

PARAMS = T.ArrayType(
    T.StructType(
        [
            T.StructField("key", T.StringType(), True),
            T.StructField("value", T.MapType(T.StringType(), T.StringType()), True),
        ]
    )
)

DEVICE = _strings(
    "category", "mobile_brand_name", "mobile_model_name", "mobile_marketing_name", "mobile_os_hardware_model",
    "operating_system", "operating_system_version", "advertising_id", "language", "is_limited_ad_tracking",
    "time_zone_offset_seconds",
)
GEO = _strings("city", "country", "continent", "region", "sub_continent", "metro")
APP_INFO = _strings("id", "version", "firebase_app_id", "install_source")
TRAFFIC_SOURCE = _strings("name", "medium", "source")

ANALYTICS_FEED = T.StructType(
    _strings("event_date", "event_timestamp", "event_name").fields
    + [T.StructField("event_params", PARAMS, True)]
    + _strings(
        "event_previous_timestamp", "event_bundle_sequence_id", "event_server_timestamp_offset", "user_id",
        "user_pseudo_id",
    ).fields
    + [
        T.StructField("user_properties", PARAMS, True),
        T.StructField("user_first_touch_timestamp", T.StringType(), True),
        T.StructField("device", DEVICE, True),
        T.StructField("geo", GEO, True),
        T.StructField("app_info", APP_INFO, True),
        T.StructField("traffic_source", TRAFFIC_SOURCE, True),
    ]
    + _strings("stream_id", "platform").fields
    + [T.StructField("items", T.ArrayType(T.StringType()), True)]
)

# The fields of an event that the source layer keeps.
ANALYTICS_LANDED = T.StructType(
    _strings("user_id", "event_date").fields
    + [
        T.StructField(
            "device",
            _strings(
                "category", "mobile_brand_name", "mobile_model_name", "mobile_os_hardware_model", "operating_system",
                "operating_system_version",
            ),
            True,
        ),
        T.StructField("geo", _strings("city", "country"), True),
        T.StructField("app_info", _strings("version"), True),
    ]
)

# --- source layer --------------------------------------------------------------------------------------

_ANALYTICS_TEXT = """user_id string, event_date string, category string, mobile_brand_name string,
    mobile_model_name string, mobile_os_hardware_model string, operating_system string,
    operating_system_version string, city string, country string, appversion string"""
_LANDED = "processed_at timestamp, cryear int, crmonth int, crday int"

ANALYTICS_FLAT = _contract(_ANALYTICS_TEXT)

SOURCE_USERS = _contract("user_id string, business_id string, rating string, created_at string, " + _LANDED)
SOURCE_TRANSACTIONS = _contract(
    """transaction_id string, user_id string, business_id string, amount string, transaction_type string,
    type string, created_at string, """
    + _LANDED
)
SOURCE_ANALYTICS = _contract(_ANALYTICS_TEXT + ", " + _LANDED)

# --- curated layer -------------------------------------------------------------------------------------

_PROFILE = """debit_count bigint, credit_count bigint, total_trans_count bigint,
    debitamount_inmillion double, creditamount_inmillion double, totaltransamount_inmillion double"""
_TRANS = """user_id string, transaction_id string, business_id string, amount string,
    transaction_type string, type string, created_at string, processed_at timestamp, cryear int, crmonth int,
    crday int, trans_date string"""

CURATED_USERS = _contract(
    """user_id string, business_id string, rating string, created_at string, processed_at timestamp,
    signup_since_days int, cryear int, crmonth int, crday int"""
)
TRANS_CORE = _contract(_TRANS)
TRANS_PROFILE = _contract("user_id string, " + _PROFILE)
CURATED_TRANSACTIONS = _contract(_TRANS + ", " + _PROFILE)
CURATED_ANALYTICS = SOURCE_ANALYTICS

# --- consumption layer ---------------------------------------------------------------------------------

DATE_DIM = _contract(
    """date_id_pk int, trans_date date, trans_year int, trans_month int, trans_quarter int, trans_day int,
    trans_dayofweek int, trans_dayname string, trans_dayofmonth int, trans_weekday string"""
)
USER_DIM = _contract(
    """user_id_pk bigint, user_id string, business_id string, rating string, created_at string,
    processed_at timestamp, signup_since_days int, cryear int, crmonth int, crday int, isActive string"""
)
TRANS_DIM = _contract(
    """trans_id_pk bigint, user_id string, transaction_id string, business_id string, amount string,
    transaction_type string, type string, created_at string, processed_at timestamp, cryear int, crmonth int,
    crday int, trans_date string, """
    + _PROFILE
    + ", isActive string"
)
ANALYTICS_DIM = _contract("analytics_id_pk bigint, " + _ANALYTICS_TEXT + ", " + _LANDED + ", isActive string")
PROFILE_FACT = _contract(
    """profile_id_pk bigint, user_id_fk bigint, trans_id_fk bigint, analytics_id_fk bigint, date_id_fk int,
    gmv_per_month double, avgtranspermonth double"""
)
GMV = _contract("trans_year int, trans_month int, gmv_per_month double, avgtranspermonth double")

RUN_CLOCK = _contract(
    """datetoday_pk int, todayday string, todaymonth string, todayyear string, yesterdayDay string,
    yesterDayMonth string, yesterDayYear string"""
)

# --- what the load keeps on storage --------------------------------------------------------------------
# Measures that belong to a user or a month are kept once, at that grain, and joined on when the wide
# contract above is read: a new day then never forces old transactions or old fact rows to be rewritten.

TRANS_DAILY = _contract(
    """user_id string, trans_rows bigint, debit_count bigint, credit_count bigint, debit_amount total,
    credit_amount total, both_amount total, cryear int, crmonth int, crday int"""
)
PROFILE_STORE = _contract("user_id string, trans_rows bigint, " + _PROFILE)
USER_DIM_STORE = T.StructType(USER_DIM.fields + _contract("added_on date").fields)
TRANS_DIM_STORE = T.StructType([f for f in TRANS_DIM.fields if f.name not in names(_contract(_PROFILE))])
ANALYTICS_DIM_STORE = T.StructType(ANALYTICS_DIM.fields + _contract("added_on date").fields)
FACT_STORE = _contract(
    """profile_id_pk bigint, user_id_fk bigint, trans_id_fk bigint, analytics_id_fk bigint, date_id_fk int,
    amount amount, trans_year int, trans_month int"""
)

MONTH_PARTS = ("trans_year", "trans_month")

# table -> (contract on storage, partition columns)
STORED = {
    "raw.users": (SOURCE_USERS, DAY_PARTS),
    "raw.transactions": (SOURCE_TRANSACTIONS, DAY_PARTS),
    "raw.analytics": (SOURCE_ANALYTICS, DAY_PARTS),
    "curated.users": (CURATED_USERS, DAY_MONTHS),
    "curated.transactions": (TRANS_CORE, DAY_MONTHS),
    "curated.trans_daily": (TRANS_DAILY, DAY_MONTHS),
    "curated.trans_profile": (PROFILE_STORE, ()),
    "curated.analytics": (CURATED_ANALYTICS, DAY_MONTHS),
    "consumption.date_dim": (DATE_DIM, ()),
    "consumption.user_dim": (USER_DIM_STORE, ()),
    "consumption.trans_dim": (TRANS_DIM_STORE, DAY_MONTHS),
    "consumption.analytics_dim": (ANALYTICS_DIM_STORE, ()),
    "consumption.profile_fact": (FACT_STORE, MONTH_PARTS),
    "consumption.gmv_per_month": (GMV, ()),
}

# What each run could not read of the typed columns of its feeds.
CAST_REPORT = _contract(
    "feed string, column_name string, rows_read bigint, missing bigint, not_cast bigint, out_of_range bigint"
)

# Tables whose keys are also kept as month filters, and the key.
FILTERED = {"curated.transactions": "transaction_id"}
KEY_FILTERS = _contract("cryear int, crmonth int, word int, bits bigint, words int")

# Tables with a row per user that a day changes for its users only: kept in folders by the hash of the key, of which a
# run rewrites those that its users fall into.
BUCKETED = {"curated.trans_profile": "user_id", "consumption.analytics_dim": "user_id"}
BUCKET = "bucket"
BUCKETS = 64


def layout(table: str) -> tuple[T.StructType, tuple[str, ...]]:
    """Columns and partition columns of a table's folder; ``STORED`` has what is read from it."""
    schema, parts = STORED[table]
    if table in BUCKETED:
        return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType(), True)]), (BUCKET,)
    return schema, parts


def order_within(parts: tuple[str, ...]) -> tuple[str, ...]:
    """The columns that order rows within the folders of a table partitioned by ``parts``."""
    return DAY_IN_MONTH if parts == DAY_MONTHS else ()
