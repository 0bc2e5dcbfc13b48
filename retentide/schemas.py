"""Table contracts. Every schema is declared here and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The contract of the raw event log.
GENDERS = ("Male", "Female", "Non-binary", "Prefer not to say")
EVENT_TYPES = ("miles_earned", "miles_redeemed", "reward_search", "like", "share")
MILES_EVENT_TYPES = ("miles_earned", "miles_redeemed")
PLATFORMS = ("android", "ios", "web")
UTM_SOURCES = ("organic", "facebook", "tiktok", "google", "referral")
COUNTRIES = ("MY", "PH", "TH", "ID", "SG")
USER_ID_PATTERN = r"^u_\d{4}$"
DEVICE_PATTERN = r"^.+_.+$"

# User states and the default length of one activity window, in days.
USER_STATES = ("new", "retained", "resurrected", "churned")
DEFAULT_WINDOW = 14

EVENTS = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("transaction_category", T.StringType()),
        T.StructField("miles_amount", T.DoubleType()),
        T.StructField("platform", T.StringType()),
        T.StructField("utm_source", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

# The stored form carries the UTC day, so that a day filter prunes partitions.
BRONZE_EVENTS = T.StructType(EVENTS.fields + [T.StructField("event_date", T.DateType())])

# Events after cleaning: see operators.cleaning.
CLEAN_EVENTS = T.StructType(
    [f for f in EVENTS.fields if f.name != "transaction_category"]
    + [
        T.StructField("miles_category", T.StringType()),
        T.StructField("search_brand", T.StringType()),
        T.StructField("is_transactional", T.BooleanType()),
        T.StructField("event_date", T.DateType()),
    ]
)

# Sums of miles are exact: amounts have two decimals.
MILES = T.DecimalType(28, 2)

LOGIN_BITMAPS = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("country", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("utm_source", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("login_bitmap", T.StringType()),
        T.StructField("isNew", T.StringType()),
        T.StructField("reg_date", T.DateType()),
        T.StructField("device", T.StringType()),
    ]
)

# The login days of a device in a block of days, as the bits of a word, with its first event in the block.
LOGIN_BLOCKS = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("days", T.LongType()),
        T.StructField("first_time", T.TimestampType()),
        T.StructField("country", T.StringType()),
        T.StructField("utm_source", T.StringType()),
        T.StructField("block", T.DateType()),
    ]
)

USER_DAILY_ACTIVITY = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("miles_earned_sum", MILES),
        T.StructField("miles_redeemed_sum", MILES),
        T.StructField("cnt_miles_earned", T.LongType()),
        T.StructField("cnt_miles_redeemed", T.LongType()),
        T.StructField("cnt_like", T.LongType()),
        T.StructField("cnt_share", T.LongType()),
        T.StructField("cnt_reward_search", T.LongType()),
    ]
)

USER_STATE_RANGES = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("user_state", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
    ]
)

USER_MILES_BALANCE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("miles_earned_sum", MILES),
        T.StructField("miles_redeemed_sum", MILES),
        T.StructField("net_miles", MILES),
        T.StructField("miles_balance", MILES),
    ]
)

GROWTH_ACCOUNTING = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("period_start", T.DateType()),
        T.StructField("active_users", T.LongType()),
        T.StructField("new_users", T.LongType()),
        T.StructField("retained_users", T.LongType()),
        T.StructField("resurrected_users", T.LongType()),
        T.StructField("churned_users", T.LongType()),
    ]
)

COHORT_RETENTION = T.StructType(
    [
        T.StructField("cohort_date", T.DateType()),
        T.StructField("cohort_size", T.LongType()),
        T.StructField("day_offset", T.LongType()),
        T.StructField("retained_users", T.LongType()),
        T.StructField("retention_pct", T.DoubleType()),
    ]
)

ENGAGEMENT_DEPTH = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("period_start", T.DateType()),
        T.StructField("active_users", T.LongType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("miles_earned", MILES),
        T.StructField("earners", T.LongType()),
        T.StructField("redeemers", T.LongType()),
        T.StructField("events_per_user", T.DoubleType()),
        T.StructField("miles_per_user", T.DoubleType()),
        T.StructField("redemption_rate", T.DoubleType()),
    ]
)

ACTIVE_USERS = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("period_start", T.DateType()),
        T.StructField("active_users", T.LongType()),
        T.StructField("new_users", T.LongType()),
    ]
)

ACTIVE_BY_SOURCE = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("utm_source", T.StringType()),
        T.StructField("active_users", T.LongType()),
    ]
)

SESSION_FREQUENCY = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("period_start", T.DateType()),
        T.StructField("active_days", T.LongType()),
        T.StructField("sessions", T.LongType()),
        T.StructField("sessions_per_active_day", T.DoubleType()),
    ]
)

# Days are numbers since 1970-01-01; see operators.snapshot.
USER_SNAPSHOT = T.StructType(
    [T.StructField("user_id", T.StringType())]
    + [
        T.StructField(name, T.IntegerType())
        for name in (
            "epoch", "first", "last", "prev_last", "before", "earn_day", "earn_before", "redeem_day",
            "redeem_before", "since", "closed_since",
        )
    ]
    + [
        T.StructField("user_state", T.StringType()),
        T.StructField("balance", MILES),
        T.StructField("window", T.IntegerType()),
        T.StructField("metrics", T.BooleanType()),
        T.StructField("event_date", T.DateType()),
    ]
)

# A row for each loaded day, also for one without events.
LOAD_LEDGER = T.StructType(
    [
        T.StructField("n_events", T.LongType()),
        T.StructField("n_clean", T.LongType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)

# Dense numbers of users, by the day on which they were given, and the users of a day as bitmaps of them.
USER_NUMBERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("user_no", T.LongType()),
        T.StructField("event_date", T.DateType()),
    ]
)

ACTIVE_BITMAPS = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("users", T.BinaryType()),
        T.StructField("event_date", T.DateType()),
    ]
)

ROLLING_USERS = T.StructType(
    [
        T.StructField("event_date", T.DateType()),
        T.StructField("window_days", T.LongType()),
        T.StructField("active_users", T.LongType()),
    ]
)

# The last events of users whose sessions may go on after midnight.
OPEN_SESSIONS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("last_time", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
    ]
)

# The files of a raw log that has no folders of days, with the times of their events.
RAW_FILES = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("first_time", T.TimestampType()),
        T.StructField("last_time", T.TimestampType()),
        T.StructField("n_without_time", T.LongType()),
        T.StructField("log_id", T.StringType()),
    ]
)
