"""The registered queries as plain SQL for DuckDB, written from the definitions.

States come from counting active days by a range join on a dense calendar, runs from the difference of
two row numbers, range ends from the least later start; bitmaps from concatenating one character per
day, a day's step from who was there yesterday and who is there today.
"""

from __future__ import annotations

from collections.abc import Callable

EVENTS = """
ev AS (
  SELECT event_id, ts AS event_time,
    'u_' || CASE WHEN length(CAST(user_id AS VARCHAR)) >= 4 THEN CAST(user_id AS VARCHAR)
                 ELSE lpad(CAST(user_id AS VARCHAR), 4, '0') END AS user_id,
    CASE user_id % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Non-binary'
         ELSE 'Prefer not to say' END AS gender,
    CASE event_type WHEN 'purchase' THEN 'miles_earned' WHEN 'signup' THEN 'miles_redeemed'
         WHEN 'view' THEN 'reward_search' WHEN 'click' THEN 'like' ELSE 'share' END AS event_type,
    CASE WHEN event_type IN ('purchase', 'signup', 'view')
         THEN json_extract_string(props, '$.k') END AS transaction_category,
    CASE WHEN event_type IN ('purchase', 'signup') THEN value END AS miles_amount,
    CASE WHEN event_id % 10 = 0 THEN 'web'
         ELSE CASE user_id % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE 'web' END
         END AS platform,
    CASE user_id % 5 WHEN 0 THEN 'organic' WHEN 1 THEN 'facebook' WHEN 2 THEN 'tiktok'
         WHEN 3 THEN 'google' ELSE 'referral' END AS utm_source,
    CASE (user_id // 5) % 5 WHEN 0 THEN 'MY' WHEN 1 THEN 'PH' WHEN 2 THEN 'TH' WHEN 3 THEN 'ID'
         ELSE 'SG' END AS country,
    CAST(ts AS DATE) AS event_date
  FROM events
)"""

ORDERS = """
ord AS (
  SELECT 'c_' || CASE WHEN length(CAST(o_custkey AS VARCHAR)) >= 8 THEN CAST(o_custkey AS VARCHAR)
                      ELSE lpad(CAST(o_custkey AS VARCHAR), 8, '0') END AS user_id,
    CAST(o_orderdate AS DATE) AS event_date
  FROM orders
)"""

CONTRACT = (
    "event_time, user_id, gender, event_type, transaction_category, miles_amount, platform, "
    "utm_source, country"
)
ALL = "SELECT * FROM ev"
BEFORE_LAST = "SELECT * FROM ev WHERE event_date < (SELECT max(event_date) FROM ev)"
W = 2  # the window of the queries on the sample events

# The raw log of the batch: the events with categories that CSV has to quote.
ODD = (
    EVENTS.replace("ev AS (", "plain_ev AS (", 1)
    + r""",
ev AS (
  SELECT * REPLACE (CASE event_id % 6
    WHEN 0 THEN 'Joe "X" ' || coalesce(transaction_category, '')
    WHEN 1 THEN 'C:\dir' || coalesce(transaction_category, '') || '"'
    WHEN 2 THEN 'Bob "Y", ' || coalesce(transaction_category, '')
    WHEN 3 THEN '  ' || coalesce(transaction_category, '') || ' x '
    WHEN 4 THEN '"' || coalesce(transaction_category, '') || '\"'
    ELSE transaction_category END AS transaction_category)
  FROM plain_ev
)""".replace("\\\\", "\\")
)

# The raw log with line breaks inside quotes.
QUOTED_BREAKS = EVENTS.replace("ev AS (", "plain_ev AS (", 1) + """,
ev AS (
  SELECT * REPLACE (CASE event_id % 5
    WHEN 0 THEN coalesce(transaction_category, 'none') || chr(10)
    WHEN 1 THEN chr(10) || chr(10) || '"' || coalesce(transaction_category, 'none')
    WHEN 2 THEN coalesce(transaction_category, 'none') || ',' || chr(10) || '"x"' || chr(10) || ',,,'
    ELSE transaction_category END AS transaction_category)
  FROM plain_ev
)"""

FIRST_ROW = (
    "row_number() OVER (PARTITION BY event_time, user_id, event_type ORDER BY "
    "gender NULLS FIRST, transaction_category NULLS FIRST, miles_amount NULLS FIRST, "
    "platform NULLS FIRST, utm_source NULLS FIRST, country NULLS FIRST, event_date NULLS FIRST)"
)
# What the batch builds silver from: one row per event key.
CLEAN = ODD.replace("\nev AS (", "\nodd_ev AS (", 1) + f""",
ev AS (SELECT * EXCLUDE rn FROM (SELECT *, {FIRST_ROW} AS rn FROM odd_ev) WHERE rn = 1)"""
CLEANED = (
    "SELECT event_time, user_id, gender, event_type, "
    "CASE WHEN event_type IN ('miles_earned', 'miles_redeemed') THEN miles_amount "
    "ELSE coalesce(miles_amount, 0.0) END AS miles_amount, platform, utm_source, country, "
    "event_date, CASE WHEN event_type IN ('miles_earned', 'miles_redeemed') "
    "THEN transaction_category END AS miles_category, "
    "CASE WHEN event_type = 'reward_search' THEN transaction_category END AS search_brand, "
    "event_type IN ('miles_earned', 'miles_redeemed') AS is_transactional FROM {rows}"
)
# The block of 32 days that a day is in, and its days as bits.
BLOCK = "CAST(DATE '1970-01-01' + CAST((event_date - DATE '1970-01-01') // 32 * 32 AS INT) AS DATE)"
BLOCK_BITS = "CAST(bit_or(CAST(1 AS BIGINT) << CAST((event_date - DATE '1970-01-01') % 32 AS INT)) AS BIGINT)"
BOUNDS = "bounds AS (SELECT min(event_date) AS low, max(event_date) AS high, " \
    "min(event_date) + CAST((max(event_date) - min(event_date)) // 2 AS INT) AS middle FROM ev)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _silver(feed: str, as_of: str = "(SELECT max(event_date) FROM ev)", name: str = "silver") -> str:
    """Bitmaps of the events in ``feed`` on every day up to ``as_of``."""
    return f"""
{name}_feed AS ({feed}),
{name}_end AS (SELECT CAST({as_of} AS DATE) AS last_day),
{name}_device AS (
  SELECT platform || '_' || user_id AS device, platform, user_id, min(event_date) AS reg_date,
    first(country ORDER BY event_time, country, utm_source) AS country,
    first(utm_source ORDER BY event_time, country, utm_source) AS utm_source
  FROM {name}_feed, {name}_end WHERE event_date <= last_day GROUP BY platform, user_id
),
{name}_day AS (SELECT DISTINCT platform || '_' || user_id AS device, event_date FROM {name}_feed),
{name}_cal AS (
  SELECT d.*, CAST(unnest(generate_series(reg_date, last_day, INTERVAL 1 DAY)) AS DATE) AS event_date
  FROM {name}_device d, {name}_end WHERE reg_date <= last_day
),
{name} AS (
  SELECT c.event_date, c.country, c.platform, c.utm_source, c.user_id,
    string_agg(CASE WHEN a.device IS NULL THEN '0' ELSE '1' END, '')
      OVER (PARTITION BY c.device ORDER BY c.event_date) AS login_bitmap,
    CASE WHEN c.event_date = c.reg_date THEN '1' ELSE '0' END AS "isNew",
    c.reg_date, c.device
  FROM {name}_cal c LEFT JOIN {name}_day a ON a.device = c.device AND a.event_date = c.event_date
)"""


SILVER_COLUMNS = (
    'event_date, country, platform, utm_source, user_id, login_bitmap, "isNew", reg_date, device'
)


def _dense(activity: str, window: int) -> str:
    """Window counts of every user on every day of the calendar."""
    return f"""
act AS (SELECT DISTINCT user_id, event_date FROM ({activity})),
bounds AS (SELECT max(event_date) AS last_day FROM act),
cal AS (
  SELECT user_id, reg_date,
    CAST(unnest(generate_series(reg_date, last_day, INTERVAL 1 DAY)) AS DATE) AS event_date
  FROM (SELECT user_id, min(event_date) AS reg_date FROM act GROUP BY user_id), bounds
),
counts AS (
  SELECT c.user_id, c.event_date,
    count(a.event_date) FILTER (WHERE a.event_date > c.event_date - {window}) AS active_now,
    count(a.event_date) FILTER (WHERE a.event_date <= c.event_date - {window}) AS active_prior,
    CAST(c.event_date - c.reg_date AS BIGINT) AS days_since_reg
  FROM cal c LEFT JOIN act a ON a.user_id = c.user_id
    AND a.event_date <= c.event_date AND a.event_date > c.event_date - {2 * window}
  GROUP BY c.user_id, c.event_date, c.reg_date
)"""


def _states(activity: str, window: int) -> str:
    return (
        _dense(activity, window)
        + f""",
states AS (
  SELECT user_id, event_date,
    CASE WHEN active_now = 0 THEN 'churned' WHEN days_since_reg < {window} THEN 'new'
         WHEN active_prior = 0 THEN 'resurrected' ELSE 'retained' END AS user_state
  FROM counts WHERE active_now + active_prior > 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_date)
    - row_number() OVER (PARTITION BY user_id, user_state ORDER BY event_date) AS shift
  FROM states
),
runs AS (
  SELECT user_id, user_state, shift, min(event_date) AS opened, max(event_date) AS closed
  FROM placed GROUP BY user_id, user_state, shift
),
ranges AS (
  SELECT r.user_id, r.user_state, r.opened AS start_date, CAST(min(l.opened) - 1 AS DATE) AS end_date
  FROM runs r LEFT JOIN runs l ON l.user_id = r.user_id AND l.opened > r.opened
  GROUP BY r.user_id, r.user_state, r.opened
)"""
    )


def _ranges(source: str, activity: str, window: int) -> str:
    return _with(source, _states(activity, window)) + "SELECT * FROM ranges"


def _growth(source: str, activity: str, period: str) -> str:
    step = {"day": "1 DAY", "week": "7 DAY", "month": "1 MONTH"}[period]
    return (
        _with(
            source,
            f"""
act AS (SELECT DISTINCT user_id, CAST(date_trunc('{period}', event_date) AS DATE) AS p
        FROM ({activity})),
last_p AS (SELECT max(p) AS last_p FROM act),
around AS (
  SELECT user_id, p, CAST(p + INTERVAL {step} AS DATE) AS after,
    lag(p) OVER (PARTITION BY user_id ORDER BY p) AS prev,
    lead(p) OVER (PARTITION BY user_id ORDER BY p) AS nxt
  FROM act
),
st AS (
  SELECT p, CASE WHEN prev IS NULL THEN 'new'
                 WHEN CAST(prev + INTERVAL {step} AS DATE) = p THEN 'retained'
                 ELSE 'resurrected' END AS s FROM around
  UNION ALL
  SELECT after, 'churned' FROM around, last_p
  WHERE (nxt IS NULL OR nxt > after) AND after <= last_p
)""",
        )
        + """SELECT p AS period_start, count(*) FILTER (WHERE s <> 'churned') AS active_users,
  count(*) FILTER (WHERE s = 'new') AS new_users,
  count(*) FILTER (WHERE s = 'retained') AS retained_users,
  count(*) FILTER (WHERE s = 'resurrected') AS resurrected_users,
  count(*) FILTER (WHERE s = 'churned') AS churned_users
FROM st GROUP BY p"""
    )


def _retention(source: str, activity: str) -> str:
    return (
        _with(
            source,
            f"""
act AS (SELECT DISTINCT user_id, event_date FROM ({activity})),
bounds AS (SELECT max(event_date) AS last_day FROM act),
cohort AS (SELECT user_id, min(event_date) AS cohort_date FROM act GROUP BY user_id),
sizes AS (SELECT cohort_date, count(*) AS cohort_size FROM cohort GROUP BY cohort_date),
offs AS (SELECT CAST(unnest([1, 7, 14, 30]) AS BIGINT) AS day_offset),
back AS (
  SELECT c.cohort_date, date_diff('day', c.cohort_date, a.event_date) AS day_offset, count(*) AS n
  FROM cohort c JOIN act a USING (user_id) GROUP BY 1, 2
)""",
        )
        + """SELECT s.cohort_date, s.cohort_size, o.day_offset,
  CASE WHEN s.cohort_date + CAST(o.day_offset AS INT) <= last_day THEN coalesce(b.n, 0) END
    AS retained_users,
  CASE WHEN s.cohort_date + CAST(o.day_offset AS INT) <= last_day
       THEN round(100.0 * CAST(coalesce(b.n, 0) AS DOUBLE) / s.cohort_size, 4) END AS retention_pct
FROM sizes s CROSS JOIN offs o CROSS JOIN bounds
LEFT JOIN back b ON b.cohort_date = s.cohort_date AND b.day_offset = o.day_offset"""
    )


DAILY = """
daily AS (
  SELECT event_date, user_id, true AS is_active, count(*) AS total_events,
    coalesce(CAST(sum(CAST(miles_amount AS DECIMAL(18, 2))) FILTER (WHERE event_type = 'miles_earned')
      AS DOUBLE), 0.0) AS miles_earned_sum,
    coalesce(CAST(sum(CAST(miles_amount AS DECIMAL(18, 2))) FILTER (WHERE event_type = 'miles_redeemed')
      AS DOUBLE), 0.0) AS miles_redeemed_sum,
    count(*) FILTER (WHERE event_type = 'miles_earned') AS cnt_miles_earned,
    count(*) FILTER (WHERE event_type = 'miles_redeemed') AS cnt_miles_redeemed,
    count(*) FILTER (WHERE event_type = 'like') AS cnt_like,
    count(*) FILTER (WHERE event_type = 'share') AS cnt_share,
    count(*) FILTER (WHERE event_type = 'reward_search') AS cnt_reward_search
  FROM ev GROUP BY event_date, user_id
)"""


BALANCE = """SELECT user_id, event_date, miles_earned_sum, miles_redeemed_sum,
  round(miles_earned_sum - miles_redeemed_sum, 2) AS net_miles,
  CAST(sum(CAST(miles_earned_sum AS DECIMAL(18, 2)) - CAST(miles_redeemed_sum AS DECIMAL(18, 2)))
    OVER (PARTITION BY user_id ORDER BY event_date) AS DOUBLE) AS miles_balance
FROM daily"""

SESSIONS = """, g AS (
  SELECT user_id, event_date, event_time,
    lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time) AS prev FROM ev
)
SELECT user_id, CAST(date_trunc('week', event_date) AS DATE) AS period_start,
  count(DISTINCT event_date) AS active_days,
  count(*) FILTER (WHERE prev IS NULL OR event_time - prev > INTERVAL 30 MINUTE) AS sessions,
  round(CAST(count(*) FILTER (WHERE prev IS NULL OR event_time - prev > INTERVAL 30 MINUTE) AS DOUBLE)
    / count(DISTINCT event_date), 4) AS sessions_per_active_day
FROM g GROUP BY 1, 2"""

BY_SOURCE = (
    "SELECT event_date, utm_source, count(DISTINCT user_id) AS active_users FROM ev "
    "GROUP BY event_date, utm_source"
)


def _depth(period: str, source: str = EVENTS) -> str:
    return (
        _with(
            source,
            f"""
per AS (SELECT *, CAST(date_trunc('{period}', event_date) AS DATE) AS p FROM ev),
tot AS (
  SELECT p AS period_start, count(DISTINCT user_id) AS active_users, count(*) AS total_events,
    coalesce(CAST(sum(CAST(miles_amount AS DECIMAL(18, 2))) FILTER (WHERE event_type = 'miles_earned')
      AS DOUBLE), 0.0) AS miles_earned,
    count(DISTINCT user_id) FILTER (WHERE event_type = 'miles_earned') AS earners,
    count(DISTINCT user_id) FILTER (WHERE event_type = 'miles_redeemed') AS redeemers
  FROM per GROUP BY p
)""",
        )
        + """SELECT *, round(CAST(total_events AS DOUBLE) / active_users, 4) AS events_per_user,
  round(miles_earned / active_users, 4) AS miles_per_user,
  CASE WHEN earners > 0 THEN round(CAST(redeemers AS DOUBLE) / earners, 4) END AS redemption_rate
FROM tot"""
    )


def _active(source: str, activity: str, period: str) -> str:
    return _with(source) + (
        f"SELECT CAST(date_trunc('{period}', event_date) AS DATE) AS period_start, "
        f"count(DISTINCT user_id) AS active_users FROM ({activity}) GROUP BY 1"
    )


def _periods(sql: Callable[[str], str], columns: str = "*", rows: str = "true") -> str:
    """The same for days, weeks and months, one below the other."""
    parts = (f"SELECT '{p}' AS period, {columns} FROM ({sql(p)}) WHERE {rows}" for p in ("day", "week", "month"))
    return "\nUNION ALL\n".join(parts)


def _rolling(source: str, activity: str) -> str:
    """Distinct users of the 7 and 28 days up to each day."""
    return _with(
        source,
        f"""act AS (SELECT DISTINCT user_id, event_date FROM ({activity}) WHERE user_id IS NOT NULL),
cal AS (SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS day FROM act),
spans AS (SELECT day, w FROM cal, (SELECT CAST(unnest([7, 28]) AS BIGINT) AS w))""",
    ) + """SELECT s.day AS event_date, s.w AS window_days, count(DISTINCT a.user_id) AS active_users
FROM spans s LEFT JOIN act a ON a.event_date <= s.day AND a.event_date > s.day - CAST(s.w AS INT) GROUP BY s.day, s.w"""


def _step(key: str) -> str:
    """Who was there yesterday gets a digit by whether the key is among today's; the others start."""
    prev = _silver(ALL, "(SELECT max(event_date) - 1 FROM ev)", "prev")
    of_key = "device" if key == "device" else "user_id"
    grain = "" if key == "device" else ", country, utm_source"
    pick = (
        "first(country ORDER BY event_time, country, utm_source) AS country, "
        "first(utm_source ORDER BY event_time, country, utm_source) AS utm_source"
        if key == "device"
        else "country, utm_source"
    )
    copies = "1" if key == "device" else "greatest(1, (SELECT count(*) FROM today t WHERE t.user_id = y.user_id))"
    return (
        _with(
            EVENTS,
            prev,
            f"""
now_day AS (SELECT max(event_date) AS d FROM ev),
yesterday AS (SELECT * FROM prev WHERE event_date = (SELECT d - 1 FROM now_day)),
today AS (
  SELECT platform, user_id, platform || '_' || user_id AS device, {pick}
  FROM ev, now_day WHERE event_date = d GROUP BY platform, user_id{grain}
),
kept AS (
  SELECT country, platform, utm_source, user_id, device, reg_date, '0' AS fresh,
    login_bitmap || CASE WHEN {of_key} IN (SELECT {of_key} FROM today) THEN '1' ELSE '0' END AS bits,
    unnest(generate_series(1, {copies})) AS copy
  FROM yesterday y
),
started AS (
  SELECT country, platform, utm_source, user_id, device, d AS reg_date, '1' AS fresh, '1' AS bits, 1 AS copy
  FROM today, now_day WHERE {of_key} NOT IN (SELECT {of_key} FROM yesterday)
)""",
        )
        + """SELECT (SELECT d FROM now_day) AS event_date, country, platform, utm_source, user_id,
  bits AS login_bitmap, fresh AS "isNew", reg_date, device
FROM (SELECT * FROM kept UNION ALL SELECT * FROM started)"""
    )


def _words(source: str, keys: str) -> str:
    """The characters of bitmaps as bits of words of 63, the newest in the lowest bit of the first."""
    return f"""SELECT {keys}, CAST(age // 63 AS INT) AS place,
  CAST(sum(CAST(substr(login_bitmap, CAST(length(login_bitmap) - age AS INT), 1) AS BIGINT) << CAST(age % 63 AS INT))
    AS BIGINT) AS bits
FROM (SELECT *, unnest(generate_series(0, length(login_bitmap) - 1)) AS age FROM {source}) GROUP BY {keys}, age // 63"""


def _uid_words(days: str, activity: str) -> str:
    """A word for each 63 days since a user's first, counted back from the days in ``days``."""
    return f"""act AS (SELECT DISTINCT user_id, event_date AS d FROM ({activity})),
reg AS (SELECT user_id, min(d) AS uid_reg_date FROM act GROUP BY user_id),
grid AS (
  SELECT c.user_id, c.event_date, r.uid_reg_date,
    unnest(generate_series(0, (c.event_date - r.uid_reg_date) // 63)) AS place
  FROM ({days}) c JOIN reg r USING (user_id)
)
SELECT g.user_id, g.event_date, g.uid_reg_date, CAST(g.place AS INT) AS place,
  CAST(coalesce(sum(CAST(1 AS BIGINT) << CAST((g.event_date - a.d) % 63 AS INT)), 0) AS BIGINT) AS bits
FROM grid g LEFT JOIN act a ON a.user_id = g.user_id AND a.d <= g.event_date AND (g.event_date - a.d) // 63 = g.place
GROUP BY ALL"""


def _feeds() -> str:
    """Bitmaps with damaged columns, and the devices that were active."""
    return _with(
        EVENTS,
        _silver(ALL, name="whole"),
        """silver AS (
  SELECT event_date,
    CASE WHEN user_id LIKE '%3' THEN left(login_bitmap, length(login_bitmap) - 1)
      || CASE WHEN login_bitmap LIKE '%1' THEN '0' ELSE '1' END ELSE login_bitmap END AS login_bitmap,
    CASE WHEN user_id LIKE '%5' AND login_bitmap LIKE '%0' THEN '1' ELSE "isNew" END AS "isNew",
    CASE WHEN user_id LIKE '%7' THEN device || 'x' ELSE device END AS device
  FROM whole
)""",
        """src AS (SELECT DISTINCT event_date, platform || '_' || user_id AS device FROM ev)""",
    )


def _rules(checks: dict[str, str], relation: str) -> str:
    """(check, n_bad), a check being bad where its condition is not true."""
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE ({holds}) IS NOT TRUE) AS n_bad "
        f"FROM {relation}"
        for name, holds in checks.items()
    )


EVENT_RULES = {
    "event_time_not_null": "event_time IS NOT NULL",
    "user_id_format": r"regexp_matches(user_id, '^u_\d{4}$')",
    "event_type_known": "event_type IN ('miles_earned', 'miles_redeemed', 'reward_search', 'like', 'share')",
    "miles_amount_positive": "CASE WHEN event_type IN ('miles_earned', 'miles_redeemed') "
    "THEN miles_amount > 0 ELSE true END",
    "miles_amount_absent": "CASE WHEN event_type IN ('reward_search', 'like', 'share') "
    "THEN miles_amount IS NULL ELSE true END",
    "country_known": "country IN ('MY', 'PH', 'TH', 'ID', 'SG')",
    "gender_known": "gender IN ('Male', 'Female', 'Non-binary', 'Prefer not to say')",
    "platform_known": "platform IN ('android', 'ios', 'web')",
    "utm_source_known": "utm_source IN ('organic', 'facebook', 'tiktok', 'google', 'referral')",
}

DAMAGED = """
dmg AS (
  SELECT CASE WHEN event_id % 11 <> 0 THEN event_time END AS event_time,
    CASE WHEN event_id % 13 = 0 THEN replace(user_id, 'u_', 'user-')
         WHEN event_id % 17 <> 0 THEN user_id END AS user_id,
    CASE WHEN event_id % 19 = 0 THEN 'login' ELSE event_type END AS event_type,
    CASE WHEN event_id % 23 = 0 THEN 0.0 WHEN event_id % 29 = 0 THEN 1.0
         WHEN event_id % 31 <> 0 THEN miles_amount END AS miles_amount,
    CASE WHEN event_id % 37 = 0 THEN 'US' ELSE country END AS country,
    CASE WHEN event_id % 41 <> 0 THEN gender END AS gender,
    CASE WHEN event_id % 43 = 0 THEN 'tv' ELSE platform END AS platform,
    CASE WHEN event_id % 47 = 0 THEN '' ELSE utm_source END AS utm_source
  FROM ev
)"""

# Rows of the events and of a damaged copy, each row once.
COMPARED = f"""
copied AS (
  SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN 'SG' ELSE country END AS country,
    CASE WHEN event_id % 61 <> 0 THEN miles_amount END AS miles_amount,
    event_date + CASE WHEN event_id % 131 = 0 THEN 1 ELSE 0 END AS event_date),
    unnest(range(CASE WHEN event_id % 211 = 0 THEN 0 WHEN event_id % 89 = 0 THEN 2 ELSE 1 END)) AS copy
  FROM ev
),
compared AS (
  SELECT {CONTRACT}, event_date, CAST(sum(s) AS BIGINT) AS source_rows, CAST(sum(t) AS BIGINT) AS table_rows
  FROM (SELECT {CONTRACT}, event_date, 1 AS s, 0 AS t FROM ev UNION ALL SELECT {CONTRACT}, event_date, 0, 1 FROM copied)
  GROUP BY {CONTRACT}, event_date
)"""

ORDER_CALENDAR = """
days AS (
  SELECT CAST(unnest(generate_series((SELECT min(event_date) FROM ord),
    (SELECT max(event_date) FROM ord), INTERVAL 1 DAY)) AS DATE) AS event_date
),
cov AS (
  SELECT d.event_date, count(o.user_id) > 0 AS has_rows
  FROM days d LEFT JOIN ord o ON o.event_date = d.event_date GROUP BY d.event_date
)"""


def build() -> dict[str, str]:
    events = _with(EVENTS)
    all_silver = _with(EVENTS, _silver(ALL))
    clean_silver = _with(CLEAN, _silver(ALL))
    all_states = _with(EVENTS, _states(ALL, W))
    feeds = _feeds()
    hourly = (
        "SELECT date_trunc('hour', event_time) AS event_time, user_id, gender, event_type, "
        "transaction_category, miles_amount, platform, utm_source, country, event_date FROM ev"
    )
    first_row = FIRST_ROW
    order_words = (
        _with(ORDERS)
        + """, d AS (SELECT DISTINCT user_id, event_date FROM ord),
u AS (SELECT user_id, min(event_date) AS reg, (SELECT max(event_date) FROM ord) AS last_day FROM d GROUP BY user_id),
cal AS (SELECT user_id, CAST(unnest(generate_series(reg, last_day, INTERVAL 1 DAY)) AS DATE) AS day FROM u),
maps AS (
  SELECT c.user_id, string_agg(CASE WHEN d.user_id IS NULL THEN '0' ELSE '1' END, '' ORDER BY c.day) AS login_bitmap
  FROM cal c LEFT JOIN d ON d.user_id = c.user_id AND d.event_date = c.day GROUP BY c.user_id
)
"""
        + _words("maps", "user_id")
    )
    return {
        # Bronze
        "bronze_events": events + f"SELECT {CONTRACT}, event_date FROM ev",
        "bronze_csv_roundtrip": _with(ODD) + f"SELECT {CONTRACT}, event_date FROM ev",
        "bronze_quoted_line_breaks": _with(QUOTED_BREAKS) + f"SELECT {CONTRACT}, event_date FROM ev",
        "bronze_csv_two_columns": _with(ODD) + "SELECT platform, country, count(*) AS n FROM ev GROUP BY platform, country",
        "bronze_day_slice": events
        + f"SELECT {CONTRACT} FROM ev WHERE event_date = (SELECT max(event_date) FROM ev)",
        "calendar_has_rows": _with(ORDERS, ORDER_CALENDAR) + "SELECT * FROM cov",
        "calendar_day_counts": events
        + "SELECT event_date, count(*) AS row_count FROM ev GROUP BY event_date",
        "bronze_dedup": events
        + f"SELECT {CONTRACT}, event_date FROM (SELECT *, {first_row} AS rn FROM ({hourly})) "
        "WHERE rn = 1",
        "bronze_clean": events + CLEANED.format(rows=f"(SELECT *, {first_row} AS rn FROM ev) WHERE rn = 1"),
        # Silver
        "silver_active_today": events
        + "SELECT DISTINCT event_date, country, platform, utm_source, user_id FROM ev",
        "silver_login_bitmap": all_silver + f"SELECT {SILVER_COLUMNS} FROM silver",
        "silver_step_device_key": _step("device"),
        "silver_step_user_key": _step("user_id"),
        "bitmap_to_words": all_silver + _words("silver", "event_date, device"),
        "bitmap_to_words_orders": order_words,
        "silver_bitmaps_of_blocks": order_words,
        "silver_login_blocks": _with(ORDERS) + f"SELECT user_id, {BLOCK} AS block, {BLOCK_BITS} AS days FROM ord GROUP BY 1, 2",
        "silver_block_windows": _with(ORDERS)
        + """, d AS (SELECT DISTINCT user_id, event_date, (SELECT max(event_date) FROM ord) - event_date AS age FROM ord)
SELECT user_id, count(*) FILTER (age < 90) AS current_days, count(*) FILTER (age >= 90) AS prior_days FROM d WHERE age < 180 GROUP BY user_id""",
        "user_daily_activity": _with(EVENTS, DAILY) + "SELECT * FROM daily",
        "user_miles_balance": _with(EVENTS, DAILY) + BALANCE,
        # State ranges
        "gold_scd2_user_state": _ranges(EVENTS, ALL, W),
        "gold_scd2_short_window": _ranges(EVENTS, ALL, 1),
        "gold_scd2_all_events": _ranges(EVENTS, ALL, 3),
        "gold_scd2_orders": _ranges(ORDERS, "SELECT * FROM ord", 14),
        "gold_scd2_orders_quarter": _ranges(ORDERS, "SELECT * FROM ord", 90),
        "gold_scd2_from_bitmaps": _ranges(EVENTS, ALL, W),
        "gold_scd2_from_counts": _ranges(ORDERS, "SELECT * FROM ord", 14),
        "gold_activity_streaks": _with(
            ORDERS,
            """
act AS (SELECT DISTINCT user_id, event_date FROM ord),
gaps AS (
  SELECT *, lag(event_date) OVER w AS prev, lead(event_date) OVER w AS nxt FROM act
  WINDOW w AS (PARTITION BY user_id ORDER BY event_date)
),
runs AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR event_date - prev > 90 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY event_date) AS run FROM gaps
)""",
        )
        + 'SELECT user_id, min(event_date) AS "first", max(event_date) AS "last", '
        "first(prev ORDER BY event_date) AS prev_last, last(nxt ORDER BY event_date) AS next_first "
        "FROM runs GROUP BY user_id, run",
        "gold_uid_epoch": events
        + "SELECT user_id, min(event_date) AS uid_reg_date FROM ev GROUP BY user_id",
        "gold_uid_epoch_join": all_silver
        + """SELECT s.user_id, s.device, s.event_date, s.reg_date, e.uid_reg_date, s.login_bitmap
FROM silver s JOIN (SELECT user_id, min(reg_date) AS uid_reg_date FROM silver GROUP BY user_id) e
USING (user_id)""",
        "gold_uid_daily_bits": all_silver.rstrip()
        + ",\n"
        + _uid_words("SELECT DISTINCT user_id, event_date FROM silver", ALL),
        "gold_uid_daily_bits_orders": _with(ORDERS).rstrip()
        + ",\n"
        + _uid_words("SELECT DISTINCT user_id, (SELECT max(event_date) FROM ord) AS event_date FROM ord", "SELECT * FROM ord"),
        "gold_window_counts": _with(EVENTS, _dense(ALL, W)) + "SELECT * FROM counts",
        "gold_window_counts_orders": _with(ORDERS, _dense("SELECT * FROM ord", 90))
        + """SELECT c.* FROM counts c JOIN (
  SELECT DISTINCT user_id, CAST(event_date + CAST(k AS INT) AS DATE) AS event_date
  FROM act, (SELECT unnest([0, 90, 180]) AS k)) p
ON p.user_id = c.user_id AND p.event_date = c.event_date""",
        "gold_user_state_daily": all_states + "SELECT * FROM states",
        "gold_state_change": all_states
        + "SELECT p.user_id, p.event_date, p.user_state, CAST(p.event_date = r.opened AS INT) AS is_new_segment "
        "FROM placed p JOIN runs r USING (user_id, user_state, shift)",
        "gold_islands": all_states
        + "SELECT p.user_id, p.event_date, p.user_state, (SELECT count(*) FROM runs e WHERE e.user_id = p.user_id "
        "AND e.opened <= p.event_date) AS segment_id FROM placed p",
        "gold_segments": all_states
        + "SELECT r.user_id, r.user_state, (SELECT count(*) FROM runs e WHERE e.user_id = r.user_id "
        "AND e.opened <= r.opened) AS segment_id, r.opened AS start_date, r.closed AS last_date FROM runs r",
        # Serving metrics
        "growth_daily": _growth(EVENTS, ALL, "day"),
        "growth_weekly": _growth(ORDERS, "SELECT * FROM ord", "week"),
        "growth_monthly": _growth(ORDERS, "SELECT * FROM ord", "month"),
        "cohort_retention": _retention(ORDERS, "SELECT * FROM ord"),
        "cohort_retention_events": _retention(EVENTS, ALL),
        "engagement_depth": _depth("day"),
        "engagement_depth_weekly": _depth("week"),
        "engagement_depth_monthly": _depth("month"),
        "session_frequency": events + SESSIONS,
        "dau": _active(EVENTS, "SELECT * FROM ev", "day"),
        "wau": _active(EVENTS, "SELECT * FROM ev", "week"),
        "mau": _active(ORDERS, "SELECT * FROM ord", "month"),
        "new_users_daily": _with(ORDERS)
        + "SELECT f AS period_start, count(*) AS new_users FROM "
        "(SELECT user_id, min(event_date) AS f FROM ord GROUP BY user_id) GROUP BY f",
        "active_by_utm": events + BY_SOURCE,
        # Data quality
        "dq_bronze_row_count": events
        + """SELECT event_date, CAST(sum(s) AS BIGINT) AS source_rows, CAST(sum(t) AS BIGINT) AS table_rows, sum(s) = sum(t) AS matches
FROM (
  SELECT event_date, 1 AS s, 0 AS t FROM ev
  UNION ALL SELECT event_date + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END, 0, 1 FROM ev
) GROUP BY event_date""",
        "dq_reconcile_rows": _with(EVENTS, COMPARED) + "SELECT * FROM compared WHERE source_rows <> table_rows",
        "dq_reconcile_days": _with(EVENTS, COMPARED)
        + """SELECT event_date, CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(table_rows) AS BIGINT) AS table_rows,
  CAST(sum(greatest(source_rows - table_rows, 0)) AS BIGINT) AS missing, CAST(sum(greatest(table_rows - source_rows, 0)) AS BIGINT) AS extra
FROM compared GROUP BY event_date""",
        "dq_bronze_not_empty": _with(ORDERS, ORDER_CALENDAR)
        + _rules({"table_not_empty": "has_rows"}, "cov"),
        "dq_source_not_empty": events
        + """SELECT 'source_not_empty' AS "check", CAST(max(event_date) - min(event_date) + 1
  - count(DISTINCT event_date) AS BIGINT) AS n_bad FROM ev""",
        "dq_events_assertions": events + _rules(EVENT_RULES, "ev"),
        "dq_events_assertions_damaged": _with(EVENTS, DAMAGED) + _rules(EVENT_RULES, "dmg"),
        "dq_silver_row_checks": _with(
            EVENTS,
            _silver("SELECT * FROM ev"),
            """dmg AS (
  SELECT login_bitmap,
    CASE WHEN "isNew" = '1' AND platform = 'ios' THEN replace(device, '_', '')
         WHEN "isNew" = '0' OR country <> 'SG' THEN device END AS device,
    CASE WHEN login_bitmap = '10' THEN '1' ELSE "isNew" END AS is_new
  FROM silver
)""",
        )
        + _rules(
            {
                "device_not_null": "device IS NOT NULL",
                "device_format": "device IS NULL OR regexp_matches(device, '^.+_.+$')",
                "new_device_has_single_login": "is_new <> '1' OR login_bitmap = '1'",
            },
            "dmg",
        ),
        "dq_silver_missing_devices": feeds
        + "SELECT event_date, device FROM src ANTI JOIN silver USING (event_date, device)",
        "dq_silver_active_ends_1": feeds
        + "SELECT event_date, device FROM silver SEMI JOIN src USING (event_date, device) "
        "WHERE login_bitmap NOT LIKE '%1'",
        "dq_silver_inactive_ends_0": feeds
        + "SELECT event_date, device FROM silver ANTI JOIN src USING (event_date, device) "
        "WHERE login_bitmap NOT LIKE '%0'",
        "dq_silver_new_not_in_source": feeds
        + "SELECT event_date, device FROM silver ANTI JOIN src USING (event_date, device) "
        "WHERE \"isNew\" = '1'",
        "dq_silver_report": feeds.rstrip()
        + """, both_sides AS (
  SELECT s.device AS table_device, r.device AS source_device, s.login_bitmap, s."isNew" AS is_new
  FROM silver s FULL OUTER JOIN src r ON r.event_date = s.event_date AND r.device = s.device
)
"""
        + _rules(
            {
                "active_device_present": "source_device IS NULL OR table_device IS NOT NULL",
                "device_not_null": "coalesce(table_device, source_device) IS NOT NULL",
                "device_format": "table_device IS NULL OR regexp_matches(table_device, '^.+_.+$')",
                "active_bitmap_ends_1": "table_device IS NULL OR source_device IS NULL "
                "OR login_bitmap LIKE '%1'",
                "inactive_bitmap_ends_0": "table_device IS NULL OR source_device IS NOT NULL "
                "OR login_bitmap LIKE '%0'",
                "new_device_has_single_login": "is_new IS NULL OR is_new <> '1' OR login_bitmap = '1'",
                "new_device_is_active": "is_new IS NULL OR is_new <> '1' OR source_device IS NOT NULL",
            },
            "both_sides",
        ),
        # The table layer and the daily batch
        "table_lifecycle": _with(ODD)
        + """SELECT true AS missing, true AS created, false AS created_again, false AS had_rows,
  count(*) AS loaded, count(*) AS loaded_again, true AS has_rows, count(*) AS n_rows
FROM ev WHERE event_date = (SELECT max(event_date) FROM ev)""",
        "table_day_partition": _with(ODD)
        + f"SELECT {CONTRACT}, event_date FROM ev WHERE event_date = (SELECT max(event_date) FROM ev)",
        "table_history_counts": clean_silver
        + "SELECT event_date, count(*) AS n_rows, CAST(sum(length(login_bitmap)) AS BIGINT) AS n_bits FROM silver GROUP BY event_date",
        "table_replaced_days": _with(EVENTS, BOUNDS)
        + """SELECT event_date, CASE WHEN event_date >= middle THEN 'changed' ELSE utm_source END AS utm_source,
  count(*) AS n_rows FROM ev, bounds WHERE event_date < high GROUP BY 1, 2""",
        "table_rebuilt": _with(EVENTS, BOUNDS)
        + "SELECT event_date, count(DISTINCT user_id) AS n_users FROM ev, bounds WHERE event_date > middle GROUP BY 1",
        "job_bronze_events": _with(ODD) + f"SELECT {CONTRACT}, event_date FROM ev",
        "job_login_bitmaps": clean_silver + f"SELECT {SILVER_COLUMNS} FROM silver",
        "job_bitmaps_of_blocks": clean_silver + f"SELECT {SILVER_COLUMNS} FROM silver",
        "job_login_blocks": _with(CLEAN)
        + f"""SELECT platform, user_id, {BLOCK_BITS} AS days, min(event_time) AS first_time,
  first(country ORDER BY event_time, country, utm_source) AS country, first(utm_source ORDER BY event_time, country, utm_source) AS utm_source,
  {BLOCK} AS block FROM ev GROUP BY platform, user_id, {BLOCK}""",
        "job_published_bitmaps": clean_silver + f"SELECT {SILVER_COLUMNS} FROM silver",
        "job_published_before": _ranges(CLEAN, BEFORE_LAST, 14),
        "job_published_growth": f"SELECT 'before' AS version, * FROM ({_periods(lambda p: _growth(CLEAN, BEFORE_LAST, p))})"
        f"\nUNION ALL\nSELECT 'now' AS version, * FROM ({_periods(lambda p: _growth(CLEAN, ALL, p))})",
        "job_user_states": _ranges(CLEAN, ALL, 14),
        "job_user_states_stepped": _ranges(CLEAN, ALL, 14),
        "job_day_arguments": _with(ODD)
        + """SELECT strftime(d, '%Y%m%d') AS argument, d AS day, CAST(d - 1 AS DATE) AS day_before FROM (
  SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS d FROM ev)""",
        "job_load_ledger": _with(ODD.replace("\nev AS (", "\nodd_ev AS (", 1))
        + f""", loaded AS (SELECT *, {FIRST_ROW} AS rn FROM odd_ev),
days AS (SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS event_date FROM odd_ev)
SELECT d.event_date, count(l.event_id) AS n_events, count(l.event_id) FILTER (rn = 1) AS n_clean, true AS unchanged
FROM days d LEFT JOIN loaded l ON l.event_date = d.event_date GROUP BY d.event_date""",
        "job_miles_balance": _with(CLEAN, DAILY) + BALANCE,
        "job_miles_balance_stepped": _with(CLEAN, DAILY) + BALANCE,
        "job_growth": _periods(lambda p: _growth(CLEAN, ALL, p)),
        "job_growth_stepped": _periods(lambda p: _growth(CLEAN, ALL, p)),
        "job_cohort_retention": _retention(CLEAN, ALL),
        "job_engagement_depth": _periods(lambda p: _depth(p, CLEAN)),
        "job_active_users": _periods(lambda p: _growth(CLEAN, ALL, p), "period_start, active_users, new_users", "active_users > 0"),
        "job_rolling_users": _rolling(CLEAN, ALL),
        "rolling_users": _rolling(ORDERS, "SELECT * FROM ord"),
        "job_events_clean": _with(CLEAN) + CLEANED.format(rows="ev"),
        "job_daily_activity": _with(CLEAN, DAILY) + "SELECT * FROM daily",
        "job_active_by_source": _with(CLEAN) + BY_SOURCE,
        "job_session_frequency": _with(CLEAN) + SESSIONS,
        "job_session_frequency_stepped": _with(CLEAN) + SESSIONS,
        "job_open_sessions": _with(CLEAN)
        + """SELECT user_id, max(event_time) AS last_time, event_date FROM ev
WHERE event_date = (SELECT max(event_date) FROM ev) AND event_time >= event_date + 1 - INTERVAL 30 MINUTE GROUP BY user_id, event_date""",
        "job_indexed_day": _with(ODD) + f"SELECT {CONTRACT} FROM ev WHERE event_date = (SELECT max(event_date) FROM ev)",
        "job_reconcile_bronze": _with(ODD)
        + """SELECT event_date, count(*) AS source_rows, count(*) AS table_rows, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra
FROM ev GROUP BY event_date""",
        "job_check_bronze": _with(ODD)
        + _rules({"row_counts_match": "true", "table_not_empty": "true", "source_not_empty": "true"}, "ev")
        + "\nUNION ALL\n"
        + _rules(EVENT_RULES, "ev"),
        "job_check_bitmaps": "SELECT unnest(['active_device_present', 'device_not_null', 'device_format', "
        "'active_bitmap_ends_1', 'inactive_bitmap_ends_0', 'new_device_has_single_login', 'new_device_is_active']) "
        'AS "check", CAST(0 AS BIGINT) AS n_bad',
        # Scalar functions and predicates
        "scalar_dates": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
  CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days_since,
  CAST(o_orderdate AS DATE) - 1 AS day_before,
  CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
  CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS next_month,
  CAST(date_trunc('week', o_orderdate) + INTERVAL 7 DAY AS DATE) AS next_week
FROM orders""",
        "scalar_strings": events
        + r"""SELECT event_id, platform || '_' || user_id AS device,
  platform || '_' || transaction_category AS device_or_null,
  lpad(transaction_category, 5, '0') AS padded,
  CAST(length(platform || '_' || user_id) AS BIGINT) AS device_length,
  right(platform || '_' || user_id, 3) AS tail,
  CAST(length(user_id) - length(replace(user_id, '0', '')) AS BIGINT) AS zeros,
  regexp_matches(platform || '_' || user_id, '^.+_.+$') AS is_device,
  regexp_matches(user_id, '^u_\d{3}7$') AS matches_pattern,
  event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' AS in_second_third,
  user_id LIKE '%1' AS ends_with_1
FROM ev""",
        "scalar_bits": """SELECT o_orderkey, o_orderkey * 8 AS shifted_left,
  o_orderkey >> 2 AS shifted_right, o_orderkey & 255 AS low_byte,
  CAST(bit_count(o_orderkey) AS BIGINT) AS bits_set,
  CAST(bit_count(o_orderkey & 127) AS BIGINT) AS bits_in_low_seven,
  CAST(bit_count((o_orderkey >> 7) & 127) AS BIGINT) AS bits_in_next_seven,
  CAST(pow(2, o_orderkey % 40) AS BIGINT) AS power
FROM orders""",
        "predicates": events
        + """SELECT event_id,
  CASE WHEN miles_amount >= 100 THEN 'large' WHEN miles_amount >= 10 THEN 'medium'
       WHEN miles_amount IS NOT NULL THEN 'small' ELSE 'none' END AS size,
  CAST(CASE WHEN miles_amount > 50 THEN 1 ELSE 0 END AS BIGINT) AS above_50,
  coalesce(transaction_category, platform) AS category_or_platform,
  transaction_category IS NULL AS without_category,
  event_date = DATE '2024-01-15' AS on_the_15th
FROM ev WHERE (miles_amount > 0 OR platform = 'web') AND NOT regexp_matches(user_id, '9$')""",
    }
