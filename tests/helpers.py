from __future__ import annotations

from datetime import date, datetime, timedelta

from retentide.schemas import EVENTS

EPOCH = date(2025, 2, 6)


def day(n: int) -> date:
    return EPOCH + timedelta(days=n)


def event(n, user="u_0001", platform="android", kind="like", hour=12, minute=0, **changes):
    """One event on day ``n`` in the contract, as a dict."""
    at = None if n is None else datetime.combine(day(n), datetime.min.time())
    miles = kind in ("miles_earned", "miles_redeemed")
    row = {
        "event_time": at and at + timedelta(hours=hour, minutes=minute),
        "user_id": user,
        "gender": "Female",
        "event_type": kind,
        "transaction_category": "dining" if miles else None,
        "miles_amount": 10.0 if miles else None,
        "platform": platform,
        "utm_source": "organic",
        "country": "SG",
    }
    row.update(changes)
    return row


def events(spark, rows):
    from retentide.sources.raw_events import with_event_date

    names = EVENTS.fieldNames()
    return with_event_date(spark.createDataFrame([tuple(r[c] for c in names) for r in rows], EVENTS))


def activity(spark, days_by_user):
    rows = [(u, day(n)) for u, days in days_by_user.items() for n in days]
    return spark.createDataFrame(rows, "user_id string, event_date date")


def brute_ranges(days_by_user, window, as_of):
    """State ranges from the definitions, one user and day at a time."""
    out = set()
    for user, days in days_by_user.items():
        active = {d for d in days if d <= as_of}
        if not active:
            continue
        first, daily = min(active), []
        for d in range(first, as_of + 1):
            now = sum(1 for a in active if d - window < a <= d)
            prior = sum(1 for a in active if d - 2 * window < a <= d - window)
            if d - first < window and now:
                daily.append((d, "new"))
            elif now and not prior:
                daily.append((d, "resurrected"))
            elif now:
                daily.append((d, "retained"))
            elif prior:
                daily.append((d, "churned"))
        starts = [x for i, x in enumerate(daily) if i == 0 or daily[i - 1][1] != x[1]]
        for i, (start, state) in enumerate(starts):
            end = starts[i + 1][0] - 1 if i + 1 < len(starts) else None
            out.add((user, state, start, end))
    return out


def as_numbers(ranges):
    return {
        (r.user_id, r.user_state, (r.start_date - EPOCH).days, r.end_date and (r.end_date - EPOCH).days)
        for r in ranges.collect()
    }
