from caseledger.functions.columns import (  # noqa: F401
    as_of_instant, before_end_of, business_today, created_and_alive, day_end, day_key,
    day_start, elapsed_hours, elapsed_seconds, event_key, event_time, from_micros,
    from_millis, in_days, is_delete, is_open, is_success, non_negative, on_day, or_unknown, percent,
    prefixed_key, resolve_snapshot_date, to_double, to_int, to_time,
)
