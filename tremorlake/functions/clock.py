"""Times: the run clock (injectable) and the feed's event times."""

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

#: A run clock: a fixed instant, or None for the wall clock of the query.
Clock = datetime | None


def _utc(clock: datetime) -> datetime:
    return clock.replace(tzinfo=timezone.utc) if clock.tzinfo is None else clock.astimezone(timezone.utc)


def _utc_now() -> Column:
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())


def utc_iso(clock: Clock = None) -> Column:
    """ISO text in UTC, with offset."""
    if clock is not None:
        return F.lit(_utc(clock).isoformat())
    return F.date_format(_utc_now(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def naive_iso(clock: Clock = None) -> Column:
    """ISO text without offset, in UTC."""
    if clock is not None:
        return F.lit(_utc(clock).replace(tzinfo=None).isoformat())
    return F.date_format(_utc_now(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def compact(clock: Clock = None) -> Column:
    """``yyyyMMddHHmmss`` text in UTC."""
    if clock is not None:
        return F.lit(_utc(clock).strftime("%Y%m%d%H%M%S"))
    return F.date_format(_utc_now(), "yyyyMMddHHmmss")


def event_time(text: Column) -> Column:
    """Instant of a feed datetime, whatever the session time zone; NULL when it fits no known form.

    Known forms: ISO with offset, plain ISO (read as UTC) and ``07 Jun 2026 13:06:08 WIB`` (UTC+7).
    Branching on the shape keeps a row from failing through several parsers.
    """
    iso = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
    return (
        F.when(text.rlike(iso + "$"), F.concat(text, F.lit("Z")).try_cast("timestamp"))
        .when(text.rlike(iso + r"(Z|[+-]\d{2}:\d{2})$"), text.try_cast("timestamp"))
        .when(text.rlike(r"^\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} WIB$"),
              F.try_to_timestamp(F.replace(text, F.lit("WIB"), F.lit("+07:00")),
                                 F.lit("dd MMM yyyy HH:mm:ss XXX")))
    )


def record_time(epoch_ms: Column) -> Column:
    """Instant of an epoch-milliseconds record time."""
    return F.timestamp_millis(epoch_ms)


def iso_text(instant: Column) -> Column:
    """ISO text of an instant in UTC; a fraction of a second is written, in six digits, when there is one."""
    utc = F.to_utc_timestamp(instant, F.current_timezone())
    whole = F.date_trunc("second", utc) == utc
    return F.when(whole, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
