"""Run ids and dates. The session time zone is UTC (see `session.prepare`)."""

from __future__ import annotations

from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

from .numbers import _col

# The two accepted run-id styles.
ISO_RUN = r"^\d{8}T\d{6}Z$"
PLAIN_RUN = r"^\d{14}$"


def is_run_id(c: Column | str) -> Column:
    return _col(c).rlike(f"{ISO_RUN}|{PLAIN_RUN}")


def run_instant(c: Column | str) -> Column:
    """Either run-id style as a timestamp; NULL when neither fits."""
    c = _col(c)
    return F.when(
        c.rlike(ISO_RUN), F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmssX"))
    ).when(
        c.rlike(PLAIN_RUN), F.try_to_timestamp(F.concat(c, F.lit("Z")), F.lit("yyyyMMddHHmmssX"))
    )


def parse_run_id(c: Column | str, invalid: str = "now") -> Column:
    """Run id as a timestamp.

    ``invalid`` says what an unreadable id counts as: ``now`` (it then beats
    every dated run), ``oldest`` or ``null``.
    """
    fallback = {
        "now": F.current_timestamp(),
        "oldest": F.timestamp_seconds(F.lit(0)),
        "null": F.lit(None).cast("timestamp"),
    }[invalid]
    return F.coalesce(run_instant(c), fallback)


def iso_z(c: Column | str) -> Column:
    """Timestamp as ``YYYY-MM-DDTHH:MM:SSZ``."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_hour(c: Column | str) -> Column:
    """UTC hour key ``YYYYMMDDHH`` of a timestamp."""
    return F.date_format(_col(c), "yyyyMMddHH")


def parse_run_hour(c: Column | str) -> Column:
    return F.try_to_timestamp(F.concat(_col(c), F.lit("Z")), F.lit("yyyyMMddHHX"))


def known_zone(tz: str) -> str:
    """The zone itself, or UTC when it does not exist."""
    try:
        ZoneInfo(tz)
        return tz
    except Exception:
        return "UTC"


def local_day(c: Column | str, tz: str = "America/New_York") -> Column:
    """Calendar day in ``tz`` of a UTC instant (timestamp or ISO text); unreadable text is NULL."""
    ts = _col(c).try_cast("timestamp")
    return F.to_date(F.from_utc_timestamp(ts, known_zone(tz)))
