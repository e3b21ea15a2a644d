"""Date and timestamp helpers (built-in expressions only).

Timestamps without a zone are ``timestamp_ntz``.  Epoch arithmetic is done
on ``timestamp_ntz`` so results never depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col

NUMERIC_TEXT = r"^\s*-?[0-9]+(\.[0-9]+)?\s*$"


def epoch_ms_to_timestamp(c: ColumnOrName) -> Column:
    """Milliseconds since 1970-01-01 UTC -> timestamp_ntz (UTC wall clock)."""
    return _add_ms(_col(c).try_cast("bigint"))


def _add_ms(ms: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", ms, epoch)


def _add_us(us: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", us, epoch)


def timestamp_to_epoch_ms(c: ColumnOrName) -> Column:
    """timestamp_ntz -> milliseconds since epoch (UTC wall clock)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, _col(c))


def iso_utc_text(ts_ntz: Column) -> Column:
    """ISO-8601 text of a UTC wall-clock timestamp with a ``+00:00`` suffix.

    The fraction is printed with six digits and only when it is non-zero,
    which is how standard ISO formatting of a UTC datetime reads.
    """
    base = F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts_ntz, "SSSSSS")
    return F.concat(base,
                    F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
                    F.lit("+00:00"))


def normalize_timestamp(c: ColumnOrName) -> Column:
    """Epoch-millisecond text -> ISO-8601 UTC text; other text passes through."""
    col = _col(c)
    ms = col.try_cast("double")
    us = F.round(ms * F.lit(1000.0)).try_cast("bigint")
    return F.when(col.rlike(NUMERIC_TEXT) & us.isNotNull(),
                  iso_utc_text(_add_us(us))).otherwise(col)


def parse_timestamp(c: ColumnOrName) -> Column:
    """Text -> timestamp_ntz, NULL when malformed; an offset is dropped and
    the wall clock of the text is kept."""
    return _col(c).try_cast("timestamp_ntz")


def date_parts(ts: ColumnOrName, prefix: str = "") -> list[Column]:
    """day, month, year, weekday (Sunday = 0) as integers."""
    t = _col(ts)
    return [F.dayofmonth(t).cast("int").alias(f"{prefix}day"),
            F.month(t).cast("int").alias(f"{prefix}month"),
            F.year(t).cast("int").alias(f"{prefix}year"),
            (F.dayofweek(t) - 1).cast("int").alias(f"{prefix}weekday")]


def run_id(when: _dt.datetime, lag_hours: int = 1) -> str:
    """Run identifier ``yyyyMMdd_HHmmss`` of ``when`` minus a lag; computed
    once on the driver and passed to the jobs as a parameter."""
    return (when - _dt.timedelta(hours=lag_hours)).strftime("%Y%m%d_%H%M%S")


def stay_dates(day: _dt.date, nights: int = 1) -> tuple[Column, Column]:
    """Check-in and check-out dates as ``yyyy-MM-dd`` text columns."""
    d = F.lit(day)
    return (F.date_format(d, "yyyy-MM-dd"),
            F.date_format(F.date_add(d, nights), "yyyy-MM-dd"))
