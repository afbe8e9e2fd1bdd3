"""Time stamp text (F11-F15, F17). The run time is always a parameter so a
run is reproducible; formatting uses the session time zone (UTC)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# A fixed default run time for tests and registered queries.
DEFAULT_RUN_TS = "2024-05-17 09:41:26"


def ts_col(run_ts) -> Column:
    if isinstance(run_ts, Column):
        return run_ts
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(str(run_ts)))


def up_to_date(ts) -> Column:
    """yyyyMMdd."""
    return F.date_format(ts_col(ts), "yyyyMMdd")


def up_to_second(ts) -> Column:
    """yyyyMMddHHmmss."""
    return F.date_format(ts_col(ts), "yyyyMMddHHmmss")


def up_to_hundredth(ts) -> Column:
    """yyyyMMddHHmmss plus two digits of the second's fraction.

    The fraction is rounded to hundredths first (the reference formats the
    epoch with 12 significant digits, which rounds); whole seconds give 00.
    """
    t = ts_col(ts)
    micros = F.unix_micros(t)
    hundredths = F.round(micros / F.lit(10000.0)).cast("long")
    whole = F.timestamp_seconds(F.floor(hundredths / 100))
    return F.concat(F.date_format(whole, "yyyyMMddHHmmss"),
                    F.lpad(F.pmod(hundredths, F.lit(100)).cast("string"), 2, "0"))


def prefix(ts) -> Column:
    """F13 + '_'."""
    return F.concat(up_to_hundredth(ts), F.lit("_"))


def queue_stamp(ts) -> Column:
    """the queue's 16-digit text, DATE_FORMAT(NOW(),'%Y%m%d%H%i%s00')."""
    return F.concat(up_to_second(ts), F.lit("00"))


def claim_token(run_ts) -> str:
    """a process name for a claim: the run time as epoch seconds text."""
    if isinstance(run_ts, str):
        run_ts = _dt.datetime.fromisoformat(run_ts).replace(tzinfo=_dt.timezone.utc)
    return repr(run_ts.timestamp())
