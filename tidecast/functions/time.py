"""Fixed-frequency time arithmetic on TIMESTAMP_NTZ columns.

Frequencies are fixed lengths (minutes, hours, days, weeks), written either as in the
workload (``'1H'``, ``'1D'``) or as interval text (``'1 hour'``).  All arithmetic goes
through ``timestampdiff`` / ``timestampadd`` in microseconds.  Spark evaluates those on
NTZ values through the session zone, which tidecast pins to UTC (``SESSION_DEFAULTS``),
so no daylight-saving gap or overlap can shift a grid.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


_UNIT_US = {
    "us": 1, "microsecond": 1,
    "ms": 1_000, "millisecond": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000,
    "t": 60_000_000, "min": 60_000_000, "minute": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000,
    "w": 604_800_000_000, "week": 604_800_000_000,
}


def freq_micros(freq: str | int) -> int:
    """Length of one step of ``freq`` in microseconds."""
    if isinstance(freq, int):
        return freq
    m = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+?)s?\s*", str(freq))
    if not m:
        raise ValueError(f"cannot read frequency {freq!r}")
    n = int(m.group(1) or 1)
    unit = m.group(2).lower()
    if unit not in _UNIT_US:
        raise ValueError(f"unsupported frequency unit in {freq!r} (fixed-length units only)")
    return n * _UNIT_US[unit]


def freq_days(freq: str | int) -> float:
    return freq_micros(freq) / 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of an NTZ value (session zone UTC)."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(ts))


def from_micros(us) -> Column:
    return F.timestamp_add("MICROSECOND", _c(us), _epoch())


def bucket(ts, freq) -> Column:
    """Floor ``ts`` to its ``freq`` cell (left edge), as TIMESTAMP_NTZ."""
    f = freq_micros(freq)
    us = to_micros(ts)
    return from_micros(us - F.pmod(us, F.lit(f)))


def steps_between(lo, ts, freq) -> Column:
    """Whole ``freq`` steps from ``lo`` to ``ts`` (0 when equal)."""
    return F.floor(F.timestamp_diff("MICROSECOND", _c(lo), _c(ts)) / F.lit(freq_micros(freq))).cast("int")


def add_steps(ts, n, freq) -> Column:
    """``ts + n·freq`` as TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _c(n).cast("long") * F.lit(freq_micros(freq)), _c(ts))


def format_run_id(ts, with_time: bool = True) -> Column:
    """Run / model ids: ``yyyy-MM-dd`` or ``yyyy-MM-dd-HH-mm-ss``."""
    return F.date_format(_c(ts), "yyyy-MM-dd-HH-mm-ss" if with_time else "yyyy-MM-dd")


def ts_text(ts) -> Column:
    """Series start as text, ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")
