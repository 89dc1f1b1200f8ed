"""Calendar-aware window expressions over a (commodity, date) panel.

Frames are ranges of days, never counts of rows, so gaps stay gaps. All frames
share one partitioning and one order: Spark plans one exchange, one sort and
one window for all of them. A panel has one row a day and commodity, so a
frame of 31 days holds 31 rows at most.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..config import Lag, Lead, Rolling

KEYS = ("commodity",)


def day(date: str = "date") -> Column:
    return F.unix_date(F.col(date))


def frame(start: int, end: int, keys=KEYS, date: str = "date"):
    return Window.partitionBy(*keys).orderBy(day(date)).rangeBetween(start, end)


def asof_lag(value: str, lag: Lag, keys=KEYS, date: str = "date") -> Column:
    """The value of the last row in the lag's days, missing if that row's value is."""
    return F.last(F.col(value)).over(frame(-(lag.days + lag.slack), -lag.days, keys, date))


def asof_lead(value: str, lead: Lead, keys=KEYS, date: str = "date") -> Column:
    return F.first(F.col(value)).over(frame(lead.days, lead.days + lead.slack, keys, date))


def matched_lag_day(lag: Lag, keys=KEYS, date: str = "date") -> Column:
    return F.max(day(date)).over(frame(-(lag.days + lag.slack), -lag.days, keys, date))


def matched_lead_day(lead: Lead, keys=KEYS, date: str = "date") -> Column:
    return F.min(day(date)).over(frame(lead.days, lead.days + lead.slack, keys, date))


def _gated(value: str, rolling: Rolling, aggregate, keys, date) -> Column:
    w = frame(-rolling.days, 0, keys, date)
    return F.when(F.count(value).over(w) >= rolling.min_obs, aggregate(F.col(value)).over(w))


def trailing_mean(value: str, rolling: Rolling, keys=KEYS, date: str = "date") -> Column:
    return _gated(value, rolling, F.avg, keys, date)


def trailing_std(value: str, rolling: Rolling, keys=KEYS, date: str = "date") -> Column:
    """Sample standard deviation; missing for a single observation."""
    return _gated(value, rolling, F.stddev_samp, keys, date)
