"""Event-time helpers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATENESS = timedelta(seconds=10)


def millis(span: timedelta) -> int:
    return span // timedelta(milliseconds=1)


def interval(span: timedelta) -> str:
    """A span in the text form that window functions and watermarks take."""
    return f"{millis(span)} milliseconds"


def pane_start(ms: Column, width: timedelta) -> Column:
    """Start of the epoch-aligned pane holding an epoch-ms instant (integer arithmetic)."""
    return ms - F.pmod(ms, F.lit(millis(width)))


def to_event_time(ts: Column) -> Column:
    """Event times carry milliseconds; finer digits are cut, not rounded."""
    return F.date_trunc("millisecond", ts.cast("timestamp"))


def watermarked(df: DataFrame, lateness: timedelta = LATENESS) -> DataFrame:
    """Bounded out-of-orderness; without effect on a batch DataFrame."""
    return df.withWatermark("event_time", interval(lateness))
