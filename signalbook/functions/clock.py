"""Times of transactions, free of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalbook.schemas import TRANSACTION_DT_FORMAT


def parse_epoch(text: Column) -> Column:
    """Seconds since 1970 of a ``transaction_dt`` read as UTC; null if bad."""
    stamped = F.concat(text, F.lit(" +0000"))
    return F.unix_timestamp(F.try_to_timestamp(stamped, F.lit(TRANSACTION_DT_FORMAT + " Z")))


def epoch_of_ntz(ts: str) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp column."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def format_dt(ts: Column) -> Column:
    return F.date_format(ts, TRANSACTION_DT_FORMAT)
