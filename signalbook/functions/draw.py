"""Draws that depend on a row's key alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousandth(keys: list[str], seed: int) -> Column:
    """A number from 0 to 999 out of the keys of a row, the same wherever and
    whenever it is drawn; any database with MD5 draws it too."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    # Seven hex digits of the digest.
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("int") % 1000
