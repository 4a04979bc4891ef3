"""Scalar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_negative(c: Column | str, floor: float = 0.0) -> Column:
    """Negative -> floor, NULL stays NULL (``greatest`` would turn NULL into floor)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < floor, F.lit(floor).cast("double")).otherwise(c)


def season_of_month(month: Column) -> Column:
    """month % 12 // 3 + 1: Dec-Feb=1, Mar-May=2, Jun-Aug=3, Sep-Nov=4."""
    return (F.floor((month % 12) / 3) + 1).cast("int")


def weekday_mon0(ts: Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def safe_div(num: Column, den: Column, default: float | None = None) -> Column:
    """ANSI-safe division: NULL (or ``default``) when the denominator is 0/NULL."""
    q = F.try_divide(num, den)
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def hash_bucket(key: Column | str, buckets: int = 100, salt: str = "") -> Column:
    """Stable bucket 0..buckets-1 from the first 32 bits of md5(key).

    Same value in any engine that has md5, so a split made this way is
    reproducible, needs no shuffle, and is stable when new rows arrive.
    """
    k = F.col(key) if isinstance(key, str) else key
    s = F.concat(k.cast("string"), F.lit(salt)) if salt else k.cast("string")
    return (F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def hash_unit(*parts: Column) -> Column:
    """Deterministic uniform number in [0, 1) from md5 of the joined parts."""
    s = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def to_double_round(c: Column, places: int = 6) -> Column:
    return F.round(c.cast("double"), places)
