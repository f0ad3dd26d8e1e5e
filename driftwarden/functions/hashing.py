"""Repeatable pseudo-random numbers: functions of the row's keys, never of its partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DENOMINATOR = 4294967296.0


def hash_key(*parts: Column | str | int) -> Column:
    """md5 of the parts joined by ``|``; used to order rows at random but repeatably."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def uniform(*parts: Column | str | int) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of the md5 of the parts."""
    return F.conv(F.substring(hash_key(*parts), 1, 8), 16, 10).cast("double") / F.lit(DENOMINATOR)
