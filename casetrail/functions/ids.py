"""Time-ordered transaction ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_ordered_uuid() -> Column:
    """UUID of version 7: 48 bits of milliseconds, then version, variant and random bits.

    The random part comes from ``uuid()``, whose 13th digit is the version and whose 17th
    already carries the variant. Differs on every run, so leave it out of comparisons.
    """
    random = F.expr("uuid()")
    millis = F.lpad(F.lower(F.hex(F.unix_millis(F.current_timestamp()))), 12, "0")
    return F.concat(
        F.substring(millis, 1, 8), F.lit("-"), F.substring(millis, 9, 4),
        F.lit("-7"), F.substring(random, 16, 21),
    )
