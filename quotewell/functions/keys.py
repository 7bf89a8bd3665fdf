"""Row keys of the serving table: salt + security + reversed time [+ reversed seq]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotewell.functions.times import epoch_ms, from_epoch_ms

# Salt length, and the number reversed times count down from.
SALT_CHARS = 6
LONG_MAX = 9223372036854775807


def reverse_long(c: Column) -> Column:
    return F.lit(LONG_MAX) - c.cast("bigint")


def row_key(security: Column, ts: Column, seq: Column | None = None, zone: str = "UTC") -> Column:
    parts = [
        F.substring(F.md5(security.cast("binary")), 1, SALT_CHARS),
        security,
        reverse_long(epoch_ms(ts, zone)).cast("string"),
    ]
    if seq is not None:
        parts.append(reverse_long(seq).cast("string"))
    return F.concat(*parts)


def key_time(key: Column, security: Column, zone: str = "UTC") -> Column:
    """Time back out of a key. The reversed time starts after salt and id and
    is 19 digits long, whatever the length of the id."""
    reversed_ms = F.substr(key, F.length(security) + F.lit(SALT_CHARS + 1), F.lit(19))
    return from_epoch_ms(F.lit(LONG_MAX) - reversed_ms.cast("bigint"), zone)
