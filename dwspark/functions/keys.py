"""Surrogate keys.

Keys are deterministic functions of the natural key, so a fact can compute
its foreign key from the natural key without a lookup, and two runs over the
same data produce the same keys (unlike ``monotonically_increasing_id``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key scheme (must agree with the SQL oracle):
KEY_SEPARATOR = "-"
NULL_TOKEN = "<null>"
UNKNOWN_NATURAL_KEY = "-1"
UNKNOWN_DATE_KEY = -1


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sk(*cols) -> Column:
    """md5 over the natural key parts, NULL-safe."""
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def sk_unknown() -> Column:
    """Key of the unknown member: md5('-1')."""
    return F.md5(F.lit(UNKNOWN_NATURAL_KEY))


def packed(c) -> Column:
    """A key as bytes, one to one, for grouping: md5 in hex takes half its room, behind a byte that no UTF-8 text has."""
    s = _as_col(c).cast("string")
    b = F.unhex(s)  # NULL if not hex; there and back is cheaper than a pattern
    is_md5 = (F.length(s) == 32) & (F.lower(F.hex(b)) == s)
    return F.when(is_md5, F.concat(F.unhex(F.lit("FF")), b)).otherwise(s.cast("binary"))


def unpacked(c) -> Column:
    """The text of a ``packed`` key."""
    b = _as_col(c)
    return F.when(F.substring(F.hex(b), 1, 2) == "FF", F.lower(F.substring(F.hex(b), 3, 32))).otherwise(b.cast("string"))


def sk_date(c) -> Column:
    """YYYYMMDD integer date key (B26); NULL stays NULL (callers coalesce to -1)."""
    return F.date_format(_as_col(c), "yyyyMMdd").cast("int")


def sk_date_in_range(c, start: str, end: str) -> Column:
    """Date key when the date is inside the calendar [start, end], else -1.

    Equivalent to a left join on the calendar dimension followed by
    ``coalesce(sk_fecha, -1)``, without a join.
    """
    d = _as_col(c)
    inside = d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return F.when(inside, sk_date(d)).otherwise(F.lit(UNKNOWN_DATE_KEY))
