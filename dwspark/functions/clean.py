"""Cleaning expressions B01-B17 (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate(c, n: int) -> Column:
    """First n characters."""
    return F.substring(_c(c), 1, n)


# Fixed gender vocabularies.
GENDER4 = {
    "Masculino": ["m", "masculino"],
    "Femenino": ["f", "femenino"],
    "No Binario": ["x", "nobinario", "no binario"],
}
GENDER4_DEFAULT = "No Especificado"
GENDER2 = {"m": "Masculino", "f": "Femenino"}
GENDER2_DEFAULT = "No especificado"


def strip_ws(c) -> Column:
    """Strip all leading/trailing whitespace (tabs, newlines too); SQL ``trim`` strips spaces only."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"^\s+", ""), r"\s+$", "")


def map_gender4(c) -> Column:
    """strip + lower, then 4 classes; anything else (NULL too) -> 'No Especificado' (B02)."""
    g = F.lower(strip_ws(c))
    out = None
    for label, keys in GENDER4.items():
        cond = g.isin(*keys)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(GENDER4_DEFAULT))


def map_gender2(c) -> Column:
    """lower, m/f mapped, anything else -> 'No especificado' (B03)."""
    g = F.lower(_c(c))
    m = F.create_map(*[x for k, v in GENDER2.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, g), F.lit(GENDER2_DEFAULT))


def to_number(c, to: str = "double") -> Column:
    """Lenient numeric: unparsable -> NULL (B04). ``try_cast`` (plain cast raises under ANSI)."""
    return F.expr(f"try_cast({_sql(c)} as {to})") if isinstance(c, str) else _c(c).try_cast(to)


def _sql(c: str) -> str:
    return f"`{c}`"


def comma_decimal(c, to: str = "double") -> Column:
    """',' -> '.' then lenient numeric."""
    return F.replace(_c(c).cast("string"), F.lit(","), F.lit(".")).try_cast(to)


# Fixed flight date patterns (B06), in priority order; Spark pattern letters.
FLIGHT_DATE_PATTERNS = ["d/M/yyyy H:mm", "M-d-yyyy h:mm a", "d-M-yyyy H:mm", "yyyy-M-d H:mm"]
CUSTOMER_DATE_PATTERNS = ["yyyy-M-d", "d/M/yyyy"]


def _shape_regex(pattern: str) -> str | None:
    """A regex accepting every string the datetime ``pattern`` can parse (a superset).

    Numeric fields become ``[+-]?[0-9]+`` (a ``yyyy`` year at least four
    digits), the am/pm marker ``[A-Za-z]+``; literals must match exactly. Returns None for pattern letters not covered,
    and the caller then parses without a guard.
    """
    out, i = ["^"], 0
    while i < len(pattern):
        ch = pattern[i]
        j = i
        while j < len(pattern) and pattern[j] == ch:
            j += 1
        if ch in "yMdHhms":
            if ch == "M" and j - i > 2:
                return None  # month names
            # a year of 4+ letters needs at least that many digits
            out.append(f"[+-]?[0-9]{{{j - i},}}" if ch == "y" and j - i >= 4 else "[+-]?[0-9]+")
        elif ch == "a":
            out.append("[A-Za-z]+")
        elif ch.isalpha() or ch == "'":
            return None
        else:
            out.append(re.escape(pattern[i:j]))
        i = j
    out.append("$")
    return "".join(out)


def parse_dates(c, patterns: list[str]) -> Column:
    """First matching pattern wins; blank / unparsable -> NULL.

    Each pattern is tried only on strings of its shape: a failed
    ``try_to_timestamp`` costs a JVM exception per row, and with four patterns
    most rows would fail three times. The guard accepts a superset of what the
    pattern parses, so the result is the same as trying every pattern.
    """
    s = F.nullif(F.trim(_c(c)), F.lit(""))
    tries = []
    for p in patterns:
        parsed = F.try_to_timestamp(s, F.lit(p))
        rx = _shape_regex(p)
        tries.append(parsed if rx is None else F.when(s.rlike(rx), parsed))
    return F.coalesce(*tries)


def int_or_zero(c) -> Column:
    """Lenient numeric, NULL -> 0, truncated to int."""
    return F.coalesce(_c(c).cast("string").try_cast("double").try_cast("int"), F.lit(0))


def default_text(c, default: str) -> Column:
    """'' or NULL -> default."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default))


def sentinel_to_blank(df: DataFrame, sentinels=("Nan", "None")) -> DataFrame:
    """Whole-cell sentinel strings -> '' on every string column."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c).isin(*sentinels), F.lit("")).otherwise(F.col(c)) for c in cols})


def strip_all(df: DataFrame) -> DataFrame:
    """B10 on every string column."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: strip_ws(c) for c in cols})


def title_case(c) -> Column:
    """'ANA DIAZ' -> 'Ana Diaz' (B11). ``initcap`` capitalises after spaces only."""
    return F.initcap(_c(c))


def drop_null_rows(df: DataFrame, subset: list[str]) -> DataFrame:
    """B16."""
    return df.dropna(subset=subset)
