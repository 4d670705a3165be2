"""Scalar column helpers, all JVM-side built-ins (whole-stage codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that match the landing format.
TEXT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
KEY_PREFIXES = {"customers": "c-", "orders": "o-", "marketing": "a-"}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col) -> Column:
    """Remove ',' and turn each newline into a space (landing files are '|'-separated
    with one record per line)."""
    return F.translate(_c(col), "\n,", " ")


def prefixed_key(col, prefix: str) -> Column:
    """Surrogate key text ``prefix || key``."""
    return F.concat(F.lit(prefix), _c(col).cast("string"))


def ts_to_text(col, ntz: bool = True) -> Column:
    """Timestamp as landing text ``yyyy-MM-dd HH:mm:ss`` (fraction dropped).

    For ``timestamp_ntz`` the text comes from the value's own fields (its string form), so
    the session time zone plays no part; ``date_format`` would route it through the zone
    and move times that fall in a daylight-saving gap.
    """
    return F.substring(_c(col).cast("string"), 1, 19) if ntz \
        else F.date_format(_c(col), TEXT_TS_FORMAT)


def month_text(col, ntz: bool = True) -> Column:
    """``yyyy-MM`` of a timestamp (zone-free for ``timestamp_ntz``)."""
    return F.substring(_c(col).cast("string"), 1, 7) if ntz else F.date_format(_c(col), "yyyy-MM")


_TEXT_TS_RE = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"


def text_to_ts(col, ntz: bool = True, lenient: bool = True) -> Column:
    """Parse landing text back into a timestamp.

    ``timestamp_ntz`` is built from the text's fields (no time zone). ``lenient`` gives
    NULL for text that is not a valid ``yyyy-MM-dd HH:mm:ss``; otherwise a bad value raises.
    """
    c = _c(col)
    if not ntz:
        fmt = F.lit(TEXT_TS_FORMAT)
        return F.try_to_timestamp(c, fmt) if lenient else F.to_timestamp(c, TEXT_TS_FORMAT)
    if not lenient:
        return F.to_timestamp_ntz(c, F.lit(TEXT_TS_FORMAT))
    part = [F.regexp_extract(c, _TEXT_TS_RE, i).try_cast("int") for i in range(1, 7)]
    return F.when(c.rlike(_TEXT_TS_RE), F.try_make_timestamp_ntz(*part))


def round_half_even(col, scale: int = 0) -> Column:
    """Banker's rounding, as Python's ``round``."""
    return F.bround(_c(col), scale)


def in_window_end(col, days: int) -> Column:
    """``ts + INTERVAL days DAY`` (an exact day-time interval)."""
    return _c(col) + F.make_dt_interval(days=F.lit(days))


def prompt(prefix: str, col) -> Column:
    """``prefix || col`` (NULL when the column is NULL)."""
    return F.concat(F.lit(prefix), _c(col))
