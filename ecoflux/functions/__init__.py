"""Column -> Column expressions.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
Text parsing uses the ``try_*`` family: Spark 4 runs in ANSI mode, where a plain cast
of bad text raises instead of giving null.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source system's) ----------------------------------
# Time zone the daily facts are dated in.
LOCAL_TZ = "America/Sao_Paulo"
# Layout of the UTC reading timestamp built from the date and hour columns.
UTC_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Shape an hour string must have once the UTC marker is stripped.
HOUR_SHAPE = r"^\d{2}:\d{2}:\d{2}$"
# Marker stripped from hour strings such as "12:00:00 UTC".
UTC_MARKER_PATTERN = r"\s*UTC\s*"
# Plant classes of the generation pivot: substring patterns, case- and accent-sensitive.
PLANT_CLASS_PATTERNS = {
    "eolica": ["%Eólica%", "%Eolica%"],
    "solar": ["%Solar%", "%Fotovolt%"],
    "hidro": ["%Hidrel%"],
    "termica": ["%Térmica%", "%Termica%"],
}
# ISO day-of-week numbers counted as weekend (Saturday, Sunday).
WEEKEND_ISO_DAYS = [6, 7]
# ------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_comma(c: Column | str) -> Column:
    """Text with a decimal comma -> double.

    Every comma becomes a point, then the text is parsed leniently: blank or malformed
    text ("1.234,56" becomes "1.234.56") gives null instead of an error. Numbers that are
    already numeric round-trip through their text form unchanged.
    """
    # translate replaces every comma, like a regex replace of ",", without a regex engine
    text = F.translate(_col(c).cast("string"), ",", ".")
    return text.try_cast("double")


def strip_utc_marker(c: Column | str) -> Column:
    """Remove every ``UTC`` marker (and surrounding blanks) from an hour string."""
    return F.regexp_replace(_col(c).cast("string"), UTC_MARKER_PATTERN, "")


def utc_reading_ts(date_c: Column | str, hour_c: Column | str) -> Column:
    """UTC wall-clock timestamp (timestamp_ntz) from a date column and an hour string.

    The text ``yyyy-MM-dd HH:mm:ss`` must match exactly: a missing date or hour, or an
    hour like ``"1200"``, gives null. The strict shape test plus a lenient cast is the
    same rule as parsing with that pattern, without a formatter per row and without
    depending on the session time zone.
    """
    day = _col(date_c).cast("string").try_cast("date").cast("string")
    hour = strip_utc_marker(hour_c)
    text = F.concat_ws(" ", day, hour)
    ok = day.isNotNull() & hour.rlike(HOUR_SHAPE)
    return F.when(ok, text.try_cast("timestamp_ntz"))


def utc_to_local(ts_ntz: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Shift a UTC wall clock to the wall clock of ``tz`` (DST-aware)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(ts_ntz))


def local_date(date_c: Column | str, hour_c: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Local calendar date of a UTC reading given as date + hour text."""
    return F.to_date(utc_to_local(utc_reading_ts(date_c, hour_c), tz))


def to_date_lenient(c: Column, data_type_name: str) -> Column:
    """Date of a timestamp, or of text (bad text -> null)."""
    if data_type_name in ("timestamp", "timestamp_ntz", "date"):
        return F.to_date(c)
    return c.cast("string").try_cast("date")


def iso_weekday(d: Column | str) -> Column:
    """ISO day of week: Monday=1 ... Sunday=7 (not ``dayofweek``, where Sunday=1)."""
    return (F.weekday(_col(d)) + F.lit(1)).cast("int")


def is_weekend(d: Column | str) -> Column:
    return iso_weekday(d).isin(WEEKEND_ISO_DAYS)


def month_name(d: Column | str) -> Column:
    return F.date_format(_col(d), "MMMM")


def weekday_name(d: Column | str) -> Column:
    return F.date_format(_col(d), "EEEE")


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` when ``den > 0``; null for a null, zero or negative denominator."""
    return F.when(_col(den) > 0, _col(num) / _col(den))


def like_any(c: Column | str, patterns: list[str]) -> Column:
    """OR of SQL ``LIKE`` patterns (case-sensitive)."""
    return reduce(lambda a, b: a | b, [_col(c).like(p) for p in patterns])


def year_in_name(name: Column | str) -> Column:
    """First 4-digit run of a file or folder name as text; null when there is none."""
    y = F.regexp_extract(_col(name), r"(\d{4})", 1)
    return F.when(y != "", y)


def entry_name(file_path: Column | str, root: str | None = None) -> Column:
    """Name of the delivered entry a data file belongs to: the first part of its path (below
    ``root``, when given) with a ``.parquet`` extension in any case, be it the file itself or a
    folder of part files; the file's own name when no part has one."""
    path = _col(file_path)
    if root:
        below = re.sub(r"^[A-Za-z][\w+.-]*:/*", "/", root).rstrip("/") + "/"
        at = F.instr(path, below)
        path = F.when(at > 0, F.substring(path, at + F.lit(len(below)), F.length(path))).otherwise(path)
    entry = F.regexp_extract(path, r"(?i)(?:^|/)([^/]+\.parquet)(?=/|$)", 1)
    return F.when(entry != "", entry).otherwise(F.element_at(F.split(path, "/"), -1))
