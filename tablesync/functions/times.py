"""Date-string detection, conversion to UTC text, high-water mark formatting.

All expressions are JVM-side and exact in any session time zone, also
across its daylight-saving changes: instants become UTC wall clocks through
their epoch microseconds, text is cut from the zone-free string form of a
``timestamp_ntz``, and zones are only ever named explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the source system's date conventions:
# the offset its API writes, the detection pattern (a prefix match), the text
# format of converted dates, the zone and format of the high-water mark sent
# back to the API, and the parse format of a mark read back as text.
SOURCE_OFFSET = "+1100"
DETECT_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d+"  # followed by the offset
UTC_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # produced by ntz_text
MARK_ZONE = "Pacific/Noumea"
MARK_FORMAT = "yyyy/MM/dd HH:mm"  # produced by format_mark, read by mark_text_to_utc
ISO_PARSE_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _offset_re(offset: str) -> str:
    return offset.replace("+", r"\+")


def is_source_date(col: Column | str, offset: str = SOURCE_OFFSET) -> Column:
    """True when the text starts like an API date with the given offset."""
    return _c(col).rlike(DETECT_PATTERN + _offset_re(offset))


_EPOCH = "1970-01-01 00:00:00"


def utc_wall_clock(ts: Column) -> Column:
    """An instant (``timestamp``) as its UTC wall clock (``timestamp_ntz``)."""
    # epoch microseconds added to the zone-free epoch: plain long arithmetic
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit(_EPOCH).cast(T.TimestampNTZType()))


def _ntz_parts(ntz: Column) -> tuple[Column, Column]:
    """(``yyyy-MM-dd HH:mm:ss``, six fraction digits) of a wall clock."""
    s = ntz.cast("string")  # zone-free: 'yyyy-MM-dd HH:mm:ss[.f...]'
    frac = F.when(F.length(s) > 20, F.substring(s, 21, 6)).otherwise(F.lit(""))
    return F.substring(s, 1, 19), F.rpad(frac, 6, "0")


def _session_zone_is_fixed() -> bool:
    """Whether the active session's zone has no offset changes (UTC or a
    fixed offset).  Spark binds the zone when an expression is analysed --
    right after it is built -- so the choice and the binding agree."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is None:
        return False
    zone = (spark.conf.get("spark.sql.session.timeZone", "") or "").upper()
    return zone in ("UTC", "GMT", "Z", "ETC/UTC", "ETC/GMT", "UCT", "ZULU") or bool(
        __import__("re").fullmatch(r"(UTC|GMT)?[+-]\d{1,2}(:\d{2})?", zone)
    )


def ntz_text(ntz: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` of a wall clock (NULL stays NULL).

    ``date_format`` goes through the session zone, which is exact only when
    that zone never changes its offset; otherwise the text is cut from the
    zone-free string form.
    """
    c = _c(ntz)
    if _session_zone_is_fixed():
        return F.date_format(c, UTC_TEXT_FORMAT)
    base, frac = _ntz_parts(c)
    return F.when(c.isNotNull(), F.concat(base, F.lit("."), frac))


def to_utc_text(col: Column | str, offset: str = SOURCE_OFFSET) -> Column:
    """Convert an API date string to UTC text with 6 fraction digits.

    Only strings matching the detection pattern are touched; those that do
    not parse in full (bad field values, more than 6 fraction digits,
    trailing text) are returned unchanged, as is every other string.
    """
    c = _c(col)
    # The full-match guard implies the detection pattern (a prefix match)
    # and rejects what the strict parse would reject too (7+ fraction
    # digits, trailing text); bad field values then fail the parse.
    strict = DETECT_PATTERN.replace(r"\d+", r"\d{1,6}") + _offset_re(offset) + "$"
    parsed = F.try_to_timestamp(c, F.lit(ISO_PARSE_FORMATS[0]))
    converted = ntz_text(utc_wall_clock(parsed))
    # cheap length / 'T' test first: most strings are not dates at all
    shaped = F.length(c).between(25, 31 + len(offset) - 5) & (F.substring(c, 11, 1) == F.lit("T"))
    return F.when(shaped & c.rlike(strict), F.coalesce(converted, c)).otherwise(c)


def parse_mark(col: Column | str) -> Column:
    """A mark read back as ISO text with an offset -> UTC ``timestamp_ntz``."""
    c = _c(col)
    parsed = F.coalesce(*[F.try_to_timestamp(c, F.lit(fmt)) for fmt in ISO_PARSE_FORMATS])
    return utc_wall_clock(parsed)


def mark_as_utc(col: Column | str, dtype: T.DataType) -> Column:
    """Normalise a mark of any supported type to UTC ``timestamp_ntz``.

    ``timestamp_ntz`` is taken as UTC wall clock already (how columnar
    targets store it); ``timestamp`` is an instant; strings with an offset
    are instants, strings without one (the UTC text this engine writes) are
    UTC wall clocks.
    """
    c = _c(col)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return utc_wall_clock(c)
    if isinstance(dtype, T.StringType):
        return F.coalesce(parse_mark(c), c.try_cast(T.TimestampNTZType()))
    raise TypeError(f"unsupported high-water mark type {dtype.simpleString()}")


def format_mark(utc_ntz: Column | str, zone: str = MARK_ZONE) -> Column:
    """UTC wall clock -> ``yyyy/MM/dd HH:mm`` in ``zone`` (the API's filter
    syntax, minute grain: seconds are cut, not rounded)."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(utc_ntz))
    base, _ = _ntz_parts(local)
    return F.concat(F.translate(F.substring(base, 1, 10), "-", "/"), F.lit(" "), F.substring(base, 12, 5))


def mark_text_to_utc(text: Column | str, zone: str = MARK_ZONE) -> Column:
    """The API filter text back to a UTC wall clock (for table sources)."""
    t = _c(text)
    part = lambda a, n: F.substring(t, a, n).try_cast("int")
    local = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2), F.lit(0).cast("decimal(8,6)"))
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def source_text(utc_ntz: Column | str, offset: str = SOURCE_OFFSET) -> Column:
    """Render a UTC wall clock the way the API writes dates (millis + offset).

    Used to turn columnar rows into API-shaped documents.
    """
    sign = -1 if offset.startswith("-") else 1
    minutes = sign * (int(offset[1:3]) * 60 + int(offset[3:5]))
    local = _c(utc_ntz) + F.expr(f"INTERVAL {minutes} MINUTES")
    base, frac = _ntz_parts(local)
    return F.concat(F.substring(base, 1, 10), F.lit("T"), F.substring(base, 12, 8), F.lit("."), F.substring(frac, 1, 3), F.lit(offset))
