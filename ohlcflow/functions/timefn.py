"""Calendar functions (FN-1, FN-6..14) as Column expressions.

All run in the session zone, which the library pins to UTC; Seoul appears
only where the reference renders dates in it. Month steps use ``add_months``:
it clamps to the month end once and never fails (quirk Q7: a chain of
single-month steps from the 29th-31st can differ, and fails for days the
previous month lacks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import KST_ZONE, TIME_FORMAT

# --- Fixed values: text formats tried, in order, when parsing free text,
# each with the shape a text must have before that format is tried; no format:
# ISO 8601 with optional fraction and offset, as Spark's own cast reads it. ---
DATETIME_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy-M-d H:mm:ss"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{2}:\d{2}$", "yyyy-M-d'T'H:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([zZ]|[+-]\d{2}:?\d{2})?$", None),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}$", "yyyy-M-d H:mm"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
)
# --- end of fixed values ---


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_to_text(seconds: str | Column) -> Column:
    """FN-1: epoch seconds to ``yyyy-MM-dd HH:mm:ss``."""
    return F.from_unixtime(_c(seconds), TIME_FORMAT)


def today_kst() -> Column:
    """FN-6: today's date in Seoul."""
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), KST_ZONE))


def utc_to_kst_date(ts: str | Column) -> Column:
    """FN-7: a UTC instant (timestamp or text) to its Seoul date as text."""
    c = _c(ts).try_cast("timestamp")  # bad text gives null
    return F.date_format(F.from_utc_timestamp(c, KST_ZONE), "yyyy-MM-dd")


def months_before(d: str | Column, months: int = 1) -> Column:
    """FN-8/9: ``months`` months back (one month back by default)."""
    return F.add_months(_c(d), -months)


def years_before(d: str | Column, years: int) -> Column:
    """FN-9: ``years`` years back as 12*years months."""
    return F.add_months(_c(d), -12 * years)


def days_before(d: str | Column, days: int) -> Column:
    """FN-10: ``days`` days back, a date."""
    return F.date_sub(_c(d), days)


def datetime_days_before(d: str | Column, days: int) -> Column:
    """FN-10: midnight ``days`` days back, a timestamp."""
    return F.date_sub(_c(d), days).cast("timestamp")


def hours_before_midnight(d: str | Column, hours: int) -> Column:
    """FN-11: midnight of ``d`` minus ``hours`` hours."""
    return F.to_date(_c(d)).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours))


# --- Fixed values: what a free-form text is made of (matched in lower case). ---
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
WEEKDAY = r"\b(?:mon|tue(?:s)?|wed(?:nes)?|thu(?:rs|r)?|fri|sat(?:ur)?|sun)(?:day)?\b\.?,?"
# Zone names and their offsets; any other name makes a text no time.
ZONES = {"z": "+00:00", "utc": "+00:00", "gmt": "+00:00", "kst": "+09:00"}
_NAMES = "|".join(ZONES)
_ZONE = rf"(?:\s*\(?((?:{_NAMES})?\s*[+-]\d{{2}}:?\d{{2}}|[+-]\d{{2}}|(?:{_NAMES})\b)\)?)?"
_HALF = r"([ap])\.?m\.?(?![a-z])"
CLOCK = rf"(?<![\d.])(\d{{1,2}}):(\d{{2}})(?::(\d{{2}})(?:[.,](\d{{1,9}}))?)?(?:\s*{_HALF})?{_ZONE}"
HOUR = rf"(?<![\d.:])(\d{{1,2}})\s*{_HALF}{_ZONE}"
_SEP = r"[\s./,-]+"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_YEAR = r"('?\d{2}|\d{4})"
# Shapes of a date and the places of its year, month and day. Where all three are numbers the
# second group decides: see parse_free.
DATE_SHAPES = (
    (rf"^{_DAY}(?:\s*of)?[\s./-]*{MONTH}[\s./,-]*{_YEAR}$", "$3|$2|$1"),
    (rf"^{MONTH}[\s./-]*{_DAY}{_SEP}{_YEAR}$", "$3|$1|$2"),
    (rf"^(\d{{4}})[\s./,-]*{MONTH}[\s./-]*{_DAY}$", "$1|$2|$3"),
    (r"^(\d{4})([-/. ])(1[3-9]|[23]\d)\2(\d{1,2})$", "$1|$4|$3"),
    (r"^(\d{4})([-/. ])(\d{1,2})\2(\d{1,2})$", "$1|$3|$4"),
    (rf"^(1[3-9]|[23]\d)([-/. ])(\d{{1,2}})\2{_YEAR}$", "$4|$3|$1"),
    (rf"^(\d{{1,2}})([-/. ])(\d{{1,2}})\2{_YEAR}$", "$4|$1|$3"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1|$2|$3"),
)
# Digits without colons after a date of eight digits.
COMPACT = r"^(\d{8})[t ]?(\d{2})(\d{2})(\d{2})?"
# --- end of fixed values ---


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _clock(t: Column) -> Column:
    """``struct(rest, hour, minute, second, micros, offset)`` of a lower-case text: its time of
    day taken out. A text without one is midnight; ``hour`` is null where it cannot be."""

    def of(found: Column, pattern: str, minute: int, second: int, frac: int, half: int, zone: int) -> Column:
        def part(k: int) -> Column:
            return F.regexp_extract(found, pattern, k)

        hour, pm, z = part(1).cast("int"), part(half), F.regexp_replace(part(zone), r"\s", "")
        # Twelve is the first hour of a half; 13 has none.
        whole = F.when(pm == "", hour).when(hour.between(1, 12), hour % 12 + F.when(pm == "p", 12).otherwise(0))
        names = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
        digits = F.regexp_replace(z, rf"^(?:{_NAMES})|:", "")
        sign = F.when(digits.startswith("-"), -1).otherwise(1)
        named = F.element_at(names, F.when(digits == "", z))
        east = sign * (F.substring(digits, 2, 2).try_cast("int") * 3600 + F.coalesce(F.substring(digits, 4, 2).try_cast("int"), F.lit(0)) * 60)
        named_s = F.substring(named, 2, 2).cast("int") * 3600 + F.substring(named, 5, 2).cast("int") * 60
        return F.struct(
            F.regexp_replace(t, pattern, " ").alias("rest"),
            whole.alias("hour"),
            (F.coalesce(part(minute).try_cast("int"), F.lit(0)) if minute else F.lit(0)).alias("minute"),
            (F.coalesce(part(second).try_cast("int"), F.lit(0)) if second else F.lit(0)).alias("second"),
            (F.coalesce(F.rpad(F.substring(part(frac), 1, 6), 6, "0").try_cast("int"), F.lit(0)) if frac else F.lit(0)).alias("micros"),
            F.when(z == "", 0).when(digits == "", named_s).otherwise(east).alias("offset"),
        )

    def compact() -> Column:
        part = lambda k: F.regexp_extract(t, COMPACT, k).try_cast("int")
        zone = F.regexp_extract(t, COMPACT + r"\s*(z|utc|gmt)?$", 0)
        zero = F.lit(0)
        return F.struct(
            F.when(zone != "", F.regexp_extract(t, COMPACT, 1)).otherwise(t).alias("rest"),
            part(2).alias("hour"), part(3).alias("minute"), F.coalesce(part(4), zero).alias("second"),
            zero.alias("micros"), zero.alias("offset"),
        )

    none = F.struct(t.alias("rest"), *[F.lit(0).alias(c) for c in ("hour", "minute", "second", "micros", "offset")])
    return (
        F.when(t.rlike(CLOCK), of(F.regexp_extract(t, CLOCK, 0), CLOCK, 2, 3, 4, 5, 6))
        .when(t.rlike(HOUR), of(F.regexp_extract(t, HOUR, 0), HOUR, 0, 0, 0, 2, 3))
        .when(t.rlike(COMPACT), compact())
        .otherwise(none)
    )


def _date(rest: Column) -> Column:
    """``year|month|day`` of what is left of a text, as it has them; null for no shape."""
    out = F.lit(None).cast("string")
    for pattern, order in reversed(DATE_SHAPES):
        out = F.when(rest.rlike(pattern), F.regexp_replace(rest, pattern, order)).otherwise(out)
    return out


def parse_free(text: str | Column) -> Column:
    """FN-12: a date and time written freely, as an instant in the session zone (UTC).

    The text is taken apart by token classes: a time of day (24 hours, or a half of the day;
    fractions to microseconds) with its zone (``Z``, names in ``ZONES``, offsets), which may
    stand before or after the date; a weekday, which is passed over; and a date, which must be all
    that is left: a month's name with day and year in any of their orders, three numbers with
    one separator, or eight digits.

    **Ambiguous dates.** A first number of four digits is the year. Of three numbers without
    one the last is the year and the first the month, unless it is over 12: then it is the day;
    after a year the second number is the month, unless it is over 12. Years of two digits are
    1969 to 2068. A date without a year, a zone name that is not listed, a day that its month
    does not have and anything else give null."""
    number = F.create_map(*[F.lit(x) for n, m in enumerate(MONTHS) for x in (m, n + 1)])

    def made(c: Column) -> Column:
        def whole(d: Column) -> Column:
            part = lambda k: F.get(F.split(d, r"\|"), F.lit(k))
            y = F.regexp_replace(part(0), "'", "").try_cast("int")
            year = F.when(y >= 100, y).when(F.length(part(0)) == 4, y).otherwise(y + F.when(y >= 69, 1900).otherwise(2000))
            month = F.coalesce(part(1).try_cast("int"), F.try_element_at(number, F.substring(part(1), 1, 3)))
            day = part(2).try_cast("int")
            second = (c["second"] + c["micros"] / F.lit(1_000_000)).cast("decimal(8,6)")
            at = F.try_make_timestamp(year, month, day, c["hour"], c["minute"], second)
            return F.timestamp_micros(F.unix_micros(at) - c["offset"].cast("long") * 1_000_000)

        rest = F.regexp_replace(F.regexp_replace(c["rest"], WEEKDAY, " "), r"\b(at|the)\b", " ")
        rest = F.regexp_replace(F.regexp_replace(rest, r"\s+", " "), r"^[\s,t]+(?=\d)|^[\s,]+|[\s,]+$|(?<=\d)t\s*$", "")
        return _let(_date(rest), whole)

    return _let(_clock(F.lower(F.trim(_c(text)))), made)


def parse_datetime(
    text: str | Column, formats: Sequence[tuple[str, str | None]] = DATETIME_FORMATS, free: bool = True
) -> Column:
    """FN-12: by the first listed format whose shape the text has; a text that is none of these
    is taken apart by :func:`parse_free` (unless ``free`` is off: then it is null).

    The shape test is a cheap regex, so only the matching parser runs per row
    (a failed parse attempt costs an exception), and the common forms never reach the
    free one. A text with an offset is an instant, shown in the session zone.
    """
    c = F.trim(_c(text))
    out = F.lit(None).cast("timestamp")
    # The cast wants a colon in the offset and a capital Z.
    iso = F.regexp_replace(F.upper(c), r"([+-]\d{2})(\d{2})$", "$1:$2").try_cast("timestamp")
    for pattern, fmt in reversed(formats):
        value = iso if fmt is None else F.try_to_timestamp(c, F.lit(fmt))
        out = F.when(c.rlike(pattern), value).otherwise(out)
    return F.coalesce(out, parse_free(c)) if free else out


def parse_date(
    text: str | Column, formats: Sequence[tuple[str, str | None]] = DATETIME_FORMATS, free: bool = True
) -> Column:
    """FN-12: date part of :func:`parse_datetime`."""
    return F.to_date(parse_datetime(text, formats, free))


def date_to_datetime(d: str | Column) -> Column:
    """FN-13: midnight of a date."""
    return F.to_date(_c(d)).cast("timestamp")


def to_epoch_seconds(ts: str | Column) -> Column:
    """FN-14: epoch seconds of a date or timestamp in the session zone (truncating)."""
    return F.unix_timestamp(_c(ts).cast("timestamp"))
