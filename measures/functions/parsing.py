"""Row-level parsing and typing (S1-S5, S7, S8, S16-S18) as built-in column expressions.

Everything here is a Catalyst expression: it stays inside whole-stage codegen
and needs no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from measures.schema import LOW_QUALITY_THRESHOLD, MISSING_TOKENS

# --- Fixed values (must equal the reference's for identical results) --------
# A plain unsigned decimal number (value_num), and a "systolic/diastolic"
# pair (bp_systolic / bp_diastolic); both matched on the trimmed value.  `\z`
# anchors at the very end (Java's `$` would also accept a trailing newline).
_PLAIN_NUMBER = r"^[0-9]+(\.[0-9]+)?\z"
_BP_PAIR = r"^[0-9]+/[0-9]+\z"
# Quality is clamped to [0, 1] and stored as DECIMAL(3,2).
_QUALITY_LOW, _QUALITY_HIGH, _QUALITY_TYPE = 0.0, 1.0, "decimal(3,2)"
# -----------------------------------------------------------------------------
# Surrounding whitespace as a general "strip" removes it (spaces, tabs,
# line breaks, Unicode spaces), not only ASCII blanks like `trim`.
_EDGE_WS = r"(?U)^\s+|\s+$"
# ISO-8601 dates: calendar (year, year-month, day), week and ordinal forms; a
# time of hours, minutes or seconds with a fraction; and a zone as Z or offset.
_ISO_DATE = (r"(?:(\d{4})(?:-(\d{2}))?|(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})"
             r"|(\d{4})-?W(\d{2})(?:-?(\d))?|(\d{4})-?(\d{3}))")
_ISO_TIME = r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?"
_ISO = "^" + _ISO_DATE + _ISO_TIME + r"\z"
# The usual extended form, which a plain cast reads as it stands.
_ISO_USUAL = (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?\z")
# A number as text; no type suffixes and no hexadecimal.
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\z"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_missing(c: Column | str) -> Column:
    """Map the fixed set of missing-value tokens to NULL (trap T21)."""
    c = _c(c)
    return F.when(c.isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(c)


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of every kind (S3, trap T7).

    Text that begins and ends in a visible ASCII character, as most does, has
    none and skips the pattern."""
    c = _c(c)
    bare = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(bare, c).otherwise(F.regexp_replace(c, _EDGE_WS, ""))


def parse_timestamp_utc(c: Column | str) -> Column:
    """ISO-8601 text -> UTC wall clock as TIMESTAMP_NTZ (S1, traps T4, T5).

    Offsets are honoured: the text is read as an instant (session zone UTC for
    zone-less text), then its UTC wall clock is kept.  NULL when unreadable;
    the per-file gate turns that into a failed file.

    The rarer forms are a lambda over the one text: written out in place, their
    parts would make the generated method of the whole projection too long for
    the JVM to compile, and every row would be interpreted.
    """
    c = _c(c)
    return F.when(c.rlike(_ISO_USUAL), F.try_to_timestamp(c).cast("timestamp_ntz")).when(
        c.rlike(_ISO), F.get(F.transform(F.array(c), _rarer_iso), F.lit(0)))


def _rarer_iso(c: Column) -> Column:
    """Any ISO-8601 form, from its parts: day + time of day - offset."""
    def part(i: int) -> Column:
        found = F.regexp_extract(c, _ISO, i)
        return F.when(found != "", found)

    def number(*groups: int, default: int | None = None) -> Column:
        return F.coalesce(*map(part, groups), F.lit(default)).cast("int")

    def date(*parts: Column) -> Column:
        text = F.format_string("%04d-%02d-%02d", *parts)
        return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")

    year = number(1, 3, 6, 9, 12)
    calendar = date(year, number(2, 4, 7, default=1), number(5, 8, default=1))
    week, weekday = number(10), number(11, default=1)
    fourth = date(year, F.lit(1), F.lit(4))  # always in week 1
    by_week = F.when(week.between(1, 53) & weekday.between(1, 7), F.date_add(
        fourth, (week - 1) * 7 + weekday - 1 - F.weekday(fourth)))
    ordinal = F.date_add(date(year, F.lit(1), F.lit(1)), number(13) - 1)
    ordinal = F.when((number(13) >= 1) & (F.year(ordinal) == year), ordinal)
    day = F.when(part(10).isNotNull(), by_week).when(part(13).isNotNull(), ordinal).otherwise(
        calendar)
    hour, minute, second = (number(i, default=0) for i in (14, 15, 16))
    micros = F.rpad(F.substring(F.coalesce(part(17), F.lit("0")), 1, 6), 6, "0").cast("bigint")
    zone = F.regexp_replace(F.coalesce(part(18), F.lit("Z")), ":", "")
    shift = F.when(zone == "Z", F.lit(0)).otherwise(
        F.concat(F.substring(zone, 1, 1), F.lit("1")).cast("int")
        * (F.substring(zone, 2, 2).cast("int") * 60
           + F.coalesce(F.substring(zone, 4, 2).try_cast("int"), F.lit(0))))
    of_day = (hour * 3600 + minute * 60 + second).cast("bigint") * 1_000_000 + micros
    valid = (minute < 60) & (second < 60) & (
        (hour < 24) | ((hour == 24) & (of_day == F.lit(86_400_000_000))))
    start = F.unix_micros(day.cast("timestamp"))
    return F.when(valid, F.timestamp_micros(
        start + of_day - shift.cast("bigint") * 60_000_000).cast("timestamp_ntz"))


def clamp_quality(c: Column | str) -> Column:
    """Quality text -> number clamped to [0, 1], stored as DECIMAL(3,2).

    Unreadable, missing and NaN become NULL; `least/greatest` alone would turn
    NULL into 0 and NaN into 1.
    """
    text = F.trim(_c(c).cast("string"))
    q = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    clamped = F.least(F.greatest(q, F.lit(_QUALITY_LOW)), F.lit(_QUALITY_HIGH))
    return F.when(q.isNull() | F.isnan(q), F.lit(None)).otherwise(clamped).cast(_QUALITY_TYPE)


def value_num(c: Column | str = "value") -> Column:
    """Numeric reading when the trimmed text is a plain unsigned number."""
    v = F.trim(_c(c))
    return F.when(v.rlike(_PLAIN_NUMBER), v.try_cast("double"))


def is_bp_pair(c: Column | str = "value") -> Column:
    return F.trim(_c(c)).rlike(_BP_PAIR)


def bp_part(c: Column | str, index: int) -> Column:
    """Systolic (1) or diastolic (2) reading of a `120/80` value.

    `try_cast` keeps an over-long number from failing the whole job; the gate
    reports it as an integer overflow instead.
    """
    v = F.trim(_c(c))
    return F.when(v.rlike(_BP_PAIR), F.split_part(v, F.lit("/"), F.lit(index)).try_cast("int"))


def bp_overflow(c: Column | str = "value") -> Column:
    """True when a blood-pressure pair matches but a side does not fit INT."""
    return is_bp_pair(c) & (bp_part(c, 1).isNull() | bp_part(c, 2).isNull())


def is_low_quality(c: Column | str = "quality_score") -> Column:
    """quality < 0.95 on the stored DECIMAL(3,2) value (P8, T3): 0.949 -> 0.95 is not low."""
    return _c(c) < F.lit(LOW_QUALITY_THRESHOLD).cast(_QUALITY_TYPE)


def as_day(c: Column | str = "timestamp") -> Column:
    """Truncate a timestamp to its calendar day."""
    return F.to_date(_c(c))


def batch_instant(instant=None) -> Column:
    """Load time for processed_at / created_at (S7, S18): a fixed instant when
    given (replays stay deterministic), else the query start time."""
    if instant is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(instant).cast("timestamp_ntz")
