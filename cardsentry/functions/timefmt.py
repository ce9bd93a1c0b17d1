"""Time arithmetic and text formatting as column expressions.

Differences are taken on ``TIMESTAMP_NTZ`` wall-clock values as exact
integers of microseconds and never depend on the session time zone (no DST
jumps).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start, end) -> Column:
    """Exact ``end - start`` in microseconds (BIGINT)."""
    return epoch_micros(end) - epoch_micros(start)


def abs_hours_from_millis(a, b) -> Column:
    """Absolute duration in hours computed from whole milliseconds
    (the duration is truncated to ms first, then divided as a double)."""
    millis = F.floor(F.abs(micros_between(a, b)) / F.lit(1000))
    return millis.cast("double") / F.lit(3_600_000.0)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01T00:00 of a wall-clock timestamp.

    Built from the wall-clock fields read as UTC, so the result never depends
    on the session time zone (``timestampdiff``/``unix_micros`` would first
    cast TIMESTAMP_NTZ to a zoned timestamp and shift across DST changes).
    """
    ts = _col(ts)
    as_utc = F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
                              F.extract(F.lit("SECOND"), ts), F.lit("UTC"))
    return F.unix_micros(as_utc)


def utc_wall_clock(ts) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ of its UTC wall clock, whatever
    the session time zone (a plain cast would use the session zone)."""
    secs = (F.unix_micros(_col(ts)) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=secs)


def days_since_epoch(ts) -> Column:
    """Fractional days since the epoch (chart colour axis)."""
    return epoch_micros(ts).cast("double") / F.lit(86_400_000_000.0)


def format_2dp(x) -> Column:
    """``String.format("%.2f", x)``: HALF_UP on the shortest decimal form,
    ``Infinity`` / ``NaN`` spelled out.  Spark's ``format_string`` is the
    same JVM formatter."""
    return F.format_string("%.2f", _col(x))


def local_datetime_text(ts) -> Column:
    """ISO text of a ``LocalDateTime``: ``yyyy-MM-ddTHH:mm`` and then
    ``:ss`` only if seconds or fraction are non-zero, and the fraction in
    groups of three digits (``.SSS`` or ``.SSSSSS``)."""
    ts = _col(ts)
    micros = F.pmod(epoch_micros(ts), F.lit(60_000_000))   # seconds + fraction
    frac = F.pmod(micros, F.lit(1_000_000))
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm")
    secs = F.date_format(ts, ":ss")
    frac_text = (F.when(frac == 0, F.lit(""))
                 .when(F.pmod(frac, F.lit(1000)) == 0, F.concat(F.lit("."), F.date_format(ts, "SSS")))
                 .otherwise(F.concat(F.lit("."), F.date_format(ts, "SSSSSS"))))
    return F.when(micros == 0, base).otherwise(F.concat(base, secs, frac_text))


def iso_local_datetime_text(ts) -> Column:
    """``DateTimeFormatter.ISO_LOCAL_DATE_TIME`` text: seconds always, the
    fraction only when non-zero and without trailing zeros."""
    ts = _col(ts)
    frac = F.regexp_replace(F.date_format(ts, "SSSSSS"), "0+$", "")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(frac == "", base).otherwise(F.concat(base, F.lit("."), frac))


def parse_timestamp_ntz(s) -> Column:
    """Parse ISO text with or without fraction / ``T`` separator; NULL when invalid."""
    return _col(s).cast("string").try_cast("timestamp_ntz")


def parse_timestamp_pattern(s, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """``datetime.strptime(s, '%Y-%m-%d %H:%M:%S')`` as a column; NULL when invalid."""
    return F.try_to_timestamp(_col(s), F.lit(pattern)).cast("timestamp_ntz")


_TIME = "[ H:mm[:ss[.SSSSSS]]]"
_CLOCK = r"( \d{1,2}:\d\d(:\d\d(\.\d{1,6})?)?)?"
#: Shapes of a date text and the patterns to try on it, in turn.  A date of three numbers
#: is month first, day first where that gives no month.
MIXED_SHAPES = [
    (rf"\d{{1,2}}/\d{{1,2}}/\d{{4}}{_CLOCK}", ["M/d/yyyy" + _TIME, "d/M/yyyy" + _TIME]),
    (rf"\d{{1,2}}\.\d{{1,2}}\.\d{{4}}{_CLOCK}", ["M.d.yyyy" + _TIME, "d.M.yyyy" + _TIME]),
    (rf"\d{{1,2}}-\d{{1,2}}-\d{{4}}{_CLOCK}", ["M-d-yyyy" + _TIME, "d-M-yyyy" + _TIME]),
    (rf"\d{{4}}/\d{{1,2}}/\d{{1,2}}{_CLOCK}", ["yyyy/M/d" + _TIME]),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d\d(:\d\d)? [AP]M", ["M/d/yyyy h:mm[:ss] a", "d/M/yyyy h:mm[:ss] a"]),
    (r"\d{8}", ["yyyyMMdd"]),
    (r"\d{8}[T ]?\d{6}", ["yyyyMMdd['T'][ ]HHmmss"]),
    (rf"[A-Z][a-z]{{2}} \d{{1,2}},? \d{{4}}{_CLOCK}", ["MMM d[,] yyyy" + _TIME]),
    (rf"[A-Z][a-z]{{3,8}} \d{{1,2}},? \d{{4}}{_CLOCK}", ["MMMM d[,] yyyy" + _TIME]),
    (rf"\d{{1,2}} [A-Z][a-z]{{2}} \d{{4}}{_CLOCK}", ["d MMM yyyy" + _TIME]),
    (rf"\d{{1,2}} [A-Z][a-z]{{3,8}} \d{{4}}{_CLOCK}", ["d MMMM yyyy" + _TIME]),
]


def parse_timestamp_mixed(s) -> Column:
    """Parse each text by its own shape (``MIXED_SHAPES``), ISO text first; NULL when none fits.

    The wall clock is read as it stands, whatever the session's time zone."""
    text = F.trim(_col(s).cast("string"))
    # with a zone in the text no session zone takes part
    at = lambda p: utc_wall_clock(F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(p + " XXX")))
    shaped = None
    for shape, patterns in MIXED_SHAPES:
        value = F.coalesce(*[at(p) for p in patterns]) if len(patterns) > 1 else at(patterns[0])
        fits = text.rlike(f"^({shape})$")
        shaped = F.when(fits, value) if shaped is None else shaped.when(fits, value)
    return shaped.otherwise(parse_timestamp_ntz(text))
