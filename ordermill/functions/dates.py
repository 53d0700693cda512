"""Date arithmetic on zone-free timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names, English, in full or by their first three letters.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_NAME = r"([A-Za-z]{3,9})\.?"
# What the three groups of a date are, by its form; the slash marks a form where both are numbers, so
# that day and month may change places.
DATE_FORMS = [
    (r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})", "ymd"),
    (r"(\d{4})(\d{2})(\d{2})", "ymd"),
    (r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})", "d/m/y"),
    (rf"(\d{{1,2}})[-\s]{_NAME}[-,\s]+(\d{{4}})", "dmy"),
    (rf"{_NAME}\s+(\d{{1,2}}),?\s+(\d{{4}})", "mdy"),
]
# Hour, minute, second, fraction, half of the day and zone.
_TIME = (
    r"(?:(?:T|\s+)(\d{1,2}):(\d{2})(?::(\d{2})(?:(\.\d{1,6})\d*)?)?"
    r"\s*(?:([aApP])[mM])?\s*(Z|z|UTC|GMT|[+-]\d{2}:?\d{2})?)?"
)
PARTS = "ymd/HMSfhz"


def _one_pass() -> tuple[str, str]:
    """A pattern for every text, and the replacement that turns it into its ``PARTS``, comma-separated.

    Exactly one form matches, so the groups of all forms that stand for a part can be written one after
    another. A text of no form matches the last alternative, which has no groups.
    """
    of, at = {part: "" for part in PARTS}, 0
    for _, order in DATE_FORMS:
        for part in order.replace("/", ""):
            at += 1
            of[part] += f"${at}"
            if part == "m" and "/" in order:
                of["/"] += f"${at}"  # not empty where the two may be swapped
    for part in PARTS[4:]:
        at += 1
        of[part] = f"${at}"
    forms = "|".join(form for form, _ in DATE_FORMS)
    return rf"^\s*(?:{forms}){_TIME}\s*$|(?s)^.*$", ",".join(of.values())


_PATTERN, _REPLACEMENT = _one_pass()


def _month(text: Column) -> Column:
    """The number of a month given in digits or by name; NULL for another word."""
    place = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(text, 1, 3)))
    return F.coalesce(text.try_cast("int"), F.when(place > 0, place.cast("int")))


def _moment(parts: Column) -> Column:
    """The timestamp of split ``PARTS``; NULL if its numbers are no date and time."""

    def part(name: str) -> Column:
        return F.get(parts, F.lit(PARTS.index(name)))

    def number(name: str) -> Column:
        return part(name).try_cast("int")

    year, hour, zone = number("y"), number("H"), part("z")
    # Years of two digits lie in 1969 to 2068.
    year = year + F.when(F.length(part("y")) > 2, 0).when(year < 69, 2000).otherwise(1900)
    half = F.lower(part("h"))
    of_twelve = F.when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    hour = F.when(part("H") == "", 0).when(half == "", hour).otherwise(of_twelve)
    second = F.concat(part("S"), part("f"))
    # A sixtieth second would be carried over instead of being none.
    second = F.when(part("S") == "", 0).when(part("S") < "60", second.try_cast("decimal(16,6)"))
    minute = F.when(part("M") == "", 0).otherwise(number("M"))

    def at(month: Column, day: Column) -> Column:
        return F.try_make_timestamp_ntz(year, month, day, hour, minute, second)

    moment = at(_month(part("m")), number("d"))
    moment = F.coalesce(moment, F.when(part("/") != "", at(number("d"), number("m"))))
    digits = F.translate(zone, "+-:", "")
    ahead = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    shift = F.when(zone.startswith("+"), -ahead).when(zone.startswith("-"), ahead)
    return F.coalesce(moment + F.make_dt_interval(mins=shift), moment)


def parse_mixed_timestamp(raw: Column) -> Column:
    """Read the usual forms of dates, with or without a time; NULL when a text is none of them.

    ISO, ``2024/03/05``, ``20240305``, ``05-03-2024``, ``5-3-24``, ``05 Mar 2024`` and ``March 5, 2024``, with 24 or
    12 hours. Forms that begin with the year are never swapped; others are read day first, and month
    first where that gives no date (``05-25-2024``). A time with a zone is converted to UTC;
    one without stays as it is. One pattern reads a text once, whatever its form.
    """
    parts = F.split(F.regexp_replace(raw, _PATTERN, _REPLACEMENT), ",")
    # The lambda's variable keeps the parts, which the rest refers to many times.
    return F.get(F.transform(F.array(parts), _moment), F.lit(0))


def once(value: Column) -> Column:
    """The value, computed in the projection where it stands and nowhere else.

    A filter on a computed column would move below the projection and compute it again. What
    is not deterministic stays, and the number of a task's partition is, if nothing else, no
    constant.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def stamp_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``. By cast, since formatting goes through the session's time zone,
    in which some local times do not exist."""
    return F.substring(ts.cast("string"), 1, 19)


def day_first_text(ts: Column) -> Column:
    """``DD-MM-YYYY HH:MM:SS``."""
    return F.regexp_replace(stamp_text(ts), r"^(\d+)-(\d+)-(\d+)", "$3-$2-$1")


def month_start(ts: Column) -> Column:
    """The first day of the month. Group by this and format the few results, not every row."""
    return F.trunc(ts, "month")


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days between two timestamps (not the number of midnights)."""
    return F.extract(F.lit("DAY"), end - start).cast("bigint")


def thirty_day_month(start: Column, day: Column) -> Column:
    """Calendar days from ``start`` to ``day`` in steps of 30, truncated toward zero."""
    return (F.date_diff(F.to_date(day), start) / 30).cast("bigint")


def as_date(value: str | dt.date) -> dt.date:
    """Validate a ``YYYY-MM-DD`` argument; anything else raises ``ValueError``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


def end_of(value: str | dt.date) -> Column:
    """The last instant that an argument covers, as a literal: a moment (``YYYY-MM-DD HH:MM:SS``, or a
    datetime without a zone) stands for itself, a bare day for all of it."""
    if isinstance(value, str) and len(value) > 10:
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            raise ValueError("a moment without a zone is asked for")
        return F.lit(value.isoformat(" ", "microseconds")).cast("timestamp_ntz")
    return F.lit(f"{as_date(value).isoformat()} 23:59:59.999999").cast("timestamp_ntz")


def midnight(day: dt.date) -> Column:
    """A zone-free timestamp literal, so that the filter on it reaches the Parquet scan."""
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")
