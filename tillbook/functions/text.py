"""Lenient conversions of text cells. Bad input gives NULL, never an error."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Unicode calls white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# The usual ones of these, which are finite, and texts that can be a date of the form yyyy-MM-dd only.
_PLAIN = r"^[+-]?[0-9]{1,300}(\.[0-9]{0,300})?$"
_ISO = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"

# Spreadsheet day numbers count from this day; only first values
# strictly between the two bounds mark a column as day numbers.
SERIAL_EPOCH = "1899-12-30"
SERIAL_MIN, SERIAL_MAX = 30_000, 65_000
_LAST_SERIAL = 2_958_465  # 9999-12-31

# Date formats in the order they are tried.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy")


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed a single time, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(v: Column) -> Column:
    """Remove white space of any kind from both ends.

    A text that begins and ends with a visible ASCII character is left as it is, without a search among ``WHITESPACE``.
    """
    last = F.substring(v, -1, 1)
    bare = (v >= "!") & (v < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(bare, v).otherwise(F.btrim(v, F.lit(WHITESPACE)))


def to_number(v: Column) -> Column:
    """Text as double; NULL unless the whole text is a plain number."""
    return F.when(v.rlike(_PLAIN), v.try_cast("double")).otherwise(_checked(v))


def _checked(v: Column) -> Column:
    return once(v, lambda t: F.when(t.rlike(_NUMBER), t.try_cast("double")))


def to_money(v: Column) -> Column:
    """Text as double after removing commas and white space; NULL unless finite."""
    plain = F.when(v.rlike(_NUMBER), v).otherwise(F.translate(v, "," + WHITESPACE, ""))
    number = once(_checked(plain), lambda n: F.when(F.abs(n) < float("inf"), n))
    return F.when(v.rlike(_PLAIN), v.try_cast("double")).otherwise(number)


def round_quantity(n: Column, half_even: bool = True) -> Column:
    """Number as int, rounded; NULL beyond 32 bits."""
    rounded = F.rint(n) if half_even else F.signum(n) * F.floor(F.abs(n) + 0.5)
    return rounded.try_cast("int")


def is_serial(n: Column) -> Column:
    """TRUE if the number is a day number within the detection bounds."""
    return F.coalesce((n > SERIAL_MIN) & (n < SERIAL_MAX), F.lit(False))


def serial_to_date(n: Column) -> Column:
    """Day number (fraction cut off) as a date; NULL outside the calendar."""
    days = F.when((n >= 1) & (n < _LAST_SERIAL + 1), F.floor(n).cast("int"))
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), days)


def _shape(fmt: str) -> str | None:
    """Pattern of the texts of a format of fixed width; None for other formats."""
    others = re.sub("yyyy|MM|dd", "", fmt)
    if not all(t in fmt for t in ("yyyy", "MM", "dd")) or re.search("[A-Za-z']", others):
        return None
    return re.sub("yyyy|MM|dd", lambda m: "[0-9]{%d}" % len(m[0]), re.escape(fmt).replace("\\-", "-"))


def is_iso(v: Column) -> Column:
    """Does the text look like ``yyyy-MM-dd``? Such a text is no number."""
    return F.coalesce(v.rlike(_ISO), F.lit(False))


def never_iso(fmt: str) -> bool:
    """Does no text that looks like ``yyyy-MM-dd`` fit the format?"""
    shape = _shape(fmt)
    return shape is not None and re.fullmatch(shape, "0000-00-00") is None


def parse_format(v: Column, fmt: str) -> Column:
    """Text as a date of one format, or NULL.

    Year-month-day formats of fixed width are rearranged to ISO and cast, which
    unlike the pattern parser throws no exception per bad value.
    """
    spots, shape = {t: fmt.find(t) for t in ("yyyy", "MM", "dd")}, _shape(fmt)
    if shape is None:
        return F.try_to_date(v, fmt)
    if fmt == "yyyy-MM-dd":
        iso = v
    else:
        iso = F.concat_ws("-", *(F.substring(v, spots[t] + 1, len(t)) for t in ("yyyy", "MM", "dd")))
    return F.when(v.rlike(f"^{shape}$"), iso.try_cast("date"))


def text_to_date(v: Column, chosen: Column, formats=DATE_FORMATS, infer: bool = True) -> Column:
    """Text as a date in the chosen one of ``formats`` (by number); date-times lose their time of day.

    ``infer`` also takes ISO dates with one-digit months or days. With
    ``formats=("yyyy-MM-dd",), infer=False`` only plain ISO dates pass.
    """
    arms = [F.when(chosen == i, parse_format(v, f)) for i, f in enumerate(formats)]
    arms.append(
        F.when(v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}"), v.try_cast("timestamp_ntz").cast("date"))
    )
    if infer:
        arms.append(F.when(v.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), v.try_cast("date")))
    return F.coalesce(*arms)
