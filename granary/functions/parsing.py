"""Lenient scalar parsing and the rounding rules of the three layers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace that a text is stripped of.
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

#: What counts as a number: digits with optional sign, point and exponent.
NUMBER = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"


def stripped(c: Column) -> Column:
    """Text without whitespace at its ends, tabs and line ends too."""
    return F.btrim(c, F.lit(_BLANKS))


def num(c: Column, default: float = 0.0) -> Column:
    """Text to double; the default where it is blank or no number."""
    plain = F.regexp_replace(stripped(c), "_", "")
    return F.coalesce(F.when(c.rlike(NUMBER), plain.try_cast("double")), F.lit(default))


def truncated(c: Column, default: float = 0.0) -> Column:
    return num(c, default).cast("int")


def falsy(c: Column, default, zero: bool = True) -> Column:
    """``c or default``: null, the empty text and, with ``zero``, 0 are replaced."""
    none = c.isNull() | (c.cast("string") == "")
    if zero:
        none = none | (c.try_cast("double") == 0)
    return F.when(F.coalesce(none, F.lit(False)), F.lit(default)).otherwise(c)


def tokens(c: Column) -> Column:
    """Words of a text as an array; empty for null or blank."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda x: x != "")


def joined(c: Column) -> Column:
    """Array of names to trimmed text, blanks dropped."""
    return F.concat_ws(" ", F.filter(F.transform(c, stripped), lambda x: x != ""))


def pairs(c: Column) -> Column:
    """``a:1 b:2`` to a map; words without ``:`` are skipped, the last of
    equal names wins, and only the field after the first ``:`` counts."""
    parts = F.transform(F.filter(tokens(c), lambda x: x.contains(":")), lambda x: F.split(x, ":"))
    last = F.filter(parts, lambda p, i: ~F.exists(F.slice(parts, i + 2, F.size(parts) + 1), lambda q: q[0] == p[0]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p[0].alias("key"), p[1].cast("double").alias("value"))))


def half_up(c: Column, places: int = 1) -> Column:
    """Half towards plus infinity, as the browser layer rounds."""
    scale = 10**places
    return F.floor(c * scale + 0.5) / scale


def half_even(c: Column, places: int) -> Column:
    """The nearest multiple of 10^-places to the exact binary value, ties to
    even, as the server layer rounds: 2.675 is below its tie, 0.25 is one."""
    scale = float(10**places)
    p = c * scale
    # What the product lost in rounding, by splitting ``c`` into two halves.
    big = c * 134217729.0
    high = big - (big - c)
    lost = (high * scale - p) + (c - high) * scale
    low = F.floor(p).cast("double")
    part = p - low
    up = (part > 0.5) | ((part == 0.5) & ((lost > 0) | ((lost == 0) & (low % 2 != 0))))
    return F.when(F.abs(p) >= 2.0**52, c).otherwise(F.when(up, low + 1).otherwise(low) / scale)


def trimmed(c: Column, places: int) -> Column:
    """Rounded text without trailing zeros, never with an exponent; null for null."""
    text = F.format_string(f"%.{places}f", half_even(c, places))
    text = F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
    return F.when(text == "-0", "0").when(c.isNotNull(), text)


def name_contains(c: Column, q: str) -> Column:
    return F.lower(c).contains(q.strip().lower())


def run_of(shelf: Column) -> Column:
    return F.when(shelf <= 3, "fresh").when(shelf <= 14, "weekly").otherwise("staple")
