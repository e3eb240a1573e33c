"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The whitespace that a text strip removes. Spark's own trim removes spaces only.
WHITESPACE = (
    " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: runs of letters, with the comma inside the class, so "now," is a word.
WORD_PATTERN = "[A-Z,a-z]+"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def decode(payload: Column) -> Column:
    return F.decode(payload, "UTF-8")


def encode(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def fields(line: Column, names: list[str], separator: str = ",") -> list[Column]:
    """One column per position of a delimited line; NULL where the line is too short."""
    # A single character, escaped if need be, splits without a compiled pattern.
    plain = separator.isalnum() or separator in ",;:"
    parts = F.split(line, separator if plain else f"\\{separator}", -1)
    return [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names)]


def scrub_timestamp(text: Column) -> Column:
    r"""Drop written-out ``\r`` and ``\n`` marks and quotes from a timestamp text."""
    return F.regexp_replace(strip(text), r"\\r|\\n|'", "")


def is_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def joined(values: Column, separator: str = ", ") -> Column:
    """The elements of a list as one text."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), separator)


def length_between(text: Column, lower: int, upper: int | None = None) -> Column:
    """Length in ``[lower, upper]``; no upper bound when it is None."""
    length = F.length(text)
    return length >= lower if upper is None else length.between(lower, upper)


def words(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """All matches of the pattern as an array."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
