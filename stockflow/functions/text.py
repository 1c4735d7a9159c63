"""String helpers."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_blanks(text: Column) -> Column:
    """Trim all white space; a plain ``trim`` only takes the space character."""
    return F.trim(text, F.lit(WHITE_SPACE))


def has_tag(tags: Column, tag: str) -> Column:
    """Is ``tag`` one of the comma-separated tags, ignoring case and outer blanks?"""
    each = F.split(F.coalesce(tags, F.lit("")), ",")
    return F.exists(each, lambda one: F.upper(trim_blanks(one)) == F.lit(tag.upper()))


def extract_first(text: Column, pattern: str) -> Column:
    """First group of the first match, NULL without a match.

    The group must not be able to match nothing, as Spark gives '' for no match.
    """
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def matches(text: Column, pattern: str) -> Column:
    """Does the pattern occur in the lower-case text? NULL text counts as empty."""
    return F.lower(F.coalesce(text, F.lit(""))).rlike(pattern)


def fill(template: str, columns: dict[str, str]) -> Column:
    """A text with ``{name}`` replaced by columns; NULL if one of them is.

    ``columns`` maps the names in the template to column names.
    """
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(F.col(columns[name]).cast("string"))
    return F.concat(*parts)
