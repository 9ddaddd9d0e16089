"""Text: two meanings of "trim", joining, and safe column names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every kind of white space, the no-break space and the byte-order mark included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def trimmed(c: Column) -> Column:
    """Strip spaces (only spaces) from both ends; blank becomes null."""
    return F.nullif(F.trim(c), F.lit(""))


def stripped(c: Column) -> Column:
    """Strip all white space from both ends; blank becomes null."""
    return F.nullif(strip_white(c), F.lit(""))


def strip_white(c: Column) -> Column:
    """Strip all white space from both ends; blank stays blank."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def joined(*parts: Column) -> Column:
    """The parts that are not null, one space between them; null when nothing is left."""
    return trimmed(F.concat_ws(" ", *parts))


def safe_name(raw: str) -> str:
    """A header label as a lower-case snake_case column name."""
    label = raw.replace("\ufeff", "").strip().lower()
    name = re.sub(r"[^a-z0-9]+", "_", label).strip("_")
    return name if re.match(r"[a-z]", name) else f"_{name}"


def safe_name_column(c: Column) -> Column:
    """``safe_name`` for a column that holds header labels."""
    words = F.regexp_replace(F.lower(F.regexp_replace(c, r"\x{FEFF}", "")), "[^a-z0-9]+", "_")
    name = F.regexp_replace(words, "^_+|_+$", "")
    return F.when(name.rlike("^[a-z]"), name).otherwise(F.concat(F.lit("_"), name))
