"""Text helpers over Columns that agree with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space including the no-break and zero-width-free Unicode spaces.
_EDGE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
#: Line ends that split text into lines: CRLF, LF, CR, VT, FF, FS..RS, NEL, LS, PS.
_LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends; null stays null."""
    return F.regexp_replace(_col(c), _EDGE, "")


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, null where nothing is left."""
    s = strip(c)
    return F.when(s != "", s)


def fold(c: Column | str) -> Column:
    """Text compared without regard to letter case and outer white space; blank becomes null."""
    return F.lower(blank_to_null(c))


def alnum_key(c: Column | str) -> Column:
    """Letters and digits alone, lower case; blank becomes null."""
    s = F.lower(F.regexp_replace(_col(c), r"[^\p{L}\p{N}]", ""))
    return F.when(s != "", s)


def split_lines(c: Column | str) -> Column:
    """Lines of a text as ``str.splitlines`` gives them (no trailing empty line)."""
    text = F.regexp_replace(_col(c), f"(?:{_LINE_ENDS})\\z", "")
    return F.when(_col(c) == "", F.array().cast("array<string>")).otherwise(F.split(text, _LINE_ENDS, -1))


def squeeze(c: Column | str) -> Column:
    """Inner white space runs become one space, outer ones go."""
    return F.regexp_replace(strip(c), r"\s+", " ")
