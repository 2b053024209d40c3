"""Small string and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python counts as white space. (?U) makes \s follow the Unicode
# property; the four separators U+001C-U+001F are the ones that property leaves out.
# They are listed singly, which Java tests faster than a range.
SPACES = r"(?U)[\s\x1c\x1d\x1e\x1f]+"
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

PREVIEW_CHARS = 80
ELLIPSIS = "..."
RUN_STAMP = "yyyyMMdd_HHmmss"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (`F.trim` removes blanks only)."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def first_field(line: Column) -> Column:
    """Text before the first comma; quotes have no meaning here."""
    return F.split_part(line, F.lit(","), F.lit(1))


def preview(text: Column, size: int = PREVIEW_CHARS, always_mark: bool = False) -> Column:
    """First `size` characters; the mark follows if text was cut, or always on request."""
    head = F.substring(text, 1, size)
    marked = F.concat(head, F.lit(ELLIPSIS))
    return marked if always_mark else F.when(F.length(text) > size, marked).otherwise(text)


def escape_dollar(label: Column) -> Column:
    """Put a backslash before `$`, which chart labels would read as math markup."""
    return F.replace(label, F.lit("$"), F.lit("\\$"))


def base_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def normal_label(label: Column) -> Column:
    """Lower-cased label; a missing one becomes the empty string."""
    return F.lower(F.coalesce(label, F.lit("")))


def run_stamp(moment: Column) -> Column:
    """Timestamp in the form result files carry in their names."""
    return F.date_format(moment, RUN_STAMP)


def event_time(created_at: Column) -> Column:
    """Parse a time; malformed input gives NULL instead of an ANSI error."""
    return F.try_to_timestamp(created_at)


def iso_time(moment: Column) -> Column:
    """Timestamp as ISO-8601 text with zone, the form messages carry."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
