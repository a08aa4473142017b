"""Line, chunk and in-place text operations as column expressions. All read the whole text, in linear time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x85\x{2028}\x{2029}]"


def lines(text: Column) -> Column:
    """Lines of ``text`` without their terminators; a final terminator does not start another line."""
    parts = F.split(text, LINE_BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def chunks(text: Column, size: int) -> Column:
    """Consecutive pieces of ``size`` characters; one empty piece for the empty text."""
    pieces = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(pieces)


def chunk_count(text: Column, size: int) -> Column:
    return F.greatest(F.ceil(F.length(text) / F.lit(size)), F.lit(1)).cast("int")


def rewrite_matches(text: Column, pattern: str, rewrite: Callable[[Column], Column]) -> Column:
    """Replace every match, where it stands, by ``rewrite(match)``.

    The text is cut at the matches, so a replacement can depend on the match and never touches equal text
    elsewhere. Rows without a match are returned as they are.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    joined = F.array_join(
        F.zip_with(between, F.transform(found, rewrite), lambda b, r: F.concat(b, F.coalesce(r, F.lit("")))), "")
    return F.when(text.rlike(pattern), joined).otherwise(text)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def stars(match: Column) -> Column:
    """As many asterisks as the match has characters."""
    return F.repeat(F.lit("*"), F.length(match))


def keep_first_char(match: Column) -> Column:
    return F.concat(F.left(match, F.lit(1)), F.repeat(F.lit("*"), F.length(match) - 1))


def percent(ratio: Column) -> Column:
    """Whole percent, halves to the even side."""
    return F.rint(ratio * 100).cast("int")


def trim_space(text: Column) -> Column:
    """Remove white space, not just blanks, on both sides."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def tokens(text: Column) -> Column:
    """Distinct lower-cased words."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def mapping_text(args: Column) -> Column:
    """A string map written as ``{'key': 'value', ...}``."""
    def quoted(s: Column) -> Column:
        escaped = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
        return F.when(s.contains("'") & ~s.contains('"'), F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))
    items = F.transform(F.map_entries(args), lambda e: F.concat(quoted(e["key"]), F.lit(": "), quoted(e["value"])))
    return F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))
