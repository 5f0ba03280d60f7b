"""Column functions over physical lines and record text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks the place inside a field where a physical line ended.
CUT = "\u0000"
# First physical line of a record: a number, a semicolon, a letter.
RECORD_START = r"^\s*\d+\s*;\s*[A-Za-z]"
# Every character Unicode counts as white space, plus the four ASCII separators.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def is_record_start(line: Column) -> Column:
    return line.rlike(RECORD_START)


def join_physical_lines(text: Column) -> Column:
    """Join a record's physical lines, held in one text separated by line feeds.

    In order: a line ending in ";" or a next line starting with ";" needs nothing between them; a next
    line starting with one space and a value lost its ";"; any other break fell inside a field and
    leaves a mark there.
    """
    joined = F.replace(text, F.lit(";\n"), F.lit(";"))
    joined = F.replace(joined, F.lit("\n;"), F.lit(";"))
    joined = F.regexp_replace(joined, "\n (?=[^ \n])", "; ")
    joined = F.replace(joined, F.lit("\n"), F.lit(CUT))
    return F.when(text.contains("\n"), joined).otherwise(text)


def without_cuts(text: Column) -> Column:
    return F.replace(text, F.lit(CUT), F.lit(""))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def unquoted_fields(text: Column) -> Column:
    """Split on ";" honouring double quotes: a quoted field may hold ";" and doubles its quotes."""
    # With a ";" in front of every field no match is empty, so none is skipped.
    led = F.concat(F.lit(";"), text)
    fields = F.regexp_extract_all(led, F.lit(r';("(?:[^"]++|"")*+"?[^;]*+|[^;]*+)'), F.lit(1))

    def unquote(field: Column) -> Column:
        inner = F.regexp_extract(field, r'^"((?:[^"]++|"")*+)', 1)
        rest = F.regexp_extract(field, r'^"(?:[^"]++|"")*+"?([^;]*+)$', 1)
        return F.when(
            field.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)
        ).otherwise(field)

    return F.transform(fields, unquote)
