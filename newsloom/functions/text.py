"""Small text expressions shared by extraction and feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters XML 1.0 does not allow.
NOT_XML = "[^\\t\\n\\r\\x20-\\uD7FF\\uE000-\\uFFFD\\x{10000}-\\x{10FFFF}]"

# Replacement per character in markup text and attributes.
MARKUP_ESCAPES = (
    ("&", "&amp;"),
    ("'", "&#39;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&#34;"),
    ("\r", "&#13;"),
)


def trim_field(value: Column) -> Column:
    """Trim space, tab and newline; a carriage return stays."""
    return F.btrim(value, F.lit(" \t\n"))


def escape_markup(value: Column) -> Column:
    for plain, escaped in MARKUP_ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(escaped))
    return value


def xml_text(value: Column) -> Column:
    """Escaped text for an XML document; disallowed characters become U+FFFD."""
    return escape_markup(F.regexp_replace(value, NOT_XML, "�"))


def first_line(value: Column) -> Column:
    return F.substring_index(value, "\n", 1)
