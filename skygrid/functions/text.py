"""Column expressions on identifiers and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the archive's name tables put behind a place, and how their identifiers look.
#: Place suffixes of names: padded state or province and country, then the compact form of two countries.
PADDED_PLACE = r"\s{2,}(?:[A-Z]{2}\s+)?[A-Z]{2}$"
COMPACT_PLACE = r"\s+[A-Z]{2}\s+(?:US|CA)$"
#: Identifiers in the fixed-width name table.
FOUR_SIGNS = "^[A-Z0-9]{4}$"


def stripped(text: Column) -> Column:
    """Without white space of any kind at the ends (trim knows spaces only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def decoded_id(raw: Column) -> Column:
    """Text of a fixed-width byte identifier: no NULs, no padding; bytes that are no UTF-8 become U+FFFD; "" for null."""
    text = F.make_valid_utf8(raw.cast("string"))
    return F.coalesce(stripped(F.replace(text, F.lit("\x00"), F.lit(""))), F.lit(""))


def as_text(value: Column) -> Column:
    """Any value as text, "" for null."""
    return F.coalesce(value.cast("string"), F.lit(""))


def clean_place_name(text: Column) -> Column:
    """The first 39 characters without their place suffixes."""
    head = F.rtrim(F.substring(text, 1, 39))
    return stripped(F.regexp_replace(F.regexp_replace(head, PADDED_PLACE, ""), COMPACT_PLACE, ""))


def clean_wide_name(text: Column) -> Column:
    """A name of the fixed-width table: underscores are spaces."""
    return stripped(F.replace(text, F.lit("_"), F.lit(" ")))
