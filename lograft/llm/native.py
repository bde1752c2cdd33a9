"""Column helpers shared by the operators that use DataFrame functions only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters of ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
#: Order of rows without a doc_id: after all others.
NO_ID = (1 << 63) - 1


def no_id(column: Column) -> Column:
    """doc_id as a sortable number; null sorts after every id."""
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def public_id(column: Column) -> Column:
    return F.when(column != F.lit(NO_ID), column)


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character unchanged; ``lower`` does the same on pure ASCII and is faster."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, ascii_uppercase, ascii_lowercase)))


def spaced(text: Column) -> Column:
    """Words of a text joined by single spaces; null counts as empty."""
    return F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_RUN, " "))


def word_array(spaced_text: Column) -> Column:
    return F.when(spaced_text == "", F.array().cast("array<string>")).otherwise(F.split(spaced_text, " "))
