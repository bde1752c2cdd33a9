"""Column expressions with the exact semantics of Java string methods.

The messages were produced for (and the reference parses them with) Java
``String.split`` / ``String.trim``.  Spark's built-ins differ in ways that
change answers, so each rule is restated here with native expressions only:

* ``String.split(regex)`` drops trailing empty pieces, except that an input
  without any match comes back whole (``"" -> [""]``).  Spark keeps them.
* ``String.trim()`` strips every char <= U+0020; Spark ``trim`` only spaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lograft.functions.frames import let

# Fixed value: the characters Java's String.trim() removes (U+0000..U+0020).
JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x00, 0x21))


def java_trim(col: Column) -> Column:
    return F.trim(col, F.lit(JAVA_TRIM_CHARS))


_REGEX_META = set(".$|()[{^?*+\\")


def java_split(col: Column, regex: str) -> Column:
    """``col.split(regex)`` as Java computes it (limit 0).

    For a single literal character the trailing empty pieces are exactly the
    trailing separator characters, so ``split(rtrim(col, sep))`` is exact
    (a non-empty text made only of separators gives ``[]``) and needs no
    lambda.  Otherwise the last non-empty piece is located once from the
    end and the array sliced: linear, no per-element search.
    """
    if len(regex) == 1 and regex not in _REGEX_META:
        sep = F.lit(regex)
        cut = F.rtrim(col, sep)
        return (F.when((col != F.lit("")) & (cut == F.lit("")), F.array().cast("array<string>"))
                .otherwise(F.split(cut, regex)))
    def trailing_cut(p: Column) -> Column:
        n = F.size(p)
        pos = F.array_position(F.transform(F.reverse(p), lambda x: x != F.lit("")), True)
        return (F.when(n == 1, p)
                .when(pos == 0, F.array().cast("array<string>"))
                .otherwise(F.slice(p, F.lit(1), (n - pos + 1).cast("int"))))
    return let(F.split(col, regex), trailing_cut)


def pair_pieces(line: Column) -> Column:
    """The pieces of ``line.split("=")`` as far as their count matters: exactly
    two pieces here iff Java's split has exactly two: trailing empty pieces
    come solely from trailing ``=`` characters."""
    return F.split(F.rtrim(line, F.lit("=")), "=")


def pieces_pair(pieces: Column, lower_key: bool = True, lower_value: bool = False) -> Column:
    """``struct<k,v>`` from two pieces, Java-trimmed (no size check)."""
    k = java_trim(F.get(pieces, 0))
    v = java_trim(F.get(pieces, 1))
    return F.struct((F.lower(k) if lower_key else k).alias("k"),
                    (F.lower(v) if lower_value else v).alias("v"))

