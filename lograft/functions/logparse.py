"""Column expressions for the key/value log-message grammar.

    message := record ("----------" record)*
    record  := header "\\n" (line "\\n")*
    header  := logtype(2 chars) ":<" clock ">" uniquestr "[" flag "]"
    line    := key "=" value

All functions take and return ``Column`` objects (string functions, regexes
and higher-order functions over arrays; no Python UDF), so a whole message is
handled inside one row and no shuffle is needed to regroup its records.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lograft.functions.frames import let
from lograft.functions.javastr import java_split, java_trim, pair_pieces, pieces_pair

# Fixed value: the record separator is exactly ten dashes.
DASHES = "----------"
# Splitting on either separator at once gives the same pieces as splitting on
# the dashes first and then each record on "\n" (the two never overlap).
LINE_OR_RECORD = "\n|-{10}"


def split_records(value: Column) -> Column:
    """One message -> its records, with Java's trailing-empty rule."""
    return java_split(value, DASHES)


def record_lines(record: Column) -> Column:
    return F.split(record, "\n")


def _header_parts(record: Column) -> tuple[Column, ...]:
    h = F.substring_index(record, "\n", 1)
    r = F.rtrim(h, F.lit(">"))
    seg = F.when(F.instr(r, ">") > 0,
                 F.substring_index(F.substring_index(r, ">", 2), ">", -1))
    only_brackets = (seg != F.lit("")) & (F.trim(seg, F.lit("[")) == F.lit(""))
    # substring(0, 2) counts UTF-16 units: a leading astral character (4
    # bytes in UTF-8) is two units on its own.
    first_astral = F.octet_length(F.substring(h, 1, 1)) == 4
    return h, seg, only_brackets, first_astral, first_astral | (F.length(h) >= 2)


#: What can be wrong with a header, in the order in which it is looked for.
HEADER_FAULTS = ["short_type", "no_id", "only_brackets"]


def header_fault(record: Column) -> Column:
    """Why a record's header is not ``ok``; null if it is."""
    _, seg, only_brackets, _, long_enough = _header_parts(record)
    return (F.when(~long_enough, HEADER_FAULTS[0]).when(seg.isNull(), HEADER_FAULTS[1])
            .when(only_brackets, HEADER_FAULTS[2]))


def header_fields(record: Column) -> Column:
    """``struct<ok, logtype, uniquestr>`` for a record's first line.

    The type is the header's first two characters and the id the text between
    the first ``>`` and the next ``[``; a message whose header is too short for
    either is dropped whole, which is what ``ok`` tests.
    Computed with plain string functions (no arrays): the header is the
    text before the first newline; Java's split drops trailing empty pieces,
    so piece 1 of ``split(">")`` exists iff the header without its trailing
    ``>`` run still contains a ``>``, and it is the text between the first
    and the second ``>``.  ``split("\\[")[0]`` throws only for a non-empty
    run of ``[`` and is otherwise the text before the first ``[``.
    """
    h, seg, only_brackets, first_astral, long_enough = _header_parts(record)
    ok = F.coalesce(long_enough & seg.isNotNull() & ~only_brackets, F.lit(False))
    return F.struct(
        ok.alias("ok"),
        F.when(ok, F.when(first_astral, F.substring(h, 1, 1))
               .otherwise(F.substring(h, 1, 2))).alias("logtype"),
        F.when(ok, F.substring_index(seg, "[", 1)).alias("uniquestr"),
    )


def record_pairs(record: Column, lower_values: bool = False,
                 keys: list[str] | None = None) -> Column:
    """Accepted ``key=value`` lines of a record as ``array<struct<k,v>>``.

    Keys are Java-trimmed and lower-cased; values trimmed (and lower-cased when
    asked).  ``keys`` keeps only a whitelist, applied inside the array so the
    later per-key lookups scan only what survives.
    """
    pieces = F.transform(record_lines(record), pair_pieces)
    pieces = F.filter(pieces, lambda pc: F.size(pc) == 2)
    parsed = F.transform(pieces, lambda pc: pieces_pair(pc, lower_value=lower_values))
    if keys:
        parsed = F.filter(parsed, lambda p: p["k"].isin(*keys))
    return parsed


# Java-trimmable characters other than the line break (a line has none).
_TRIM_CLASS = r"[\x00-\x09\x0b-\x20]*"


def _key_class(key: str) -> str:
    """Regex matching exactly the strings whose Java lower-case is ``key``.

    Each ASCII letter matches both cases; the Kelvin sign (U+212A) is the one
    other character whose lower-case is an ASCII letter (``k``).  A blanket
    ``(?iu)`` would be wrong: it also folds U+017F and U+0130, which
    ``toLowerCase`` does not turn into ``s``/``i``.
    """
    out = []
    for ch in key:
        if ch == "k":
            out.append(r"[kK\u212A]")
        elif ch.isalpha():
            out.append(f"[{ch}{ch.upper()}]")
        else:
            out.append(re.escape(ch))
    return "".join(out)


def last_key_value(record: Column, key: str) -> Column:
    """Value (Java-trimmed) of the last accepted ``key=value`` line, or NULL.

    A line is accepted when, after dropping trailing ``=``, it has exactly one
    ``=`` and the text before it trims and lower-cases to ``key``; i.e. it
    matches ``^[trim]*KEY[trim]*=([^=\n]+)=*$`` line-wise (``(?d)``: only
    ``\n`` ends a line).  One compiled regex per key, evaluated in generated
    code, instead of a lambda over every line.
    """
    pattern = rf"(?dm)^{_TRIM_CLASS}{_key_class(key)}{_TRIM_CLASS}=([^=\n]+)=*$"
    found = F.regexp_extract_all(record, F.lit(pattern), 1)
    return java_trim(F.try_element_at(found, F.lit(-1)))


def last_wins(entries: Column) -> Column:
    """Deduplicate ``array<struct<k,v>>`` keeping each key's last entry.

    Sort by (key, -index) and keep the first of every key run: O(n log n) per
    record instead of a quadratic look-ahead.  Output is sorted by key (JSON
    object key order is not significant).
    """
    tagged = F.transform(entries, lambda e, i: F.struct(
        e["k"].alias("k"), (-i).alias("o"), e["v"].alias("v")))
    # ``ordered`` is bound once: an outer expression used inside a lambda
    # would be re-evaluated (re-sorted) for every element.
    kept = let(F.sort_array(tagged), lambda ordered: F.filter(
        ordered, lambda e, i: (i == 0) | (e["k"] != F.get(ordered, i - 1)["k"])))
    return F.transform(kept, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))


def record_document(record: Column, header: Column) -> Column:
    """T4: one record as ``map<string,string>``: header fields, then pairs."""
    entries = F.concat(
        F.array(F.struct(F.lit("logtype").alias("k"), header["logtype"].alias("v")),
                F.struct(F.lit("uniquestr").alias("k"), header["uniquestr"].alias("v"))),
        record_pairs(record),
    )
    return F.map_from_entries(last_wins(entries))
