"""U1-U3 from SQL text: the message grammar as temporary SQL functions.

``register(spark)`` makes them known to a session; ``spark.sql`` can then parse messages without the
Python API::

    SELECT m.msg_id, r.rec_pos, p.*
    FROM messages m, LATERAL log_records(m.value) r, LATERAL log_pairs(r.record) p

The functions are SQL expressions, which the optimizer inlines: every call becomes one generator in
the caller's stage, with no join, no exchange and no Python.  The filter of ``log_pairs`` therefore
works inside the array; a WHERE within the function would make the lateral call a join.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lograft.functions.javastr import JAVA_TRIM_CHARS
from lograft.functions.logparse import DASHES

_TRIM = "".join(f"\\u{ord(c):04x}" for c in JAVA_TRIM_CHARS)

# A text without separator is one piece; otherwise trailing empty pieces go.
_SPLIT_RECORDS = f"""get(transform(array(split(value, '{DASHES}')), p ->
    IF(size(p) = 1, p, slice(p, 1, CAST(size(p) - coalesce(
        nullif(array_position(transform(reverse(p), x -> x <> ''), true), 0) - 1, size(p)) AS INT)))), 0)"""

FUNCTIONS = {
    "java_trim": f"java_trim(s STRING) RETURNS STRING RETURN trim(BOTH '{_TRIM}' FROM s)",

    "split_records": f"split_records(value STRING) RETURNS ARRAY<STRING> RETURN {_SPLIT_RECORDS}",

    "log_records": f"""log_records(value STRING) RETURNS TABLE(rec_pos INT, record STRING)
        RETURN SELECT pos, col FROM LATERAL posexplode({_SPLIT_RECORDS})""",

    "log_pairs": f"""log_pairs(record STRING) RETURNS TABLE(line_pos INT, key STRING, value STRING)
        RETURN SELECT at, lower(trim(BOTH '{_TRIM}' FROM pc[0])), trim(BOTH '{_TRIM}' FROM pc[1])
        FROM LATERAL inline(filter(
            transform(split(record, '\\n'), (l, i) -> named_struct('at', i, 'pc', split(rtrim('=', l), '='))),
            x -> size(x.pc) = 2))""",

    # The id stands between the first and the second '>', if more than trailing '>' follow the first.
    "header_id": r"""header_id(record STRING) RETURNS STRING RETURN
        CASE WHEN instr(rtrim('>', substring_index(record, '\n', 1)), '>') > 0 THEN
            substring_index(substring_index(rtrim('>', substring_index(record, '\n', 1)), '>', 2), '>', -1) END""",

    "header_type": r"""header_type(record STRING) RETURNS STRING RETURN
        CASE WHEN octet_length(left(record, 1)) = 4 THEN left(record, 1)
             WHEN length(substring_index(record, '\n', 1)) >= 2 THEN left(record, 2) END""",

    "log_header": r"""log_header(record STRING)
        RETURNS STRUCT<header_ok: BOOLEAN, logtype: STRING, uniquestr: STRING>
        RETURN IF(header_type(record) IS NOT NULL AND header_id(record) IS NOT NULL
                  AND NOT (header_id(record) <> '' AND trim(BOTH '[' FROM header_id(record)) = ''),
            named_struct('header_ok', true, 'logtype', header_type(record),
                         'uniquestr', substring_index(header_id(record), '[', 1)),
            named_struct('header_ok', false, 'logtype', CAST(NULL AS STRING), 'uniquestr', CAST(NULL AS STRING)))""",
}


def register(spark: SparkSession) -> None:
    """Create or replace the functions in the session, in the order in which they use each other."""
    for body in FUNCTIONS.values():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
