from lograft.functions.javastr import java_split, java_trim  # noqa: F401
from lograft.functions.logparse import (  # noqa: F401
    DASHES, split_records, record_lines, header_fields, record_pairs, last_wins,
)
