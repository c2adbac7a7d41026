"""Variable-list text written from the part table, one list per part type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADER = "ShortName         Variable Name     Description (units)"
NAME_AT, TEXT_AT = 18, 36
LINES_PER_PART = 6


def varlist_lines(t) -> DataFrame:
    """(file, line_no, line): a header, then six lines per part."""
    size = F.col("p_size")
    narrow = F.replace("p_name", F.lit(" "), F.lit("_"))
    wide = size % 6 == 0
    pad = lambda n: F.lit(" " * n)
    text = F.concat_ws(" ", "p_type", size.cast("string"), F.lit("(m)"))
    lines = F.array(
        F.concat(F.lit("DS_L4_"), "p_type", F.lit("_"), F.col("p_partkey").cast("string"), F.lit("_V1"),
                 F.when(size % 4 == 0, "    *native grid*").otherwise("")),
        F.when(size % 7 == 0, F.concat(F.lit("Note: see "), "p_brand")).otherwise(""),
        F.when(wide, F.concat(pad(NAME_AT), narrow, F.lit("_of_the_global_ocean"))).otherwise(
            F.concat(pad(NAME_AT), F.rpad(narrow, TEXT_AT - NAME_AT, " "), text)
        ),
        F.when(wide, F.concat(pad(TEXT_AT), text)).otherwise(
            F.concat(pad(NAME_AT), F.rpad(F.concat(F.lit("X"), size.cast("string")), TEXT_AT - NAME_AT, " "), F.lit("second "), text)
        ),
        F.when(size % 3 == 0, "Remarks left of the name column").otherwise(""),
        F.lit(""),
    )
    part = t.table("part")
    body = part.select(
        F.col("p_type").alias("file"), "p_partkey", F.posexplode(lines).alias("pos", "line")
    ).select("file", ((F.col("p_partkey") + 1) * LINES_PER_PART + F.col("pos")).alias("line_no"), "line")
    head = part.select(F.col("p_type").alias("file")).distinct().select(
        "file", F.lit(0).cast("long").alias("line_no"), F.lit(HEADER).alias("line")
    )
    return head.unionByName(body)


NARROW = "replace(p_name, ' ', '_')"
TEXT = "p_type || ' ' || p_size || ' (m)'"
SECTION = "'DS_L4_' || p_type || '_' || p_partkey || '_V1'"
NOTE = "CASE WHEN p_size % 7 = 0 THEN 'see ' || p_brand WHEN p_size % 4 = 0 THEN '*native grid*' END"

# Lines that are not empty, with the section they open.
LINES_SQL = f"""
SELECT DISTINCT p_type AS file, CAST(0 AS BIGINT) AS line_no, false AS is_section, NULL AS section_name FROM part
UNION ALL SELECT p_type, (p_partkey + 1) * 6 + pos, pos = 0, CASE WHEN pos = 0 THEN {SECTION} END
FROM part, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS pos)
"""

PARSED_SQL = f"""
SELECT p_type AS file, CAST((p_partkey + 1) * 6 + 3 AS BIGINT) AS line_no, {SECTION} AS short_name, {NOTE} AS note,
       {NARROW} || '_of_the_global_ocean' AS var, {TEXT} AS description FROM part WHERE p_size % 6 = 0
UNION ALL SELECT p_type, CAST((p_partkey + 1) * 6 + 2 AS BIGINT), {SECTION}, {NOTE}, {NARROW}, {TEXT} FROM part WHERE p_size % 6 <> 0
UNION ALL SELECT p_type, CAST((p_partkey + 1) * 6 + 3 AS BIGINT), {SECTION}, {NOTE}, 'X' || p_size, 'second ' || {TEXT} FROM part WHERE p_size % 6 <> 0
"""
