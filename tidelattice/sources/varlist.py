"""Fixed-width variable lists -> catalogue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.scale import carry_forward, summary_side
from ..session import stored

LINES_PER_BLOCK = 100_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text lists, in the files' line order; long files are read in blocks by many tasks.

    A task reads the lines of a block in order, so a line's place in its block is
    its distance from the block's first line; the lines of the blocks before it
    are added, one row per block.
    """
    text = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("line"),
    )
    # Written with their numbers: a later read may deal blocks to tasks in another way.
    text = stored(text, "text-lines")
    blocks = text.groupBy("_path", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_path", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = text.join(summary_side(offsets, "line-offsets"), ["_path", "_start"])
    return placed.select("file", (F.col("_at") + F.col("_shift")).alias("line_no"), "line")


def parse_varlist(lines: DataFrame, section_mark: str, block_rows: int = LINES_PER_BLOCK) -> DataFrame:
    """SRC-10 / WN-3: (file, short_name, note, var, description).

    The header line sets the column offsets.  A line with the section mark opens
    a section, with an optional starred note.  Lines with text left of the name
    column are skipped.  A name too wide for its column stands alone and its
    description is on the next variable line.
    """
    line = F.col("line")
    is_header = (
        F.contains(line, F.lit("ShortName")) & F.contains(line, F.lit("Variable Name")) & F.contains(line, F.lit("Description"))
    )
    is_section = ~is_header & F.contains(line, F.lit(section_mark))
    is_note = ~is_header & ~is_section & F.contains(line, F.lit("Note:"))
    star = F.locate("*", line)
    name = F.replace(F.when(star > 0, F.substring(line, F.lit(1), star - 1)).otherwise(line), F.lit(" "), F.lit(""))
    starred = F.when(star > 0, F.substring(line, star, F.length(line)))
    tagged = lines.filter(F.length(line) > 0).select("file", F.col("line_no").cast("long").alias("line_no"), "line")
    context = carry_forward(
        tagged,
        ["file"],
        "line_no",
        {
            "head": F.when(
                is_header,
                F.struct(F.locate("Variable Name", line).alias("name_at"), F.locate("Description", line).alias("text_at")),
            ),
            "section": F.when(is_section, F.struct(F.col("line_no").alias("at"), name.alias("name"), starred.alias("starred"))),
        },
        block_rows,
    )
    # Two further steps read the tagged lines; they are written once instead of parsed again.
    context = stored(context, "varlist-lines")
    at, text_at = F.col("head.name_at"), F.col("head.text_at")
    left_blank = F.trim(F.substring(line, F.lit(1), at - 1)) == ""
    own = context.withColumn(
        "is_var", ~is_header & ~is_section & ~is_note & F.col("section").isNotNull() & left_blank
    )
    rest = F.substring(line, at, F.length(line))
    first_word = F.length(F.substring_index(rest, " ", 1))
    own = own.withColumn("is_wide", F.col("is_var") & (first_word >= text_at - at)).withColumn("rest", rest)
    followed = carry_forward(
        own,
        ["file"],
        "line_no",
        {"prior": F.when(F.col("is_var"), F.struct(F.col("is_wide").alias("wide"), F.col("rest").alias("name")))},
        block_rows,
        include_current=False,
    )
    narrow = F.replace(F.substring(line, at, text_at - at), F.lit(" "), F.lit(""))
    rows = followed.filter(F.col("is_var") & ~F.col("is_wide")).select(
        "file",
        "line_no",
        F.col("section.at").alias("section_at"),
        F.col("section.name").alias("short_name"),
        F.col("section.starred").alias("starred"),
        F.when(F.col("prior.wide"), F.col("prior.name")).otherwise(narrow).alias("var"),
        F.substring(line, text_at, F.length(line)).alias("description"),
    )
    notes = (
        context.filter(is_note & F.col("section").isNotNull())
        .groupBy("file", F.col("section.at").alias("section_at"))
        .agg(F.max_by(F.substring(line, F.lit(7), F.length(line)), "line_no").alias("noted"))
    )
    return rows.join(notes, ["file", "section_at"], "left").select(
        "file", "line_no", "short_name", F.coalesce("noted", "starred").alias("note"), "var", "description"
    )
