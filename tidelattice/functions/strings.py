"""String expressions over dataset names, URLs and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date slot of a granule name, counted from the right over `_` tokens.
DATE_SLOT = -5


def granule_date_text(url: Column) -> Column:
    """SF-20: the `YYYY-MM[-DD]` token after an underscore; empty when there is none."""
    return F.regexp_extract(url, r"_(\d{4}-\d{2}(-\d{2})?)", 1)


def token_from_right(text: Column, position: int) -> Column:
    """SF-21: `_`-separated token by negative position."""
    return F.element_at(F.split(text, "_"), position)


def with_date_token(url: Column, date_text: Column) -> Column:
    """SF-22: the same URL with another date in its date slot."""
    parts = F.split(url, "_")
    size = F.size(parts)
    head = F.slice(parts, F.lit(1), size + DATE_SLOT)
    tail = F.slice(parts, size + DATE_SLOT + 2, F.lit(-DATE_SLOT - 1))
    return F.array_join(F.concat(head, F.array(date_text), tail), "_")


def name_core(short_name: Column) -> Column:
    """SF-24: tokens between the product prefix and (grid, resolution, version)."""
    parts = F.split(short_name, "_")
    return F.array_join(F.slice(parts, F.lit(3), F.size(parts) - 5), "_")


def name_grid(short_name: Column) -> Column:
    return F.when(F.contains(short_name, F.lit("LLC")), "native").when(F.contains(short_name, F.lit("DEG")), "latlon")


def name_resolution(short_name: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for token, label in (("MONTHLY", "monthly"), ("DAILY", "daily"), ("SNAPSHOT", "snapshot")):
        out = out.when(F.contains(short_name, F.lit(token)), F.lit(label))
    return out


def name_folder(short_name: Column) -> Column:
    """SF-24: storage folder id, for example `mon_mean/latlon`."""
    res = name_resolution(short_name)
    label = F.when(res == "monthly", "mon_mean").when(res == "daily", "day_mean").when(res == "snapshot", "snap")
    return F.concat_ws("/", name_grid(short_name), label, name_core(short_name))


def contains_ci(text: Column, query: Column) -> Column:
    """SF-25: case-insensitive containment; missing text never matches."""
    return F.coalesce(F.contains(F.lower(text), F.lower(query)), F.lit(False))


def id_tail(identifier: Column) -> Column:
    """SF-26: the part of an identifier after its first slash."""
    return F.split_part(identifier, F.lit("/"), F.lit(2))


def link_short_name(link: Column) -> Column:
    """SF-26: the dataset name a metadata link asks for."""
    return F.split_part(link, F.lit("ShortName="), F.lit(2))


def replace_prefix(identifier: Column, prefix: str, root: str) -> Column:
    """SF-26: archive prefix -> identifier root."""
    return F.replace(identifier, F.lit(prefix), F.lit(root))


def basename(url: Column) -> Column:
    """SF-28."""
    return F.substring_index(url, "/", -1)


def padded_step(step: Column, width: int = 10) -> Column:
    """SF-29."""
    return F.lpad(step.cast("string"), width, "0")


def product_label(short_name: Column, note: Column) -> Column:
    """SF-31: the section's own starred note, else a label built from its name."""
    grid = F.when(F.contains(short_name, F.lit("LLC")), "native grid,").when(
        F.contains(short_name, F.lit("DEG")), "lat-lon grid,"
    )
    res = (
        F.when(F.contains(short_name, F.lit("MONTHLY")), "monthly means*")
        .when(F.contains(short_name, F.lit("DAILY")), "daily means*")
        .when(F.contains(short_name, F.lit("SNAPSHOT")), "snapshots at daily intervals*")
    )
    built = F.concat(F.lit("*"), F.coalesce(grid, F.lit("")), F.coalesce(res, F.lit("")))
    return F.when(F.contains(note, F.lit("*")), note).otherwise(built)


def note_allows(note: Column, grid: str | None, resolution: str) -> Column:
    """SF-32: a starred note restricts the grid and resolution a mixed section answers to."""
    starred = F.coalesce(F.contains(note, F.lit("*")), F.lit(False))
    ok = F.lit(True)
    if grid is not None:
        word = {"native": "native", "latlon": "lat-lon"}[grid]
        ok = ok & F.contains(note, F.lit(word))
    if resolution != "all":
        ok = ok & F.contains(note, F.lit(resolution))
    return ~starred | ok
