"""Attribute maps, keyword lists and JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def patch_attributes(attrs: Column, patch: dict[str, str | None | Callable[[Column], Column]]) -> Column:
    """SF-46 / UD-2: a value replaces, None deletes, a callable maps the old value Column to the new one."""
    touched = F.array(*[F.lit(k) for k in patch]) if patch else F.array().cast("array<string>")
    kept = F.map_filter(attrs, lambda k, v: ~F.array_contains(touched, k))
    entries = [F.map_entries(kept)]
    for name, change in patch.items():
        if change is None:
            continue
        value = change(attrs[F.lit(name)]) if callable(change) else F.lit(change)
        entries.append(F.array(F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))))
    return F.map_from_entries(F.concat(*entries))


def drop_attribute(attrs: Column, name: str) -> Column:
    return F.map_filter(attrs, lambda k, v: k != name)


def sorted_attributes(attrs: Column) -> Column:
    """SR-2: entries ordered by key without regard to case, ties by the key itself."""
    return F.transform(
        F.array_sort(
            F.transform(
                F.map_entries(attrs),
                lambda e: F.struct(F.lower(e["key"]).alias("fold"), e["key"].alias("key"), e["value"].alias("value")),
            )
        ),
        lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")),
    )


def keyword_union(*lists: Column) -> Column:
    """AG-22: distinct trimmed tokens of comma lists, sorted and joined by a comma and a space."""
    tokens = [F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)) for c in lists]
    named = F.filter(F.concat(*tokens), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_distinct(named)), ", ")


def coordinates_attribute(own: Column, known: list[str]) -> Column:
    """SF-48: own coordinates that are in the fixed list, sorted and joined by a space."""
    return F.array_join(F.array_sort(F.array_intersect(own, F.array(*[F.lit(c) for c in known]))), " ")


def rename_by_list(name: Column, pairs: Column) -> Column:
    """PRJ-16: new name from an `old:new,old:new` list, or the same name."""
    return F.coalesce(F.try_element_at(F.str_to_map(pairs, F.lit(","), F.lit(":")), name), name)


def appended_comment(*texts: Column) -> Column:
    """SF-51: comments joined by a space, missing ones left out."""
    return F.concat_ws(" ", *texts)


def scaled_range(low: Column, high: Column, factor: float, bits: int = 32) -> Column:
    """SF-49: range scaled and cast to the stored precision."""
    kind = {32: "float", 64: "double"}[bits]
    return F.struct((low * F.lit(float(factor))).cast(kind).alias("low"), (high * F.lit(float(factor))).cast(kind).alias("high"))
