"""P-13 and P-14: valid ranges and metadata repair."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.attrs import patch_attributes, scaled_range, sorted_attributes
from ..functions.strings import link_short_name
from ..operators import aggregate as A
from ..session import stored

FAILED, UNCHANGED, UPDATED = -1, 0, 1


def in_sample(identifier: Column, share: float) -> Column:
    """SF-52: a reproducible share of the granules, by id."""
    return F.pmod(identifier, F.lit(100)) < F.lit(100 * share)


def calculate_ranges(data: DataFrame, keys: Sequence[str], method: str = "hard") -> DataFrame:
    """P-13: from the values (`hard`) or from ranges stored with granules (`easy`)."""
    return {"hard": A.value_range, "easy": A.stored_range}[method](data, keys)


def correct_ranges(stored: DataFrame, new: DataFrame, keys: Sequence[str], factor: float = 1.0, bits: int = 64) -> DataFrame:
    """JN-15 / P-13: the new range replaces a different stored one.

    A range for a variable that no granule has is a failure, as are granules
    without a new range.
    """
    scaled = new.withColumn("_s", scaled_range(F.col("valid_min"), F.col("valid_max"), factor, bits)).select(
        *keys, F.col("_s.low").alias("_low"), F.col("_s.high").alias("_high")
    )
    joined = stored.join(scaled, list(keys), "full")
    same = (F.col("valid_min") == F.col("_low")) & (F.col("valid_max") == F.col("_high"))
    status = (
        F.when(F.col("file").isNull() | F.col("_low").isNull(), FAILED).when(same, UNCHANGED).otherwise(UPDATED)
    )
    return joined.select(
        *keys,
        "file",
        status.cast("long").alias("status"),
        F.coalesce("_low", "valid_min").alias("valid_min"),
        F.coalesce("_high", "valid_max").alias("valid_max"),
    )


def header_status(granules: DataFrame, repairs: DataFrame) -> DataFrame:
    """JN-9: missing id or other title fails; other name or summary is repaired."""
    joined = granules.join(repairs, "id", "left")
    name_differs = link_short_name(F.col("link")) != F.col("fix_short_name")
    summary_differs = F.col("summary") != F.col("fix_summary")
    failed = F.col("fix_title").isNull() | (F.col("title") != F.col("fix_title"))
    head = F.concat(F.split_part("link", F.lit("ShortName="), F.lit(1)), F.lit("ShortName="), F.col("fix_short_name"))
    return joined.select(
        *granules.columns,
        F.when(failed, FAILED).when(name_differs | summary_differs, UPDATED).otherwise(UNCHANGED).cast("long").alias("status"),
        F.when(~failed & name_differs, head).otherwise(F.col("link")).alias("new_link"),
        F.when(~failed & summary_differs, F.col("fix_summary")).otherwise(F.col("summary")).alias("new_summary"),
    )


def repair_audit(
    granules: DataFrame,
    repairs: DataFrame,
    stored: DataFrame,
    actual: DataFrame,
    new: DataFrame,
    comment_fixes: Sequence[str] = (),
    unit_fixes: Mapping[str, str] | None = None,
) -> DataFrame:
    """P-14: one status per granule from its header, its variables, its ranges and its values.

    `granules` have (id, file_id, dataset, units, ...), `units` being a map from
    variable to unit; ranges are keyed by (dataset, var).  Variables with a new
    comment (SO-3) or another unit are repaired.  A granule fails when its
    new range excludes actual values.
    """
    headers = header_status(granules, repairs)
    audit = A.range_audit(actual, stored, new, ["dataset", "var"])
    changed = (F.col("old_min") != F.col("new_min")) | (F.col("old_max") != F.col("new_max"))
    per_dataset = audit.groupBy("dataset").agg(
        F.bool_or("new_bad").alias("_bad"), F.bool_or(changed).alias("_changed")
    )
    joined = headers.join(per_dataset, "dataset", "left")
    failed = (F.col("status") == FAILED) | F.col("_changed").isNull() | F.col("_bad")
    commented = F.arrays_overlap(F.map_keys("units"), F.array(*[F.lit(v) for v in comment_fixes]).cast("array<string>"))
    updated = (F.col("status") == UPDATED) | F.col("_changed") | commented
    for name, unit in (unit_fixes or {}).items():
        updated = updated | F.coalesce(F.col("units")[name] != F.lit(unit), F.lit(False))
    status = F.when(failed, FAILED).when(updated, UPDATED).otherwise(UNCHANGED)
    return joined.withColumn("status", status.cast("long")).drop("_bad", "_changed")


def repair_job(
    granules: DataFrame,
    repairs: DataFrame,
    ranges: DataFrame,
    actual: DataFrame,
    new: DataFrame,
    comment_fixes: Sequence[str] = (),
    unit_fixes: Mapping[str, str] | None = None,
    patch: Mapping[str, str | None] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P-14: repaired granules, their new ranges and the summary of the run.

    Global attributes are patched (SF-46) and sorted (SR-2); a granule that fails keeps its own, as they
    are.  Ranges are replaced where they differ (JN-15); the summary counts granules by status (AG-19).
    `ranges` holds the stored range of each (dataset, var, file).  The granules are written once.
    """
    audited = repair_audit(granules, repairs, ranges, actual, new, comment_fixes, unit_fixes)
    patched = sorted_attributes(patch_attributes(F.col("attrs"), dict(patch or {})))
    fixed = audited.withColumn(
        "attrs", F.when(F.col("status") == FAILED, F.map_entries("attrs")).otherwise(patched)
    )
    written = stored(fixed, "repaired-granules")
    return written, correct_ranges(ranges, new, ["dataset", "var"]), A.status_summary(written)
