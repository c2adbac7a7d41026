"""Building blocks that keep one hot key from landing in one task.

A window over a whole series, or a join on a key that holds a third of all
rows, would put that share in a single task.  These helpers cut such groups
into blocks, work inside the blocks, and combine small per-block summaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

BLOCK = "_block"
SPLIT = "_split"
# Rows of a dimension that may be broadcast; at some 30 bytes a row this is about 150 MB.
DIMENSION_ROWS = 5_000_000


def dimension(df: DataFrame, max_rows: int = DIMENSION_ROWS) -> DataFrame:
    """A grid or lookup table, broadcast only when its counted rows allow it.

    Beyond the limit the join is planned like any other, with skew splitting.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def summary_side(df: DataFrame, purpose: str, max_rows: int = DIMENSION_ROWS) -> DataFrame:
    """An aggregate that is joined back to the rows it came from.

    It is written first, so its size is known before the join is planned: a
    small one is broadcast and the rows do not shuffle at all.
    """
    return dimension(stored(df, purpose), max_rows)


def split_hot_keys(
    big: DataFrame, small: DataFrame, keys: Sequence[str], spread: Column, rows_per_split: int = 2_000_000
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt only the keys of `big` with more than `rows_per_split` rows.

    Returns both sides with a split number and the join keys to use.  Rows of
    `big` get one split each; rows of `small` are repeated once per split of
    their key, so the inner join result is unchanged.  The list of hot keys is
    broadcast: it has at most rows(big) / rows_per_split entries.
    """
    hot = (
        big.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_split)
        .select(*keys, F.ceil(F.col("_n") / F.lit(rows_per_split)).cast("int").alias("_splits"))
    )
    splits = F.coalesce(F.col("_splits"), F.lit(1))
    salted = (
        big.join(F.broadcast(hot), list(keys), "left")
        .withColumn(SPLIT, F.pmod(F.xxhash64(spread), splits.cast("long")).cast("int"))
        .drop("_splits")
    )
    repeated = (
        small.join(F.broadcast(hot), list(keys), "left")
        .withColumn(SPLIT, F.explode(F.sequence(F.lit(0), splits - 1)))
        .drop("_splits")
    )
    return salted, repeated, [*keys, SPLIT]


def _offsets(df: DataFrame, keys: Sequence[str], total: Column) -> DataFrame:
    """Per block, the sum of `total` over the blocks before it (zero for the first)."""
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.groupBy(*keys, BLOCK)
        .agg(total.alias("_total"))
        .select(*keys, BLOCK, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    )


def sorted_ranges(df: DataFrame, order: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """The rows in ranges of the order, sorted: columns `_part`, the range's number, and `_place`, from 0 in it.

    They are written with their numbers, so that no later task can see others; neither a key nor the frame has to fit a task.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_number", F.monotonically_increasing_id())
    placed = stored(ranged, "sorted-ranges")
    number = {"_part": F.shiftright("_number", 33), "_place": F.col("_number").bitwiseAND((1 << 33) - 1)}
    return placed.withColumns(number).drop("_number")


def same_keys(keys: Sequence[str], prefix: str = "_k_") -> Column:
    """The null-safe match of `keys` with the same columns of another frame, renamed by `with_prefix`."""
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return out


def with_prefix(df: DataFrame, keys: Sequence[str], prefix: str = "_k_") -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def join_back(rows: DataFrame, sums: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows with the columns of an aggregate by `keys`; a NULL key is a key like any other."""
    return rows.join(with_prefix(sums, keys), same_keys(keys), how).drop(*[f"_k_{k}" for k in keys])


def range_rank(df: DataFrame, order: Sequence[str | Column], out: str, keys: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """1-based position in `order` over all rows, or per key when there are `keys`.

    Rows are dealt into ranges of the order and sorted there, so neither one key
    nor the whole frame has to fit a task.  A row's position is its place in its
    range plus the rows of the ranges before; per key, the key's first position
    is taken off.  Only one row per range meets in a window.  Rows that agree in
    the whole order are ranked in any order, and share a range.
    """
    placed = sorted_ranges(df, [*keys, *order], parts)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row a range
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    at = (F.col("_place") + F.col("_start") + 1).cast("long")
    ranked = placed.join(F.broadcast(starts), "_part").withColumn(out, at).drop("_part", "_place", "_start")
    if not keys:
        return ranked
    firsts = summary_side(ranked.groupBy(*keys).agg(F.min(out).alias("_first")), "first-ranks")
    return join_back(ranked, firsts, keys).withColumn(out, F.col(out) - F.col("_first") + 1).drop("_first")


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, block: Column, out: str
) -> DataFrame:
    """Running sum of `value` per key in `order`.

    `block` must not decrease along the order.  Only one row per block meets in
    the window over blocks; rows meet only inside their own block.
    """
    blocked = df.withColumn(BLOCK, block)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    offsets = _offsets(blocked, keys, F.sum(value))
    return (
        join_back(blocked.withColumn("_inside", F.sum(value).over(inside)), offsets, [*keys, BLOCK])
        .withColumn(out, F.col("_inside") + F.col("_before"))
        .drop("_inside", "_before", BLOCK)
    )


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, out: str) -> DataFrame:
    """1-based position per key in `order`, by blocks as in `running_sum`."""
    blocked = df.withColumn(BLOCK, block)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    offsets = _offsets(blocked, keys, F.count(F.lit(1)))
    return (
        join_back(blocked.withColumn("_inside", F.row_number().over(inside)), offsets, [*keys, BLOCK])
        .withColumn(out, (F.col("_inside") + F.col("_before")).cast("long"))
        .drop("_inside", "_before", BLOCK)
    )


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: str, values: dict[str, Column], block_rows: int, include_current: bool = True
) -> DataFrame:
    """Last non-missing value so far for every entry of `values`.

    `order` is an integer position.  Inside a block a window carries the value;
    across blocks only each block's last value is carried.
    """
    blocked = df.withColumn(BLOCK, F.floor(F.col(order) / F.lit(block_rows))).withColumns(
        {f"_v_{name}": col for name, col in values.items()}
    )
    stop = 0 if include_current else -1
    inside = Window.partitionBy(*keys, BLOCK).orderBy(order).rowsBetween(Window.unboundedPreceding, stop)
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    ends = blocked.groupBy(*keys, BLOCK).agg(
        *[
            F.max_by(f"_v_{name}", F.when(F.col(f"_v_{name}").isNotNull(), F.col(order))).alias(f"_e_{name}")
            for name in values
        ]
    )
    carried = ends.select(
        *keys, BLOCK, *[F.last(f"_e_{name}", ignorenulls=True).over(before).alias(f"_c_{name}") for name in values]
    )
    inner = blocked.withColumns({f"_i_{name}": F.last(f"_v_{name}", ignorenulls=True).over(inside) for name in values})
    out = join_back(inner, carried, [*keys, BLOCK])
    out = out.withColumns({name: F.coalesce(f"_i_{name}", f"_c_{name}") for name in values})
    return out.drop(BLOCK, *[f"_{p}_{name}" for name in values for p in ("v", "i", "c")])


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str, accuracy: int = 10_000) -> DataFrame:
    """Median of the non-missing values per key without gathering a key in one task.

    A mergeable quantile sketch brackets the middle; exact counts then place the
    median among the few distinct values inside the bracket.
    """
    present = df.filter(F.col(value).isNotNull()).select(*keys, value)
    margin = 2.0 / accuracy
    sketch = present.groupBy(*keys).agg(
        F.percentile_approx(value, [0.5 - margin, 0.5 + margin], accuracy).alias("_q"),
        F.count(F.lit(1)).alias("_n"),
    ).select(
        *keys,
        F.col("_q")[0].alias("_lo"),
        F.col("_q")[1].alias("_hi"),
        F.floor((F.col("_n") + 1) / 2).alias("_first"),
        F.floor((F.col("_n") + 2) / 2).alias("_second"),
    )
    placed = join_back(present, sketch, keys).filter(F.col(value) <= F.col("_hi"))
    # One row per distinct value inside the bracket, one per key for all below it.
    counted = placed.groupBy(
        *keys, "_first", "_second", F.when(F.col(value) >= F.col("_lo"), F.col(value)).alias("_v")
    ).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_to", F.sum("_c").over(upto)).withColumn("_from", F.col("_to") - F.col("_c") + 1)
    at_first = (F.col("_first") >= F.col("_from")) & (F.col("_first") <= F.col("_to"))
    at_second = (F.col("_second") >= F.col("_from")) & (F.col("_second") <= F.col("_to"))
    return ranked.groupBy(*keys).agg(
        ((F.max(F.when(at_first, F.col("_v"))) + F.max(F.when(at_second, F.col("_v")))) / 2.0).alias(out)
    )
