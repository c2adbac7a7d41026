"""P-15 and P-16: regions of the native grid and series at a point."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import align_year
from ..functions.geometry import in_box
from ..functions.gridindex import unrotate_pair
from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import windows as W


def box_cells(cells: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    return cells.filter(in_box(F.col("xc"), F.col("yc"), south, north, west, east))


def box_tiles(cells: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    """AG-17: sorted distinct tiles and index ranges of a box."""
    inside = box_cells(cells, south, north, west, east)
    return A.distinct_indices(inside, [], ["tile", "j", "i"])


def region_map(
    field: DataFrame, cells: DataFrame, box: tuple[float, float, float, float], rotated_tile: int, upright_tile: int, n: int
) -> DataFrame:
    """P-15: time mean inside a box over two neighbouring tiles, in one upright frame."""
    two = box_cells(cells, *box).filter(F.col("tile").isin(rotated_tile, upright_tile))
    means = A.time_mean(field.join(two.select("tile", "j", "i"), ["tile", "j", "i"], "left_semi"), ["tile", "j", "i", "var"])
    spot = unrotate_pair(F.col("tile"), F.col("j"), F.col("i"), rotated_tile, n)
    return means.select("var", spot.alias("_s"), "value").select("var", "_s.row", "_s.col", "value")


def point_series(
    field: DataFrame, cells: DataFrame, points: Sequence[tuple[str, float, float]], month: int, day: int, base_year: int
) -> DataFrame:
    """P-16: series at the cells nearest to named points, years aligned on one axis."""
    nearest = J.nearest_cell(cells, points)
    at = field.join(nearest.select("point", "tile", "j", "i"), ["tile", "j", "i"])
    return at.withColumn("axis_day", align_year(F.col("time"), month, day, base_year))


def before_after(field: DataFrame, keys: Sequence[str], first: str, second: str) -> DataFrame:
    """P-16: change between the records of two instants."""
    return W.change_between(field, keys, first, second)
