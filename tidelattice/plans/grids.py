"""Regular, constant-radius and native demo grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import cell_area, effective_radius
from ..operators.aggregate import extent


def regular_grid(
    spark: SparkSession,
    dx: float,
    dy: float,
    lon0: float = -180.0,
    lon1: float = 180.0,
    lat0: float = -90.0,
    lat1: float = 90.0,
) -> DataFrame:
    """SF-34 / SF-40: centres, edges and areas of a regular grid; row 0 is the northern one."""
    cols, rows = round((lon1 - lon0) / dx), round((lat1 - lat0) / dy)
    at = F.col("id")
    row, col = F.floor(at / cols), at % cols
    cell = spark.range(rows * cols).select(
        at.cast("long").alias("target_id"), row.cast("int").alias("row"), col.cast("int").alias("col"),
        (F.lit(lon0) + col * dx).alias("lon0"), (F.lit(lon0) + (col + 1) * dx).alias("lon1"),
        (F.lit(lat1) - (row + 1) * dy).alias("lat0"), (F.lit(lat1) - row * dy).alias("lat1"),
    )
    return cell.select(
        "*",
        ((F.col("lon0") + F.col("lon1")) / 2.0).alias("lon"),
        ((F.col("lat0") + F.col("lat1")) / 2.0).alias("lat"),
        cell_area(F.col("lon0"), F.col("lon1"), F.col("lat0"), F.col("lat1")).alias("area"),
    )


def demo_grid(grid: DataFrame, name: str, method: str) -> DataFrame:
    """P-17: a grid with its effective radius and name."""
    return grid.withColumn("grid", F.lit(name)).withColumn("radius", effective_radius(F.col("area"), method))


def grid_summary(grid: DataFrame) -> DataFrame:
    """P-17 / AG-18: extents and radii per grid."""
    return grid.groupBy("grid").agg(
        F.count(F.lit(1)).alias("cells"),
        *extent(grid, "lon", "lat"),
        F.min("radius").alias("radius_min"),
        F.max("radius").alias("radius_max"),
    )
