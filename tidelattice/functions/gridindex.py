"""Index arithmetic of the 13-tile cube-like native grid; pure expressions, no shuffle.

Tiles 0-6 lie upright and tiles 7-12 are rotated, so the last two faces store
three tiles side by side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First tile of each of the five faces, and the tiles per rotated face.
FACE_FIRST_TILE = (0, 3, 6, 7, 10)
TILES_PER_ROTATED_FACE = 3


def _pick(tile: Column, upright: Column, fourth: Column, fifth: Column) -> Column:
    return F.when(tile < 7, upright).when(tile < 10, fourth).otherwise(fifth)


def tile_to_compact(tile: Column, j: Column, i: Column, n: int) -> Column:
    """SF-42: struct(row, col) in the 13n x n compact layout."""
    row = _pick(tile, tile * n + j, F.lit(7 * n) + 3 * j + (tile - 7), F.lit(10 * n) + 3 * j + (tile - 10))
    return F.struct(row.cast("long").alias("row"), i.cast("long").alias("col"))


def compact_to_tile(row: Column, col: Column, n: int) -> Column:
    """Inverse of SF-42: struct(tile, j, i)."""
    r4, r5 = row - 7 * n, row - 10 * n
    upright, fourth = row < 7 * n, row < 10 * n
    tile = F.when(upright, F.floor(row / n)).when(fourth, 7 + F.pmod(r4, F.lit(3))).otherwise(10 + F.pmod(r5, F.lit(3)))
    j = F.when(upright, F.pmod(row, F.lit(n))).when(fourth, F.floor(r4 / 3)).otherwise(F.floor(r5 / 3))
    return F.struct(tile.cast("long").alias("tile"), j.cast("long").alias("j"), col.cast("long").alias("i"))


def tile_to_face(tile: Column, j: Column, i: Column, n: int) -> Column:
    """SF-43: struct(face 1..5, row, col)."""
    face = F.lit(1)
    for number, first in enumerate(FACE_FIRST_TILE[1:], start=2):
        face = F.when(tile >= first, number).otherwise(face)
    row = (
        F.when(tile < 3, tile * n + j).when(tile < 6, (tile - 3) * n + j).otherwise(j)
    )
    col = F.when(tile < 7, i).when(tile < 10, (tile - 7) * n + i).otherwise((tile - 10) * n + i)
    return F.struct(face.cast("long").alias("face"), row.cast("long").alias("row"), col.cast("long").alias("col"))


def face_to_tile(face: Column, row: Column, col: Column, n: int) -> Column:
    """Inverse of SF-43: struct(tile, j, i)."""
    upright = face <= 3
    base = F.element_at(F.array(*[F.lit(t) for t in FACE_FIRST_TILE]), face.cast("int"))
    tile = base + F.when(upright, F.floor(row / n)).otherwise(F.floor(col / n))
    j = F.when(upright, F.pmod(row, F.lit(n))).otherwise(row)
    i = F.when(upright, col).otherwise(F.pmod(col, F.lit(n)))
    return F.struct(tile.cast("long").alias("tile"), j.cast("long").alias("j"), i.cast("long").alias("i"))


def face_to_compact(face: Column, row: Column, col: Column, n: int) -> Column:
    """SF-44: through the tile indices."""
    cell = face_to_tile(face, row, col, n)
    return tile_to_compact(cell["tile"], cell["j"], cell["i"], n)


def quarter_turn(j: Column, i: Column, n: int) -> Column:
    """SF-45: where a cell of a rotated tile goes when the tile is turned upright."""
    return F.struct((F.lit(n - 1) - i).cast("long").alias("j"), j.cast("long").alias("i"))


def unrotate_pair(tile: Column, j: Column, i: Column, rotated_tile: int, n: int) -> Column:
    """SF-45: one frame for a rotated tile (left, turned upright) and its upright neighbour (right)."""
    turned = quarter_turn(j, i, n)
    is_rotated = tile == rotated_tile
    return F.struct(
        F.when(is_rotated, turned["j"]).otherwise(j.cast("long")).alias("row"),
        F.when(is_rotated, turned["i"]).otherwise(i.cast("long") + n).alias("col"),
    )
