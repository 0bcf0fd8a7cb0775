"""The two physical layouts of field data, and how one operator serves both.

``cells``  one row per grid point, scalar column ``value``
``tiles``  one row per rectangular block of grid points, column ``values`` (row-major): an array of FLOAT, or
           BINARY with the same numbers packed as little-endian float32 and NaN for missing, as whole runs and stores
           carry it

A tile row costs the same per-row work as a cell row but carries up to 256 x 256 points, so whatever works on
headers (naming, routing, windows over time, joins on time) is tens of thousands of times cheaper on tiles.
Element-wise arithmetic is written once as a function of Columns and lifted to arrays by :func:`per_element`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.kernels import Kernel, on_tiles, slices, tile_stats, to_bytes, unpack

# Columns that place a tile on its grid.
TILE_KEY = ["ty", "tx"]
TILE_GEOMETRY = ["ny", "nx", "y0", "x0", "h", "w", "lats", "lons"]
# What a stored tile says about its values and its place, so that questions on them need not open the values.
TILE_STATS = ["n_present", "v_sum", "v_min", "v_max"]
TILE_ZONE = ["lat_min", "lat_max", "lon_min", "lon_max"]
TILE_ORDER = "tkey"
# Columns that place a cell on its grid.
CELL_KEY = ["iy", "ix"]
CELL_GEOMETRY = ["lat", "lon"]

FIELD_KEY = ["run_id", "var", "level_type", "level"]


def is_tiled(df: DataFrame) -> bool:
    return "values" in df.columns


def is_packed(df: DataFrame) -> bool:
    return is_tiled(df) and isinstance(df.schema["values"].dataType, T.BinaryType)


def unpacked(df: DataFrame) -> DataFrame:
    """Tiles with ``values`` as arrays; cells and array tiles as they are."""
    return df.withColumn("values", unpack(F.col("values"))) if is_packed(df) else df


def packed(df: DataFrame) -> DataFrame:
    """Tiles with ``values`` as packed bytes; array tiles pass through Python once, before a shuffle or a write."""
    if is_packed(df):
        return df
    at = df.columns.index("values")
    fields = list(df.schema.fields)
    fields[at] = T.StructField("values", T.BinaryType())

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.set_column(at, "values", to_bytes(batch.column(at)))

    return df.mapInArrow(convert, T.StructType(fields))


def with_stats(tiles: DataFrame) -> DataFrame:
    """Tiles with count, sum, minimum and maximum of their present values; kept if they are there already."""
    if set(TILE_STATS) <= set(tiles.columns):
        return tiles
    return tiles.withColumn("_stats", tile_stats(F.col("values"))).withColumns({c: F.col(f"_stats.{c}") for c in TILE_STATS}).drop("_stats")


def with_zone(tiles: DataFrame) -> DataFrame:
    """Tiles with the bounds of their coordinates as plain numbers, which file statistics know; kept if they are there already."""
    if set(TILE_ZONE) <= set(tiles.columns):
        return tiles
    return tiles.withColumns({"lat_min": F.array_min("lats"), "lat_max": F.array_max("lats"),
                              "lon_min": F.array_min("lons"), "lon_max": F.array_max("lons")})


def curve_key(ty: Column, tx: Column) -> Column:
    """Place of a tile on a Z-shaped curve: neighbours on the grid are near on it, so sorted files can be skipped by place."""
    def spread(n: Column) -> Column:
        n = n.cast("bigint")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            n = n.bitwiseOR(F.shiftleft(n, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return n

    return F.shiftleft(spread(ty), 1).bitwiseOR(spread(tx))


def curve_position(ty: int, tx: int) -> int:
    """The same for one tile."""
    return sum(((ty >> b & 1) << 1 | tx >> b & 1) << 2 * b for b in range(16))


def value_name(df: DataFrame) -> str:
    return "values" if is_tiled(df) else "value"


def place_key(df: DataFrame) -> list[str]:
    """The columns that identify the place of a row, whatever the layout."""
    return [c for c in (TILE_KEY if is_tiled(df) else CELL_KEY) if c in df.columns]


def geometry(df: DataFrame) -> list[str]:
    return [c for c in (TILE_GEOMETRY if is_tiled(df) else CELL_GEOMETRY) if c in df.columns]


def per_element(tiled: bool, fn: Callable[..., Column], *cols: Column, kernel: Kernel | None = None,
                packed: bool = False) -> Column:
    """``fn`` on scalars, or on each position of one or two arrays (by its kernel, if there is one)."""
    if not tiled:
        return fn(*cols)
    if kernel is not None:
        return on_tiles(kernel, *cols, packed=packed)
    if len(cols) == 1:
        return F.transform(cols[0], fn)
    return F.zip_with(cols[0], cols[1], fn)


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once.

    Catalyst inlines an expression wherever its column is used. Where ``fn`` uses it inside a loop over rules, the
    lambda variable of a one-element array keeps it from being computed again for each rule.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))
