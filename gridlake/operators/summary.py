"""Reductions over cells and grids, and the comparison of two fields."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.kernels import MOST_POINTS, MOST_TILES, slices, tile_difference, to_bytes
from gridlake.layout import TILE_GEOMETRY, TILE_KEY, TILE_ORDER, TILE_STATS, TILE_ZONE, is_tiled, packed, with_stats, with_zone

REGIONAL_SPAN = 350


def extent(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Bounds of a domain, and whether it is regional (less than 350 degrees wide). Missing is skipped.

    Of tiles only their bounds are read, which stored tiles carry as numbers.
    """
    lows, highs = (("lon_min", "lat_min"), ("lon_max", "lat_max")) if is_tiled(df) else (("lon", "lat"), ("lon", "lat"))
    df = with_zone(df) if is_tiled(df) else df
    return df.groupBy(*(keys or [])).agg(
        F.min(lows[0]).alias("lon_min"), F.max(highs[0]).alias("lon_max"), F.min(lows[1]).alias("lat_min"), F.max(highs[1]).alias("lat_max"),
    ).withColumn("is_regional", F.abs(F.col("lon_max") - F.col("lon_min")) < REGIONAL_SPAN)


def axis_steps(axis: DataFrame, keys: list[str], position: str, coordinate: str) -> DataFrame:
    """First and last coordinate of an axis and the step between its first two points.

    Only the first two positions and the last one matter, so plain aggregates do, without a window.
    """
    first, second = (F.max(F.when(F.col(position) == p, F.col(coordinate))) for p in (0, 1))
    return axis.groupBy(*keys).agg(
        F.min_by(coordinate, position).alias("first"), F.max_by(coordinate, position).alias("last"),
        F.abs(second - first).alias("step"))


def symmetric_limit(df: DataFrame, keys: list[str]) -> DataFrame:
    """Largest absolute value, missing skipped. Stored tiles answer from their minimum and maximum, without their values."""
    if is_tiled(df):
        size = F.greatest(F.abs("v_min"), F.abs("v_max"))
        return with_stats(df).groupBy(*keys).agg(F.max(size).alias("max_abs"))
    return df.groupBy(*keys).agg(F.max(F.abs("value")).alias("max_abs"))


def field_mean(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean over present cells, and how many are missing (a mean that must not skip any is NULL if that is not 0).

    Stored tiles answer from their sums and counts, without their values.
    """
    if is_tiled(df):
        merged = with_stats(df).groupBy(*keys).agg(F.sum("v_sum").alias("_s"), F.sum("n_present").alias("_n"),
                                                   F.sum(F.col("h").cast("long") * F.col("w")).alias("_all"))
        return merged.select(*keys, (F.col("_s") / F.nullif(F.col("_n"), F.lit(0))).alias("mean"), (F.col("_all") - F.col("_n")).alias("n_missing"))
    return df.groupBy(*keys).agg(F.avg("value").alias("mean"),
                                 (F.count(F.lit(1)) - F.count("value")).alias("n_missing"))


def coarsen(cells: DataFrame, k: int, keys: list[str], ny: int | Column, nx: int | Column) -> DataFrame:
    """Mean of k x k blocks; rows and columns that do not fill a block are left out, missing is skipped.

    The cells of a block combine before the shuffle.
    """
    ny, nx = (n if isinstance(n, Column) else F.lit(n) for n in (ny, nx))
    inside = cells.filter((F.col("iy") < ny - ny % k) & (F.col("ix") < nx - nx % k))
    block = {"iy": F.floor(F.col("iy") / k).cast("int"), "ix": F.floor(F.col("ix") / k).cast("int")}
    return inside.withColumns(block).groupBy(*keys, "iy", "ix").agg(
        F.avg("value").alias("value"),
        *([F.avg("lat").alias("lat")] if "lat" in cells.columns else []),
        *([F.avg("lon").alias("lon")] if "lon" in cells.columns else []))


PARTS = "array<struct<sums:binary, counts:binary, lat_sum:binary, lat_n:binary, lon_sum:binary, lon_n:binary>>"


def coarsen_tiles(tiles: DataFrame, k: int, edge: int | None = None) -> DataFrame:
    """The same on tiles of any edge, for any k. Blocks inside a tile are finished where the tile lies. Of a block that a tile border cuts each tile gives
    its sums and counts, and only these strips are shuffled and merged.

    Results are tiles of the coarse grid: one of the whole blocks of each tile, and strips one block wide along borders that cut blocks.
    ``ty`` and ``tx`` number them by their first row and column. ``edge`` tells the edge of the tiles, if it is known; if it is
    a multiple of k no block is cut, and the plan has no exchange.

    A worker has ``MOST_TILES`` tiles as Python objects at once, whatever the size of a batch, and whole blocks take one pass through Python.
    """
    keep = [c for c in tiles.columns if c not in {*TILE_KEY, *TILE_GEOMETRY, *TILE_STATS, *TILE_ZONE, TILE_ORDER, "values"}]
    names = [f"c{i}" for i in range(len(keep))]
    place = [*TILE_KEY, "ny", "nx", "y0", "x0", "h", "w"]
    plain = tiles.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], *place, "lats", "lons", "values")
    own = [T.StructField(n, tiles.schema[c].dataType) for c, n in zip(keep, names, strict=True)]
    at = [T.StructField(c, T.IntegerType()) for c in place]
    arrays = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("lats", "lons")]
    cut = T.StructType([*own, *at, T.StructField("parts", T.DataType.fromDDL(PARTS))])
    out = T.StructType([*own, *at, *arrays, T.StructField("values", T.BinaryType())])

    def pieces(batches: Iterator[pa.RecordBatch], wanted: bool | None) -> Iterator[tuple[list[pa.Array], list[dict[str, bytes]]]]:
        """Columns and parts of the blocks that lie whole in a tile (``wanted``), of those a border cuts, or of all."""
        for batch in slices(batches):
            packs = batch.column("values")
            packs = packs if pa.types.is_binary(packs.type) else to_bytes(packs)
            columns = [batch.column(c).to_pylist() for c in (*place, "lats", "lons")]
            rows, places, parts, size = [], [], [], 0

            def made(batch: pa.RecordBatch = batch) -> list[pa.Array]:
                picked = pa.array(rows, pa.int64())
                return [batch.column(n).take(picked) for n in names] \
                    + [pa.array(c, pa.int32()) for c in np.array(places, "int32").reshape(-1, len(place)).T]

            for i, (_, _, ny, nx, y0, x0, h, w, lats, lons) in enumerate(zip(*columns, strict=True)):
                values = packs[i].as_py()
                grid = np.frombuffer(values, "<f4").reshape(h, w) if values is not None else np.full((h, w), np.nan, "<f4")
                for by, bx, part in _block_parts(grid, lats, lons, (ny, nx, y0, x0), k, wanted):
                    rows.append(i)
                    bh, bw = len(part["lat_n"]) // 8, len(part["lon_n"]) // 8
                    places.append((by, bx, ny // k, nx // k, by, bx, bh, bw))
                    parts.append(part)
                    size += bh * bw
                if len(rows) >= MOST_TILES or size >= MOST_POINTS:
                    yield made(), parts
                    rows, places, parts, size = [], [], [], 0
            if rows:
                yield made(), parts

    def finished(columns: list[pa.Array], given: list[list[dict[str, bytes]]]) -> pa.RecordBatch:
        lats, lons, values = [], [], []
        for parts in given:
            total = {key: sum(np.frombuffer(p[key], "<f8") for p in parts) for key in parts[0]}
            values.append(_quotient(total["sums"], total["counts"]).astype("<f4").tobytes())
            lats.append(_quotient(total["lat_sum"], total["lat_n"]))
            lons.append(_quotient(total["lon_sum"], total["lon_n"]))
        return pa.RecordBatch.from_arrays([*columns, *[pa.array([x.tolist() for x in a], pa.list_(pa.float64())) for a in (lats, lons)],
                                           pa.array(values, pa.binary())], names=out.names)

    def settled(wanted: bool | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for columns, parts in pieces(batches, wanted):
                yield finished(columns, [[part] for part in parts])

        return plain.mapInArrow(run, out)

    def strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, parts in pieces(batches, False):
            yield pa.RecordBatch.from_arrays([*columns, pa.array([[part] for part in parts], _PART_LIST)], names=cut.names)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield finished([batch.column(c) for c in (*names, *place)], batch.column("parts").to_pylist())

    if edge is not None and edge % k == 0:
        ready = settled(None)
    else:  # a block is cut by as many tiles as it touches
        joined = plain.mapInArrow(strips, cut).groupBy(*names, *place).agg(F.flatten(F.collect_list("parts")).alias("parts"))
        ready = settled(True).unionByName(joined.mapInArrow(put_together, out))
    return ready.toDF(*keep, *out.names[len(keep):])


_PART_LIST = pa.list_(pa.struct([(c, pa.binary()) for c in ("sums", "counts", "lat_sum", "lat_n", "lon_sum", "lon_n")]))


def _quotient(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, total / np.maximum(count, 1), np.nan)


def _stretch(start: int, size: int, whole: int, k: int) -> list[tuple[int, int, bool, np.ndarray]]:
    """``(first block, blocks, uncut, row starts)`` of the blocks along one side of a tile: those cut at its borders alone, those inside together."""
    first, last = start // k, min((start + size - 1) // k, whole // k - 1)
    if last < first:
        return []
    inside = range(-(-start // k), (start + size) // k)
    inside = range(inside.start, min(inside.stop, last + 1))
    out = [(b, 1, False) for b in range(first, last + 1) if b not in inside]
    if len(inside):
        out.append((inside.start, len(inside), True))
    return [(b, n, uncut, np.maximum(np.arange(b, b + n) * k - start, 0)) for b, n, uncut in out]


def _block_parts(grid: np.ndarray, lats: list, lons: list, place: tuple[int, int, int, int], k: int,
                 wanted: bool | None) -> Iterator[tuple[int, int, dict[str, bytes]]]:
    """Sums and counts of the blocks of a tile, as rectangles of blocks that are cut alike: of the whole ones (``wanted``), of those cut, or of all."""
    ny, nx, y0, x0 = place
    present = ~np.isnan(grid)
    numbers = np.where(present, grid, 0).astype("<f8")
    axes = [np.array([np.nan if v is None else v for v in axis], "<f8") for axis in (lats, lons)]
    for by, bh, uncut_y, ys in _stretch(y0, grid.shape[0], ny, k):
        y_end = min((by + bh) * k - y0, grid.shape[0])
        for bx, bw, uncut_x, xs in _stretch(x0, grid.shape[1], nx, k):
            if wanted is not None and wanted != (uncut_y and uncut_x):
                continue
            x_end = min((bx + bw) * k - x0, grid.shape[1])

            def blocks(a: np.ndarray, ys: np.ndarray = ys, xs: np.ndarray = xs, y_end: int = y_end, x_end: int = x_end) -> bytes:
                rows = np.add.reduceat(a[:y_end, :x_end].astype("<f8"), ys, axis=0)
                return np.add.reduceat(rows, xs, axis=1).tobytes()

            def line(a: np.ndarray, starts: np.ndarray, end: int) -> tuple[bytes, bytes]:
                a = a[:end]
                return (np.add.reduceat(np.nan_to_num(a), starts).tobytes(), np.add.reduceat((~np.isnan(a)).astype("<f8"), starts).tobytes())

            lat_sum, lat_n = line(axes[0], ys, y_end)
            lon_sum, lon_n = line(axes[1], xs, x_end)
            yield by, bx, {"sums": blocks(numbers), "counts": blocks(present), "lat_sum": lat_sum, "lat_n": lat_n,
                           "lon_sum": lon_sum, "lon_n": lon_n}


def time_head_tail(axes: DataFrame, limit: int = 15, head: int = 6, tail: int = 4) -> DataFrame:
    """Of each time axis all times up to ``limit``, else the first six and the last four."""
    short = F.concat(F.slice("times", 1, head), F.slice("times", -tail, tail))
    return axes.withColumn("shown", F.when(F.col("n_times") <= limit, F.col("times")).otherwise(short))


def field_diff(a: DataFrame, b: DataFrame, on: list[str], keys: list[str] | None = None) -> DataFrame:
    """Largest absolute difference of two fields, cells compared, and cells only one side has a value for.

    Works on cells and on tiles; for tiles the places have to agree.
    """
    keys = keys or []
    if is_tiled(a):
        pair = packed(a).select(*on, F.col("values").alias("_a")).join(packed(b).select(*on, F.col("values").alias("_b")), on, "full")
        found = pair.select(*keys, tile_difference(F.col("_a"), F.col("_b")).alias("_d"))
        return found.groupBy(*keys).agg(F.max("_d.max_abs").alias("max_abs_diff"), F.sum("_d.n").alias("n_compared"),
                                        F.sum("_d.n_one_sided").alias("n_one_sided"))
    pair = a.select(*on, F.col("value").alias("_a")).join(b.select(*on, F.col("value").alias("_b")), on, "full")
    return pair.groupBy(*keys).agg(
        F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_abs_diff"), F.count(F.lit(1)).alias("n_compared"),
        F.sum(F.when(F.col("_a").isNull() != F.col("_b").isNull(), 1).otherwise(0)).alias("n_one_sided"))


def map_layer(cells: DataFrame, wu: str, wv: str, keys: list[str], box: dict[str, float] | None = None,
              step: int = 15) -> DataFrame:
    """The data of a wind map: speed everywhere in the box, and which cells carry an arrow."""
    if box is not None:
        cells = cells.filter(F.col("lon").between(box["lonmin"], box["lonmax"])
                             & F.col("lat").between(box["latmin"], box["latmax"]))
    pick = lambda v: F.max(F.when(F.col("var") == v, F.col("value")))
    k = max(1, step)
    return cells.filter(F.col("var").isin(wu, wv)).groupBy(*keys, "iy", "ix", "lat", "lon") \
        .agg(pick(wu).alias("u"), pick(wv).alias("v")) \
        .withColumns({"speed": F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v")).cast("float"),
                      "arrow": (F.col("iy") % k == 0) & (F.col("ix") % k == 0)})


def inventory(cells: DataFrame, keys: list[str], time: str = "valid_time") -> DataFrame:
    """Variables, times, first and last time per group, from cells.

    Distinct (group, variable, time) first, which combines before the shuffle and is small against the cells.
    """
    seen = cells.select(*keys, "var", time).distinct()
    return seen.groupBy(*keys).agg(
        F.count_distinct("var").alias("n_vars"), F.count_distinct(time).alias("n_times"),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"))
