"""Message arrays to tiles and cells, and back to packed blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.kernels import MOST_POINTS, MOST_TILES, Kernel
from gridlake.layout import TILE_GEOMETRY, TILE_KEY, TILE_ORDER, TILE_STATS, TILE_ZONE, unpacked

TILE_EDGE = 256


def latitude_axis(flat: Column, ni: Column, nj: Column) -> Column:
    """1-D latitudes of a flat row-major grid: the first column if it varies, else the first row."""
    first_column = F.transform(F.sequence(F.lit(0), nj - 1), lambda r: F.element_at(flat, r * ni + 1))
    return F.when(F.array_min(first_column) != F.array_max(first_column), first_column) \
        .otherwise(F.slice(flat, F.lit(1), ni))


def longitude_axis(flat: Column, ni: Column, nj: Column) -> Column:
    """1-D longitudes of a flat row-major grid: the first row if it varies, else the first column."""
    first_row = F.slice(flat, F.lit(1), ni)
    return F.when(F.array_min(first_row) != F.array_max(first_row), first_row) \
        .otherwise(F.transform(F.sequence(F.lit(0), nj - 1), lambda r: F.element_at(flat, r * ni + 1)))


def with_axes(df: DataFrame) -> DataFrame:
    """Turn flat ``nj * ni`` coordinate arrays into 1-D axes; axes that are 1-D already stay.

    Done per message from its own header, before the values are split.
    """
    def axis(name: str, make, size: Column) -> Column:
        flat = F.size(name) == F.col("ni") * F.col("nj")
        return F.when(flat & (F.size(name) != size), make(F.col(name), F.col("ni"), F.col("nj"))) \
            .otherwise(F.col(name))

    return df.withColumns({"lats": axis("lats", latitude_axis, F.col("nj")),
                           "lons": axis("lons", longitude_axis, F.col("ni"))})


def valid_shape(df: DataFrame) -> Column:
    """False for messages whose array does not fill their grid; such messages cannot be reshaped.

    With a header column ``n_values`` the arrays themselves need not be read for this.
    """
    packed = isinstance(df.schema["values"].dataType, T.BinaryType)
    length = F.col("n_values") if "n_values" in df.columns else \
        F.octet_length("values") / 4 if packed else F.size("values")
    return F.coalesce(length == F.col("ni") * F.col("nj"), F.lit(False))


def cells_from_messages(df: DataFrame) -> DataFrame:
    """One row per grid point: flat position -> row and column, with the coordinates of that row and column."""
    keep = [c for c in df.columns if c not in ("values", "lats", "lons")]
    out = df.select(*keep, *(["lats", "lons"] if "lats" in df.columns else []),
                    F.posexplode("values").alias("_pos", "value"))
    ix = F.col("_pos") % F.col("ni")
    iy = ((F.col("_pos") - ix) / F.col("ni")).cast("int")
    out = out.withColumns({"iy": iy, "ix": ix})
    if "lats" in df.columns:
        out = out.withColumns({"lat": F.get("lats", F.col("iy")), "lon": F.get("lons", F.col("ix"))})
    return out.drop("_pos", "lats", "lons", "ni", "nj")


def tiles_from_messages(df: DataFrame, edge: int = TILE_EDGE, by_formula: dict[str, Kernel] | None = None,
                        packed: bool = False) -> DataFrame:
    """Split each array into blocks of at most ``edge`` x ``edge`` points; NaN becomes missing.

    With ``by_formula`` the kernel of a message's ``formula`` is applied to the whole message before. ``values`` is an
    array of FLOAT, or BINARY with the same numbers packed as little-endian float32, which is several times
    faster to scan; ``packed`` gives tiles in the same form.

    A map over Arrow batches without a shuffle. Built-in array functions can express it, but they box every element
    once per nesting level: on 245 million points they took 9 s, this takes 2 s.
    """
    keep = [c for c in df.columns if c not in ("values", "lats", "lons", "ni", "nj", "n_values")]
    ints, doubles = T.IntegerType(), T.ArrayType(T.DoubleType())
    kinds = {"lats": doubles, "lons": doubles, "values": T.BinaryType() if packed else T.ArrayType(T.FloatType())}
    schema = T.StructType([df.schema[c] for c in keep]
                          + [T.StructField(c, kinds.get(c, ints)) for c in (*TILE_KEY, *TILE_GEOMETRY, "values")])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _split_batch(batch, keep, edge, by_formula or {}, packed)

    return df.select(*keep, "ni", "nj", "lats", "lons", "values").mapInArrow(split, schema)


def _split_batch(batch: pa.RecordBatch, keep: list[str], edge: int, by_formula: dict[str, Kernel],
                 packed: bool) -> Iterator[pa.RecordBatch]:
    """The tiles of a batch, in batches of at most ``MOST_TILES`` tiles and about ``MOST_POINTS`` points."""
    def lists(name: str) -> tuple[np.ndarray, np.ndarray]:
        column = batch.column(name)
        if not pa.types.is_list(column.type):
            starts = np.frombuffer(column.buffers()[1], "int32")[column.offset:column.offset + len(column) + 1]
            return np.frombuffer(column.buffers()[2] or b"", "<f4"), starts // 4
        return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()

    numbers, at = lists("values")
    (lats, lat_at), (lons, lon_at) = lists("lats"), lists("lons")
    formulas = batch.column("formula").to_pylist() if by_formula else []
    rows, place, values, lat_parts, lon_parts = held = [], [], [], [], []
    points = 0

    def made() -> pa.RecordBatch:
        picked = pa.array(rows, pa.int64())
        columns = [batch.column(c).take(picked) for c in keep]
        columns += [pa.array(c, pa.int32()) for c in np.array(place, "int32").reshape(-1, 8).T]
        columns += [_list_array(parts, nan_is_missing=False) for parts in (lat_parts, lon_parts)]
        columns.append(pa.array([v.astype("<f4", copy=False).tobytes() for v in values], pa.binary()) if packed
                       else _list_array(values, nan_is_missing=True))
        for each in held:
            each.clear()
        return pa.RecordBatch.from_arrays(columns, names=[*keep, *TILE_KEY, *TILE_GEOMETRY, "values"])

    for i, (ni, nj) in enumerate(zip(batch.column("ni").to_pylist(), batch.column("nj").to_pylist())):
        whole = numbers[at[i]:at[i + 1]].reshape(nj, ni)
        kernel = by_formula.get((formulas[i] or "").lower()) if formulas else None
        if kernel is not None:
            whole = kernel(whole)
        for y0 in range(0, nj, edge):
            for x0 in range(0, ni, edge):
                block = whole[y0:y0 + edge, x0:x0 + edge]
                h, w = block.shape
                rows.append(i)
                place.append((y0 // edge, x0 // edge, nj, ni, y0, x0, h, w))
                values.append(block.ravel())
                lat_parts.append(lats[lat_at[i] + y0:lat_at[i] + y0 + h])
                lon_parts.append(lons[lon_at[i] + x0:lon_at[i] + x0 + w])
                points += h * w
                if len(rows) == MOST_TILES or points >= MOST_POINTS:
                    yield made()
                    points = 0
    if rows:
        yield made()


def _list_array(parts: list[np.ndarray], nan_is_missing: bool) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), from_pandas=nan_is_missing))


def cells_from_tiles(df: DataFrame) -> DataFrame:
    """One row per grid point of a tile; a tile without values gives missing cells."""
    df = unpacked(df)
    beside = {*TILE_KEY, *TILE_GEOMETRY, *TILE_STATS, *TILE_ZONE, TILE_ORDER, "values"}
    keep = [c for c in df.columns if c not in beside]
    filled = F.coalesce("values", F.array_repeat(F.lit(None).cast("float"), F.col("h") * F.col("w")))
    out = df.select(*keep, "y0", "x0", "w", "lats", "lons", F.posexplode(filled).alias("_pos", "value"))
    dx = F.col("_pos") % F.col("w")
    dy = ((F.col("_pos") - dx) / F.col("w")).cast("int")
    return out.withColumns({"iy": F.col("y0") + dy, "ix": F.col("x0") + dx,
                            "lat": F.get("lats", dy), "lon": F.get("lons", dx)}) \
        .drop("_pos", "y0", "x0", "w", "lats", "lons")


def pack_blocks(cells: DataFrame, keys: list[str], time: str = "valid_time", edge: int = TILE_EDGE,
                time_block: Column | None = None, most: int = 1 << 20) -> DataFrame:
    """Cells to spatial blocks that hold their time steps together, ordered by time, row and column.

    A block is cut after ``most`` cells, at the end of a step, so it stays bounded whatever the length of the series; ``tb`` numbers the
    parts of one place from 0 within the stretch of times a task holds, and the times of parts never overlap. Rows are dealt by
    ranges of place and time, so a place with a long series is worked on by many tasks, and none collects it. ``time_block``
    (e.g. ``floor(hour / 24)``) cuts the axis by the caller's own rule instead.
    """
    block = {"ty": F.floor(F.col("iy") / edge).cast("int"), "tx": F.floor(F.col("ix") / edge).cast("int")}
    group = [*keys, "ty", "tx"]
    entry = [time, "iy", "ix", "value"]
    if time_block is not None:
        cut = cells.withColumns({**block, "tb": time_block}).groupBy(*group, "tb")
        return cut.agg(F.array_sort(F.collect_list(F.struct(*entry))).alias("block"))
    placed = cells.withColumns(block).select(*group, *entry)
    placed = placed.repartitionByRange(*group, time).sortWithinPartitions(*group, *entry[:3])
    inner = T.StructType([T.StructField(f.name, f.dataType) for f in placed.schema if f.name in entry])
    schema = T.StructType([placed.schema[c] for c in group] + [T.StructField("tb", T.IntegerType()), T.StructField("block", T.ArrayType(inner))])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = None, 0
        for held in _stretches(batches, group, time, most):
            here = tuple(held.column(c)[0].as_py() for c in group)
            part = part + 1 if here == last else 0
            last = here
            rows = pa.StructArray.from_arrays([held.column(c).combine_chunks() if isinstance(held.column(c), pa.ChunkedArray) else held.column(c)
                                               for c in inner.names], names=inner.names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], held.schema.field(c).type) for c, v in zip(group, here, strict=True)]
                + [pa.array([part], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], names=schema.names)

    return placed.mapInArrow(close, schema)


def _stretches(batches: Iterator[pa.RecordBatch], group: list[str], time: str, most: int) -> Iterator[pa.Table]:
    """Tables of sorted rows of one group, closed at the end of the group or, from ``most`` rows on, at the end of a step."""
    held: list[pa.Table] = []
    size, last = 0, None
    for batch in batches:
        data = pa.Table.from_batches([batch])
        new_group, new_step = _changes(batch, group), _changes(batch, [*group, time])
        start = 0
        for at in [*np.nonzero(new_step)[0].tolist(), batch.num_rows]:
            if at == batch.num_rows or at > start:
                if at > start:
                    held.append(data.slice(start, at - start))
                    size += at - start
                    start = at
            if at < batch.num_rows:
                here = tuple(batch.column(c)[at].as_py() for c in (*group, time))
                if held and here != last and (size >= most or new_group[at] and here[:-1] != (last or ())[:-1]):
                    yield pa.concat_tables(held).combine_chunks()
                    held, size = [], 0
                last = here
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Whether a row differs in ``keys`` from the row before; the first one counts as different."""
    out = np.zeros(batch.num_rows, bool)
    out[:1] = True
    for key in keys:
        codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return out


def unpack_blocks(blocks: DataFrame) -> DataFrame:
    keep = [c for c in blocks.columns if c not in ("block", "ty", "tx", "tb")]
    return blocks.select(*keep, F.explode("block").alias("c")).select(*keep, "c.*")


def tiles_from_cells(cells: DataFrame, keys: list[str], edge: int = TILE_EDGE, order: str | None = None) -> DataFrame:
    """Ready-made cells to packed tiles; a tile is one block of one field and time, and absent cells are missing.

    ``keys`` are the columns of a field and the time last. Where several rows give a cell, the first present value by ``order`` counts
    (e.g. the path of the file), without ``order`` the smallest; a coordinate likewise. Each field has its own grid size, its greatest row
    and column. Other columns keep a value of the tile, the smallest.

    Cells are dealt by tile and sorted by place, and a task scatters them as they come into one block after the other, so it
    holds one block and one batch of cells. What a block has to know before, its grid size, comes as a row ahead of its cells.
    """
    rest = [c for c in cells.columns if c not in {*keys, "iy", "ix", "lat", "lon", "value", order}]
    tile = [*keys, *TILE_KEY]
    placed = cells.withColumns({"ty": F.floor(F.col("iy") / edge).cast("int"), "tx": F.floor(F.col("ix") / edge).cast("int")})
    heads = placed.groupBy(*tile).agg(F.max("iy").alias("_my"), F.max("ix").alias("_mx"), *[F.min(c).alias(c) for c in rest])
    sizes = heads.groupBy(*[F.col(c).alias(f"_{c}") for c in keys[:-1]]).agg(
        (F.max("_my") + 1).cast("int").alias("ny"), (F.max("_mx") + 1).cast("int").alias("nx"))
    same = F.lit(True)
    for c in keys[:-1]:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    heads = heads.join(sizes, same).select(*tile, *rest, "ny", "nx", F.lit(-1).alias("iy"), F.lit(-1).alias("ix"))
    points = placed.select(*tile, "iy", "ix", "lat", "lon", F.col("value").cast("float").alias("value"),
                           F.col(order).alias("_order") if order else F.lit(None).cast("string").alias("_order"))
    stream = points.unionByName(heads, allowMissingColumns=True).repartition(*tile) \
        .sortWithinPartitions(*tile, "iy", "ix", F.col("_order").asc_nulls_last(), "value", "lat", "lon")
    carried = [*tile, *rest]
    schema = T.StructType([stream.schema[c] for c in carried] + [
        T.StructField(c, T.ArrayType(T.DoubleType()) if c in ("lats", "lons") else T.IntegerType()) for c in TILE_GEOMETRY]
        + [T.StructField("values", T.BinaryType())])

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: _Block | None = None
        done: list[_Block] = []
        for batch in batches:
            iy, ix = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("iy", "ix"))
            lat, lon, value = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lat", "lon", "value"))
            heads_at = np.nonzero(iy < 0)[0].tolist()
            cuts = [0, *heads_at, batch.num_rows]
            for n, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if n:
                    if block is not None:
                        done.append(block)
                    row = {c: batch.column(c)[start].as_py() for c in (*TILE_KEY, "ny", "nx")}
                    block = _Block(batch.slice(start, 1), row, edge)
                    start += 1
                if end > start:
                    block.fill(iy[start:end], ix[start:end], lat[start:end], lon[start:end], value[start:end])
            if len(done) >= 16:
                yield _blocks(done, carried)
                done = []
        if block is not None:
            done.append(block)
        if done:
            yield _blocks(done, carried)

    return stream.mapInArrow(scatter, schema)


class _Block:
    """One tile while its cells come in."""

    def __init__(self, head: pa.RecordBatch, row: dict[str, int], edge: int) -> None:
        self.head = head
        y0, x0 = row["ty"] * edge, row["tx"] * edge
        h, w = min(edge, row["ny"] - y0), min(edge, row["nx"] - x0)
        self.place = (row["ny"], row["nx"], y0, x0, h, w)
        self.values = np.full(h * w, np.nan, "<f4")
        self.lats, self.lons = np.full(h, np.nan), np.full(w, np.nan)

    def fill(self, iy: np.ndarray, ix: np.ndarray, lat: np.ndarray, lon: np.ndarray, value: np.ndarray) -> None:
        _, _, y0, x0, _, w = self.place
        _first(self.values, (iy.astype("int64") - y0) * w + (ix - x0), value.astype("<f4", copy=False))
        _first(self.lats, iy - y0, lat)
        _first(self.lons, ix - x0, lon)


def _first(target: np.ndarray, at: np.ndarray, given: np.ndarray) -> None:
    """Put the first present number for each place that has none yet."""
    given = given.astype(target.dtype, copy=False)
    open_ = ~np.isnan(given) & np.isnan(target[at])
    at, given = at[open_][::-1], given[open_][::-1]
    target[at] = given  # of equal places the last assignment stays, which is the first number


def _blocks(done: list[_Block], carried: list[str]) -> pa.RecordBatch:
    heads = pa.Table.from_batches([b.head for b in done]).combine_chunks().to_batches()[0]
    columns = [heads.column(c) for c in carried]
    columns += [pa.array(c, pa.int32()) for c in np.array([b.place for b in done], "int32").T]
    columns += [_list_array([getattr(b, c) for b in done], nan_is_missing=True) for c in ("lats", "lons")]
    columns.append(pa.array([b.values.tobytes() for b in done], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=[*carried, *TILE_GEOMETRY, "values"])


def axis_points(tiles: DataFrame, keys: list[str], axis: str = "lats") -> DataFrame:
    """``(keys, position, coordinate)`` of the points of a grid's axis, from the tiles along its first column or row."""
    along, across = ("y0", "x0") if axis == "lats" else ("x0", "y0")
    edge_tiles = tiles.where(F.col(across) == 0).select(*keys, along, axis).distinct()
    points = edge_tiles.select(*keys, along, F.posexplode(axis).alias("_n", "coordinate"))
    return points.select(*keys, (F.col(along) + F.col("_n")).alias("position"), "coordinate")
