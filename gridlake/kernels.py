"""Element-wise arithmetic on whole tiles, as numpy over Arrow batches.

Built-in array functions box every element; on tiles of 65,536 points that is most of the time of a conversion. A
kernel sees the points of a whole batch as one flat array. Each kernel has a Column twin in
:mod:`gridlake.functions` that serves cells, and tests hold the two together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Kernel = Callable[..., np.ndarray]

#: Tiles and points a Python worker holds as objects at once. A batch may have 65,536 rows, and a row many tiles.
MOST_TILES, MOST_POINTS = 2048, 1 << 20


def slices(batches: Iterator[pa.RecordBatch], rows: int = MOST_TILES) -> Iterator[pa.RecordBatch]:
    """The batches in views of at most ``rows`` rows, none of them empty."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def on_tiles(kernel: Kernel, *columns: Column, packed: bool = False) -> Column:
    """``kernel`` on the points of one or two columns of equal lengths; a missing tile gives a missing tile.

    Columns are arrays of FLOAT, or BINARY if ``packed``; the result is of the same kind.
    """
    one = lambda a: _apply(kernel, a)
    two = lambda a, b: _apply(kernel, a, b)
    return F.arrow_udf(one if len(columns) == 1 else two, _kind(packed), F.ArrowUDFType.SCALAR)(*columns)


def on_tiles_by(choice: Column, kernels: dict[str, Kernel], first: Column, second: Column, packed: bool = False) -> Column:
    """The same with the kernel named by a column; it is looked up once per name and batch."""
    def run(names: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        parts, order = [], []
        for name in names.unique().to_pylist():
            at = pc.indices_nonzero(pc.equal(names, name))
            parts.append(_apply(kernels[name], a.take(at), b.take(at)))
            order.append(at)
        if not parts:
            return a
        back = np.argsort(pa.concat_arrays(order).to_numpy())
        return pa.concat_arrays(parts).take(pa.array(back))

    return F.arrow_udf(run, _kind(packed), F.ArrowUDFType.SCALAR)(choice, first, second)


def _kind(packed: bool) -> T.DataType:
    return T.BinaryType() if packed else T.ArrayType(T.FloatType())


STATS = T.StructType([T.StructField("n_present", T.IntegerType()), T.StructField("v_sum", T.DoubleType()),
                      T.StructField("v_min", T.FloatType()), T.StructField("v_max", T.FloatType())])
DIFFERENCE = T.StructType([T.StructField("max_abs", T.FloatType()), T.StructField("n", T.LongType()), T.StructField("n_one_sided", T.LongType())])


def tile_stats(values: Column) -> Column:
    """``struct(n_present, v_sum, v_min, v_max)`` of each tile; sum and bounds are NULL where no point is present."""
    def run(a: pa.Array) -> pa.Array:
        parts = [some(a.slice(at, MOST_TILES)) for at in range(0, max(1, len(a)), MOST_TILES)]
        return pa.concat_arrays(parts)

    def some(a: pa.Array) -> pa.Array:
        counts, sums, lows, highs = [], [], [], []
        for points in _each(a):
            points = points[~np.isnan(points)]
            counts.append(len(points))
            sums.append(float(points.sum(dtype="float64")) if len(points) else None)
            lows.append(points.min() if len(points) else None)
            highs.append(points.max() if len(points) else None)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int32()), pa.array(sums, pa.float64()), pa.array(lows, pa.float32()), pa.array(highs, pa.float32())],
            names=STATS.names)

    return F.arrow_udf(run, STATS, F.ArrowUDFType.SCALAR)(values)


def tile_difference(a: Column, b: Column) -> Column:
    """``struct(max_abs, n, n_one_sided)`` of two tiles of one place; a side that is NULL as a whole has no values."""
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        largest, counts, gaps = [], [], []
        for x, y in zip(_each(left), _each(right), strict=True):
            n = max(len(x), len(y))
            x, y = (v if len(v) else np.full(n, np.nan, "<f4") for v in (x, y))
            both = ~np.isnan(x) & ~np.isnan(y)
            largest.append(np.abs(x[both] - y[both]).max() if both.any() else None)
            counts.append(n)
            gaps.append(int((np.isnan(x) != np.isnan(y)).sum()))
        return pa.StructArray.from_arrays([pa.array(largest, pa.float32()), pa.array(counts, pa.int64()), pa.array(gaps, pa.int64())],
                                          names=DIFFERENCE.names)

    return F.arrow_udf(run, DIFFERENCE, F.ArrowUDFType.SCALAR)(a, b)


def limited(low: float | None, high: float | None) -> Kernel:
    """Kernel that limits values to a range; missing stays missing."""
    return lambda x: np.clip(x, None if low is None else np.float32(low), None if high is None else np.float32(high)) \
        if low is not None or high is not None else x


def _each(a: pa.Array) -> list[np.ndarray]:
    """The points of every row, none for a missing tile."""
    valid = a.is_valid()
    lengths = pc.divide(pc.binary_length(a), 4) if pa.types.is_binary(a.type) else pc.list_value_length(a)
    sizes = np.where(valid.to_numpy(zero_copy_only=False), pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), 0)
    return np.split(_points(a, valid), np.cumsum(sizes)[:-1]) if len(a) else []


def unpack(packed: Column) -> Column:
    """Packed tiles to arrays of FLOAT; NaN becomes missing.

    Spark shuffles, sorts and writes a packed tile as one block of bytes instead of a value at a time, so tiles are
    unpacked only where single points are wanted.
    """
    def run(a: pa.Array) -> pa.Array:
        return _lists(a)

    return F.arrow_udf(run, T.ArrayType(T.FloatType()), F.ArrowUDFType.SCALAR)(packed)


def to_bytes(a: pa.Array) -> pa.Array:
    """List array to packed bytes, NaN for missing."""
    return _encode(_points(a, a.is_valid()), a.is_valid(), pc.list_value_length(a), packed=True)


def _lists(a: pa.Array) -> pa.Array:
    return _encode(_points(a, a.is_valid()), a.is_valid(), pc.binary_length(a), packed=False, width=4)


def _points(a: pa.Array, valid: pa.Array) -> np.ndarray:
    """All points of the valid rows as one flat array, NaN where missing."""
    present = a.filter(valid)
    if not pa.types.is_binary(a.type):
        return present.flatten().to_numpy(zero_copy_only=False).astype("<f4", copy=False)
    if not len(present):
        return np.empty(0, "<f4")
    ends = np.frombuffer(present.buffers()[1], "int32")[present.offset:present.offset + len(present) + 1]
    return np.frombuffer(present.buffers()[2] or b"", "u1")[ends[0]:ends[-1]].view("<f4")


def _encode(numbers: np.ndarray, valid: pa.Array, lengths: pa.Array, packed: bool, width: int = 1) -> pa.Array:
    offsets = _offsets(valid, lengths) // width
    if not packed:
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers, from_pandas=True), mask=pc.invert(valid))
    bits = np.packbits(valid.to_numpy(zero_copy_only=False), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(valid), [pa.py_buffer(bits), pa.py_buffer(offsets * np.int32(4)),
                                                           pa.py_buffer(np.ascontiguousarray(numbers, "<f4"))])


def _offsets(valid: pa.Array, lengths: pa.Array) -> np.ndarray:
    sizes = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(np.where(valid.to_numpy(zero_copy_only=False), sizes, 0), dtype="int64")])
    if 4 * ends[-1] >= 1 << 31:
        raise OverflowError(f"a batch of {ends[-1]} points does not fit one Arrow array; lower spark.sql.execution.arrow.maxBytesPerBatch")
    return ends.astype("int32")


def _apply(kernel: Kernel, *arrays: pa.Array) -> pa.Array:
    valid = arrays[0].is_valid()
    for a in arrays[1:]:
        valid = pc.and_(valid, a.is_valid())
    numbers = kernel(*[_points(a, valid) for a in arrays]).astype("<f4", copy=False)
    if pa.types.is_binary(arrays[0].type):
        lengths = pc.divide(pc.binary_length(arrays[0]), 4)
        return _encode(numbers, valid, lengths, packed=True)
    return _encode(numbers, valid, pc.list_value_length(arrays[0]), packed=False)


def vector_magnitude(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.sqrt(u * u + v * v)


def vector_direction(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    u, v = u.astype("float64"), v.astype("float64")
    degrees = (np.degrees(np.arctan2(-u, -v)) + 360.0) % 360.0
    return np.where((u == 0) & (v == 0), 180.0, degrees)


def total(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a + b


def amount(now: np.ndarray, before: np.ndarray) -> np.ndarray:
    return now - np.where(before > now, now, before)


def k2c(x: np.ndarray) -> np.ndarray:
    return x - np.float32(273.15)


def pa2hpa(x: np.ndarray) -> np.ndarray:
    return x / np.float32(100)


def div98(x: np.ndarray) -> np.ndarray:
    return (x.astype("float64") / 9.80665).astype("float32")


def percent(x: np.ndarray) -> np.ndarray:
    """Decided by the maximum of the whole message, missing points aside."""
    present = x[~np.isnan(x)]
    return x * np.float32(100) if len(present) and present.max() <= np.float32(1.05) else x
