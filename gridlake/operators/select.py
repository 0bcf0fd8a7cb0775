"""Selections on stored fields: by variable, time, box, value range and stride."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from gridlake import kernels
from gridlake.layout import is_packed, is_tiled, per_element, value_name, with_zone
from gridlake.operators.align import time_axes


def first_group(df: DataFrame, var: str | None = None) -> DataFrame:
    """(var, grp): the first group, by name, that holds a variable."""
    held = df if var is None else df.filter(F.col("var") == var)
    return held.groupBy("var").agg(F.min("grp").alias("grp"))


def read_field(df: DataFrame, var: str, group: str | None = None) -> DataFrame:
    """One variable of a named group, or of the first group that holds it."""
    field = df.filter(F.col("var") == var)
    if group is not None:
        return field.filter(F.col("grp") == group)
    # Exactly one row (one variable, its first group) decides, and all rows share its key: they are filtered in place.
    return field.join(F.broadcast(first_group(df, var)), ["var", "grp"], "left_semi")


def at_position(df: DataFrame, index: int, keys: list[str], time: str = "valid_time") -> DataFrame:
    """The step at a position of each field's sorted times; negative counts from the end.

    A field with a single time is returned as it is. The list of picked times has a row per field.
    """
    at = index + 1 if index >= 0 else index
    picked = F.when(F.col("n_times") > 1, F.array_compact(F.array(F.try_element_at("times", F.lit(at))))) \
        .otherwise(F.col("times"))
    keep = time_axes(df, keys, time).select(*keys, F.explode(picked).alias(time))
    return df.join(keep, [*keys, time], "left_semi")


_PARTS = re.compile(r"^(\d{4})(?:-(\d{2})(?:-(\d{2})(?:[T ](\d{2})(?::(\d{2})(?::(\d{2}(?:\.\d+)?))?)?)?)?)?$")


def label_period(label: str) -> tuple[datetime, datetime | None]:
    """Start and open end of the period a time text names; a full time has no end, it is a point."""
    found = _PARTS.match(label.strip())
    if not found:
        raise ValueError(f"not a time label: {label!r}")
    year, month, day, hour, minute, second = found.groups()
    start = datetime(int(year), int(month or 1), int(day or 1), int(hour or 0), int(minute or 0))
    if second is not None:
        return start + timedelta(seconds=float(second)), None
    if minute is not None:
        return start, start + timedelta(minutes=1)
    if hour is not None:
        return start, start + timedelta(hours=1)
    if day is not None:
        return start, start + timedelta(days=1)
    if month is not None:
        return start, (start.replace(day=1) + timedelta(days=32)).replace(day=1)
    return start, start.replace(year=start.year + 1)


def in_label(time: Column, label: str, kind: str | DataType = "timestamp") -> Column:
    """Whether a time is the one a text names, or lies in the period a shorter text names (``2026-08-19``)."""
    start, end = label_period(label)
    # As text, a time is read in the time zone of the session, whatever that of the machine.
    moment = lambda t: F.lit(t.isoformat(" ")).cast(kind)
    if end is None:
        return time == moment(start)
    return (time >= moment(start)) & (time < moment(end))


def at_label(df: DataFrame, label: str, time: str = "valid_time") -> DataFrame:
    """The step with this time, or all steps of the period a shorter text names."""
    return df.filter(in_label(F.col(time), label, df.schema[time].dataType))


def bounding_box(cells: DataFrame, lonmin: float, lonmax: float, latmin: float, latmax: float) -> DataFrame:
    """Cells inside a box, borders included."""
    return cells.filter(F.col("lon").between(lonmin, lonmax) & F.col("lat").between(latmin, latmax))


def tiles_in_box(tiles: DataFrame, lonmin: float, lonmax: float, latmin: float, latmax: float) -> DataFrame:
    """Tiles that touch a box; their cells still have to pass :func:`bounding_box`.

    Stored tiles carry their bounds as plain columns, so the conditions reach the scan and skip row groups and pages.
    """
    known = with_zone(tiles)
    return known.filter((F.col("lon_max") >= lonmin) & (F.col("lon_min") <= lonmax) & (F.col("lat_max") >= latmin) & (F.col("lat_min") <= latmax)) \
        .select(*tiles.columns)


def stride(cells: DataFrame, step: int) -> DataFrame:
    """Every ``step``-th row and column; steps below one count as one."""
    k = max(1, step)
    return cells.filter((F.col("iy") % k == 0) & (F.col("ix") % k == 0))


def clip(df: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Limit values to a range with optional sides; missing stays missing."""
    tiled, value = is_tiled(df), value_name(df)
    kind = "float" if tiled else df.schema[value].dataType
    return df.withColumn(value, per_element(tiled, lambda x: limited_column(x, low, high, kind), F.col(value),
                                            kernel=kernels.limited(low, high), packed=is_packed(df)))


def limited_column(x: Column, low: float | None, high: float | None, kind: str | DataType = "float") -> Column:
    if low is not None:
        x = F.when(x < low, F.lit(low).cast(kind)).otherwise(x)
    if high is not None:
        x = F.when(x > high, F.lit(high).cast(kind)).otherwise(x)
    return x


def in_range(cells: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Cells whose value lies in a range with optional sides."""
    if low is not None:
        cells = cells.filter(F.col("value") >= low)
    return cells if high is None else cells.filter(F.col("value") <= high)
