"""Fractions to percent, decided by the maximum of each field of each file.

A message is one field of one file, so whole messages need no shuffle for this (:func:`gridlake.kernels.percent`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.units import percent_factor


def scale_percent(cells: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """The same on cells: maxima per key, combined before the shuffle, joined back to the cells.

    The table of maxima has one row per field and file; adaptive execution broadcasts it if its measured size allows that, so that
    the cells stay where they are, and otherwise splits a field that holds a large share of the cells.
    """
    maxima = cells.groupBy(*keys).agg(F.max(F.nanvl(value, F.lit(None))).alias("_max"))
    kind = cells.schema[value].dataType
    scaled = (F.col(value) * percent_factor(F.col("_max")).cast(kind)).cast(kind)
    return cells.join(maxima, keys, "left").withColumn(value, scaled).drop("_max")
