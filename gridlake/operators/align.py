"""Duplicates, time axes and the union of runs, files and derived variables.

Decisions are taken on headers (keys, file, message number). The rows that carry value arrays are only filtered
by the outcome, so they are not shuffled for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.layout import value_name


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the one with the highest ``order``; for rows without arrays.

    ``max_by`` combines before the shuffle, so a key with many duplicates arrives as a few rows.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_w")).select(*keys, "_w.*")


def superseded_messages(headers: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``order`` columns of messages that a later message of the same key replaces."""
    winners = headers.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_win"), F.count(F.lit(1)).alias("_n")) \
        .filter("_n > 1").drop("_n")
    return headers.join(winners, keys).filter(F.struct(*order) < F.col("_win")).select(*order).distinct()


def superseded_files(headers: DataFrame, keys: list[str], file: str = "source_file") -> DataFrame:
    """(key, file) pairs that lose because a file earlier in path order has the same time."""
    pairs = headers.select(*keys, file).distinct()
    first = pairs.groupBy(*keys).agg(F.min(file).alias("_first"))
    return pairs.join(first, keys).filter(F.col(file) != F.col("_first")).select(*keys, file)


def first_file_wins(df: DataFrame, keys: list[str], file: str = "source_file") -> DataFrame:
    """For each time keep the rows of the first file only.

    The winners are one row per time, reduced before the shuffle; a time that holds a large share of all rows
    is split by the adaptive skew join.
    """
    first = df.groupBy(*keys).agg(F.min(file).alias(file))
    return df.join(first, [*keys, file], "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not listed. The planner follows the measured size of the list; one that was written knows it beforehand, so that
    the rows are filtered where they are."""
    return df.join(listed, on, "left_anti")


def missing_times(df: DataFrame, field_keys: list[str], time: str = "valid_time", run: str = "run_id") -> DataFrame:
    """(field, time) pairs a field lacks although another field of its run has that time.

    Works on distinct header keys only; the time axis of a run is as long as its forecast has steps.
    """
    keys = list(dict.fromkeys([run, *field_keys]))
    have = df.select(*keys, time).distinct()
    times = have.groupBy(run).agg(F.collect_set(time).alias("_times"))
    wanted = have.select(*keys).distinct().join(times, run).select(*keys, F.explode("_times").alias(time))
    return wanted.join(have, [*keys, time], "left_anti")


def align_outer(df: DataFrame, field_keys: list[str], time: str = "valid_time", run: str = "run_id") -> DataFrame:
    """Give all fields of a run the union of its times; new rows have missing values.

    Only the gaps are computed and appended, existing rows pass through unmoved.
    """
    gaps = missing_times(df, field_keys, time, run)
    return df.unionByName(gaps, allowMissingColumns=True)


def concat(frames: list[DataFrame]) -> DataFrame:
    """Union by name; what a frame lacks is missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def replace_variables(df: DataFrame, new: DataFrame, new_names: DataFrame | None = None,
                      on: list[str] | None = None) -> DataFrame:
    """Append variables; an existing variable of the same name is replaced.

    ``new_names`` may give the names when they are known without computing ``new``.
    """
    on = on or [c for c in ("run_id", "var") if c in df.columns]
    listed = (new_names if new_names is not None else new).select(*on).distinct()
    return drop_listed(df, listed, on).unionByName(new, allowMissingColumns=True)


def present(df: DataFrame) -> DataFrame:
    """Rows that carry any value at all."""
    return df.filter(F.col(value_name(df)).isNotNull())


def time_axes(df: DataFrame, keys: list[str], time: str = "valid_time") -> DataFrame:
    """Sorted distinct times per key in one array, with their number.

    Distinct comes first and is combined before the shuffle; an axis is as long as a run has steps.
    """
    axes = df.select(*keys, time).distinct().groupBy(*keys) \
        .agg(F.array_sort(F.collect_list(time)).alias("times"))
    return axes.withColumn("n_times", F.size("times"))


def time_positions(df: DataFrame, keys: list[str], time: str = "valid_time") -> DataFrame:
    """(key, time, position of the time on the key's axis, length of the axis)"""
    return time_axes(df, keys, time).select(*keys, F.posexplode("times").alias("t_idx", time), "n_times")
