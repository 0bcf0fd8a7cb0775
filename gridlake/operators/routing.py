"""Which groups a variable belongs to, and the leading steps an N-hour group leaves out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.names import group_hours
from gridlake.operators.align import time_positions
from gridlake.rules import GroupRule, Rules

DEFAULT_GROUP = "surface"


def group_match(rule: GroupRule, var: Column, level_type: Column, acc_hours: Column) -> Column:
    """A group takes a variable by window length, by name, by level type, or because it takes all.

    By level type a variable with a window length only enters groups that have one too. The exclude list beats
    everything.
    """
    match = F.lit(rule.match_all)
    if rule.hours is not None:
        match = match | (F.coalesce(acc_hours, F.lit(-1)) == rule.hours)
    if rule.parameters:
        match = match | var.isin(*rule.parameters)
    if rule.level_types:
        by_level = F.coalesce(level_type, F.lit("")).isin(*rule.level_types)
        match = match | (by_level if rule.hours is not None else by_level & acc_hours.isNull())
    return match & ~var.isin(*rule.exclude) if rule.exclude else match


def fallback_group(rules: Rules) -> str:
    names = [r.grp for r in rules.groups]
    return next((g for g in ("others", "surface") if g in names), names[0] if names else DEFAULT_GROUP)


def matched_groups(var: Column, level_type: Column, acc_hours: Column, rules: Rules) -> Column:
    """Array of the groups whose rule fits, empty if none does."""
    hits = [F.when(group_match(r, var, level_type, acc_hours), F.lit(r.grp)) for r in rules.groups]
    return F.array_compact(F.array(*hits)) if hits else F.array(F.lit(DEFAULT_GROUP))


def groups_of(var: Column, level_type: Column, acc_hours: Column, rules: Rules) -> Column:
    """Array of groups; a variable no rule takes goes to ``others``, else ``surface``, else the first group."""
    hits = matched_groups(var, level_type, acc_hours, rules)
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(fallback_group(rules))))


def route(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per row and group. Routing depends on the row alone, so it is a projection before the write."""
    groups = groups_of(F.col("var"), F.col("level_type"), F.col("acc_hours"), rules)
    return df.withColumn("grp", F.explode(groups))


def leading_steps(grp: Column, dt_hours: Column) -> Column:
    """Steps to drop for an N-hour group, 0 for others; halves go to the even number."""
    return F.coalesce(F.bround(group_hours(grp) / dt_hours).cast("int"), F.lit(0))


def group_steps(df: DataFrame) -> DataFrame:
    """(run, group, steps to drop): the first ``dt_hours`` by variable name counts, 1 without any."""
    known = F.col("dt_hours").isNotNull()
    first = F.min_by(F.when(known, F.col("dt_hours")), F.when(known, F.col("var")))
    return df.groupBy("run_id", "grp").agg(F.coalesce(first, F.lit(1.0)).alias("_dt")) \
        .select("run_id", "grp", leading_steps(F.col("grp"), F.col("_dt")).alias("steps"))


def kept_times(df: DataFrame, axis: DataFrame | None = None, time: str = "valid_time") -> DataFrame:
    """(run, group, time) that stay when N-hour groups lose their first steps by position.

    Positions count on the time axis of the whole run (``axis``, by default that of ``df``). A group whose axis is
    too short for the cut keeps everything.
    """
    positions = time_positions(axis if axis is not None else df, ["run_id"], time)
    return positions.join(group_steps(df), "run_id") \
        .filter((F.col("steps") >= F.col("n_times")) | (F.col("t_idx") >= F.col("steps"))) \
        .select("run_id", "grp", time)


def trim_leading(df: DataFrame, axis: DataFrame | None = None, time: str = "valid_time") -> DataFrame:
    """Drop the first steps of N-hour groups by position; the list of kept times is header-sized."""
    return df.join(kept_times(df, axis, time), ["run_id", "grp", time], "left_semi")
