"""Fields computed from two other fields at the same time and place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake import kernels
from gridlake.functions.wind import vector_direction, vector_magnitude
from gridlake.kernels import on_tiles_by
from gridlake.layout import geometry, is_packed, is_tiled, place_key, value_name
from gridlake.rules import DerivedRule

# recipe: function of two Columns, kernel for tiles
RECIPES: dict[str, tuple[Callable[[Column, Column], Column], kernels.Kernel]] = {
    "vector_magnitude": (vector_magnitude, kernels.vector_magnitude),
    "vector_direction": (vector_direction, kernels.vector_direction),
    "accumulation": (lambda a, b: a + b, kernels.total),
}
WIND = ("vector_magnitude", "vector_direction")
SUMS = ("accumulation",)


def usable(rules: tuple[DerivedRule, ...], kinds: tuple[str, ...]) -> list[DerivedRule]:
    return [r for r in rules if r.kind in kinds and len(r.sources) == 2]


def derive(df: DataFrame, rules: list[DerivedRule], keys: list[str] | None = None,
           by_level: bool = True) -> DataFrame:
    """All recipes in one pass: the sources of a time and place meet in one group, and each recipe whose two
    sources are there gives one row.

    Only source variables enter the shuffle, and a group holds at most one row per source.
    """
    tiled, value = is_tiled(df), value_name(df)
    kind = df.schema[value].dataType
    sources = list(dict.fromkeys(s for r in rules for s in r.sources))
    keys = keys or [c for c in ("run_id", "valid_time") if c in df.columns] + place_key(df)
    level = [c for c in ("level_type", "level") if by_level and c in df.columns]
    shape = [c for c in geometry(df) if c not in keys]

    def pick(source: str) -> Column:
        found = F.when(F.col("var") == source, F.col(value))
        return (F.first(found, ignorenulls=True) if tiled else F.max(found)).alias(f"_v_{source}")

    groups = df.filter(F.col("var").isin(*sources)).groupBy(*keys, *level) \
        .agg(*[pick(s) for s in sources], *[F.first(c).alias(c) for c in shape])

    def result(rule: DerivedRule) -> Column:
        a, b = (F.col(f"_v_{s}") for s in rule.sources)
        number = a if tiled else RECIPES[rule.kind][0](a, b).cast(kind)
        return F.when(a.isNotNull() & b.isNotNull(), F.struct(
            F.lit(rule.out_var).alias("var"), F.lit(rule.shortname or rule.out_var).alias("shortname"),
            F.lit(rule.units).alias("units"), F.lit(rule.long_name).alias("long_name"),
            F.lit(rule.kind).alias("_kind"), number.alias(value), b.alias("_b")))

    if not rules:
        raise ValueError("no recipe to run")
    rows = groups.select(*keys, *level, *shape,
                         F.explode(F.array_compact(F.array(*[result(r) for r in rules]))).alias("_r"))
    rows = rows.select(*keys, *level, *shape, "_r.*")
    if tiled:
        recipes = {k: RECIPES[k][1] for k in dict.fromkeys(r.kind for r in rules)}
        rows = rows.withColumn(value, on_tiles_by(F.col("_kind"), recipes, F.col(value), F.col("_b"),
                                                  is_packed(df)))
    return rows.drop("_kind", "_b")
