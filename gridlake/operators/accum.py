"""Run-total precipitation to amounts over the last N hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake import kernels
from gridlake.functions import names
from gridlake.functions.times import epoch_seconds
from gridlake.functions.wind import amount
from gridlake.layout import bind, is_packed, is_tiled, per_element, place_key, value_name
from gridlake.rules import Rules, label_hours, literal

AMOUNT_UNITS = "kg m-2"


def source_match(var: Column, shortname: Column, source: Column) -> Column:
    """A rule fits its source name itself, the name followed by a number, and any field with that short name."""
    rest = F.translate(F.substring(var, F.length(source) + 1, F.length(var)), ".", "")
    numbered = F.startswith(var, source) & rest.rlike("^[0-9]+$")
    return (var == source) | numbered | (F.coalesce(shortname, F.lit("")) == source)


def window_targets(var: Column, shortname: Column, rules: Rules) -> Column:
    """``array<struct<acc_hours, source>>`` a variable has to be turned into; the last fitting rule names the source."""
    sources: dict[int, list[str]] = {}
    for source, labels in rules.accumulations:
        for label in labels:
            hours = label_hours(label)
            if hours is not None:
                sources.setdefault(hours, []).append(source)
    table = literal([{"acc_hours": h, "sources": s} for h, s in sources.items()],
                    "array<struct<acc_hours:int,sources:array<string>>>")

    def targets(field: Column) -> Column:
        fitted = F.transform(table, lambda r: F.struct(
            r["acc_hours"].alias("acc_hours"),
            F.try_element_at(F.filter(r["sources"], lambda s: source_match(field["var"], field["shortname"], s)),
                             F.lit(-1)).alias("source")))
        return F.filter(fitted, lambda t: t["source"].isNotNull())

    return bind(F.struct(var.alias("var"), shortname.alias("shortname")), targets)


def exact_lag(value: str, keys: list[str], seconds: Column, hours: int) -> Column:
    """The value exactly ``hours`` earlier, NULL if no row has that time.

    A range frame of one point on the time axis: it works on uneven axes, and all lengths share one exchange
    and one sort. A window group is one field at one place, so it holds at most the steps of a run.
    """
    back = -hours * 3600
    return F.first(value).over(Window.partitionBy(*keys).orderBy(seconds).rangeBetween(back, back))


def sliding_amounts(df: DataFrame, hours: list[int], keys: list[str], time: str = "valid_time",
                    seconds: Column | None = None, wanted: str | None = None) -> DataFrame:
    """Rows of ``acc(T) - acc(T - N)`` for each N in ``hours``, in a new column ``acc_hours``.

    Negative differences become zero, a missing predecessor gives a missing amount. ``wanted`` names an array
    column with the lengths a row asks for; without it each row gets all of them.
    """
    tiled, packed, value = is_tiled(df), is_packed(df), value_name(df)
    df = df.withColumn("_s", seconds if seconds is not None else epoch_seconds(F.col(time)))
    before = F.array(*[F.struct(F.lit(n).alias("acc_hours"),
                                exact_lag(value, keys, F.col("_s"), n).alias("before")) for n in hours])
    df = df.withColumn("_before", before)
    chosen = F.col("_before") if wanted is None else \
        F.filter("_before", lambda b: F.array_contains(F.col(wanted), b["acc_hours"]))
    keep = [c for c in df.columns if c not in (value, "_before", "_s", "acc_hours")]
    out = df.select(*keep, value, F.explode(chosen).alias("_b"))
    return out.select(*keep, F.col("_b.acc_hours").alias("acc_hours"),
                      per_element(tiled, amount, F.col(value), F.col("_b.before"), kernel=kernels.amount,
                                  packed=packed).alias(value))


def accumulate(df: DataFrame, rules: Rules, dt_hours: float = 1.0, keys: list[str] | None = None,
               targets: str | None = None) -> DataFrame:
    """The new variables ``<var>_<N>h`` of all rules; inputs are not repeated.

    Only rows some rule fits enter the shuffle. Amounts themselves are no inputs, so running this on its own
    output adds nothing.
    """
    hours = rules.accumulation_hours
    keys = keys or [c for c in ("run_id", "var", "level_type", "level") if c in df.columns] + place_key(df)
    if targets is None:
        targets = "_targets"
        df = df.withColumn(targets, window_targets(F.col("var"), F.col("shortname"), rules))
    df = df.filter((F.size(targets) > 0) & F.col("acc_hours").isNull()).drop("acc_hours")
    if not hours:
        return df.withColumn("acc_hours", F.lit(None).cast("int")).drop(targets).limit(0)
    df = df.withColumn("_wanted", F.transform(targets, lambda t: t["acc_hours"]))
    out = sliding_amounts(df, hours, keys, wanted="_wanted")
    source = F.filter(F.col(targets), lambda t: t["acc_hours"] == F.col("acc_hours"))
    out = out.withColumns({
        "shortname": F.element_at(source, 1)["source"],
        "units": F.lit(AMOUNT_UNITS),
        "long_name": names.amount_long_name(F.col("acc_hours")),
        "level_type": F.coalesce("level_type", F.lit("surface")),
        "level": F.coalesce("level", F.lit(0.0)),
        "dt_hours": F.lit(float(dt_hours)),
        "source_name": F.col("var"),
    })
    return out.withColumn("var", names.amount_name(F.col("var"), F.col("acc_hours"))).drop(targets, "_wanted")
