"""Unit formulas by key, with an open registry."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlake import kernels
from gridlake.layout import per_element

KELVIN_OFFSET = 273.15
STANDARD_GRAVITY = 9.80665
PERCENT_LIMIT = 1.05


@dataclass(frozen=True)
class Formula:
    """``apply`` maps one value to one value and has to keep the FLOAT or DOUBLE type of its input."""

    apply: Callable[[Column], Column]
    units: str | None = None
    compat: bool = True  # False: an addition that compatibility mode leaves out
    kernel: kernels.Kernel | None = None  # the same on arrays of FLOAT


def _float(number: float) -> Column:
    # A FLOAT literal keeps FLOAT data in FLOAT; with DOUBLE data Spark widens it, hence _typed below.
    return F.lit(number).cast("float")


def _k2c(double: bool) -> Callable[[Column], Column]:
    offset = F.lit(KELVIN_OFFSET) if double else _float(KELVIN_OFFSET)
    return lambda x: x - offset


_REGISTRY: dict[str, Callable[[bool], Formula]] = {
    "k2c": lambda double: Formula(_k2c(double), "Celsius", kernel=kernels.k2c),
    "pa2hpa": lambda double: Formula(lambda x: _narrow(x / F.lit(100.0), double), "hPa", kernel=kernels.pa2hpa),
    "div98": lambda double: Formula(lambda x: _narrow(x / F.lit(STANDARD_GRAVITY), double), "m", False, kernels.div98),
}


def _narrow(x: Column, double: bool) -> Column:
    return x if double else x.cast("float")


def register_formula(key: str, apply: Callable[[Column], Column], units: str | None = None,
                     kernel: kernels.Kernel | None = None) -> None:
    """Add a formula, e.g. ``register_formula("joule2kwh", lambda x: x / 3.6e6, "kWh m-2")``.

    ``kernel`` may give the same on numpy arrays; without it tiles use ``apply`` element by element.
    """
    _REGISTRY[key.lower()] = lambda double: Formula(lambda x: _narrow(apply(x), double), units, kernel=kernel)


def unregister_formula(key: str) -> None:
    _REGISTRY.pop(key.lower(), None)


def formula_kernels(compat: bool = False) -> dict[str, kernels.Kernel]:
    """Kernels by key, for whole messages; ``percent`` is among them, since a message is one field of one file."""
    found = {k: make(False) for k, make in _REGISTRY.items()}
    return {"percent": kernels.percent} | {k: f.kernel for k, f in found.items() if f.kernel and (f.compat or not compat)}


def nan_to_null(value: Column, tiled: bool = False) -> Column:
    """Missing data is NULL from here on; Spark's max and avg would take NaN for a value."""
    if not tiled:
        return F.nanvl(value, F.lit(None))
    missing = F.array_contains(value, F.lit(float("nan")).cast("float"))
    return F.when(missing, F.transform(value, lambda x: F.nanvl(x, F.lit(None).cast("float")))).otherwise(value)


def formulas_without_kernel() -> list[str]:
    return [k for k, make in _REGISTRY.items() if make(False).kernel is None]


def apply_formula(value: Column, formula: Column, tiled: bool = False, double: bool = False,
                  compat: bool = False, without: Iterable[str] = ()) -> Column:
    """Convert by formula key; unknown keys, ``none`` and NULL leave the value as it is.

    The key is looked at once per row, so on tiles the choice is not repeated per element. ``percent`` needs
    the maximum of a field and lives in :mod:`gridlake.operators.percent`. Keys in ``without`` are left alone.
    """
    key = F.lower(formula)
    result = None
    for name, make in _REGISTRY.items():
        rule = make(double)
        if name in without or (compat and not rule.compat):
            continue
        converted = per_element(tiled, rule.apply, value)
        result = F.when(key == name, converted) if result is None else result.when(key == name, converted)
    return value if result is None else result.otherwise(value)


def formula_units(formula: Column, units: Column, compat: bool = False) -> Column:
    """Unit after conversion: the rule's own unit wins, a formula fills in where the rule names none."""
    key = F.lower(formula)
    given = F.nullif(units, F.lit("unknown"))
    by_formula = F.when(key == "percent", F.lit("%"))
    for name, make in _REGISTRY.items():
        rule = make(True)
        if rule.units and (rule.compat or not compat):
            by_formula = by_formula.when(key == name, F.lit(rule.units))
    return F.coalesce(given, by_formula, units)


def percent_factor(maximum: Column) -> Column:
    """100 for fractions (maximum at most 1.05), else 1; an all-missing field stays as it is."""
    return F.when(maximum <= F.lit(PERCENT_LIMIT), F.lit(100)).otherwise(F.lit(1))
