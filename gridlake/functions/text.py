"""Report text, attribute fallbacks and box strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX_KEYS = ("lonmin", "lonmax", "latmin", "latmax")


def first_attr(attrs: Column, names: list[str], default: Column) -> Column:
    """First attribute present among ``names``, else the default."""
    return F.coalesce(*[F.try_element_at(attrs, F.lit(n)) for n in names], default)


def long_name_of(attrs: Column, var: Column) -> Column:
    return first_attr(attrs, ["long_name", "GRIB_name"], var)


def units_of(attrs: Column) -> Column:
    return first_attr(attrs, ["units", "unit", "GRIB_units"], F.lit("unknown"))


def level_type_of(attrs: Column) -> Column:
    return first_attr(attrs, ["level_type", "GRIB_typeOfLevel"], F.lit("surface"))


def level_of(attrs: Column) -> Column:
    return first_attr(attrs, ["level_value", "level"], F.lit("0.0")).try_cast("double")


def inventory_line(var: Column, long_name: Column, units: Column, level_type: Column, level: Column) -> Column:
    """One variable of the inventory report; the level shows only if it is not zero."""
    level_text = F.when(F.coalesce(level, F.lit(0.0)) != 0, F.concat(F.lit(", level: "), level.cast("string")))
    return F.concat(
        F.lit("    - "), F.format_string("%-16s", var), F.lit(" : "), long_name, F.lit(" ["), units,
        F.lit("] (type: "), level_type, F.coalesce(level_text, F.lit("")), F.lit(")"))


def box_column(box: Column) -> Column:
    """``struct(lonmin, lonmax, latmin, latmax)`` from settings such as ``lonmin=-2, ...``; NULL unless all four have a number.

    Settings are separated by commas, names are case-free, of a name given twice the last one counts, and a number is whatever casts to
    DOUBLE. What is no setting is passed over.
    """
    settings = F.transform(F.split(box, ","), lambda part: F.split(part, "=", 2))
    named = F.filter(settings, lambda s: F.size(s) == 2)

    def bound(name: str) -> Column:
        given = F.filter(named, lambda s: F.lower(F.trim(s[0])) == name)
        return F.trim(F.try_element_at(given, F.lit(-1))[1]).try_cast("double")

    corners = F.struct(*[bound(name).alias(name) for name in BOX_KEYS])
    complete = F.forall(F.array(*[bound(name) for name in BOX_KEYS]), lambda x: x.isNotNull())
    return F.when(complete, corners)


def parse_box(text: str | None) -> dict[str, float] | None:
    """The same for one text given as an argument."""
    corners: dict[str, float | None] = dict.fromkeys(BOX_KEYS)
    for setting in (text or "").split(","):
        name, sign, number = setting.partition("=")
        if sign and name.strip().lower() in corners:
            corners[name.strip().lower()] = _number(number)
    return None if None in corners.values() else corners


def parse_limits(limits: str | tuple | list | None) -> tuple[float | None, float | None]:
    """Lower and upper limit from a pair or from text with a comma between; a side without a number is open."""
    sides = limits.partition(",")[::2] if isinstance(limits, str) else (limits or (None, None))
    low, high = (_number(side) for side in sides)
    return low, high


def _number(given: str | float | None) -> float | None:
    try:
        return float(given)
    except (TypeError, ValueError):
        return None
