"""Names of variables, levels and groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlake.rules import Rules, literal


def first_number(text: Column) -> Column:
    """First run of digits as an int (``RR12h`` -> 12), NULL without one."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).try_cast("int")


def group_hours(grp: Column) -> Column:
    """Window length in a group name (``surface_3h`` -> 3), NULL without one."""
    return F.nullif(F.regexp_extract(grp, r"(\d+)h", 1), F.lit("")).try_cast("int")


def fallback_name(field_id: Column) -> Column:
    return F.lower(F.translate(field_id, ".", "_"))


def normalise_level_type(raw: Column, rules: Rules) -> Column:
    """Message level type to field level type; anything unlisted is ``surface``."""
    table = literal(rules.level_types, "map<string,string>")
    return F.coalesce(F.try_element_at(table, raw), F.lit("surface"))


def grib_variable(shortname: Column, level_type: Column, level: Column) -> Column:
    """Name with level: always on pressure and PV levels, elsewhere unless the name shows the level already."""
    digits = level.cast("int").cast("string")
    vertical = level_type.isin("isobaric", "pv")
    with_level = (level > 0) & (vertical | ~F.contains(shortname, digits))
    return F.when(with_level, F.concat(shortname, digits)).otherwise(shortname)


def fa_variable(shortname: Column, level_type: Column, level: Column) -> Column:
    """Name with whole-number level: always on pressure levels, on height and PV levels if not zero."""
    with_level = (level_type == "isobaric") | (level_type.isin("height", "pv") & (level != 0))
    return F.when(with_level, F.concat(shortname, level.cast("int").cast("string"))).otherwise(shortname)


def amount_name(var: Column, hours: Column) -> Column:
    return F.concat(var, F.lit("_"), hours.cast("string"), F.lit("h"))


def amount_long_name(hours: Column) -> Column:
    return F.concat(hours.cast("string"), F.lit("h Accumulated Precipitation"))


def fa_level(field_id: Column, rules: Rules) -> Column:
    """``struct(level_type, level, suffix)`` of a raw code.

    The longest prefix that fits is taken; it fits when digits follow it, and the two near-surface prefixes
    also fit without digits, with 2 m for temperature and humidity and 10 m for wind.
    """
    near_surface = F.when(F.contains(field_id, F.lit("TEMPERATURE")) | F.contains(field_id, F.lit("HUMI")), F.lit(2.0)) \
        .when(F.contains(field_id, F.lit("VENT")), F.lit(10.0)).otherwise(F.lit(0.0))

    def parsed(level_type: str | Column, level: Column, suffix: Column) -> Column:
        kind = F.lit(level_type)
        return F.struct(kind.alias("level_type"), level.cast("double").alias("level"), suffix.alias("suffix"))

    branches: list[tuple[Column, Column]] = []
    for rule in sorted(rules.fa_levels, key=lambda r: len(r.prefix), reverse=True):
        pattern = f"^{rule.prefix}(\\d+)(.*)"
        digits = F.regexp_extract(field_id, pattern, 1)
        branches.append((field_id.rlike(pattern),
                         parsed(rule.level_type, digits.try_cast("double") * F.lit(rule.factor),
                                F.regexp_extract(field_id, pattern, 2))))
        if rule.prefix in ("CLS", "SURF"):
            branches.append((field_id.startswith(rule.prefix),
                             parsed(rule.level_type, near_surface,
                                    F.substring(field_id, F.lit(len(rule.prefix) + 1), F.length(field_id)))))
    unknown = parsed("unknown", F.lit(0.0), field_id)
    if not branches:
        return unknown
    chain = F.when(*branches[0])
    for condition, result in branches[1:]:
        chain = chain.when(condition, result)
    return chain.otherwise(unknown)

