"""From raw field codes to canonical variables.

Rules are literals in the plan, so this is one projection over message headers: no join, no shuffle, and the
value arrays are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions import names
from gridlake.layout import bind
from gridlake.rules import FieldRule, Rules, literal

RULE_COLUMNS = ["shortname", "units", "formula", "long_name"]


RULE_TYPE = "struct<shortname:string,units:string,formula:string,long_name:string>"


def _entry(rule: FieldRule) -> dict:
    return {c: getattr(rule, c) for c in RULE_COLUMNS}


def _lookup(rules: tuple[FieldRule, ...], key: Column) -> Column:
    """Rule by exact code; of two rules with the same code the later counts."""
    table = literal({r.field_id: _entry(r) for r in rules}, f"map<string,{RULE_TYPE}>")
    return F.try_element_at(table, key)


def skip_condition(field_id: Column, patterns: tuple[str, ...]) -> Column:
    """True where a pattern occurs in the code, literally or as a regular expression."""
    if not patterns:
        return F.lit(False)
    literally = F.exists(literal(list(patterns), "array<string>"), lambda p: F.contains(field_id, p))
    return literally | field_id.rlike("|".join(f"(?:{p})" for p in patterns))


def skip_fa(df: DataFrame, rules: Rules, id_col: str = "field_id") -> DataFrame:
    """Drop the codes a skip pattern hits; this comes before any mapping."""
    return df.filter(~skip_condition(F.col(id_col), rules.fa_skip))


def suffix_rule(suffix: Column, rules: Rules) -> Column:
    """The first field rule, in file order, whose code ends the given text (dots count as underscores)."""
    table = literal([{"ending": r.field_id.replace(".", "_"), "rule": _entry(r)} for r in rules.fa_fields],
                    f"array<struct<ending:string,rule:{RULE_TYPE}>>")
    first = lambda text: F.try_element_at(F.filter(table, lambda r: F.endswith(text, r["ending"])), F.lit(1))
    return bind(F.translate(suffix, ".", "_"), first)["rule"]


def resolve_fa(df: DataFrame, rules: Rules, id_col: str = "field_id") -> DataFrame:
    """Skip, map and name FA-like codes.

    An exact code is a surface field. Otherwise the level prefix is parsed off and the rest matched by suffix;
    a code no rule knows keeps its own name in lower case.
    """
    fid = F.col(id_col)
    unknown = F.struct(names.fallback_name(fid).alias("shortname"), F.lit("unknown").alias("units"),
                       F.lit("None").alias("formula"), F.concat(F.lit("Field "), fid).alias("long_name"))
    df = skip_fa(df, rules, id_col)
    df = df.withColumns({"_exact": _lookup(rules.fa_fields, fid), "_level": names.fa_level(fid, rules)})
    df = df.withColumn("_rule", F.coalesce("_exact", suffix_rule(F.col("_level.suffix"), rules), unknown))
    exact = F.col("_exact").isNotNull()
    df = df.withColumns({
        **{c: F.col(f"_rule.{c}") for c in RULE_COLUMNS},
        "level_type": F.when(exact, F.lit("surface")).otherwise(F.col("_level.level_type")),
        "level": F.when(exact, F.lit(0.0)).otherwise(F.col("_level.level")),
        "source_name": fid,
    }).drop("_exact", "_level", "_rule")
    return df.withColumn("var", names.fa_variable(F.col("shortname"), F.col("level_type"), F.col("level")))


def message_code(df: DataFrame, rules: Rules, id_col: str = "field_id") -> Column:
    """The short name of a GRIB-like message: by numeric key if the rules hold any, else its own."""
    own = F.col(id_col)
    has = set(df.columns)
    by_key = []
    if rules.grib2_keys and {"discipline", "category", "number"} <= has:
        key = F.concat_ws(".", *[F.col(c).cast("string") for c in ("discipline", "category", "number")])
        by_key.append(F.when(F.col("edition") == 2, _from_map(rules.grib2_keys, key)))
    if rules.grib1_keys and "indicator_of_parameter" in has:
        by_key.append(F.when(F.col("edition") != 2,
                             _from_map(rules.grib1_keys, F.col("indicator_of_parameter").cast("string"))))
    return F.coalesce(*by_key, own) if by_key else own


def _from_map(pairs: dict[str, str], key: Column) -> Column:
    return F.nullif(F.try_element_at(literal(pairs, "map<string,string>"), key), F.lit(""))


def resolve_grib(df: DataFrame, rules: Rules, id_col: str = "field_id",
                 level_type_col: str = "level_type_raw", level_col: str = "level_raw") -> DataFrame:
    """Look up, skip, map and name GRIB-like messages; messages without a rule are dropped."""
    df = df.withColumn("source_name", message_code(df, rules, id_col))
    name = F.col("source_name")
    df = df.filter(name.isNotNull() & (name != "") & ~name.isin(*rules.grib_skip)) if rules.grib_skip \
        else df.filter(name.isNotNull() & (name != ""))
    df = df.withColumn("_rule", _lookup(rules.grib_fields, name)).filter(F.col("_rule").isNotNull())
    level_known = F.col(level_type_col).isNotNull() & F.col(level_col).isNotNull()
    df = df.withColumns({
        **{c: F.col(f"_rule.{c}") for c in RULE_COLUMNS},
        "level_type": names.normalise_level_type(F.when(level_known, F.col(level_type_col)), rules),
        "level": F.when(level_known, F.col(level_col)).otherwise(F.lit(0)).cast("double"),
    }).drop("_rule")
    return df.withColumn("var", names.grib_variable(F.col("shortname"), F.col("level_type"), F.col("level")))
