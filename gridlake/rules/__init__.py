"""Rule tables: what a raw field code means, what is derived from it, and which group it goes to.

Rules are configuration of at most a few hundred entries that the driver always holds as Python values.
Operators therefore compile them into Column expressions (literal maps and arrays), which costs no join and
no shuffle; :meth:`Rules.tables` gives the same rules as DataFrames for inspection and SQL.
"""

from __future__ import annotations

import json
import logging
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.rules import defaults

log = logging.getLogger(__name__)


def literal(value, schema: str) -> Column:
    """A rule table as one literal of the plan (folded to a constant before execution)."""
    return F.from_json(F.lit(json.dumps(value)), schema)


@dataclass(frozen=True)
class FieldRule:
    field_id: str
    shortname: str
    units: str = "unknown"
    formula: str = "None"
    long_name: str | None = None


@dataclass(frozen=True)
class LevelRule:
    prefix: str
    level_type: str
    factor: float = 1


@dataclass(frozen=True)
class DerivedRule:
    out_var: str
    kind: str
    sources: tuple[str, ...]
    shortname: str | None = None
    units: str | None = None
    long_name: str | None = None


@dataclass(frozen=True)
class GroupRule:
    grp: str
    level_types: tuple[str, ...] = ()
    parameters: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    match_all: bool = False

    @property
    def hours(self) -> int | None:
        """Window length carried by the group name (``surface_3h`` -> 3)."""
        found = re.search(r"(\d+)h", self.grp)
        return int(found.group(1)) if found else None


def label_hours(label: str) -> int | None:
    """Window length carried by an accumulation label (``RR12h`` -> 12); None makes the label void."""
    found = re.search(r"(\d+)", label)
    return int(found.group(1)) if found else None


@dataclass(frozen=True)
class Rules:
    fa_fields: tuple[FieldRule, ...] = ()
    fa_levels: tuple[LevelRule, ...] = ()
    fa_skip: tuple[str, ...] = ()
    grib_fields: tuple[FieldRule, ...] = ()
    grib_skip: tuple[str, ...] = ()
    grib1_keys: dict[str, str] = field(default_factory=dict)
    grib2_keys: dict[str, str] = field(default_factory=dict)
    level_types: dict[str, str] = field(default_factory=lambda: dict(defaults.GRIB_LEVEL_TYPES))
    derived: tuple[DerivedRule, ...] = ()
    accumulations: tuple[tuple[str, tuple[str, ...]], ...] = ()
    groups: tuple[GroupRule, ...] = ()

    @property
    def accumulation_hours(self) -> list[int]:
        """All window lengths in order of first mention."""
        hours = [label_hours(label) for _, labels in self.accumulations for label in labels]
        return list(dict.fromkeys(h for h in hours if h is not None))

    def with_(self, **changes) -> "Rules":
        return replace(self, **changes)

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The rules as DataFrames."""
        maps = [("fa", r.field_id, i, r.shortname, r.units, r.formula, r.long_name)
                for i, r in enumerate(self.fa_fields)]
        maps += [("grib", r.field_id, i, r.shortname, r.units, r.formula, r.long_name)
                 for i, r in enumerate(self.grib_fields)]
        skips = [("fa", p, True) for p in self.fa_skip] + [("grib", p, False) for p in self.grib_skip]
        make = spark.createDataFrame
        return {
            "field_map": make(maps, "fmt string, field_id string, rule_order int, shortname string, "
                                    "units string, formula string, long_name string"),
            "level_map": make([(r.prefix, len(r.prefix), r.level_type, float(r.factor)) for r in self.fa_levels],
                              "prefix string, prefix_len int, level_type string, factor double"),
            "skip_rules": make(skips, "fmt string, pattern string, is_regex boolean"),
            "derived_rules": make([(r.out_var, i, r.kind, list(r.sources), r.units, r.long_name)
                                   for i, r in enumerate(self.derived)],
                                  "out_var string, rule_order int, kind string, sources array<string>, "
                                  "units string, long_name string"),
            "accum_rules": make([(src, label_hours(label)) for src, labels in self.accumulations
                                 for label in labels if label_hours(label) is not None],
                                "src_shortname string, hours int"),
            "group_rules": make([(r.grp, i, r.hours, list(r.level_types), list(r.parameters), list(r.exclude),
                                  r.match_all) for i, r in enumerate(self.groups)],
                                "grp string, grp_order int, hours int, level_types array<string>, "
                                "parameters array<string>, exclude array<string>, match_all boolean"),
        }


def default_rules() -> Rules:
    """The rules that ship with the package."""
    return Rules(
        fa_fields=tuple(FieldRule(*row) for row in defaults.FA_FIELDS),
        fa_levels=tuple(LevelRule(*row) for row in defaults.FA_LEVELS),
        fa_skip=tuple(defaults.FA_SKIP),
        grib_fields=tuple(FieldRule(*row) for row in defaults.GRIB_FIELDS),
        grib_skip=tuple(defaults.GRIB_SKIP),
        derived=tuple(DerivedRule(out, kind, tuple(sources), short, units, text)
                      for out, short, units, text, kind, sources in defaults.DERIVED_FIELDS),
        accumulations=tuple((src, tuple(labels)) for src, labels in defaults.ACCUMULATIONS),
        groups=tuple(GroupRule(grp, tuple(levels), tuple(params), tuple(exclude))
                     for grp, levels, params, exclude in defaults.GROUPS),
    )


def load_rules(spark: SparkSession, rules_dir: str | None = None, fa_file: str = "fa.json",
               grib_file: str = "grib.json", group_file: str = "groups.json") -> Rules:
    """Rules from a directory of JSON files on any file system Spark can reach, else the shipped ones.

    A missing or broken file gives empty sections and a warning; the other files still count.
    """
    if rules_dir is None:
        return default_rules()
    fa, grib, groups = (_read_json(spark, f"{rules_dir}/{name}") for name in (fa_file, grib_file, group_file))
    return Rules(
        fa_fields=_field_rules(fa.get("fields", {})),
        fa_levels=tuple(LevelRule(prefix, info["type"], info.get("factor", 1))
                        for prefix, info in fa.get("levels", {}).items()),
        fa_skip=tuple(fa.get("skip_fields", [])),
        grib_fields=_field_rules(grib.get("fields", {}), describe_by_id=True),
        grib_skip=tuple(grib.get("skip_shortnames", [])),
        grib1_keys=grib.get("grib1_keys", {}),
        grib2_keys=grib.get("grib2_keys", {}),
        derived=tuple(
            DerivedRule(out, info.get("recipe", {}).get("type"), tuple(info.get("recipe", {}).get("sources", [])),
                        info.get("shortname"), info.get("unit"), info.get("desc"))
            for out, info in fa.get("derived_fields", {}).items()),
        accumulations=tuple((src, tuple(labels)) for src, labels in fa.get("accumulations", {}).items()),
        groups=tuple(
            GroupRule(grp, tuple(m.get("level_types", [])), tuple(m.get("parameters", [])),
                      tuple(m.get("exclude", [])), bool(m.get("all", False)))
            for grp, m in ((g, body.get("match", {})) for g, body in groups.get("groups", {}).items())),
    )


def _field_rules(section: dict, describe_by_id: bool = False) -> tuple[FieldRule, ...]:
    return tuple(
        FieldRule(fid, f["shortname"], f.get("unit", "unknown"), f.get("formula", "None"),
                  f.get("desc", fid if describe_by_id else f["shortname"]))
        for fid, f in section.items())


def _read_json(spark: SparkSession, path: str) -> dict:
    try:
        rows = spark.read.text(path, wholetext=True).take(1)
        return json.loads(rows[0][0])
    except Exception as err:  # absent file, unreadable file or invalid JSON: same outcome
        log.warning("rule file %s not usable (%s); its sections stay empty", path, type(err).__name__)
        return {}
