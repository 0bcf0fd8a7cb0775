"""Conversion of decoded runs into group tiles.

Two passes over the messages. The first reads headers only (a fraction of a percent of the bytes) and settles
everything that depends on more than one message: duplicates, times taken by an earlier file, which sources and
new names exist. The second splits the arrays into tiles, converts units and writes; only precipitation and wind
components are shuffled, for windows over time and for pairing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridlake.functions import names, units
from gridlake.layout import FIELD_KEY, TILE_GEOMETRY, TILE_KEY, packed, unpacked
from gridlake.operators import accum, align, derived, grid, routing
from gridlake.rules import DerivedRule, Rules, load_rules
from gridlake.session import apply_settings, known, remove_dir, scratch_dir
from gridlake.sources import files, messages as msg

log = logging.getLogger(__name__)

TILE_COLUMNS = ["run_id", "var", "shortname", "units", "long_name", "level_type", "level", "acc_hours", "dt_hours",
                "source_name", "field_order", "valid_time", *TILE_KEY, *TILE_GEOMETRY, "values"]
# Derived variables stand behind those that were read, amounts first.
AMOUNT_ORDER, DERIVED_ORDER = 1_000_000, 2_000_000


@dataclass
class RunReport:
    """What a conversion left out: messages by reason, and the table with their headers, if any was written."""

    counts: dict[str, int] = field(default_factory=dict)
    rejected: str | None = None


class EmptyRun(Exception):
    """Nothing to convert."""


class MixedGrid(Exception):
    """Messages of one field differ in grid size."""


def decoder(fmt: str) -> Callable[..., DataFrame]:
    if fmt == "fa":
        return msg.decode_fa
    if fmt == "grib":
        return msg.decode_grib
    raise EmptyRun(f"unsupported message format {fmt!r}")


def with_run(df: DataFrame, run_id: str | None) -> DataFrame:
    return df if run_id is None else df.withColumn("run_id", F.lit(run_id))


def message_key(fmt: str, compat: bool) -> list[str]:
    """Messages with the same key replace each other."""
    if fmt == "grib":
        return ["run_id", "shortname", "level_type", "level", "valid_time"]
    return ["run_id", "source_file", "var"] if compat else ["run_id", "source_file", "var", "level_type", "level"]


def superseded(headers: DataFrame, signs: dict[str, int], fmt: str, compat: bool) -> list[tuple[DataFrame, list[str]]]:
    """What is replaced, as (key table, key columns). Nothing is computed for a kind of conflict no field shows."""
    out = []
    order = ["run_id", *msg.ORDER]
    if signs["repeated"] or compat and signs["named_twice"]:
        out.append((align.superseded_messages(headers, message_key(fmt, compat), order), order))
    if fmt == "fa" and signs["shared_time"]:
        on = ["run_id", "valid_time", "source_file"]
        out.append((align.superseded_files(headers, on[:2]), on))
    if fmt == "grib" and compat and signs["named_twice"]:
        # Fields whose names collide: the one that turned up last replaces the others as a whole.
        key = ["run_id", "var", "shortname", "level_type", "level"]
        seen = headers.groupBy(*key).agg(F.min(F.struct(*msg.ORDER)).alias("_seen"))
        latest = seen.groupBy("run_id", "var").agg(F.max("_seen").alias("_latest"))
        out.append((seen.join(latest, ["run_id", "var"]).filter("_seen < _latest").select(*key), key))
    return out


def conflict_signs(headers: DataFrame, facts: DataFrame) -> dict[str, int]:
    """How many fields, times and files show each kind of conflict; one job over headers that are kept."""
    checks = {
        "repeated": facts.filter("n > 1 or n_times < n_rows"),
        "named_twice": facts.groupBy("run_id", "var").count().filter("count > 1"),
        "shared_time": time_conflicts(headers),
        "mixed_time": file_times(headers),
        "mixed_grid": facts.filter("ni_min < ni_max or nj_min < nj_max"),
    }
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("sign"), "n") for name, df in checks.items()]
    return {r["sign"]: r["n"] for r in align.concat(counted).collect()}


def file_times(headers: DataFrame) -> DataFrame:
    """(run, file, time) of files whose messages name several times; the first message speaks for the file."""
    return headers.groupBy("run_id", "source_file").agg(
        F.min_by("valid_time", "msg_no").alias("_time"), F.count_distinct("valid_time").alias("_n")).filter("_n > 1").drop("_n")


def header_facts(headers: DataFrame) -> DataFrame:
    """One row per field of a run: grid sizes, source code, and whether a time occurs more than once."""
    field = ["run_id", "var", "shortname", "level_type", "level"]
    grids = [agg(c).alias(f"{c}_{agg.__name__}") for c in ("ni", "nj") for agg in (F.min, F.max)]
    per_time = headers.groupBy(*field, "source_name", "valid_time").agg(F.count(F.lit(1)).alias("n"), *grids)
    return per_time.groupBy(*field).agg(
        F.max("n").alias("n"), F.collect_set("source_name").alias("source_names"),
        F.count_distinct("valid_time").alias("n_times"), F.count("valid_time").alias("n_rows"),
        F.min("ni_min").alias("ni_min"), F.max("ni_max").alias("ni_max"),
        F.min("nj_min").alias("nj_min"), F.max("nj_max").alias("nj_max"))


def time_conflicts(headers: DataFrame) -> DataFrame:
    """(run, time) that more than one file brings."""
    return headers.groupBy("run_id", "valid_time").agg(F.min("source_file").alias("a"), F.max("source_file").alias("b")) \
        .filter("a < b").select("run_id", "valid_time")


def new_names(facts: DataFrame, rules: Rules, compat: bool) -> DataFrame:
    """(run_id, var) of everything the rules will add, known from header facts alone."""
    recipes = recipes_of(rules, compat)
    amounts = _amount_names(facts, rules)
    if not recipes:
        return amounts
    per_run = facts.groupBy("run_id").agg(F.collect_set("var").alias("_vars"))
    made = per_run.select("run_id", F.explode(F.array_compact(F.array(*[
        F.when(F.array_contains("_vars", r.sources[0]) & F.array_contains("_vars", r.sources[1]),
               F.struct(F.lit(r.out_var).alias("var"), F.lit(r.shortname or r.out_var).alias("shortname"),
                        F.lit(r.kind).alias("kind"))) for r in recipes]))).alias("r")).select("run_id", "r.*")
    sums = made.filter(F.col("kind").isin(*derived.SUMS))
    return amounts.unionByName(_amount_names(sums, rules)).unionByName(made.select("run_id", "var")).distinct()


def _amount_names(held: DataFrame, rules: Rules) -> DataFrame:
    targets = accum.window_targets(F.col("var"), F.col("shortname"), rules)
    return held.select("run_id", "var", F.explode(targets["acc_hours"]).alias("_h")) \
        .select("run_id", names.amount_name(F.col("var"), F.col("_h")).alias("var"))


def recipes_of(rules: Rules, compat: bool) -> list[DerivedRule]:
    return derived.usable(rules.derived, derived.WIND if compat else (*derived.SUMS, *derived.WIND))


def is_source(rules: Rules) -> Column:
    """Variables something is derived from."""
    wanted = sorted({s for r in rules.derived for s in r.sources}) or [""]
    return F.col("var").isin(*wanted) | \
        (F.size(accum.window_targets(F.col("var"), F.col("shortname"), rules)) > 0)


def base_tiles(decoded: DataFrame, edge: int, compat: bool) -> DataFrame:
    """Tiles of decoded messages with missing data as NULL and units converted; rows stay where they are."""
    by_kernel = units.formula_kernels(compat)
    df = grid.tiles_from_messages(decoded, edge, by_kernel, packed=True)
    if units.formulas_without_kernel():
        converted = units.apply_formula(F.col("values"), F.col("formula"), tiled=True, compat=compat, without=by_kernel)
        df = packed(unpacked(df).withColumn("values", converted))
    df = df.withColumns({"units": units.formula_units(F.col("formula"), F.col("units"), compat), "field_order": F.col("msg_no"),
                         "acc_hours": F.lit(None).cast("int"), "dt_hours": F.lit(None).cast("double")})
    return df.select(*TILE_COLUMNS)


def derived_tiles(base: DataFrame, rules: Rules, dt_hours: float, compat: bool,
                  held: set[str] | None = None) -> list[DataFrame]:
    """Sums, amounts and wind fields. Sums come first, so that amounts are taken of them too.

    ``held`` names the variables that exist, if known, and leaves out recipes that cannot give anything.
    """
    recipes = [r for r in recipes_of(rules, compat) if held is None or set(r.sources) <= held]
    sums = [r for r in recipes if r.kind in derived.SUMS]
    wind = [r for r in recipes if r.kind in derived.WIND]
    out, totals = [], base
    if sums:
        added = _complete(derived.derive(base, sums))
        out.append(added)
        totals = base.unionByName(added)
    if rules.accumulations:
        amounts = accum.accumulate(totals, rules, dt_hours).withColumn("field_order", F.lit(AMOUNT_ORDER) + F.col("acc_hours")) \
            .select(*TILE_COLUMNS)
        out.append(amounts if compat else align.present(amounts))
    if wind:
        out.append(_complete(derived.derive(base, wind, by_level=not compat)))
    return out


def _complete(df: DataFrame) -> DataFrame:
    """Derived fields have no level type of their own and therefore go to the fallback group."""
    return df.withColumns({
        "level_type": F.lit(None).cast("string"), "acc_hours": F.lit(None).cast("int"),
        "dt_hours": F.lit(None).cast("double"), "source_name": F.col("var"), "field_order": F.lit(DERIVED_ORDER),
        **({} if "level" in df.columns else {"level": F.lit(None).cast("double")}),
    }).select(*TILE_COLUMNS)


def assemble(base: DataFrame, sources: DataFrame, facts: DataFrame, held: set[str], rules: Rules, dt_hours: float, compat: bool,
             cached: list[DataFrame]) -> DataFrame:
    """Base and derived tiles with their groups. A new variable replaces an existing one of its name."""
    extra = derived_tiles(sources, rules, dt_hours, compat, held)
    replaced, n = known(facts.select("run_id", "var").distinct().join(new_names(facts, rules, compat), ["run_id", "var"], "left_semi"), cached)
    kept = align.drop_listed(base, replaced, ["run_id", "var"]) if n else base
    routed = routing.route(align.concat([kept, *extra]), rules)
    if not compat:
        return routed
    return routing.trim_leading(routed, kept.select("run_id", "valid_time").distinct())


def source_codes(facts: DataFrame, rules: Rules) -> dict[str, list[str]]:
    """Codes behind each variable something is derived from: as many as the rules and the code table name, whatever the number of runs."""
    named = facts.filter(is_source(rules)).select("var", F.explode_outer("source_names").alias("code"))
    return {r["var"]: r["codes"] for r in named.groupBy("var").agg(F.collect_set("code").alias("codes")).collect()}


def messages_to_groups(table: DataFrame, fmt: str, rules: Rules, run_id: str | None = None, dt_hours: float = 1.0,
                       edge: int = grid.TILE_EDGE, compat: bool = False,
                       stage: Callable[[DataFrame], DataFrame] | None = None,
                       cached: list[DataFrame] | None = None,
                       left_out: Callable[[DataFrame, dict[str, int]], None] | None = None) -> DataFrame:
    """All tiles of one or many runs with their group.

    ``run_id`` names the run; without it the table has a ``run_id`` column and any number of runs. ``stage`` may
    write the source tiles of derived fields to a table and read them back, so that the arrays are decoded once
    for all derivations and a lost executor does not repeat it. ``cached`` receives what to unpersist after the write.
    ``left_out`` receives the headers of messages that are left out, with their reason, and the number of messages by reason.
    """
    cached = [] if cached is None else cached
    decoded = decoder(fmt)(with_run(table, run_id), rules, compat)
    seen = Observation()
    judged = decoded.select("run_id", *msg.HEADER, "ni", "nj", "reason") \
        .observe(seen, *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in msg.REASONS])
    judged, _ = known(judged, cached)
    counts = dict(seen.get)
    decoded = decoded.filter("reason is null")
    if fmt == "fa" and counts["shape"]:
        spoilt, _ = known(judged.filter("reason = 'shape'").select("run_id", "source_file").distinct(), cached)
        decoded = align.drop_listed(decoded, spoilt, ["run_id", "source_file"])
        judged, _ = known(msg.spoilt_files(judged, ["run_id"]), cached)
        counts["file"] = judged.filter("reason = 'file'").count()
    if left_out is not None:
        left_out(judged.filter("reason is not null"), counts)
    headers = judged.filter("reason is null")
    facts, n = known(header_facts(headers), cached)
    if not n:
        raise EmptyRun("no message of the run is mapped to a variable")
    signs = conflict_signs(headers, facts)
    if signs["mixed_grid"]:
        bad = facts.filter("ni_min < ni_max or nj_min < nj_max").first()
        raise MixedGrid(f"grid size of {bad['var']} changes within the run")
    if fmt == "fa" and signs["mixed_time"]:
        times, _ = known(file_times(headers), cached)
        decoded, headers = (df.join(times, ["run_id", "source_file"], "left").withColumn("valid_time", F.coalesce("_time", "valid_time")).drop("_time")
                            for df in (decoded, headers))
        facts, _ = known(header_facts(headers), cached)
        signs = conflict_signs(headers, facts)
    for listed, on in superseded(headers, signs, fmt, compat):
        decoded = align.drop_listed(decoded, known(listed, cached)[0], on)
    wanted, codes = decoded.filter(is_source(rules)), source_codes(facts, rules)
    if not (rules.grib1_keys or rules.grib2_keys):  # else a code may be made of several columns
        wanted = wanted.filter(F.col("field_id").isin(sorted({c for held in codes.values() for c in held})))  # reaches the scan
    base, sources = base_tiles(decoded, edge, compat), base_tiles(wanted, edge, compat)
    if stage is not None and codes:
        sources = stage(sources)
    return assemble(base, sources, facts, set(codes), rules, dt_hours, compat, cached)


def cells_to_groups(cells: DataFrame, rules: Rules, run_id: str | None = None, dt_hours: float = 1.0,
                    edge: int = grid.TILE_EDGE, compat: bool = False,
                    stage: Callable[[DataFrame], DataFrame] | None = None, cached: list[DataFrame] | None = None) -> DataFrame:
    """The same from ready-made cells: names and units stay as they are. Where files overlap, the first present value in path
    order (``source_file``) counts."""
    cached = [] if cached is None else cached
    cells = with_run(cells, run_id)
    for name, kind in (("shortname", "string"), ("units", "string"), ("long_name", "string"), ("level_type", "string"),
                       ("level", "double"), ("source_name", "string"), ("field_order", "int")):
        if name not in cells.columns:
            cells = cells.withColumn(name, F.lit(None).cast(kind))
    cells = cells.withColumn("value", units.nan_to_null(F.col("value").cast("float")))
    order = "source_file" if "source_file" in cells.columns else None
    tiles = grid.tiles_from_cells(cells, [*FIELD_KEY, "valid_time"], edge, order)
    tiles = tiles.withColumns({"acc_hours": F.lit(None).cast("int"), "dt_hours": F.lit(None).cast("double")}) \
        .select(*TILE_COLUMNS)
    if stage is not None:
        tiles = stage(tiles)
    named = tiles if stage is not None else cells
    facts, _ = known(named.groupBy("run_id", "var", "shortname").agg(F.collect_set("source_name").alias("source_names")), cached)
    return assemble(tiles, tiles.filter(is_source(rules)), facts, set(source_codes(facts, rules)), rules, dt_hours, compat, cached)


def table_stage(spark: SparkSession, made: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Stage by writing a table to the shared scratch folder, sorted by variable in each file; ``made`` receives its path."""
    def stage(df: DataFrame) -> DataFrame:
        path = scratch_dir(spark)
        made.append(path)
        packed_df = packed(df).sortWithinPartitions("var")
        packed_df.write.option("parquet.enable.dictionary#values", "false").parquet(path)
        return spark.read.schema(packed_df.schema).parquet(path).select(*df.columns)

    return stage


def convert(spark: SparkSession, input_dir: str, store_dir: str, model: str, run: str, fmt: str | None = None,
            dt_hours: float = 1.0, rules: Rules | None = None, rules_dir: str | None = None,
            edge: int = grid.TILE_EDGE, compat: bool = False, skip_corrupt: bool = False, report: RunReport | None = None) -> bool:
    """Convert a run into its groups below ``store_dir``; True on success.

    ``input_dir`` holds a Parquet table of decoded messages (``fa`` and ``grib``) or of cells (``netcdf``);
    ``run`` is ``YYYYMMDDHH``. Without ``fmt`` the messages themselves tell. False for an absent or empty directory,
    for a run without variables, and for any failure, which is logged.

    Messages that cannot be used are left out. Their headers with a reason are written to ``<store_dir>/rejected``, by run, and ``report``
    receives how many there are of each reason. A file Spark cannot read fails the job; with ``skip_corrupt`` it is left out
    and listed there too.
    """
    from gridlake.plans.store import write_groups

    apply_settings(spark)
    scratch: list[str] = []
    cached: list[DataFrame] = []
    report = RunReport() if report is None else report
    try:
        rules = rules or load_rules(spark, rules_dir)
        run_id = f"{model}_{run}"
        fmt = files.ALIASES.get(fmt.lower(), fmt.lower()) if fmt else table_format(spark, input_dir, skip_corrupt)

        def left_out(headers: DataFrame, counts: dict[str, int]) -> None:
            if skip_corrupt:
                corrupt = msg.unread_files(spark, input_dir).withColumns({"run_id": F.lit(run_id), "reason": F.lit("corrupt")})
                corrupt, counts["corrupt"] = known(corrupt, cached)
                headers = headers.unionByName(corrupt, allowMissingColumns=True)
            report.counts = counts
            if sum(counts.values()):
                report.rejected = f"{store_dir}/rejected"
                headers.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(report.rejected)
                log.warning("%s: messages left out by reason: %s", input_dir, counts)

        settings = (rules, run_id, dt_hours, edge, compat, table_stage(spark, scratch), cached)
        if fmt == "netcdf":
            groups = cells_to_groups(msg.read_cells(spark, input_dir), *settings)
        else:
            groups = messages_to_groups(msg.read_messages(spark, input_dir, skip_corrupt), fmt, *settings, left_out)
        write_groups(groups, store_dir, run_ids=[run_id])
        return True
    except Exception as err:
        log.error("conversion of %s failed: %s", input_dir, err)
        return False
    finally:
        for df in cached:
            df.unpersist()
        for path in scratch:
            remove_dir(spark, path)


def table_format(spark: SparkSession, input_dir: str, skip_corrupt: bool = False) -> str:
    """Format of a decoded run: cells have a ``value`` column, messages name their format; the first one decides."""
    columns = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(input_dir).columns
    if "value" in columns:
        return "netcdf"
    first = msg.read_messages(spark, input_dir, skip_corrupt).groupBy().agg(
        F.min_by(F.lower("fmt"), F.struct(*msg.ORDER)).alias("fmt")).take(1)
    found = first[0]["fmt"] if first else None
    return files.ALIASES.get(found, "unknown") if found else "none"
