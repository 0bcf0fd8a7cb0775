"""The group store: Parquet tiles by run and group, with a small table of fields beside them.

``<store>/tiles/run_id=.../grp=...``   values (packed float32), sorted by variable, place and time, with statistics and bounds of each tile
``<store>/fields/run_id=.../grp=...``  one row per variable: attributes, order, times, grid

Questions about content read ``fields`` only, and sums, means and limits read the statistics only. Reading a field prunes to its run and group by
directory, and to its variable, time and place by row-group and page statistics.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions import text
from gridlake.functions.times import iso_text
from gridlake.kernels import unpack
from gridlake.layout import TILE_ORDER, TILE_STATS, curve_key, curve_position, packed, with_stats, with_zone
from gridlake.operators import align, select, summary
from gridlake.operators.grid import cells_from_tiles
from gridlake.operators.summary import time_head_tail
from gridlake.session import apply_settings

PARTITIONS = ["run_id", "grp"]
SORT = [*PARTITIONS, "var", "level_type", "level", TILE_ORDER, "valid_time"]
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(64 * 1024 * 1024),
    "parquet.enable.dictionary#values": "false",
    # Pages of few rows let page statistics find one tile or one time inside a row group.
    "parquet.page.row.count.limit": "64",
    "parquet.page.size.row.check.min": "1",
}
REPORT_ORDER = ["grp", "part", "n", "place", "var", "line"]
ATTRIBUTES = ["shortname", "units", "long_name", "acc_hours", "dt_hours", "source_name"]

# Lines of the inspection report.
RULER = "=" * 72
TITLE = "STORE INSPECTION: "
GROUP_LINE = "Group: '%s' (%d variables, %d timesteps)"
RANGE_LINE = "  Time range  : "
TIMES_LINE = "  Timesteps (%d) : "
SIZE_LINE = "  Grid size   : %d latitudes x %d longitudes"
BOUNDS_LINE = "  {} bounds  : [%.4f .. %.4f] (step ~ %.4f)"
FIELDS_LINE = "  Variables   :"


def write_groups(groups: DataFrame, store_dir: str, compact: bool = True, run_ids: list[str] | None = None) -> None:
    """Replace exactly the (run, group) directories that occur in ``groups``, with their field rows.

    Tiles and field rows are written aside, below ``<store_dir>/_aside-...``, which no reader sees, and moved to their places when both are complete. If
    a write or a move fails, what was there before is back in place and the error goes on. A driver that dies between moves leaves the
    replaced directories below ``_aside-.../old``. ``run_ids`` is not needed any more and kept for callers.

    ``compact`` rebalances by variable and place, so files are of even size; adaptive execution splits what is much larger than the rest.
    """
    spark = groups.sparkSession
    stored = with_zone(with_stats(packed(groups))).withColumn(TILE_ORDER, curve_key(F.col("ty"), F.col("tx")))
    if "field_order" not in stored.columns:
        stored = stored.withColumn("field_order", F.lit(None).cast("int"))
    out = stored.hint("rebalance", *PARTITIONS, "var", "ty", "tx") if compact else stored
    aside = f"{store_dir.rstrip('/')}/_aside-{uuid.uuid4().hex}"
    try:
        out.sortWithinPartitions(*SORT).write.options(**WRITE_OPTIONS).partitionBy(*PARTITIONS).parquet(f"{aside}/new/tiles")
        written = spark.read.schema(stored.schema).parquet(f"{aside}/new/tiles")
        describe_fields(written).write.partitionBy(*PARTITIONS).parquet(f"{aside}/new/fields")
        _swap(spark, f"{aside}/new", store_dir, f"{aside}/old")
    finally:
        _Files(spark, aside).remove(aside)


class _Files:
    """The file system a path lies on."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def remove(self, path: str) -> None:
        self.system.delete(self.path(path), True)

    def exists(self, path: str) -> bool:
        return self.system.exists(self.path(path))

    def folders(self, path: str) -> list[str]:
        held = self.system.listStatus(self.path(path)) if self.exists(path) else []
        return [s.getPath().getName() for s in held if s.isDirectory()]

    def move(self, old: str, new: str) -> None:
        target = self.path(new)
        self.system.mkdirs(target.getParent())
        if not self.system.rename(self.path(old), target):
            raise OSError(f"cannot move {old} to {new}")


def _swap(spark: SparkSession, new: str, store_dir: str, old: str) -> None:
    """Move each new (run, group) directory to its place and the one it replaces to ``old``; undo all moves if one fails."""
    where = _Files(spark, store_dir)
    done: list[tuple[str, str]] = []

    def move(a: str, b: str) -> None:
        where.move(a, b)
        done.append((a, b))

    try:
        for name in ("tiles", "fields"):
            for run in where.folders(f"{new}/{name}"):
                for grp in where.folders(f"{new}/{name}/{run}"):
                    part = f"{name}/{run}/{grp}"
                    if where.exists(f"{store_dir}/{part}"):
                        move(f"{store_dir}/{part}", f"{old}/{part}")
                    move(f"{new}/{part}", f"{store_dir}/{part}")
    except BaseException:
        for a, b in reversed(done):
            where.move(b, a)
        raise


def describe_fields(tiles: DataFrame) -> DataFrame:
    """One row per run, group and field. Reads no values; the times of a field are as many as its run has steps."""
    top, left = F.col("y0") == 0, F.col("x0") == 0
    order = F.min("field_order") if "field_order" in tiles.columns else F.lit(None).cast("int")
    described = tiles.groupBy(*PARTITIONS, "var", "level_type", "level").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ATTRIBUTES if c in tiles.columns],
        order.alias("field_order"),
        F.array_sort(F.collect_set("valid_time")).alias("times"),
        F.max("ny").alias("ny"), F.max("nx").alias("nx"),
        F.max(F.greatest(F.when(F.col("ty") > 0, F.col("y0") / F.col("ty")), F.when(F.col("tx") > 0, F.col("x0") / F.col("tx"))))
        .cast("int").alias("edge"),
        F.max(F.when(top, F.get("lats", F.lit(0)))).alias("lat_first"),
        F.max_by(F.element_at("lats", -1), F.col("y0")).alias("lat_last"),
        F.max(F.when(top, F.abs(F.get("lats", F.lit(1)) - F.get("lats", F.lit(0))))).alias("lat_step"),
        F.max(F.when(left, F.get("lons", F.lit(0)))).alias("lon_first"),
        F.max_by(F.element_at("lons", -1), F.col("x0")).alias("lon_last"),
        F.max(F.when(left, F.abs(F.get("lons", F.lit(1)) - F.get("lons", F.lit(0))))).alias("lon_step"),
    )
    kinds = {"acc_hours": "int", "dt_hours": "double"}
    described = described.withColumns({c: F.lit(None).cast(kinds.get(c, "string")) for c in ATTRIBUTES if c not in tiles.columns})
    named = F.create_map(*[x for c in (*ATTRIBUTES, "level_type", "level") for x in (F.lit(c), F.col(c).cast("string"))])
    return described.withColumn("attrs", F.map_filter(named, lambda _, v: v.isNotNull()))


def open_store(spark: SparkSession, path: str, run_id: str | None = None) -> "GridStore":
    """Open a store, a single table of tiles (one group), or a folder of such tables, one a group; FileNotFoundError if there is none."""
    apply_settings(spark)
    name = path.rstrip("/").rsplit("/", 1)[-1]
    tiles = _table(spark, f"{path}/tiles")
    if tiles is not None:
        described = _table(spark, f"{path}/fields")
        return GridStore(name, _completed(tiles, name, None), described if described is not None else describe_fields(tiles), run_id)
    tiles = _table(spark, path)
    if tiles is not None:
        if not TILE_COLUMNS <= set(tiles.columns):
            raise ValueError(f"{path} is no table of tiles")
        table = _completed(tiles, name, name.rsplit(".", 1)[0])
        return GridStore(name, table, describe_fields(table), run_id)
    where = _Files(spark, path)
    found = {group: _table(spark, f"{path}/{group}") for group in sorted(where.folders(path))}
    parts = [_completed(t, name, group.rsplit(".", 1)[0]) for group, t in found.items() if t is not None and TILE_COLUMNS <= set(t.columns)]
    if not parts:
        raise FileNotFoundError(f"no store at {path}")
    table = align.concat(parts)
    return GridStore(name, table, describe_fields(table), run_id)


TILE_COLUMNS = {"var", "valid_time", "values", "ty", "tx"}


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        table = spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return table


def _completed(table: DataFrame, run: str, group: str | None) -> DataFrame:
    """Tiles with run and group, bounds and place on the curve, as far as the files lack them."""
    for column, default in (("run_id", run), ("grp", group)):
        if column not in table.columns:
            table = table.withColumn(column, F.lit(default))
    for column, kind in (("level_type", "string"), ("level", "double")):
        if column not in table.columns:
            table = table.withColumn(column, F.lit(None).cast(kind))
    if TILE_ORDER not in table.columns:
        table = table.withColumn(TILE_ORDER, curve_key(F.col("ty"), F.col("tx")))
    return with_zone(table)


class GridStore:
    """Questions on one store, or on one run of it."""

    def __init__(self, name: str, tiles: DataFrame, fields: DataFrame, run_id: str | None = None) -> None:
        keep = F.lit(True) if run_id is None else F.col("run_id") == run_id
        self.name = run_id or name
        self.run_id = run_id
        self.tiles = tiles.filter(keep)
        self.fields = fields.filter(keep)

    # ---- listing -------------------------------------------------------------------------------------

    def groups(self) -> DataFrame:
        return self.fields.select("grp").distinct().orderBy("grp")

    def field_list(self, group: str | None = None) -> DataFrame:
        """Names of a group, or of all groups without repetition, sorted."""
        held = self.fields if group is None else self.fields.filter(F.col("grp") == group)
        return held.select("var").distinct().orderBy("var")

    def listfields(self, group: str | None = None) -> list[str]:
        """The same as a list; KeyError for an unknown group."""
        if group is not None and not self.fields.filter(F.col("grp") == group).take(1):
            raise KeyError(f"no group {group!r}")
        held = self.fields if group is None else self.fields.filter(F.col("grp") == group)
        return sorted(r["var"] for r in held.select("var").distinct().collect())

    def inventory(self) -> DataFrame:
        """Per run and group: variables, times, first and last time, grid size."""
        return self.fields.groupBy(*PARTITIONS).agg(
            F.count_distinct("var").alias("n_vars"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("times")))).alias("times"),
            F.max("ny").alias("ny"), F.max("nx").alias("nx"),
            *[F.min(c).alias(c) for c in ("lat_first", "lat_last", "lat_step", "lon_first", "lon_last", "lon_step")],
        ).withColumns({"n_times": F.size("times"), "first_time": F.get("times", F.lit(0)),
                       "last_time": F.element_at("times", -1)})

    # ---- report --------------------------------------------------------------------------------------

    def report(self, details: str | None = None, sortfields: bool = False, verbose: bool = False) -> DataFrame:
        """Lines of the inventory report with their order (``pos``).

        ``details``: ``time`` or ``times``, ``grid``, ``chunks`` (size of a tile) or ``compression`` (codec of the files); ``verbose`` shows times
        too. Variables stand in stored order, by name with ``sortfields``.
        """
        rows = self._report_rows(details, sortfields, verbose)
        head = self.fields.sparkSession.createDataFrame(
            [("", 0, n, line, 0, "") for n, line in enumerate(self._title())] + [("\uffff", 9, 0, f"\n{RULER}", 0, "")], rows.schema)
        return head.unionByName(rows).orderBy(*REPORT_ORDER)

    def _title(self) -> list[str]:
        return [RULER, TITLE + self.name, RULER]

    def _report_rows(self, details: str | None, sortfields: bool, verbose: bool) -> DataFrame:
        group = self.inventory()
        lines = [F.lit(""), F.format_string(GROUP_LINE, "grp", "n_vars", "n_times"),
                 F.concat(F.lit(RANGE_LINE), F.coalesce(iso_text(F.col("first_time")), F.lit("Static / None")), F.lit(" -> "),
                          F.coalesce(iso_text(F.col("last_time")), F.lit("Static / None")))]
        if details in ("time", "times") or verbose:
            shown = F.transform("shown", iso_text)
            joined = F.when(F.col("n_times") <= 15, F.array_join(shown, ", ")).otherwise(F.concat(
                F.array_join(F.slice(shown, 1, 6), ", "), F.lit(" ... "), F.array_join(F.slice(shown, -4, 4), ", ")))
            group = time_head_tail(group)
            lines.append(F.when(F.col("n_times") > 0, F.concat(F.format_string(TIMES_LINE, "n_times"), joined)))
        lines.append(F.format_string(SIZE_LINE, "ny", "nx"))
        if details == "grid":
            for name, axis in (("Lat", "lat"), ("Lon", "lon")):
                lines.append(F.when((F.col("ny") > 1) & (F.col("nx") > 1), F.format_string(
                    BOUNDS_LINE.format(name), f"{axis}_first", f"{axis}_last", f"{axis}_step")))
        lines.append(F.lit(FIELDS_LINE))
        grp = F.concat_ws("/", "run_id", "grp") if self.run_id is None else F.col("grp")
        top = group.select(grp.alias("grp"), F.lit(1).alias("part"), F.posexplode(F.array_compact(F.array(*lines))).alias("n", "line"),
                           F.lit(0).alias("place"), F.lit("").alias("var"))
        attrs, var = F.col("attrs"), F.col("var")
        line = text.inventory_line(var, text.long_name_of(attrs, var), text.units_of(attrs), text.level_type_of(attrs), text.level_of(attrs))
        if details == "chunks":
            edge = lambda n: F.least(F.coalesce("edge", n), n)
            line = F.concat(line, F.format_string(" | chunks: [1, %d, %d]", edge("ny"), edge("nx")))
        elif details == "compression":
            line = F.concat(line, F.lit(f" | compressor: {WRITE_OPTIONS['compression']}"))
        place = F.lit(0) if sortfields else F.coalesce("field_order", F.lit(0))
        body = self.fields.select(grp.alias("grp"), F.lit(2).alias("part"), F.lit(0).alias("n"), line.alias("line"), place.alias("place"), "var")
        return top.unionByName(body)

    def what(self, details: str | None = None, output_dir: str | None = None, stdout: bool = True, sortfields: bool = False,
             verbose: bool = False) -> str:
        """The report as text, printed or written as the file ``<store>.info`` in ``output_dir``.

        The report has one line per variable of the opened run, so it is small by nature.
        """
        rows = sorted(self._report_rows(details, sortfields, verbose).collect(), key=lambda r: tuple(r[c] for c in REPORT_ORDER))
        report = "\n".join([*self._title(), *[r["line"] for r in rows], f"\n{RULER}"])
        if output_dir is not None:
            _write_text(self.fields.sparkSession, f"{output_dir}/{self.name}.info", report + "\n")
        elif stdout:
            print(report)
        return report

    # ---- reading -------------------------------------------------------------------------------------

    def _axes(self) -> DataFrame:
        """(run, group, sorted times): the time axis of a group is that of all its fields."""
        return self.fields.groupBy(*PARTITIONS).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("times")))).alias("axis"))

    def _picks(self, var: str, timestep: int | str | None, group: str | None) -> DataFrame:
        """What to read of a field: a row per run, level and time with the group, the time to show and the time to scan (``at``).

        Each run has its own group, the named one or the first, by name, that holds the field, and its own time axis. A position counts
        on the axis of the group (negative from the end) and a text names a time or a period of it; both are ignored if the axis has one time. A time of
        the axis the field itself lacks is shown as missing: its tiles come from the field's first time, without values.
        """
        held = self._held(var, group)
        chosen = held.groupBy("run_id").agg(F.min("grp").alias("grp"))
        field = held.join(chosen, PARTITIONS).select(*PARTITIONS, "level_type", "level", "times")
        if timestep is None:
            return field.select(*PARTITIONS, "level_type", "level", F.explode("times").alias("valid_time")).withColumn("at", F.col("valid_time"))
        if isinstance(timestep, str):
            named = F.filter("axis", lambda t: select.in_label(t, timestep))
        else:
            named = F.array_compact(F.array(F.try_element_at("axis", F.lit(timestep + 1 if timestep >= 0 else timestep))))
        axes = self._axes().join(chosen, PARTITIONS).withColumn("wanted", F.when(F.size("axis") > 1, named))
        shown = field.join(axes, PARTITIONS).select(*PARTITIONS, "level_type", "level", "times",
                                                    F.explode(F.coalesce("wanted", "times")).alias("valid_time"))
        own = F.array_contains("times", F.col("valid_time"))
        return shown.select(*PARTITIONS, "level_type", "level", "valid_time", F.when(own, F.col("valid_time")).otherwise(F.get("times", F.lit(0))).alias("at"))

    def times(self, group: str) -> list:
        """Sorted times of a group of the opened run (at most as many as the run has steps)."""
        rows = self._axes().filter(F.col("grp") == group).take(1)
        return list(rows[0]["axis"]) if rows else []

    def read_tiles(self, var: str, timestep: int | str | None = None, group: str | None = None) -> DataFrame:
        """Tiles of a field, of every run from its own group. An int is a position on the times of the group (negative from the end) and is ignored if
        there is only one; a text is a time, or the start of one for a period. KeyError if no run has the field.

        Of one opened run group and times become literals of the scan. Over many runs the picked rows are joined, and dynamic pruning
        takes only their directories.
        """
        field = self.tiles.filter(F.col("var") == var)
        if self.run_id is not None:
            grp, rows = self._picked_rows(var, timestep, group)
            field = field.filter(F.col("grp") == grp)
            if rows is None:
                return field
            field = field.filter(F.col("valid_time").isin([r["at"] for r in rows]))
            if all(r["valid_time"] == r["at"] for r in rows):
                return field
            picks = field.sparkSession.createDataFrame(rows, self._picks(var, timestep, group).schema)
        else:
            if not self._held(var, group).take(1):
                raise KeyError(_absent(var, group))
            picks = self._picks(var, timestep, group)
            if timestep is None:
                return field.join(picks.select(*PARTITIONS).distinct(), PARTITIONS, "left_semi")
        named = picks.select(*[F.col(c).alias(f"_{c}") for c in picks.columns])
        same = (F.col("run_id") == F.col("_run_id")) & (F.col("grp") == F.col("_grp")) & (F.col("valid_time") == F.col("_at")) \
            & F.col("level_type").eqNullSafe(F.col("_level_type")) & F.col("level").eqNullSafe(F.col("_level"))
        found = field.join(named, same)
        lacks = F.col("_at") != F.col("_valid_time")
        blank = {c: F.when(~lacks, F.col(c)) for c in ("values", *TILE_STATS) if c in field.columns}
        if "n_present" in blank:
            blank["n_present"] = F.coalesce(blank["n_present"], F.lit(0))
        return found.withColumns({**blank, "valid_time": F.col("_valid_time")}).select(*field.columns)

    def _held(self, var: str, group: str | None) -> DataFrame:
        held = self.fields.filter(F.col("var") == var)
        return held if group is None else held.filter(F.col("grp") == group)

    def _picked_rows(self, var: str, timestep: int | str | None, group: str | None) -> tuple[str, list | None]:
        """Group of a field of the opened run, and what :meth:`_picks` says of it, if a time is asked for: levels and times of one field."""
        groups = [r["grp"] for r in self._held(var, group).select("grp").distinct().collect()]
        if not groups:
            raise KeyError(_absent(var, group))
        return min(groups), None if timestep is None else self._picks(var, timestep, min(groups)).collect()

    def readfield(self, var: str, timestep: int | str | None = None, group: str | None = None) -> DataFrame:
        """Cells of a field."""
        return cells_from_tiles(self.read_tiles(var, timestep, group))

    def point_series(self, var: str, iy: int, ix: int, group: str | None = None) -> DataFrame:
        """All times of one grid point: only the tiles that hold the point are read, and one element of each.

        The edge of the tiles is a fact of the fields table, so the place on the curve the files are sorted by is a literal of the scan.
        """
        edges = [r["edge"] for r in self.fields.filter(F.col("var") == var).select("edge").distinct().collect()]  # sizes of tiles in use
        at_keys = sorted({curve_position(iy // e, ix // e) if e else 0 for e in edges})
        tiles = packed(self.read_tiles(var, group=group)).filter(F.col(TILE_ORDER).isin(at_keys))
        tiles = tiles.filter((F.col("y0") <= iy) & (F.col("y0") + F.col("h") > iy)
                             & (F.col("x0") <= ix) & (F.col("x0") + F.col("w") > ix))
        at = (F.lit(iy) - F.col("y0")) * F.col("w") + F.lit(ix) - F.col("x0")
        return tiles.select("run_id", "var", "level", "valid_time",
                            F.get(unpack(F.substring("values", at * 4 + 1, F.lit(4))), F.lit(0)).alias("value"))

    def read_box(self, var: str, lonmin: float, lonmax: float, latmin: float, latmax: float,
                 timestep: int | str | None = None, group: str | None = None) -> DataFrame:
        """Cells of a field inside a box; row groups and tiles outside are passed over by their bounds."""
        box = (lonmin, lonmax, latmin, latmax)
        return select.bounding_box(cells_from_tiles(select.tiles_in_box(
            self.read_tiles(var, timestep, group), *box)), *box)

    def map_data(self, var: str | None = None, timestep: int | str | None = None, group: str | None = None, wind: tuple[str, str] | None = None,
                 zoom: str | dict | None = None, minmax: str | tuple | None = None, subsampling: int = 15) -> DataFrame:
        """The data of a map in one call: cells of a field, or of a pair of wind components with ``speed`` and ``arrow``.

        ``zoom`` is a box, as text or mapping, and ignored unless all four sides are given; ``minmax`` limits shown values, as text or pair.
        ``arrow`` marks every ``subsampling``-th row and column.
        """
        box = zoom if isinstance(zoom, dict) else text.parse_box(zoom)
        low, high = text.parse_limits(minmax)

        def layer(name: str) -> DataFrame:
            tiles = self.read_tiles(name, timestep, group)
            cells = cells_from_tiles(tiles if box is None else select.tiles_in_box(tiles, **box))
            return cells if box is None else select.bounding_box(cells, **box)

        if wind is None:
            return select.clip(layer(var), low, high)
        u, v = wind
        both = layer(u).unionByName(layer(v))
        drawn = summary.map_layer(both, u, v, ["run_id", "valid_time"], None, subsampling)
        return drawn.withColumn("speed", select.limited_column(F.col("speed"), low, high))


def _absent(var: str, group: str | None) -> str:
    return f"field {var!r} not found" + (f" in group {group!r}" if group else " in any group")


def _write_text(spark: SparkSession, path: str, content: str) -> None:
    """One small file on any file system Spark reaches."""
    where = _Files(spark, path)
    stream = where.system.create(where.path(path), True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
