"""Queries on whole jobs and on written stores: convert, reopen, read back; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators import grid, routing, summary
from gridlake.plans.convert import convert
from gridlake.plans.store import open_store, write_groups
from gridlake.rules import default_rules, load_rules
from gridlake.session import scratch_dir
from gridlake.sources import files, messages
from workload.adapters import GR_SQL, RUN, grid_messages, r6, table
from workload.queries import query, stored_grids

START = "TIMESTAMP '2026-08-19 00:00:00'"


def _hour(time: str = "valid_time") -> Column:
    """Hours since the start of the run."""
    start = F.unix_timestamp(F.lit("2026-08-19 00:00:00").cast("timestamp"))
    return ((F.unix_timestamp(time) - start) / 3600).cast("bigint").alias("step")


def _flat_axes(df: DataFrame) -> DataFrame:
    """Coordinates of every point, as a decoder gives them that knows no axes."""
    points = F.sequence(F.lit(0), F.lit(63))
    return df.withColumns({"lats": F.transform(points, lambda p: (F.lit(30) + F.floor(p / 8)).cast("double")),
                           "lons": F.transform(points, lambda p: (p % 8).cast("double"))})


def _nulls(*columns: str, kind: str = "int") -> list[Column]:
    return [F.lit(None).cast(kind).alias(c) for c in columns]


def _reopened(spark: SparkSession, rows: DataFrame, model: str) -> DataFrame:
    """All cells of the store a run is converted to."""
    root = scratch_dir(spark)
    rows.write.parquet(f"{root}/in")
    if not convert(spark, f"{root}/in", f"{root}/store", model, "2026081900", edge=4):
        raise RuntimeError("conversion failed")
    return grid.cells_from_tiles(open_store(spark, f"{root}/store", f"{model}_2026081900").tiles) \
        .select("grp", "var", _hour(), "iy", "ix", "lat", "lon", r6("value").alias("value"))


# ---- FA ---------------------------------------------------------------------------------------------------

FA_CODES = ["SURFACCPLUIE", "CLSVENT.ZONAL", "CLSVENT.MERIDIEN", "CLSTEMPERATURE", "P85000HUMI_RELATIV", "P50000GEOPOTENTIEL"]


def fa_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as an FA-like run of six fields a step with flat coordinates.

    Precipitation grows with the step, humidity is a fraction in even steps and percent in odd ones, each seventh step comes again
    in a file later in path order, and each tenth step holds a field without its last values, which spoils the file.
    """
    n = F.lit(len(FA_CODES))
    code = F.element_at(F.array(*[F.lit(c) for c in FA_CODES]), (F.col("vec_id") % n + 1).cast("int"))
    step = F.floor(F.col("vec_id") / n)
    grown = F.transform("values", lambda x: (x + F.col("_step").cast("float")).cast("float"))
    share = F.transform("values", lambda x: F.when(F.col("_step") % 2 == 1, (x * F.lit(50).cast("float")).cast("float")).otherwise(x))
    rows = _flat_axes(grid_messages(spark, sf_dir)).withColumns({"field_id": code, "_step": step})
    rows = rows.withColumn("values", F.when(F.col("field_id") == FA_CODES[0], grown).when(F.col("field_id") == FA_CODES[4], share)
                           .when((F.col("field_id") == FA_CODES[3]) & (F.col("_step") % 10 == 9), F.slice("values", 1, 10)).otherwise(F.col("values")))
    again = rows.where("_step % 7 = 3").withColumns({"values": F.transform("values", lambda x: (x + F.lit(100).cast("float")).cast("float")), "_late": F.lit("Z")})
    return rows.withColumn("_late", F.lit("")).unionByName(again).select(
        F.format_string("/in/%sFULLPOS_2026081900_%04d", "_late", "_step").alias("source_file"), (F.col("vec_id") % n).cast("int").alias("msg_no"),
        F.lit("fa").alias("fmt"), *_nulls("edition"), "field_id", *_nulls("discipline", "category", "number", "indicator_of_parameter"),
        *_nulls("level_type_raw", kind="string"), *_nulls("level_raw"), F.lit(20260819).alias("data_date"), F.lit(0).alias("data_time"),
        F.lit("0").alias("step_range"), "ni", "nj", "lats", "lons", "values")


WIND_SQL = """CASE WHEN u = 0 AND v = 0 THEN 180 ELSE (degrees(atan2(-CAST(u AS DOUBLE), -CAST(v AS DOUBLE))) + 360) % 360 END"""


@query(f"""WITH {GR_SQL}, m AS (SELECT vec_id // 6 AS step, vec_id % 6 AS f, iy, ix, lat, lon, value FROM gr WHERE vec_id // 6 % 10 <> 9),
h AS (SELECT *, CASE WHEN f = 4 AND step % 2 = 1 THEN CAST(value * CAST(50 AS FLOAT) AS FLOAT) ELSE value END AS x FROM m),
b AS (SELECT step, iy, ix, lat, lon, ['tp', 'u10', 'v10', 't2', 'r850', 'gh500'][f + 1] AS var,
  CASE f WHEN 0 THEN CAST(x + CAST(step AS FLOAT) AS FLOAT) WHEN 3 THEN CAST(x - CAST(273.15 AS FLOAT) AS FLOAT)
    WHEN 4 THEN CASE WHEN max(x) OVER (PARTITION BY step, f) <= CAST(1.05 AS FLOAT) THEN CAST(x * CAST(100 AS FLOAT) AS FLOAT) ELSE x END
    WHEN 5 THEN CAST(CAST(x AS DOUBLE) / 9.80665 AS FLOAT) ELSE x END AS value FROM h),
n(hours) AS (VALUES (3), (6), (12), (24)),
a AS (SELECT 'surface_' || hours || 'h' AS grp, 'tp_' || hours || 'h' AS var, t.step, t.iy, t.ix, t.lat, t.lon,
  CASE WHEN t.value < p.value THEN CAST(0 AS FLOAT) ELSE CAST(t.value - p.value AS FLOAT) END AS value
  FROM n CROSS JOIN (SELECT * FROM b WHERE var = 'tp') t JOIN (SELECT * FROM b WHERE var = 'tp') p
    ON p.step = t.step - hours AND p.iy = t.iy AND p.ix = t.ix),
w AS (SELECT step, iy, ix, lat, lon, max(CASE WHEN var = 'u10' THEN value END) AS u, max(CASE WHEN var = 'v10' THEN value END) AS v
  FROM b GROUP BY ALL),
o AS (SELECT CASE WHEN var IN ('r850', 'gh500') THEN 'alt_pressure' ELSE 'surface' END AS grp, var, step, iy, ix, lat, lon, value FROM b
  UNION ALL SELECT grp, var, step, iy, ix, lat, lon, value FROM a
  UNION ALL SELECT 'surface', 'ws10', step, iy, ix, lat, lon, CAST(sqrt(CAST(u * u + v * v AS DOUBLE)) AS FLOAT) FROM w WHERE u IS NOT NULL AND v IS NOT NULL
  UNION ALL SELECT 'surface', 'wdir10', step, iy, ix, lat, lon, CAST({WIND_SQL} AS FLOAT) FROM w WHERE u IS NOT NULL AND v IS NOT NULL)
SELECT grp, var, CAST(step AS BIGINT) AS step, iy, ix, lat, lon, round(CAST(value AS DOUBLE), 6) + 0.0 AS value FROM o""")
def convert_fa(spark, sf_dir):
    """An FA-like run written, reopened and read back, with flat coordinates, both kinds of percent, geopotential,
    a second file for some times and spoilt files."""
    return _reopened(spark, fa_messages(spark, sf_dir), "arome")


# ---- GRIB -------------------------------------------------------------------------------------------------

GRIB_CODES = [("2t", "heightAboveGround", 2), ("t", "isobaricInhPa", 850), ("tp", "surface", 0), ("z", "isobaricInhPa", 500), ("msl", "meanSea", 0)]


def grib_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a GRIB-like run of five fields a step. Each fourth message comes again, changed, in a later file; each eleventh lacks
    values and each thirteenth has a step that cannot be read."""
    n = len(GRIB_CODES)
    pick = F.element_at(F.array(*[F.struct(F.lit(a).alias("code"), F.lit(b).alias("kind"), F.lit(c).alias("level")) for a, b, c in GRIB_CODES]),
                        (F.col("vec_id") % n + 1).cast("int"))
    rows = _flat_axes(grid_messages(spark, sf_dir)).withColumns({"_p": pick, "_step": F.floor(F.col("vec_id") / n), "_file": F.lit("a")})
    again = rows.where("vec_id % 4 = 1").withColumns({
        "values": F.transform("values", lambda x: (x + F.lit(1).cast("float")).cast("float")), "_file": F.lit("b")})
    rows = rows.unionByName(again).withColumn("values", F.when(F.col("vec_id") % 11 == 5, F.slice("values", 1, 10)).otherwise(F.col("values")))
    return rows.select(
        F.format_string("/in/%s_%04d", "_file", "_step").alias("source_file"), (F.col("vec_id") % n).cast("int").alias("msg_no"),
        F.lit("grib").alias("fmt"), F.lit(2).alias("edition"), F.col("_p.code").alias("field_id"),
        F.lit(0).alias("discipline"), F.lit(0).alias("category"), F.lit(0).alias("number"), *_nulls("indicator_of_parameter"),
        F.col("_p.kind").alias("level_type_raw"), F.col("_p.level").alias("level_raw"), F.lit(20260819).alias("data_date"), F.lit(0).alias("data_time"),
        F.when(F.col("vec_id") % 13 == 7, F.lit("30m")).otherwise(F.format_string("0-%d", "_step")).alias("step_range"),
        "ni", "nj", "lats", "lons", "values")


@query(f"""WITH {GR_SQL}, m AS (SELECT vec_id // 5 AS step, vec_id % 5 AS f, iy, ix, lat, lon,
  CASE WHEN vec_id % 4 = 1 THEN CAST(value + CAST(1 AS FLOAT) AS FLOAT) ELSE value END AS x FROM gr WHERE vec_id % 11 <> 5 AND vec_id % 13 <> 7),
b AS (SELECT step, iy, ix, lat, lon, ['2t', 't850', 'tp', 'gh500', 'prmsl'][f + 1] AS var,
  CASE WHEN f IN (0, 1) THEN CAST(x - CAST(273.15 AS FLOAT) AS FLOAT) WHEN f = 3 THEN CAST(CAST(x AS DOUBLE) / 9.80665 AS FLOAT) ELSE x END AS value FROM m),
n(hours) AS (VALUES (3), (6), (12), (24)),
a AS (SELECT 'surface_' || hours || 'h' AS grp, 'tp_' || hours || 'h' AS var, t.step, t.iy, t.ix, t.lat, t.lon,
  CASE WHEN t.value < p.value THEN CAST(0 AS FLOAT) ELSE CAST(t.value - p.value AS FLOAT) END AS value
  FROM n CROSS JOIN (SELECT * FROM b WHERE var = 'tp') t JOIN (SELECT * FROM b WHERE var = 'tp') p
    ON p.step = t.step - hours AND p.iy = t.iy AND p.ix = t.ix)
SELECT CASE WHEN var IN ('t850', 'gh500') THEN 'alt_pressure' ELSE 'surface' END AS grp, var, CAST(step AS BIGINT) AS step, iy, ix, lat, lon,
round(CAST(value AS DOUBLE), 6) + 0.0 AS value FROM b UNION ALL
SELECT grp, var, CAST(step AS BIGINT), iy, ix, lat, lon, round(CAST(value AS DOUBLE), 6) + 0.0 FROM a""")
def convert_grib(spark, sf_dir):
    """A GRIB-like run written, reopened and read back, with replaced, broken and unreadable messages."""
    return _reopened(spark, grib_messages(spark, sf_dir), "gfs")


BAD_FA_SQL = """fa AS (SELECT 'arome' AS run, vec_id // 6 AS step, vec_id % 6 AS f, late FROM embeddings,
  (SELECT unnest(['', 'Z']) AS late) WHERE late = '' OR vec_id // 6 % 7 = 3),
fa_bad AS (SELECT printf('/in/%sFULLPOS_2026081900_%04d', late, step) AS source_file, CAST(f AS INTEGER) AS msg_no,
  CASE WHEN f = 3 THEN 'shape' ELSE 'file' END AS reason FROM fa s WHERE step % 10 = 9
  AND EXISTS (SELECT 1 FROM fa t WHERE t.step = s.step AND t.late = s.late AND t.f = 3))"""


@query(f"""WITH {BAD_FA_SQL}, grib AS (SELECT vec_id, vec_id // 5 AS step, vec_id % 5 AS f, file FROM embeddings, (SELECT unnest(['a', 'b']) AS file)
  WHERE file = 'a' OR vec_id % 4 = 1)
SELECT source_file, msg_no, reason FROM fa_bad UNION ALL
SELECT printf('/in/%s_%04d', file, step), CAST(f AS INTEGER), CASE WHEN vec_id % 11 = 5 THEN 'shape' ELSE 'time' END
FROM grib WHERE vec_id % 11 = 5 OR vec_id % 13 = 7""")
def bad_messages(spark, sf_dir):
    """The messages a conversion leaves out, each with its reason."""
    rules = default_rules()
    fa = messages.bad_messages(fa_messages(spark, sf_dir), rules, "fa")
    grib = messages.bad_messages(grib_messages(spark, sf_dir), rules, "grib")
    return fa.unionByName(grib).select("source_file", "msg_no", "reason")


# ---- cells ------------------------------------------------------------------------------------------------

def run_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as cells of two overlapping sources: rows 0 to 4, with gaps, and rows 3 to 7. Fields of odd labels lack the last three columns."""
    cells = grid.cells_from_messages(grid_messages(spark, sf_dir)).drop("run_id").withColumns({
        "var": F.concat(F.lit("f"), F.col("label").cast("string")), "level_type": F.when(F.col("label") < 5, F.lit("surface")).otherwise(F.lit("isobaric")),
        "level": F.lit(0.0), "valid_time": F.timestamp_seconds(F.unix_timestamp(F.lit("2026-08-19").cast("timestamp")) + F.col("vec_id") * 3600)})
    cells = cells.where("label % 2 = 0 or ix < 5")
    first = cells.where("iy < 5").withColumns({"source_file": F.lit("a"), "value": F.when((F.col("iy") == 4) & (F.col("ix") % 2 == 0), F.lit(None))
                                              .otherwise(F.col("value")).cast("float")})
    second = cells.where("iy >= 3").withColumns({"source_file": F.lit("b"), "value": (F.col("value") + F.lit(1).cast("float")).cast("float")})
    return first.unionByName(second).select("source_file", "var", "level_type", "level", "valid_time", "iy", "ix", "lat", "lon", "value")


CELLS_SQL = f"""{GR_SQL}, kept AS (SELECT *, CASE WHEN iy > 4 OR (iy = 4 AND ix % 2 = 0) THEN CAST(value + CAST(1 AS FLOAT) AS FLOAT) ELSE value END AS x
FROM gr WHERE label % 2 = 0 OR ix < 5)"""


@query(f"""WITH {CELLS_SQL} SELECT 'f' || label AS var, CAST(vec_id AS BIGINT) AS step, iy, ix, lat, lon, 8 AS ny, CASE label % 2 WHEN 0 THEN 8 ELSE 5 END AS nx,
round(CAST(x AS DOUBLE), 6) + 0.0 AS value FROM kept""")
def cells_convert(spark, sf_dir):
    """Cells of overlapping files to tiles, the first present value in path order, each field with its own grid."""
    cells = run_cells(spark, sf_dir).withColumn("run_id", F.lit(RUN))
    tiles = grid.tiles_from_cells(cells, ["run_id", "var", "level_type", "level", "valid_time"], 3, "source_file")
    sizes = tiles.select("*", F.col("ny").alias("_ny"), F.col("nx").alias("_nx"))
    return grid.cells_from_tiles(sizes).select("var", _hour(), "iy", "ix", "lat", "lon", F.col("_ny").alias("ny"), F.col("_nx").alias("nx"),
                                               r6("value").alias("value"))


@query(f"""WITH {CELLS_SQL} SELECT CASE WHEN label < 5 THEN 'surface' ELSE 'alt_pressure' END AS grp, 'f' || label AS var, CAST(vec_id AS BIGINT) AS step,
iy, ix, lat, lon, round(CAST(x AS DOUBLE), 6) + 0.0 AS value FROM kept""")
def convert_cells(spark, sf_dir):
    """The same through the job: written, reopened and read back."""
    return _reopened(spark, run_cells(spark, sf_dir), "nest")


# ---- stores -----------------------------------------------------------------------------------------------

def _two_runs(spark: SparkSession, sf_dir: str) -> str:
    """A store of two runs: labels below 5 at the surface, the others on a pressure level; of each run every third time belongs to ``g``, not ``f``."""
    path = scratch_dir(spark)
    low = F.col("label") < 5
    tiles = grid.tiles_from_messages(grid_messages(spark, sf_dir).select(
        F.when(low, F.lit("a_2026081900")).otherwise(F.lit("b_2026081900")).alias("run_id"),
        F.when(F.col("vec_id") % 3 == 0, F.lit("g")).otherwise(F.lit("f")).alias("var"),
        F.when(low, F.lit("surface")).otherwise(F.lit("isobaric")).alias("level_type"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2026-08-19").cast("timestamp")) + F.col("vec_id") * 3600).alias("valid_time"),
        "ni", "nj", "lats", "lons", "values"), 4)
    write_groups(routing.route(tiles.withColumns({
        "shortname": F.col("var"), "units": F.lit("1"), "long_name": F.lit(None).cast("string"), "level": F.lit(0.0), "source_name": F.col("var"),
        "acc_hours": F.lit(None).cast("int"), "dt_hours": F.lit(None).cast("double")}), default_rules()), path)
    return path


@query(f"""WITH {GR_SQL}, runs AS (SELECT *, CASE WHEN label < 5 THEN 'a_2026081900' ELSE 'b_2026081900' END AS run_id,
  CASE WHEN label < 5 THEN 'surface' ELSE 'alt_pressure' END AS grp FROM gr),
axis AS (SELECT run_id, vec_id, row_number() OVER (PARTITION BY run_id ORDER BY vec_id DESC) AS back FROM (SELECT DISTINCT run_id, vec_id FROM runs))
SELECT -CAST(back AS INTEGER) AS pos, run_id, grp, vec_id AS step, iy, ix, lat, lon,
CASE WHEN vec_id % 3 <> 0 THEN round(CAST(value AS DOUBLE), 6) + 0.0 END AS value FROM runs JOIN axis USING (run_id, vec_id) WHERE back <= 4""")
def store_many_runs(spark, sf_dir):
    """A field at positions of each run's own axis and group; times the field lacks are missing."""
    store = open_store(spark, _two_runs(spark, sf_dir))
    parts = [store.readfield("f", -back).withColumn("pos", F.lit(-back)) for back in (1, 2, 3, 4)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.select("pos", "run_id", "grp", _hour(), "iy", "ix", "lat", "lon", r6("value").alias("value"))


@query(f"""WITH {GR_SQL} SELECT 'f' || label AS var, round(CAST(max(abs(value)) AS DOUBLE), 6) + 0.0 AS max_abs, round(avg(CAST(value AS DOUBLE)), 6) + 0.0 AS mean,
CAST(0 AS BIGINT) AS n_missing, min(lon) AS lon_min, max(lon) AS lon_max, min(lat) AS lat_min, max(lat) AS lat_max, TRUE AS is_regional FROM gr GROUP BY label""")
def store_reductions(spark, sf_dir):
    """Limits, means and bounds of stored fields, from what is written beside the tiles, without their values."""
    tiles = open_store(spark, stored_grids(spark, sf_dir)).tiles
    limits, means, bounds = (fn(tiles, ["var"]) for fn in (summary.symmetric_limit, summary.field_mean, summary.extent))
    return limits.join(means, "var").join(bounds, "var").select(
        "var", r6("max_abs").alias("max_abs"), r6("mean").alias("mean"), F.col("n_missing").cast("bigint").alias("n_missing"),
        "lon_min", "lon_max", "lat_min", "lat_max", "is_regional")


@query(f"""WITH {GR_SQL} SELECT 'f' || label AS var, vec_id, iy, ix, round(CAST(value AS DOUBLE), 6) + 0.0 AS value FROM gr
WHERE label = 3 AND lon BETWEEN 1.5 AND 4 AND lat BETWEEN 32 AND 35""")
def store_box(spark, sf_dir):
    """Cells of a stored field inside a box; row groups outside are passed over."""
    cells = open_store(spark, stored_grids(spark, sf_dir), RUN).read_box("f3", 1.5, 4, 32, 35)
    return cells.select("var", (F.unix_timestamp("valid_time") / 3600).cast("bigint").alias("vec_id"), "iy", "ix", r6("value").alias("value"))


@query(f"""WITH {GR_SQL}, t AS (SELECT label, vec_id, dense_rank() OVER (PARTITION BY label < 5 ORDER BY vec_id) AS r FROM (SELECT DISTINCT label, vec_id FROM gr)),
p AS (SELECT vec_id FROM t WHERE label = (SELECT label FROM t t2 WHERE t2.r = 3 AND t2.label < 5) AND r = 3 AND label < 5)
SELECT g.iy, g.ix, round(CAST(CASE WHEN g.label <> 2 THEN NULL WHEN g.value > CAST(0.1 AS FLOAT) THEN CAST(0.1 AS FLOAT) ELSE g.value END AS DOUBLE), 6) + 0.0 AS value
FROM gr g JOIN p USING (vec_id) WHERE g.lon BETWEEN 2 AND 6 AND g.lat BETWEEN 31 AND 36""")
def store_map(spark, sf_dir):
    """The data of a map in one call: field, step, box and limits; a time the field lacks is missing."""
    return open_store(spark, stored_grids(spark, sf_dir), RUN).map_data("f2", 2, zoom="lonmin=2, lonmax=6, latmin=31, latmax=36", minmax="None,0.1") \
        .select("iy", "ix", r6("value").alias("value"))


@query("""SELECT CASE WHEN label < 5 THEN 'surface' ELSE 'alt_pressure' END AS grp, 'f' || label AS var,
CAST(row_number() OVER (PARTITION BY label < 5 ORDER BY 9 - label) AS INTEGER) AS place, '1' AS units, 'f' || label AS shortname
FROM (SELECT DISTINCT label FROM embeddings)""")
def store_order(spark, sf_dir):
    """Variables in stored order with their attributes; the fixture stores them by falling label."""
    fields = open_store(spark, stored_grids(spark, sf_dir), RUN).fields
    listed = fields.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("field_order", "var", F.map_entries("attrs").alias("a")))).alias("f"))
    return listed.select("grp", F.posexplode("f").alias("n", "f")).select(
        "grp", "f.var", (F.col("n") + 1).cast("int").alias("place"), *[F.map_from_entries("f.a")[c].alias(c) for c in ("units", "shortname")])


@query(f"""WITH {GR_SQL} SELECT CASE WHEN label < 5 THEN 'surface' ELSE 'alt_pressure' END AS grp, 'f' || label AS var, CAST(iy // 4 AS INTEGER) AS ty,
CAST(ix // 4 AS INTEGER) AS tx, CAST(row_number() OVER (PARTITION BY label, iy, ix ORDER BY vec_id) - 1 AS INTEGER) AS n, vec_id
FROM gr WHERE iy % 4 = 0 AND ix % 4 = 0""")
def store_sorted(spark, sf_dir):
    """L1: the times of each tile in the order they stand in the files."""
    tiles = open_store(spark, stored_grids(spark, sf_dir)).tiles
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    listed = tiles.withColumn("_at", place).groupBy("grp", "var", "ty", "tx").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "valid_time"))), lambda r: r["valid_time"]).alias("t"))
    return listed.select("grp", "var", "ty", "tx", F.posexplode("t").alias("n", "t")).select(
        "grp", "var", "ty", "tx", "n", (F.unix_timestamp("t") / 3600).cast("bigint").alias("vec_id"))


@query("""SELECT CASE WHEN label < 5 THEN 'surface' ELSE 'alt_pressure' END AS grp, count(*) * 4 AS n_tiles, TRUE AS has_size FROM embeddings GROUP BY 1""")
def group_bytes(spark, sf_dir):
    """Files and megabytes per group of a written store, beside the tiles each group has to hold."""
    root = stored_grids(spark, sf_dir)
    listed = files.list_files(spark, f"{root}/tiles", recursive=True)
    sizes = files.size_by_group(listed, files.store_group(F.col("path")))
    held = open_store(spark, root).tiles.groupBy("grp").agg(F.count(F.lit(1)).alias("n_tiles"))
    return held.join(sizes, "grp").select("grp", "n_tiles", ((F.col("mb") > 0) & (F.col("n_files") > 0)).alias("has_size"))


# ---- grids, files and rules -------------------------------------------------------------------------------

@query("""SELECT vec_id, '30,31,32,33,34,35,36,37' AS lats, '0,1,2,3,4,5,6,7' AS lons FROM embeddings""")
def grid_axes(spark, sf_dir):
    """axes of flat coordinates, along whichever direction they vary: odd messages hold them by column."""
    points = F.sequence(F.lit(0), F.lit(63))
    odd = F.col("vec_id") % 2 == 1
    along, across = F.transform(points, lambda p: F.floor(p / 8).cast("double")), F.transform(points, lambda p: (p % 8).cast("double"))
    lats = F.transform(F.when(odd, across).otherwise(along), lambda x: x + 30)
    flat = grid_messages(spark, sf_dir).withColumns({"lats": lats, "lons": F.when(odd, along).otherwise(across)})
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), ",").alias(c)
    return grid.with_axes(flat).select("vec_id", text("lats"), text("lons"))


NAMES_SQL = """SELECT p_partkey, '/in/' || p_partkey || ['.nc', '.NC4', '.netcdf', '.grib', '.GRB2', '', '', '', '.dat'][p_partkey % 9 + 1] AS path,
['GRIB', 'CDF' || chr(1), chr(65533), 'oops'][p_size % 4 + 1] AS head FROM part"""


@query(f"""WITH f AS ({NAMES_SQL}) SELECT path, CASE WHEN lower(path) SIMILAR TO '.*\\.(nc|nc4|netcdf)' THEN 'netcdf'
WHEN lower(path) SIMILAR TO '.*\\.(grib|grb|grib1|grib2|grb1|grb2)' THEN 'grib' WHEN head[1:4] = 'GRIB' THEN 'grib' WHEN head[1:3] = 'CDF' THEN 'netcdf'
ELSE 'unknown' END AS fmt FROM f""")
def file_format(spark, sf_dir):
    """Format by ending, else by the first bytes."""
    endings = F.array(*[F.lit(e) for e in (".nc", ".NC4", ".netcdf", ".grib", ".GRB2", "", "", "", ".dat")])
    heads = F.array(*[F.lit(h) for h in ("GRIB", "CDF\x01", "�", "oops")])
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit("/in/"), F.col("p_partkey").cast("string"), F.element_at(endings, (F.col("p_partkey") % 9 + 1).cast("int"))).alias("path"),
        F.element_at(heads, F.col("p_size") % 4 + 1).cast("binary").alias("head"))
    return rows.select("path", files.format_of(F.col("path"), F.col("head")).alias("fmt"))


@query("""SELECT CAST(n_regionkey AS INTEGER) AS folder, count(*) AS n_rows, TRUE AS in_order, 'netcdf' AS fmt FROM nation GROUP BY 1""")
def file_catalog(spark, sf_dir):
    """The files Spark wrote for each region in path order, and the format of the folder: that of its first file that tells."""
    root = scratch_dir(spark)
    table(spark, sf_dir, "nation").coalesce(1).select("n_regionkey", F.lit("CDF").alias("value")) \
        .write.option("compression", "none").partitionBy("n_regionkey").text(root)
    listed = files.list_files(spark, root, recursive=True)
    folder = F.regexp_extract("path", r"n_regionkey=(\d+)", 1).cast("int")
    rows = spark.read.text(root).groupBy(F.col("n_regionkey").alias("folder")).count()
    per = files.classify_files(listed.withColumn("folder", folder)).groupBy("folder").agg(
        F.collect_list("path").alias("paths"), F.min_by("fmt", "path").alias("fmt"))
    return per.join(rows, "folder").select("folder", F.col("count").alias("n_rows"),
                                           (F.col("paths") == F.array_sort("paths")).alias("in_order"), "fmt")


@query("""WITH f AS (SELECT split_part(p_name, ' ', -1) AS noun, min(p_size) AS s, count(*) AS n FROM part GROUP BY 1)
SELECT 'field_map' AS rule_table, upper(noun) AS id, noun AS name, 'u' || s AS detail FROM f UNION ALL
SELECT 'skip_rules', upper(noun) || '.X', '', 'true' FROM f WHERE s = 1 UNION ALL
SELECT 'accum_rules', noun, '', CAST(h AS VARCHAR) FROM f, (SELECT unnest([3, 12]) AS h) UNION ALL
SELECT 'group_rules', 'g_' || noun || '_6h', noun, '6' FROM f UNION ALL
SELECT 'derived_rules', 'd_' || noun, noun, 'vector_magnitude' FROM f""")
def rules_load(spark, sf_dir):
    """Rule files made from the part names, loaded from a folder, as rule tables."""
    noun = F.element_at(F.split("p_name", " "), -1)
    rows = table(spark, sf_dir, "part").groupBy(noun.alias("noun")).agg(F.min("p_size").alias("s"))
    root = scratch_dir(spark)

    def entries(key: Column, value: Column) -> Column:
        return F.map_from_entries(F.collect_list(F.struct(key, value)))

    field = F.struct(F.col("noun").alias("shortname"), F.concat(F.lit("u"), F.col("s").cast("string")).alias("unit"))
    recipe = F.struct(F.struct(F.lit("vector_magnitude").alias("type"), F.array("noun", "noun").alias("sources")).alias("recipe"))
    match = F.struct(F.struct(F.array("noun").alias("parameters")).alias("match"))
    fa = rows.agg(entries(F.upper("noun"), field).alias("fields"),
                  F.collect_list(F.when(F.col("s") == 1, F.concat(F.upper("noun"), F.lit(".X")))).alias("skip_fields"),
                  entries(F.concat(F.lit("d_"), "noun"), recipe).alias("derived_fields"),
                  entries(F.col("noun"), F.array(F.lit("RR3h"), F.lit("none"), F.lit("RR12h"))).alias("accumulations"))
    groups = rows.agg(entries(F.concat(F.lit("g_"), "noun", F.lit("_6h")), match).alias("groups"))
    for name, made in (("fa", fa), ("groups", groups)):
        made.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(f"{root}/{name}.json")
    loaded = load_rules(spark, root).tables(spark)
    text = {
        "field_map": ("field_id", F.col("shortname"), F.col("units")), "skip_rules": ("pattern", F.lit(""), F.col("is_regex").cast("string")),
        "accum_rules": ("src_shortname", F.lit(""), F.col("hours").cast("string")),
        "group_rules": ("grp", F.get("parameters", F.lit(0)), F.col("hours").cast("string")),
        "derived_rules": ("out_var", F.get("sources", F.lit(0)), F.col("kind"))}
    out = [loaded[t].select(F.lit(t).alias("rule_table"), F.col(i).alias("id"), n.alias("name"), d.alias("detail")) for t, (i, n, d) in text.items()]
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result
