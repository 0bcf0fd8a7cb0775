"""Tables of decoded messages and of ready-made grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions import times
from gridlake.operators.grid import valid_shape, with_axes
from gridlake.operators.resolve import resolve_fa, resolve_grib
from gridlake.rules import Rules

HEADER_SCHEMA = (
    "source_file string, msg_no int, fmt string, edition int, field_id string, discipline int, category int, "
    "number int, indicator_of_parameter int, level_type_raw string, level_raw int, data_date int, data_time int, "
    "step_range string, ni int, nj int, lats array<double>, lons array<double>")
MESSAGE_SCHEMA = HEADER_SCHEMA + ", values array<float>"
PACKED_SCHEMA = HEADER_SCHEMA + ", values binary"

CELL_SCHEMA = ("var string, level_type string, level double, valid_time timestamp, iy int, ix int, lat double, "
               "lon double, value float")

# Columns that identify a message and the order in which messages were written.
ORDER = ["source_file", "msg_no"]
# What a decoded header holds, whatever the format.
HEADER = ["source_file", "msg_no", "source_name", "var", "shortname", "units", "formula", "long_name", "level_type",
          "level", "valid_time"]


# Why a message is left out: its values do not fill its grid, its time cannot be read, its file holds a broken message (FA: a file is
# taken as a whole), its file cannot be read.
REASONS = ("shape", "time", "file", "corrupt")


def read_messages(spark: SparkSession, path: str, skip_corrupt: bool = False) -> DataFrame:
    """Scan decoded messages with a fixed schema. An unreadable file fails the scan; with ``skip_corrupt`` it is left out, and
    :func:`unread_files` names it.

    ``values`` is an array of FLOAT or BINARY with packed little-endian float32. A table may also hold ``n_values``, the
    number of values; then headers alone tell broken messages.
    """
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    found = reader.parquet(path).schema
    packed = isinstance(found["values"].dataType, T.BinaryType)
    schema = (PACKED_SCHEMA if packed else MESSAGE_SCHEMA) + (", n_values int" if "n_values" in found.names else "")
    return reader.schema(schema).parquet(path)


def unread_files(spark: SparkSession, path: str) -> DataFrame:
    """``source_file`` of the table files below ``path`` that give no row: unreadable ones, and those without rows."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")
    read = spark.read.option("ignoreCorruptFiles", "true").schema("source_file string").parquet(path) \
        .select(F.col("_metadata.file_path").alias("path")).distinct()
    return listed.join(read, "path", "left_anti").select(F.col("path").alias("source_file"))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Scan ready-made cells of many files; names and units stay as they are, absent columns are missing.

    ``source_file`` is the path of the table's file, unless the table names its sources itself.
    """
    cells = spark.read.option("mergeSchema", "true").parquet(path)
    return cells if "source_file" in cells.columns else cells.withColumn("source_file", F.col("_metadata.file_path"))


def decode_fa(messages: DataFrame, rules: Rules, compat: bool = False) -> DataFrame:
    """Named messages of FA-like files, with ``reason`` for those that cannot be used. A file is one time step: its base time plus the
    four digits ending its name, else its own validity."""
    named = resolve_fa(messages, rules)
    base = times.base_time(F.col("data_date"), F.col("data_time"))
    own = times.valid_time(F.col("data_date"), F.col("data_time"), F.col("step_range"), compat)
    file_name = F.element_at(F.split("source_file", "/"), -1)
    return _judged(with_axes(named.withColumn("valid_time", times.file_step_time(file_name, base, own))))


def decode_grib(messages: DataFrame, rules: Rules, compat: bool = False) -> DataFrame:
    """Named messages of GRIB-like files, with ``reason`` for those that cannot be used; each message stands for itself."""
    named = resolve_grib(messages, rules)
    return _judged(with_axes(named.withColumn("valid_time", times.valid_time(
        F.col("data_date"), F.col("data_time"), F.col("step_range"), compat))))


def _judged(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("reason", F.when(~valid_shape(decoded), F.lit("shape")).when(F.col("valid_time").isNull(), F.lit("time")))


def bad_messages(messages: DataFrame, rules: Rules, fmt: str, compat: bool = False) -> DataFrame:
    """Headers of the messages that a conversion leaves out, with the reason; messages no rule maps are not wanted and not among them."""
    decoded = (decode_fa if fmt == "fa" else decode_grib)(messages, rules, compat)
    run = [c for c in ("run_id",) if c in decoded.columns]
    headers = decoded.select(*run, *HEADER, "reason")
    if fmt != "fa":
        return headers.where("reason is not null")
    return spoilt_files(headers, run).where("reason is not null")


def spoilt_files(headers: DataFrame, run: list[str]) -> DataFrame:
    """Headers of FA-like files in which a broken message takes the others with it."""
    broken = headers.where("reason = 'shape'").select(*run, "source_file").distinct().withColumn("_broken", F.lit(True))
    return headers.join(broken, [*run, "source_file"], "left") \
        .withColumn("reason", F.coalesce("reason", F.when(F.col("_broken"), F.lit("file")))).drop("_broken").select(*headers.columns)
