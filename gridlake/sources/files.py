"""The files of a run: listing, format, size. File contents are not read beyond a 16-byte header."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Endings, first bytes and names of the formats.
EXTENSIONS = {
    "netcdf": (".nc", ".nc4", ".netcdf"),
    "grib": (".grib", ".grb", ".grib1", ".grib2", ".grb1", ".grb2"),
}
MAGIC = ((b"GRIB", "grib"), (b"CDF", "netcdf"), (b"\x89HDF", "netcdf"))
ALIASES = {"fa": "fa", "lfa": "fa", "grib": "grib", "grib1": "grib", "grib2": "grib", "netcdf": "netcdf",
           "nc": "netcdf"}


def list_files(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """(path, length, modified) of the plain files of one directory, or of a tree, by path. Spark leaves out names with a
    leading ``_`` or ``.`` and files without content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(directory) \
        .select("path", "length", F.col("modificationTime").alias("modified")).orderBy("path")


def format_by_extension(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))
    chain = F.when(suffix.isin(*EXTENSIONS["netcdf"]), F.lit("netcdf"))
    return chain.when(suffix.isin(*EXTENSIONS["grib"]), F.lit("grib"))


def format_by_bytes(head: Column) -> Column:
    """Format by the first bytes of a file; NULL if they tell nothing."""
    found = [F.when(F.substring(head, 1, len(magic)) == F.lit(magic), F.lit(fmt)) for magic, fmt in MAGIC]
    return F.coalesce(*found)


def format_of(path: Column, head: Column) -> Column:
    """Format by ending first, by the first bytes for what the ending leaves open, else ``unknown``."""
    return F.coalesce(format_by_extension(path), format_by_bytes(head), F.lit("unknown"))


@F.pandas_udf(T.StringType())
def format_by_header(paths: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Format by the first 16 bytes, read where the file lives; unreadable files are unknown."""
    from pyarrow import fs

    def sniff(path: str) -> str:
        try:
            where, name = fs.FileSystem.from_uri(path)
            with where.open_input_stream(name) as stream:
                head = stream.read(16)
        except OSError:
            return "unknown"
        return next((fmt for magic, fmt in MAGIC if head.startswith(magic)), "unknown")

    for batch in paths:
        yield batch.map(sniff)


def classify_files(files: DataFrame) -> DataFrame:
    """Add ``fmt`` per file: extension first, header bytes for what the extension leaves open."""
    by_name = files.withColumn("fmt", format_by_extension(F.col("path")))
    known = by_name.filter(F.col("fmt").isNotNull())
    rest = by_name.filter(F.col("fmt").isNull()).withColumn("fmt", format_by_header(_uri(F.col("path"))))
    return known.unionByName(rest)


def _uri(path: Column) -> Column:
    # Spark writes local paths as file:/x, which is no valid URI for other libraries.
    return F.regexp_replace(path, r"^file:/(?!/)", "file:///")


def run_format(spark: SparkSession, directory: str, explicit: str | None = None) -> str:
    """Format of a run: as given, else that of the first file, in path order, that is recognised.

    ``none`` for an empty directory, ``unknown`` if no file tells.
    """
    listed = list_files(spark, directory)
    if not listed.take(1):
        return "none"
    if explicit and explicit.lower() in ALIASES:
        return ALIASES[explicit.lower()]
    known = F.when(F.col("fmt") != "unknown", F.col("path"))
    return classify_files(listed).agg(F.min_by("fmt", known)).first()[0] or "unknown"


def size_by_group(files: DataFrame, group: Column) -> DataFrame:
    """Megabytes and files per group."""
    return files.groupBy(group.alias("grp")).agg(F.count(F.lit(1)).alias("n_files"),
                                                 (F.sum("length") / F.lit(1e6)).alias("mb"))


def store_group(path: Column) -> Column:
    """The group a store file belongs to, from its partition directory."""
    return F.nullif(F.regexp_extract(path, r"/grp=([^/]+)/", 1), F.lit(""))
