from pyspark.sql import functions as F

from gridlake.sources import files


def test_format_of_files(spark, tmp_path):
    (tmp_path / "a.nc").write_bytes(b"x")
    (tmp_path / "b.GRIB2").write_bytes(b"x")
    (tmp_path / "c").write_bytes(b"GRIB" + bytes(20))
    (tmp_path / "d.dat").write_bytes(b"\x89HDF" + bytes(20))
    (tmp_path / "e").write_bytes(b"CDF\x01")
    (tmp_path / "f").write_bytes(b"nothing known")
    found = files.classify_files(files.list_files(spark, str(tmp_path)))
    assert {r["path"].rsplit("/", 1)[1]: r["fmt"] for r in found.collect()} == {
        "a.nc": "netcdf", "b.GRIB2": "grib", "c": "grib", "d.dat": "netcdf", "e": "netcdf", "f": "unknown"}


def test_format_of_a_run(spark, tmp_path):
    for name in ("file_001.nc", "file_002.nc"):
        (tmp_path / name).write_bytes(b"x")
    assert files.run_format(spark, str(tmp_path)) == "netcdf"
    assert files.run_format(spark, str(tmp_path), "LFA") == "fa"
    assert files.list_files(spark, str(tmp_path)).count() == 2


def test_empty_and_unknown_runs(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert files.run_format(spark, str(tmp_path / "empty")) == "none"
    (tmp_path / "odd").mkdir()
    for i in range(5):
        (tmp_path / "odd" / f"a{i}").write_bytes(b"x")
    (tmp_path / "odd" / "z.nc").write_bytes(b"x")  # every file counts, not a sample
    assert files.run_format(spark, str(tmp_path / "odd")) == "netcdf"
    (tmp_path / "odd" / "z.nc").unlink()
    assert files.run_format(spark, str(tmp_path / "odd")) == "unknown"


def test_sizes(spark, tmp_path):
    (tmp_path / "grp=x").mkdir()
    (tmp_path / "grp=x" / "one").write_bytes(bytes(1000))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path", "length")
    row = files.size_by_group(listed, files.store_group(F.col("path"))).first()
    assert (row["grp"], row["n_files"], row["mb"]) == ("x", 1, 0.001)
