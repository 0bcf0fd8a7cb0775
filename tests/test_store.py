"""Stores: what reaches the scan, statistics, swaps, several runs and layouts; cells to tiles; messages that are left out."""

import os
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake import convert, open_store
from gridlake.functions import text
from gridlake.layout import curve_key, curve_position
from gridlake.operators import grid, summary
from gridlake.plans import store as store_plan
from gridlake.plans.convert import RunReport
from tests.builders import as_grid, fa_run, frame, grib_run, message

CODES = {"CLSTEMPERATURE": lambda g, s: g.uniform(260, 310, 35), "CLSVENT.ZONAL": lambda g, s: g.normal(0, 5, 35),
         "CLSVENT.MERIDIEN": lambda g, s: g.normal(0, 5, 35)}
NAME = "arome_2026081900"


@pytest.fixture(scope="module")
def fa(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    rows, truth = fa_run(CODES, range(4))
    frame(spark, rows).write.parquet(f"{root}/in")
    assert convert(spark, f"{root}/in", f"{root}/store", "arome", "2026081900", edge=2)
    return root, truth


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pushed(df):
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [line for line in text.splitlines() if "PushedFilters" in line or "ReadSchema" in line]


def test_box_and_place_reach_the_scan(spark, fa):
    store = open_store(spark, f"{fa[0]}/store", NAME)
    box = " ".join(pushed(store.read_box("t2", 2, 4, 31, 32, timestep=0)))
    for column in ("lat_min", "lat_max", "lon_min", "lon_max", "var", "valid_time"):
        assert f"({column}," in box, box
    series = " ".join(pushed(store.point_series("t2", 4, 6)))
    assert f"EqualTo(tkey,{curve_position(2, 3)})" in series or f"In(tkey, [{curve_position(2, 3)}])" in series, series


def test_many_runs_prune_by_join(spark, fa):
    plan = plan_of(open_store(spark, f"{fa[0]}/store").read_tiles("t2", 1))
    assert "dynamicpruning" in plan


def test_reductions_leave_values_closed(spark, fa):
    store = open_store(spark, f"{fa[0]}/store", NAME)
    truth = np.stack([fa[1]["CLSVENT.ZONAL", s] for s in range(4)])
    for made in (summary.symmetric_limit, summary.field_mean, summary.extent):
        df = made(store.read_tiles("u10"), ["var"])
        assert not any("values:binary" in line for line in pushed(df)), made
    assert summary.symmetric_limit(store.read_tiles("u10"), ["var"]).first()["max_abs"] == np.abs(truth).max()
    assert summary.field_mean(store.read_tiles("u10"), ["var"]).first()["mean"] == pytest.approx(truth.astype("f8").mean(), abs=1e-9)


def test_statistics_skip_missing_points(spark):
    rows = [([1.0, None, -3.0, 2.0],), ([None] * 4,), (None,)]
    tiles = spark.createDataFrame(rows, "values array<float>").withColumns({"h": F.lit(2), "w": F.lit(2), "k": F.lit(1)})
    got = summary.field_mean(tiles, ["k"]).first()
    assert (got["mean"], got["n_missing"]) == (0.0, 9)
    assert summary.symmetric_limit(tiles, ["k"]).first()["max_abs"] == 3.0


def test_curve_agrees_with_its_column(spark):
    places = [(0, 0), (0, 1), (1, 0), (3, 5), (200, 77), (65535, 65535)]
    got = spark.createDataFrame(places, "ty int, tx int").select(curve_key(F.col("ty"), F.col("tx"))).collect()
    assert [r[0] for r in got] == [curve_position(*p) for p in places]


@pytest.mark.parametrize("broken", ["describe", "move"])
def test_a_failed_write_leaves_the_old_store(spark, fa, tmp_path, monkeypatch, broken):
    rows, truth = fa_run(CODES, range(2))
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    assert convert(spark, f"{tmp_path}/in", out, "arome", "2026081900", edge=4)
    before = {r["grp"]: r for r in open_store(spark, out, NAME).inventory().collect()}

    def fail(*_):
        raise OSError("disk gone")

    if broken == "describe":
        monkeypatch.setattr(store_plan, "describe_fields", fail)
    else:
        original, calls = store_plan._Files.move, []

        def some(self, old, new):
            calls.append(new)
            if len(calls) == 3:  # the tiles are swapped, the fields are on their way
                fail()
            original(self, old, new)

        monkeypatch.setattr(store_plan._Files, "move", some)
    assert not convert(spark, f"{fa[0]}/in", out, "arome", "2026081900", edge=4)
    monkeypatch.undo()
    store = open_store(spark, out, NAME)
    assert {r["grp"]: r for r in store.inventory().collect()} == before
    assert np.array_equal(as_grid(store.readfield("t2", 1), 5, 7), truth["CLSTEMPERATURE", 1] - np.float32(273.15))
    assert sorted(x for x in os.listdir(out) if not x.startswith(".")) == ["fields", "tiles"]


def test_fields_keep_order_and_attributes(spark, fa):
    fields = {r["var"]: r for r in open_store(spark, f"{fa[0]}/store", NAME).fields.collect()}
    assert fields["t2"]["attrs"]["units"] == "Celsius" and fields["t2"]["attrs"]["source_name"] == "CLSTEMPERATURE"
    assert sorted(fields, key=lambda v: (fields[v]["field_order"], v)) == ["t2", "u10", "v10", "wdir10", "ws10"]


def test_report_options(spark, fa, tmp_path):
    store = open_store(spark, f"{fa[0]}/store", NAME)
    lines = store.what(stdout=False).splitlines()
    names = [line.split()[1] for line in lines if line.startswith("    - ")]
    assert names == ["t2", "u10", "v10", "wdir10", "ws10"]
    assert [line.split()[1] for line in store.what(stdout=False, sortfields=True).splitlines() if line.startswith("    - ")] == sorted(names)
    assert store.what("times", stdout=False) == store.what("time", stdout=False) == store.what(stdout=False, verbose=True)
    assert "| chunks: [1, 2, 2]" in store.what("chunks", stdout=False) and "| compressor: zstd" in store.what("compression", stdout=False)
    said = store.what(output_dir=str(tmp_path))
    assert (tmp_path / f"{NAME}.info").read_text() == said + "\n"


def test_one_group_and_a_folder_of_groups(spark, fa, tmp_path):
    tiles = open_store(spark, f"{fa[0]}/store", NAME).tiles.drop("run_id", "grp")
    tiles.filter("var = 't2'").write.parquet(f"{tmp_path}/run/surface.tiles")
    tiles.filter("var = 'u10'").write.parquet(f"{tmp_path}/run/other.tiles")
    one = open_store(spark, f"{tmp_path}/run/surface.tiles")
    assert one.listfields() == ["t2"] and [r["grp"] for r in one.groups().collect()] == ["surface"]
    both = open_store(spark, f"{tmp_path}/run")
    assert both.listfields() == ["t2", "u10"] and both.listfields("other") == ["u10"]
    assert both.readfield("u10", 2).count() == 35
    spark.range(3).write.parquet(f"{tmp_path}/plain")
    with pytest.raises(ValueError):
        open_store(spark, f"{tmp_path}/plain")


def test_map_data(spark, fa):
    store = open_store(spark, f"{fa[0]}/store", NAME)
    u, v = fa[1]["CLSVENT.ZONAL", 2], fa[1]["CLSVENT.MERIDIEN", 2]
    rows = {(r["iy"], r["ix"]): r for r in store.map_data(timestep=2, wind=("u10", "v10"), zoom="lonmin=1,lonmax=5,latmin=30,latmax=33", subsampling=3).collect()}
    assert set(rows) == {(y, x) for y in range(4) for x in range(1, 6)}
    assert rows[3, 3]["arrow"] and not rows[2, 3]["arrow"] and rows[2, 3]["speed"] == pytest.approx(np.hypot(u[2, 3], v[2, 3]), rel=1e-6)
    assert max(r["value"] for r in store.map_data("u10", 2, minmax=(None, 1.0)).collect()) <= 1.0


# ---- cells and blocks ----


def cell_rows(n, value=lambda y, x: float(y * 1000 + x), file="a"):
    return [(file, "run", "f", datetime(2026, 8, 19), y, x, 30.0 + y, float(x), value(y, x)) for y in range(n) for x in range(n)]


CELLS = "source_file string, run_id string, var string, valid_time timestamp, iy int, ix int, lat double, lon double, value float"
KEYS = ["run_id", "var", "valid_time"]


def test_a_full_tile_is_linear(spark):
    points = spark.range(65536).select(F.lit("a").alias("source_file"), F.lit("run").alias("run_id"), F.lit("f").alias("var"),
                                       F.lit(datetime(2026, 8, 19)).alias("valid_time"), (F.col("id") / 256).cast("int").alias("iy"),
                                       (F.col("id") % 256).cast("int").alias("ix"), (F.col("id") % 7).cast("float").alias("value")) \
        .withColumns({"lat": F.col("iy").cast("double"), "lon": F.col("ix").cast("double")}).persist()
    points.count()
    tiles = grid.tiles_from_cells(points, KEYS, 256, "source_file")
    tiles.collect()
    start = time.time()
    row = tiles.collect()[0]
    took = time.time() - start
    got = np.frombuffer(row["values"], "<f4")
    assert np.array_equal(got, (np.arange(65536) % 7).astype("f4"))
    points.unpersist()
    assert took < 5  # the aim is one second; a loaded machine gets some slack


def test_overlapping_cells_are_settled_by_file(spark):
    first = [r if (r[4], r[5]) != (1, 1) else (*r[:8], None) for r in cell_rows(4)]
    second = cell_rows(5, lambda y, x: -1.0, "b")
    third = cell_rows(1, lambda y, x: 9.0, "a")  # the same cell twice in one file
    cells = spark.createDataFrame(second + first + third, CELLS)
    tiles = grid.tiles_from_cells(cells, KEYS, 3, "source_file")
    assert {(r["ny"], r["nx"]) for r in tiles.collect()} == {(5, 5)}
    got = as_grid(grid.cells_from_tiles(tiles), 5, 5)
    want = np.full((5, 5), -1.0)
    want[:4, :4] = [[y * 1000 + x for x in range(4)] for y in range(4)]
    want[1, 1] = -1
    assert np.array_equal(got, want.astype("f4"))


def test_cells_without_rows_or_coordinates(spark):
    cells = spark.createDataFrame([r for r in cell_rows(4) if r[4] != 1], CELLS).withColumn("lat", F.when(F.col("iy") > 0, F.col("lat")))
    row = grid.tiles_from_cells(cells, KEYS, 4).first()
    assert row["lats"] == [None, None, 32.0, 33.0] and np.isnan(np.frombuffer(row["values"], "<f4").reshape(4, 4)[1]).all()
    assert grid.tiles_from_cells(cells.limit(0), KEYS, 4).count() == 0


def test_blocks_are_cut_by_size(spark):
    cells = spark.range(10_000 * 4).select(F.lit("f").alias("var"), F.floor(F.col("id") / 4).alias("t"), (F.col("id") % 4 / 2).cast("int").alias("iy"),
                                           (F.col("id") % 2).cast("int").alias("ix"), F.col("id").cast("float").alias("value"))
    blocks = grid.pack_blocks(cells, ["var"], "t", 2, most=1000)
    sizes = [r[0] for r in blocks.select(F.size("block")).collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 1003 and all(s % 4 == 0 for s in sizes)
    spans = sorted((r["a"], r["b"]) for r in blocks.select(F.col("block")[0]["t"].alias("a"), F.element_at("block", -1)["t"].alias("b")).collect())
    assert all(b < a for (_, b), (a, _) in zip(spans, spans[1:]))
    back = grid.unpack_blocks(blocks).select("t", "iy", "ix", "value")
    assert back.exceptAll(cells.select("t", "iy", "ix", "value")).count() == 0
    assert "collect_list" not in plan_of(blocks)


@pytest.mark.parametrize("k", [1, 2, 3, 7, 300])
def test_coarsening_across_tiles(spark, k):
    rng = np.random.default_rng(1)
    whole = rng.normal(size=(530, 610)).astype("f4")
    whole[rng.random(whole.shape) < 0.2] = np.nan
    whole[:9, :9] = np.nan
    values = [None if np.isnan(x) else float(x) for x in whole.ravel()]
    rows = [("f", 610, 530, [float(y) for y in range(530)], [x / 2 for x in range(610)], values)]
    tiles = grid.tiles_from_messages(spark.createDataFrame(rows, "var string, ni int, nj int, lats array<double>, lons array<double>, values array<float>"), 256)
    coarse = summary.coarsen_tiles(tiles, k).collect()
    ny, nx = 530 // k, 610 // k
    got, lats, seen = np.zeros((ny, nx)), np.zeros(ny), np.zeros((ny, nx), int)
    for r in coarse:
        at = np.s_[r["y0"]:r["y0"] + r["h"], r["x0"]:r["x0"] + r["w"]]
        got[at] = np.frombuffer(r["values"], "<f4").reshape(r["h"], r["w"])
        lats[at[0]] = r["lats"]
        seen[at] += 1
        assert (r["ny"], r["nx"]) == (ny, nx)
    assert (seen == 1).all()
    blocks = whole[:ny * k, :nx * k].reshape(ny, k, nx, k).astype("f8")
    count = (~np.isnan(blocks)).sum(axis=(1, 3))
    want = np.where(count > 0, np.nansum(blocks, axis=(1, 3)) / np.maximum(count, 1), np.nan)
    np.testing.assert_allclose(got, want.astype("f4"), rtol=2e-6, atol=1e-7)
    np.testing.assert_allclose(lats, np.arange(530)[:ny * k].reshape(ny, k).mean(axis=1))
    assert len({(r["ty"], r["tx"]) for r in coarse}) == len(coarse)


def test_aligned_coarsening_has_no_exchange(spark):
    rows = [("f", 8, 8, [float(y) for y in range(8)], [float(x) for x in range(8)], [1.0] * 64)]
    tiles = grid.tiles_from_messages(spark.createDataFrame(rows, "var string, ni int, nj int, lats array<double>, lons array<double>, values array<float>"), 4)
    assert "Exchange" not in plan_of(summary.coarsen_tiles(tiles, 2, edge=4))


# ---- what is left out ----


def test_rejected_messages_are_counted_and_listed(spark, tmp_path):
    rows, _ = fa_run(CODES, [0, 1])
    rows.append(message(source_file="/in/BAD_0005", msg_no=0, fmt="fa", field_id="CLSTEMPERATURE", data_date=20260819, data_time=0, ni=7, nj=5,
                        lats=[1.0], lons=[1.0], values=[1.0]))
    rows.append(message(source_file="/in/BAD_0005", msg_no=1, fmt="fa", field_id="CLSVENT.ZONAL", data_date=20260819, data_time=0, ni=7, nj=5,
                        lats=[float(y) for y in range(5)], lons=[float(x) for x in range(7)], values=[1.0] * 35))
    rows.append(message(source_file="/in/NODATE", msg_no=0, fmt="fa", field_id="CLSTEMPERATURE", data_date=None, data_time=0, ni=7, nj=5,
                        lats=[float(y) for y in range(5)], lons=[float(x) for x in range(7)], values=[1.0] * 35))
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    report = RunReport()
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2026081900", edge=4, report=report)
    assert report.counts == {"shape": 1, "time": 1, "file": 1, "corrupt": 0}
    listed = spark.read.parquet(report.rejected)
    assert sorted((r["source_file"], r["msg_no"], r["reason"]) for r in listed.collect()) == [
        ("/in/BAD_0005", 0, "shape"), ("/in/BAD_0005", 1, "file"), ("/in/NODATE", 0, "time")]


def test_corrupt_files_fail_or_are_named(spark, tmp_path):
    rows, truth = grib_run({("2t", "heightAboveGround", 2): lambda g, s: g.uniform(260, 310, 24)}, [0, 3])
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/in")
    (tmp_path / "in" / "part-zzz.parquet").write_bytes(b"PAR1 this is no table PAR1")
    assert not convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "gfs", "2025102200")
    report = RunReport()
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "gfs", "2025102200", skip_corrupt=True, report=report)
    assert report.counts["corrupt"] == 1
    assert spark.read.parquet(report.rejected).first()["source_file"].endswith("part-zzz.parquet")
    store = open_store(spark, f"{tmp_path}/out", "gfs_2025102200")
    assert np.array_equal(as_grid(store.readfield("2t", 1), 4, 6), truth["2t", "heightAboveGround", 2, 3] - np.float32(273.15))


def test_a_file_has_one_time(spark, tmp_path):
    base = dict(fmt="fa", data_time=0, ni=2, nj=2, lats=[1.0, 2.0], lons=[1.0, 2.0])
    rows = [message(source_file="/in/ONE", msg_no=0, field_id="CLSTEMPERATURE", data_date=20260819, step_range="3", values=[1.0] * 4, **base),
            message(source_file="/in/ONE", msg_no=1, field_id="CLSVENT.ZONAL", data_date=20260819, step_range="6", values=[2.0] * 4, **base)]
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2026081900")
    store = open_store(spark, f"{tmp_path}/out", NAME)
    assert store.times("surface") == [datetime(2026, 8, 19) + timedelta(hours=3)]


# ---- texts ----


@pytest.mark.parametrize(("box", "want"), [
    ("lonmin=-2, lonmax=12,latmin=1e1 , LATMAX=5.", (-2.0, 12.0, 10.0, 5.0)),
    ("lonmin=1,lonmin=3,lonmax=4,latmin=5,latmax=6,note", (3.0, 4.0, 5.0, 6.0)),
    ("lonmin=1,lonmax=2,latmin=3", None), ("lonmin=x,lonmax=2,latmin=3,latmax=4", None), ("", None), (None, None)])
def test_boxes(spark, box, want):
    named = None if want is None else dict(zip(text.BOX_KEYS, want, strict=True))
    assert text.parse_box(box) == named
    got = spark.createDataFrame([(box,)], "b string").select(text.box_column(F.col("b")).alias("x")).first()["x"]
    assert (None if got is None else got.asDict()) == named


def test_limits():
    assert text.parse_limits("1e2, None") == (100.0, None) and text.parse_limits(" 5. ,6") == (5.0, 6.0)
    assert text.parse_limits(None) == text.parse_limits("") == (None, None) and text.parse_limits((None, 3)) == (None, 3.0)
