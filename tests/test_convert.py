"""Whole runs: stored values have to equal plain array arithmetic with difference zero."""

from datetime import datetime

import numpy as np
import pytest

from gridlake import convert, open_store
from tests.builders import as_grid, fa_run, frame, grib_run, message

CODES = {
    "CLSTEMPERATURE": lambda g, s: g.uniform(260, 310, 35),
    "SURFACCPLUIE": lambda g, s: g.uniform(0, 2, 35) + s,
    "SURFPREC.EAU.CON": lambda g, s: g.uniform(0, 1, 35) + s,
    "SURFPREC.EAU.GEC": lambda g, s: g.uniform(0, 1, 35) + 2 * s,
    "CLSVENT.ZONAL": lambda g, s: g.normal(0, 5, 35),
    "CLSVENT.MERIDIEN": lambda g, s: g.normal(0, 5, 35),
    "P85000TEMPERATURE": lambda g, s: g.uniform(250, 290, 35),
    "P50000GEOPOTENTIEL": lambda g, s: g.uniform(50000, 57000, 35),
    "V00150VENT_ZONAL": lambda g, s: g.normal(0, 9, 35),
    "CLSHUMI.RELATIVE": lambda g, s: g.uniform(0, 1, 35),
    "P85000HUMI_RELATIV": lambda g, s: g.uniform(20, 95, 35),
    "SURFTEMPERATURE": lambda g, s: g.uniform(0, 1, 35),
    "MYSTERY.FIELD": lambda g, s: g.uniform(0, 1, 35),
}
STEPS = [0, 1, 2, 3, 4, 5, 6, 9, 12]


@pytest.fixture(scope="module")
def fa(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("fa")
    rows, truth = fa_run(CODES, STEPS)
    frame(spark, rows).repartition(5).write.parquet(f"{root}/in")
    assert convert(spark, f"{root}/in", f"{root}/store", "arome", "2026081900", edge=4)
    return root, truth


def at(step):
    return datetime(2026, 8, 19, step).isoformat()


def test_units_and_names(spark, fa):
    root, truth = fa
    store = open_store(spark, f"{root}/store", "arome_2026081900")
    t2 = as_grid(store.readfield("t2", timestep=3, group="surface"), 5, 7)
    assert np.array_equal(t2, truth["CLSTEMPERATURE", 3] - np.float32(273.15))
    t850 = as_grid(store.readfield("t850", timestep=at(12)), 5, 7)
    assert np.array_equal(t850, truth["P85000TEMPERATURE", 12] - np.float32(273.15))
    gh = as_grid(store.readfield("gh500", timestep=0), 5, 7)
    np.testing.assert_allclose(gh, truth["P50000GEOPOTENTIEL", 0] / 9.80665, rtol=1e-6)
    r2 = as_grid(store.readfield("r2", timestep=-1), 5, 7)
    assert np.array_equal(r2, truth["CLSHUMI.RELATIVE", 12] * np.float32(100))
    r850 = as_grid(store.readfield("r850", timestep=-1), 5, 7)
    assert np.array_equal(r850, truth["P85000HUMI_RELATIV", 12])


def test_amounts(spark, fa):
    root, truth = fa
    store = open_store(spark, f"{root}/store", "arome_2026081900")
    for var, code, n in (("tp_3h", "SURFACCPLUIE", 3), ("tp_6h", "SURFACCPLUIE", 6),
                         ("twatp_con_3h", "SURFPREC.EAU.CON", 3), ("twatp_gec_12h", "SURFPREC.EAU.GEC", 12)):
        expected = {s for s in STEPS if s - n in STEPS}
        stored = store.read_tiles(var, group=f"surface_{n}h")
        assert {r[0].hour for r in stored.select("valid_time").distinct().collect()} == expected
        for s in expected:
            got = as_grid(store.readfield(var, timestep=at(s), group=f"surface_{n}h") if len(expected) > 1
                          else store.readfield(var), 5, 7)
            diff = truth[code, s] - truth[code, s - n]
            assert np.array_equal(got, np.where(diff < 0, np.float32(0), diff))


def test_sums_are_built_before_amounts(spark, fa):
    root, truth = fa
    store = open_store(spark, f"{root}/store", "arome_2026081900")
    rain = {s: truth["SURFPREC.EAU.CON", s] + truth["SURFPREC.EAU.GEC", s] for s in STEPS}
    assert np.array_equal(as_grid(store.readfield("rain_aladin", timestep=at(9)), 5, 7), rain[9])
    got = as_grid(store.readfield("rain_aladin_3h", timestep=at(9), group="surface_3h"), 5, 7)
    assert np.array_equal(got, np.maximum(rain[9] - rain[6], np.float32(0)))


def test_wind(spark, fa):
    root, truth = fa
    store = open_store(spark, f"{root}/store", "arome_2026081900")
    u, v = truth["CLSVENT.ZONAL", 5], truth["CLSVENT.MERIDIEN", 5]
    assert np.array_equal(as_grid(store.readfield("ws10", timestep=5), 5, 7), np.sqrt(u**2 + v**2))
    degrees = (np.degrees(np.arctan2(-u, -v)) + 360) % 360
    np.testing.assert_allclose(as_grid(store.readfield("wdir10", timestep=5), 5, 7), degrees, rtol=1e-5)


def test_inventory(spark, fa):
    root, _ = fa
    store = open_store(spark, f"{root}/store", "arome_2026081900")
    assert [r["grp"] for r in store.groups().collect()] == [
        "alt_pressure", "alt_pv", "surface", "surface_12h", "surface_3h", "surface_6h"]
    assert store.listfields("alt_pv") == ["u1"]
    assert store.listfields("alt_pressure") == ["gh500", "r850", "t850"]
    fields = store.listfields()
    assert "ts" not in fields and "mystery_field" in fields and "ws" not in fields
    with pytest.raises(KeyError):
        store.listfields("nowhere")
    with pytest.raises(KeyError):
        store.readfield("t2", group="alt_pv")
    report = store.what("time", stdout=False)
    assert "STORE INSPECTION: arome_2026081900" in report
    assert "Group: 'alt_pressure' (3 variables, 9 timesteps)" in report
    assert "  Time range  : 2026-08-19T00:00:00 -> 2026-08-19T12:00:00" in report
    assert "    - t2               : 2m Temperature [Celsius] (type: surface)" in report
    assert "    - u1               : U-component of wind [m s-1] (type: pv, level: 1.5)" in report
    assert "  Grid size   : 5 latitudes x 7 longitudes" in report
    assert "  Lat bounds  : [30.0000 .. 34.0000] (step ~ 1.0000)" in store.what("grid", stdout=False)


def test_report_goes_to_a_file(spark, fa, tmp_path):
    root, _ = fa
    store = open_store(spark, f"{root}/store", "arome_2026081900")
    store.what(output_dir=str(tmp_path))
    text = spark.read.text(f"{tmp_path}/arome_2026081900.info")
    assert text.filter("value like '%2m Temperature%'").count() == 1


def test_point_and_box(spark, fa):
    root, truth = fa
    store = open_store(spark, f"{root}/store", "arome_2026081900")
    series = {r["valid_time"].hour: r["value"] for r in store.point_series("t2", 4, 6).collect()}
    assert series == {s: float(truth["CLSTEMPERATURE", s][4, 6] - np.float32(273.15)) for s in STEPS}
    box = store.read_box("t2", 2, 4, 31, 32, timestep=0)
    assert sorted((r["iy"], r["ix"]) for r in box.collect()) == [(y, x) for y in (1, 2) for x in (2, 3, 4)]


def test_rerun_replaces_groups(spark, fa):
    root, truth = fa
    before = spark.read.parquet(f"{root}/store/tiles").count()
    assert convert(spark, f"{root}/in", f"{root}/store", "arome", "2026081900", fmt="lfa", edge=4)
    assert spark.read.parquet(f"{root}/store/tiles").count() == before


def test_grib_run(spark, tmp_path):
    fields = {
        ("2t", "heightAboveGround", 2): lambda g, s: g.uniform(260, 310, 24),
        ("t", "isobaricInhPa", 850): lambda g, s: g.uniform(260, 310, 24),
        ("10u", "heightAboveGround", 10): lambda g, s: g.normal(0, 5, 24),
        ("tp", "surface", 0): lambda g, s: g.uniform(0, 1, 24) + s,
        ("msl", "meanSea", 0): lambda g, s: g.uniform(99000, 103000, 24),
        ("absv", "isobaricInhPa", 500): lambda g, s: g.normal(0, 1, 24),
        ("nonsense", "surface", 0): lambda g, s: g.normal(0, 1, 24),
    }
    rows, truth = grib_run(fields, [0, 3, 6])
    # A later message of the same field and time replaces the earlier one.
    again = np.full(24, 300.0, "float32")
    rows.append(message(source_file="/in/grib_2025102200_9999", msg_no=0, fmt="grib", edition=2, field_id="2t",
                        level_type_raw="heightAboveGround", level_raw=2, data_date=20251022, data_time=0,
                        step_range="3", ni=6, nj=4, lats=[40.0, 39.0, 38.0, 37.0], lons=[x * 0.5 for x in range(6)],
                        values=again))
    # Not decodable: dropped alone.
    rows.append(message(source_file="/in/grib_2025102200_9999", msg_no=1, fmt="grib", edition=2, field_id="2t",
                        level_type_raw="heightAboveGround", level_raw=2, data_date=20251022, data_time=0,
                        step_range="6", ni=6, nj=4, lats=[1.0], lons=[1.0], values=[1.0]))
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2025102200", edge=3)
    store = open_store(spark, f"{tmp_path}/out", "arome_2025102200")
    assert store.listfields() == ["10u", "2t", "prmsl", "t850", "tp", "tp_3h", "tp_6h"]
    assert np.array_equal(as_grid(store.readfield("2t", 0), 4, 6),
                          truth["2t", "heightAboveGround", 2, 0] - np.float32(273.15))
    assert np.array_equal(as_grid(store.readfield("2t", 1), 4, 6), again.reshape(4, 6) - np.float32(273.15))
    assert np.array_equal(as_grid(store.readfield("2t", 2), 4, 6),
                          truth["2t", "heightAboveGround", 2, 6] - np.float32(273.15))
    assert np.array_equal(as_grid(store.readfield("10u", 1), 4, 6), truth["10u", "heightAboveGround", 10, 3])
    first = store.readfield("2t", 0).filter("iy = 1 and ix = 3").first()
    assert (first["lat"], first["lon"]) == (39.0, 1.5)


def test_compat_trims_by_position(spark, tmp_path):
    rows, truth = fa_run({"SURFACCPLUIE": CODES["SURFACCPLUIE"], "P50000GEOPOTENTIEL": CODES["P50000GEOPOTENTIEL"]},
                         [0, 1, 2, 3, 4, 6])
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2026081900", edge=4, compat=True)
    store = open_store(spark, f"{tmp_path}/out", "arome_2026081900")
    assert [t.hour for t in store.times("surface_3h")] == [3, 4, 6]
    # An axis of six steps cannot lose six: everything stays, mostly missing.
    assert [t.hour for t in store.times("surface_6h")] == [0, 1, 2, 3, 4, 6]
    assert np.isnan(as_grid(store.readfield("tp_6h", 0), 5, 7)).all()
    gh = as_grid(store.readfield("gh500", 0), 5, 7)
    assert np.array_equal(gh, truth["P50000GEOPOTENTIEL", 0])


def test_duplicate_time_and_bad_file(spark, tmp_path):
    rows, truth = fa_run({"CLSTEMPERATURE": CODES["CLSTEMPERATURE"]}, [0, 1])
    grid = np.full(35, 280.0)
    common = dict(fmt="fa", field_id="CLSTEMPERATURE", data_date=20260819, data_time=0, ni=7, nj=5,
                  lats=[30.0 + y for y in range(5)], lons=[float(x) for x in range(7)])
    # Same time as step 1 in a file later in path order: left out.
    rows.append(message(source_file="/in/ZZZ", msg_no=0, step_range="1", values=grid, **common))
    # One broken field spoils its whole file.
    rows.append(message(source_file="/in/BAD_0005", msg_no=0, values=grid, **common))
    rows.append(message(source_file="/in/BAD_0005", msg_no=1, values=[1.0], **{**common, "field_id": "CLSVENT.ZONAL"}))
    # A broken field that is skipped anyway does no harm.
    rows.append(message(source_file="/in/GOOD_0006", msg_no=0, values=grid, **common))
    rows.append(message(source_file="/in/GOOD_0006", msg_no=1, values=[1.0], **{**common, "field_id": "SURFTEMPERATURE"}))
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2026081900", edge=4)
    store = open_store(spark, f"{tmp_path}/out", "arome_2026081900")
    assert [t.hour for t in store.times("surface")] == [0, 1, 6]
    assert np.array_equal(as_grid(store.readfield("t2", 1), 5, 7), truth["CLSTEMPERATURE", 1] - np.float32(273.15))


def test_ready_made_cells(spark, tmp_path):
    rows = []
    for step in range(4):
        for y in range(3):
            for x in range(5):
                stamp = datetime(2026, 8, 19, step)
                rows.append(("tp", "surface", 0.0, stamp, y, x, 30.0 + y, float(x), float(step * 2 + y)))
                if (step, y, x) != (2, 1, 1):
                    rows.append(("t2", "surface", 2.0, stamp, y, x, 30.0 + y, float(x), float(step + x)))
    from gridlake.sources.messages import CELL_SCHEMA
    spark.createDataFrame(rows, CELL_SCHEMA).write.parquet(f"{tmp_path}/in")
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "gfs", "2026081900", edge=2)
    store = open_store(spark, f"{tmp_path}/out", "gfs_2026081900")
    assert store.listfields() == ["t2", "tp", "tp_3h"]
    assert np.array_equal(as_grid(store.readfield("tp_3h"), 3, 5), np.full((3, 5), 6.0, "float32"))
    t2 = as_grid(store.readfield("t2", 2), 3, 5)
    assert np.isnan(t2[1, 1]) and np.isfinite(t2).sum() == 14


def test_failures_return_false(spark, tmp_path):
    assert not convert(spark, f"{tmp_path}/absent", f"{tmp_path}/out", "arome", "2026081900")
    rows, _ = grib_run({("nonsense", "surface", 0): lambda g, s: g.normal(0, 1, 24)}, [0])
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    assert not convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2026081900")
    with pytest.raises(FileNotFoundError):
        open_store(spark, f"{tmp_path}/out")


def test_changing_grid_is_refused(spark, tmp_path):
    small, _ = grib_run({("2t", "heightAboveGround", 2): lambda g, s: g.uniform(0, 1, 24)}, [0])
    large, _ = grib_run({("2t", "heightAboveGround", 2): lambda g, s: g.uniform(0, 1, 30)}, [3], nj=5)
    frame(spark, small + large).write.parquet(f"{tmp_path}/in")
    assert not convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2025102200")


def test_many_runs_at_once(spark):
    from pyspark.sql import functions as F

    from gridlake import default_rules
    from gridlake.operators.grid import cells_from_tiles
    from gridlake.plans.convert import messages_to_groups

    first, truth1 = fa_run({"SURFACCPLUIE": CODES["SURFACCPLUIE"]}, [0, 3], seed=1)
    second, truth2 = fa_run({"SURFACCPLUIE": CODES["SURFACCPLUIE"]}, [0, 3], seed=2)
    both = frame(spark, first).withColumn("run_id", F.lit("a")).unionByName(frame(spark, second).withColumn("run_id", F.lit("b")))
    groups = messages_to_groups(both, "fa", default_rules(), edge=4)
    for run, truth in (("a", truth1), ("b", truth2)):
        cells = cells_from_tiles(groups.filter((F.col("run_id") == run) & (F.col("var") == "tp_3h")))
        diff = truth["SURFACCPLUIE", 3] - truth["SURFACCPLUIE", 0]
        assert np.array_equal(as_grid(cells, 5, 7), np.maximum(diff, np.float32(0)))


def test_compat_keeps_one_field_per_name(spark, tmp_path):
    fields = {("t", "heightAboveGround", 850): lambda g, s: g.uniform(260, 310, 24),
              ("t", "isobaricInhPa", 850): lambda g, s: g.uniform(260, 310, 24)}
    rows, truth = grib_run(fields, [0, 3])
    frame(spark, rows).write.parquet(f"{tmp_path}/in")
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2025102200", compat=True)
    store = open_store(spark, f"{tmp_path}/out", "arome_2025102200")
    assert [r["grp"] for r in store.groups().collect()] == ["alt_pressure"]
    assert np.array_equal(as_grid(store.readfield("t850", 0), 4, 6), truth["t", "isobaricInhPa", 850, 0] - np.float32(273.15))


def test_packed_messages(spark, tmp_path):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from gridlake.kernels import to_bytes

    rows, truth = fa_run({"CLSTEMPERATURE": CODES["CLSTEMPERATURE"]}, [0, 1])
    pack = F.arrow_udf(lambda a: to_bytes(a), T.BinaryType(), F.ArrowUDFType.SCALAR)
    frame(spark, rows).withColumn("values", pack("values")).write.parquet(f"{tmp_path}/in")
    assert convert(spark, f"{tmp_path}/in", f"{tmp_path}/out", "arome", "2026081900", edge=4)
    store = open_store(spark, f"{tmp_path}/out", "arome_2026081900")
    assert np.array_equal(as_grid(store.readfield("t2", 1), 5, 7), truth["CLSTEMPERATURE", 1] - np.float32(273.15))
