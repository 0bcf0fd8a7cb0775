"""Operators on small literal inputs."""

import json
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake import default_rules, kernels, load_rules
from gridlake.functions import names, text, times, units, wind
from gridlake.layout import packed, unpacked
from gridlake.operators import accum, align, derived, grid, percent, resolve, routing, select, summary
from gridlake.rules import DerivedRule, GroupRule, Rules

START = datetime(2026, 3, 1)
RULES = default_rules()


def series(spark, hours, values):
    rows = [("r", "tp", START + timedelta(hours=h), v) for h, v in zip(hours, values)]
    return spark.createDataFrame(rows, "run_id string, var string, valid_time timestamp, value double")


def amounts(spark, hours, values, n):
    out = accum.sliding_amounts(series(spark, hours, values), [n], ["run_id", "var"]).orderBy("valid_time")
    return [r["value"] for r in out.collect()]


# ---- amounts ----------------------------------------------------------------------------------------------

def test_amount_of_an_even_axis(spark):
    assert amounts(spark, range(5), [0.0, 2.0, 5.0, 5.0, 10.0], 3) == [None, None, None, 5.0, 8.0]


def test_amount_of_an_uneven_axis(spark):
    got = amounts(spark, [0, 1, 2, 3, 4, 6, 9, 12], [0.0, 2.0, 5.0, 5.0, 10.0, 9.0, 20.0, 21.0], 3)
    assert got == [None, None, None, 5.0, 8.0, 4.0, 11.0, 1.0]


def test_negative_and_missing(spark):
    assert amounts(spark, [0, 1], [5.0, 3.0], 1) == [None, 0.0]
    assert amounts(spark, [0, 1, 2], [1.0, None, 4.0], 1) == [None, None, None]


def test_all_lengths_share_one_exchange_and_one_sort(spark):
    df = series(spark, range(5), [0.0, 2.0, 5.0, 5.0, 10.0]).withColumns({
        "shortname": F.col("var"), "level_type": F.lit("surface"), "level": F.lit(0.0), "acc_hours": F.lit(None).cast("int")})
    out = accum.accumulate(df, RULES)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and plan.count("Window [") == 1
    assert {r["var"] for r in out.select("var").distinct().collect()} == {"tp_3h", "tp_6h", "tp_12h", "tp_24h"}


def test_which_variables_get_amounts(spark):
    df = spark.createDataFrame([("tp", "x"), ("tp850", "x"), ("tp1.5", "x"), ("tpx", "x"), ("other", "tsnowp"), ("tp_3h", None)],
                               "var string, shortname string")
    hit = df.select("var", accum.window_targets(F.col("var"), F.col("shortname"), RULES).alias("t")).collect()
    assert {r["var"]: [(t["acc_hours"], t["source"]) for t in r["t"]][:1] for r in hit} == {
        "tp": [(3, "tp")], "tp850": [(3, "tp")], "tp1.5": [(3, "tp")], "tpx": [], "other": [(3, "tsnowp")], "tp_3h": []}


def test_amounts_are_no_sources(spark):
    df = series(spark, range(5), [0.0, 2.0, 5.0, 5.0, 10.0]).withColumns({
        "shortname": F.lit("tp"), "level_type": F.lit("surface"), "level": F.lit(0.0), "acc_hours": F.lit(3)})
    assert accum.accumulate(df, RULES).count() == 0


# ---- wind and units ---------------------------------------------------------------------------------------

def test_wind(spark):
    df = spark.createDataFrame([(3.0, 4.0), (0.0, -5.0), (-3.0, 0.0), (0.0, 0.0)], "u double, v double")
    rows = df.select(wind.vector_magnitude(F.col("u"), F.col("v")), wind.vector_direction(F.col("u"), F.col("v"))).collect()
    assert [r[0] for r in rows] == [5.0, 5.0, 3.0, 0.0]
    np.testing.assert_allclose([r[1] for r in rows], [216.869898, 0.0, 90.0, 180.0], atol=1e-6)


def test_units(spark):
    df = spark.createDataFrame([(273.15,), (300.15,), (None,)], "x double")
    got = [r[0] for r in df.select(units.apply_formula(F.col("x"), F.lit("K2C"), double=True)).collect()]
    assert got[2] is None and np.allclose(got[:2], [0, 27])
    same = df.select(units.apply_formula(F.col("x"), F.lit("acc"), double=True)).collect()
    assert [r[0] for r in same] == [273.15, 300.15, None]
    compat = df.select(units.apply_formula(F.col("x"), F.lit("div98"), double=True, compat=True)).collect()
    assert compat[0][0] == 273.15


@pytest.mark.parametrize("values, expected", [([0.2, 1.0], [20.0, 100.0]), ([20.0, 95.0], [20.0, 95.0]), ([None, None], [None, None]),
                                              ([0.5, float("nan")], [50.0, None])])
def test_percent(spark, values, expected):
    df = spark.createDataFrame([("f", v) for v in values], "var string, value double") \
        .withColumn("value", units.nan_to_null(F.col("value")))
    got = [r["value"] for r in percent.scale_percent(df, ["var"]).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    whole = kernels.percent(np.array([np.nan if v is None else v for v in values], "float32"))
    np.testing.assert_allclose(whole, [np.nan if v is None else v for v in expected], rtol=1e-6)


def test_kernels_agree_with_columns(spark):
    rng = np.random.default_rng(1)
    a, b = (rng.normal(0, 10, 200).astype("float32") for _ in range(2))
    a[:3], b[:3] = 0, 0
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a float, b float")
    A, B = F.col("a"), F.col("b")
    pairs = {
        "magnitude": (wind.vector_magnitude(A, B).cast("float"), kernels.vector_magnitude(a, b)),
        "direction": (wind.vector_direction(A, B).cast("float"), kernels.vector_direction(a, b).astype("float32")),
        "amount": (wind.amount(A, B), kernels.amount(a, b)),
        **{k: (units.apply_formula(A, F.lit(k)), fn(a)) for k, fn in units.formula_kernels().items() if k != "percent"}}
    got = df.select(*[c.alias(k) for k, (c, _) in pairs.items()]).toPandas()
    for k, (_, expected) in pairs.items():
        np.testing.assert_allclose(got[k].to_numpy("float32"), expected, rtol=2e-7, err_msg=k)


def test_custom_formula(spark):
    units.register_formula("Joule2kWh", lambda x: x / 3.6e6, "kWh m-2")
    try:
        df = spark.createDataFrame([([3.6e6, None],)], "values array<float>")
        assert df.select(units.apply_formula(F.col("values"), F.lit("joule2kwh"), tiled=True)).first()[0] == [1.0, None]
        assert df.select(units.formula_units(F.lit("joule2kwh"), F.lit("unknown"))).first()[0] == "kWh m-2"
    finally:
        units.unregister_formula("joule2kwh")


def test_derived_only_with_both_sources(spark):
    rows = [("r", START, 0, 0, v, 1.0 * i) for i, v in enumerate(["u", "u10", "v10"])]
    df = spark.createDataFrame(rows, "run_id string, valid_time timestamp, iy int, ix int, var string, value float")
    out = derived.derive(df, derived.usable(RULES.derived, derived.WIND)).collect()
    assert {r["var"] for r in out} == {"ws10", "wdir10"}


# ---- codes, names, times ----------------------------------------------------------------------------------

def test_fa_codes(spark):
    codes = ["CLSTEMPERATURE", "CLSVENT.ZONAL", "P85000TEMPERATURE", "V00150VENT_ZONAL", "SURFTEMPERATURE", "S045WIND.U.PHYS",
             "H00100TEMPERATURE", "XYZ.A", "P00050TEMPERATUR", "CLSHUMI.FOO", "CLSVENT.X", "SURFFOO"]
    df = spark.createDataFrame([(c,) for c in codes], "field_id string")
    got = {r["field_id"]: (r["var"], r["level_type"], r["level"], r["formula"]) for r in resolve.resolve_fa(df, RULES).collect()}
    assert got == {
        "CLSTEMPERATURE": ("t2", "surface", 0.0, "k2c"), "CLSVENT.ZONAL": ("u10", "surface", 0.0, "None"),
        "P85000TEMPERATURE": ("t850", "isobaric", 850.0, "k2c"), "V00150VENT_ZONAL": ("u1", "pv", 1.5, "None"),
        "S045WIND.U.PHYS": ("u", "model_level", 45.0, "None"), "H00100TEMPERATURE": ("t100", "height", 100.0, "k2c"),
        "XYZ.A": ("xyz_a", "unknown", 0.0, "None"), "P00050TEMPERATUR": ("t0", "isobaric", 0.5, "k2c"),
        "CLSHUMI.FOO": ("clshumi_foo", "surface", 2.0, "None"), "CLSVENT.X": ("clsvent_x", "surface", 10.0, "None"),
        "SURFFOO": ("surffoo", "surface", 0.0, "None")}


def test_grib_codes(spark):
    rows = [("t", "isobaricInhPa", 850), ("2t", "heightAboveGround", 2), ("t", "heightAboveGround", 2), ("10u", "heightAboveGround", 10),
            ("absv", "surface", 0), ("zz", "surface", 0), ("msl", "meanSea", 0), ("tcc", "nominalTop", 0), ("sp", None, None)]
    df = spark.createDataFrame(rows, "field_id string, level_type_raw string, level_raw int")
    got = [(r["field_id"], r["var"], r["level_type"]) for r in resolve.resolve_grib(df, RULES).collect()]
    assert got == [("t", "t850", "isobaric"), ("2t", "2t", "height"), ("t", "t2", "height"), ("10u", "10u", "height"),
                   ("msl", "prmsl", "meanSea"), ("tcc", "totcc", "surface"), ("sp", "ps", "surface")]


def test_valid_times(spark):
    df = spark.createDataFrame([(20260819, 1230, s) for s in ("0-3", "6", "30m", "")] + [(20261319, 0, "1")], "d int, t int, s string")
    got = [r[0] for r in df.select(times.valid_time(F.col("d"), F.col("t"), F.col("s"))).collect()]
    assert got == [datetime(2026, 8, 19, 15, 30), datetime(2026, 8, 19, 18, 30), None, datetime(2026, 8, 19, 12, 30), None]
    old = [r[0] for r in df.select(times.valid_time(F.col("d"), F.col("t"), F.col("s"), compat=True)).collect()]
    assert old[2] == old[4] == datetime(1970, 1, 1)


def test_text(spark):
    row = spark.range(1).select(
        text.box_column(F.lit("lonmin=-2, LONMAX=12, latmin=30, latmax=40.5")), text.box_column(F.lit("lonmin=-2, latmin=30")),
        names.first_number(F.lit("RR12h")), names.group_hours(F.lit("surface")), times.digit_stamp(F.lit("none"))).first()
    assert tuple(row[0]) == (-2.0, 12.0, 30.0, 40.5) and row[1:] == (None, 12, None, "static")
    assert text.parse_box("lonmin=1, lonmax=2, latmin=3") is None
    assert text.parse_limits("None, 4") == (None, 4.0) and text.parse_limits((1, None)) == (1, None)


def test_orientation_of_axes(spark):
    lats, lons = [1.0, 1.0, 2.0, 2.0], [5.0, 6.0, 5.0, 6.0]
    df = spark.createDataFrame([(2, 2, lats, lons), (2, 2, lons, lats)], "ni int, nj int, lats array<double>, lons array<double>")
    got = grid.with_axes(df).collect()
    assert [(r["lats"], r["lons"]) for r in got] == [([1.0, 2.0], [5.0, 6.0]), ([5.0, 6.0], [1.0, 2.0])]


# ---- groups, times, duplicates ----------------------------------------------------------------------------

def routes(spark, rows, rules=RULES):
    df = spark.createDataFrame(rows, "var string, level_type string, acc_hours int")
    return {(r["var"], r["grp"]) for r in routing.route(df, rules).collect()}


def test_routing(spark):
    rows = [("tp_3h", "surface", 3), ("prmsl", "meanSea", None), ("t850", "isobaric", None), ("ws10", None, None), ("RR3h", "surface", None),
            ("tp_1h", "surface", 1)]
    assert routes(spark, rows) == {("tp_3h", "surface_3h"), ("prmsl", "surface"), ("t850", "alt_pressure"), ("ws10", "surface"),
                                   ("RR3h", "surface_3h"), ("tp_1h", "surface")}
    assert routes(spark, rows[1:2], Rules(groups=(GroupRule("a"), GroupRule("others")))) == {("prmsl", "others")}
    assert routes(spark, rows[1:2], Rules(groups=(GroupRule("a"), GroupRule("b")))) == {("prmsl", "a")}
    assert routes(spark, rows[1:2], Rules()) == {("prmsl", "surface")}


def test_trim_rounds_half_to_even(spark):
    df = spark.createDataFrame([("r", "g_5h", "a", float(dt), START + timedelta(hours=h)) for dt in (2,) for h in range(6)],
                               "run_id string, grp string, var string, dt_hours double, valid_time timestamp")
    assert routing.trim_leading(df).count() == 4  # 2.5 steps count as 2


def test_times(spark):
    df = series(spark, [0, 3, 25], [1.0, 2.0, 3.0])
    pick = lambda d: [r["value"] for r in d.orderBy("valid_time").collect()]
    assert pick(select.at_position(df, -1, ["var"])) == [3.0]
    assert pick(select.at_position(df, 7, ["var"])) == []
    assert pick(select.at_position(df.filter("value = 2"), 5, ["var"])) == [2.0]
    assert pick(select.at_label(df, "2026-03-01")) == [1.0, 2.0]
    assert pick(select.at_label(df, "2026-03-01T03:00:00")) == [2.0]
    assert pick(select.at_label(df, "2026-03")) == [1.0, 2.0, 3.0]
    with pytest.raises(ValueError):
        select.at_label(df, "yesterday")


def test_duplicates(spark):
    df = spark.createDataFrame([("k", "a", 0, 1.0), ("k", "b", 1, 2.0), ("k", "b", 0, 3.0), ("m", "a", 0, 4.0)],
                               "key string, source_file string, msg_no int, value double")
    assert {(r["key"], r["value"]) for r in align.last_wins(df, ["key"], ["source_file", "msg_no"]).collect()} == {("k", 2.0), ("m", 4.0)}
    assert {r["value"] for r in align.first_file_wins(df, ["key"]).collect()} == {1.0, 4.0}
    gone = align.superseded_messages(df, ["key"], ["source_file", "msg_no"])
    left = align.drop_listed(df, gone, ["source_file", "msg_no"])
    assert {r["value"] for r in left.collect()} == {2.0}  # ("a", 0) names two messages here


def test_head_and_tail(spark):
    axes = align.time_axes(series(spark, range(20), [0.0] * 20), ["var"])
    shown = summary.time_head_tail(axes).first()["shown"]
    assert [t.hour for t in shown] == [0, 1, 2, 3, 4, 5, 16, 17, 18, 19]


# ---- tiles ------------------------------------------------------------------------------------------------

@pytest.fixture
def messages(spark):
    rng = np.random.default_rng(7)
    grids = [rng.normal(0, 1, (9, 11)).astype("float32") for _ in range(3)]
    grids[1][4, 5] = np.nan
    rows = [(f"v{i}", "none", 11, 9, [float(y) for y in range(9)], [float(x) for x in range(11)], [float(v) for v in g.ravel()])
            for i, g in enumerate(grids)]
    return grids, spark.createDataFrame(rows, "var string, formula string, ni int, nj int, lats array<double>, lons array<double>, "
                                              "values array<float>")


@pytest.mark.parametrize("edge", [1, 4, 9, 256])
@pytest.mark.parametrize("as_bytes", [False, True])
def test_tiles_give_back_cells(messages, edge, as_bytes):
    grids, df = messages
    tiles = grid.tiles_from_messages(df, edge, packed=as_bytes)
    cells = grid.cells_from_tiles(tiles).toPandas()
    assert len(cells) == 3 * 99 and (cells.lat == cells.iy).all() and (cells.lon == cells.ix).all()
    for i, g in enumerate(grids):
        got = cells[cells["var"] == f"v{i}"].sort_values(["iy", "ix"]).value.to_numpy("float32").reshape(9, 11)
        np.testing.assert_array_equal(got, g)


def test_packing_keeps_missing(messages):
    _, df = messages
    tiles = grid.tiles_from_messages(df, 4)
    back = unpacked(packed(tiles))
    diff = summary.field_diff(tiles, back, ["var", "ty", "tx"]).first()
    assert (diff["max_abs_diff"], diff["n_one_sided"]) == (0.0, 0)
    assert summary.field_mean(back, ["var"]).filter("n_missing = 1").count() == 1


def test_coarsening_inside_tiles(messages):
    grids, df = messages
    tiles = summary.coarsen_tiles(grid.tiles_from_messages(df, 4), 2, edge=4)
    assert "Exchange" not in tiles._jdf.queryExecution().executedPlan().toString()
    cells = grid.cells_from_tiles(tiles).toPandas()
    for i, g in enumerate(grids):
        got = cells[cells["var"] == f"v{i}"].sort_values(["iy", "ix"]).value.to_numpy("float32").reshape(4, 5)
        blocks = g[:8, :10].reshape(4, 2, 5, 2).transpose(0, 2, 1, 3).reshape(4, 5, 4)
        np.testing.assert_allclose(got, np.nanmean(blocks, axis=2), rtol=1e-5, atol=1e-6)


def many_messages(n):
    """An Arrow batch of ``n`` messages of 8 x 8 points, with one value missing in each."""
    values = np.random.default_rng(5).normal(size=(n, 64)).astype("float32")
    values[np.arange(n), np.arange(n) % 64] = np.nan
    axis = [float(x) for x in range(8)]
    return values, pa.RecordBatch.from_pydict({
        "var": pa.array([f"v{i}" for i in range(n)]), "ni": pa.array([8] * n, pa.int32()), "nj": pa.array([8] * n, pa.int32()),
        "lats": pa.array([axis] * n), "lons": pa.array([axis] * n), "values": pa.array(values.tolist(), pa.list_(pa.float32()))})


def test_a_batch_of_messages_is_split_in_bounded_batches():
    values, batch = many_messages(3000)
    made = list(grid._split_batch(batch, ["var"], 4, {}, packed=True))
    assert max(b.num_rows for b in made) <= kernels.MOST_TILES
    got = pa.Table.from_batches(made)
    assert got.column("var").to_pylist() == [f"v{i}" for i in range(3000) for _ in range(4)]
    tiles = np.array([np.frombuffer(v, "<f4") for v in got.column("values").to_pylist()]).reshape(3000, 2, 2, 4, 4)
    np.testing.assert_array_equal(tiles, values.reshape(3000, 2, 4, 2, 4).transpose(0, 1, 3, 2, 4))


def test_coarsening_many_small_tiles_takes_one_pass(spark):
    values, _ = many_messages(2500)
    df = spark.createDataFrame([(f"v{i}", 8, 8, list(map(float, range(8))), list(map(float, range(8))), [None if np.isnan(x) else float(x) for x in v])
                                for i, v in enumerate(values)], "var string, ni int, nj int, lats array<double>, lons array<double>, values array<float>").coalesce(1)
    tiles = grid.tiles_from_messages(df, 4)
    plan = summary.coarsen_tiles(tiles, 2, edge=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2  # the split and the coarsening, each a Python worker a task
    for k in (2, 3):
        cells = grid.cells_from_tiles(summary.coarsen_tiles(tiles, k, edge=4)).collect()
        m = 8 // k
        blocks = values.reshape(-1, 8, 8)[:, :m * k, :m * k].reshape(-1, m, k, m, k).astype("float64")
        expected = np.nanmean(blocks, axis=(2, 4))
        assert len(cells) == expected.size
        got = np.full(expected.shape, np.nan)
        for c in cells:
            got[int(c["var"][1:]), c["iy"], c["ix"]] = c["value"]
        np.testing.assert_allclose(got, expected, rtol=1e-5, atol=1e-6)


def test_statistics_of_a_large_batch(monkeypatch):
    values, batch = many_messages(2500)
    sizes = []
    each = kernels._each
    monkeypatch.setattr(kernels, "_each", lambda a: sizes.append(len(a)) or each(a))
    captured = {}
    monkeypatch.setattr(kernels.F, "arrow_udf", lambda fn, *a: captured.setdefault("fn", fn) and (lambda *c: None))
    kernels.tile_stats(None)
    got = captured["fn"](kernels.to_bytes(batch.column("values")))
    assert max(sizes) <= kernels.MOST_TILES and len(got) == 2500
    np.testing.assert_allclose(got.field("v_sum").to_numpy(), np.nansum(values.astype("float64"), axis=1))
    assert got.field("n_present").to_pylist() == [63] * 2500


# ---- rules ------------------------------------------------------------------------------------------------

def test_shipped_rules(spark):
    tables = RULES.tables(spark)
    assert {n: t.count() for n, t in tables.items()} == {
        "field_map": 100, "level_map": 6, "skip_rules": 33, "derived_rules": 8, "accum_rules": 32, "group_rules": 7}


def test_rules_from_files(spark, tmp_path):
    (tmp_path / "fa.json").write_text(json.dumps({
        "fields": {"ABC": {"shortname": "abc", "formula": "k2c"}}, "levels": {"P": {"type": "isobaric", "factor": 0.01}},
        "accumulations": {"abc": ["RR6h", "none"]},
        "derived_fields": {"x": {"unit": "m", "recipe": {"type": "vector_magnitude", "sources": ["a", "b"]}}}}))
    (tmp_path / "groups.json").write_text("{ broken")
    rules = load_rules(spark, str(tmp_path))
    assert rules.fa_fields[0].long_name == "abc" and rules.fa_fields[0].units == "unknown"
    assert rules.accumulation_hours == [6] and rules.groups == () and rules.grib_fields == ()
    assert rules.derived[0] == DerivedRule("x", "vector_magnitude", ("a", "b"), None, "m", None)


def test_numeric_keys_only_if_given(spark):
    df = spark.createDataFrame([("10u", 2, 0, 2, 2, "surface", 0)], "field_id string, edition int, discipline int, category int, "
                               "number int, level_type_raw string, level_raw int")
    assert resolve.resolve_grib(df, RULES).first()["var"] == "10u"
    keyed = RULES.with_(grib2_keys={"0.2.2": "u"})
    assert resolve.resolve_grib(df, keyed).first()["var"] == "u"
