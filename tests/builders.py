"""Small message tables for tests, and the values they should lead to, by brute force."""

from __future__ import annotations

import numpy as np

from gridlake.sources.messages import MESSAGE_SCHEMA

NAMES = [part.split()[0] for part in MESSAGE_SCHEMA.split(", ")]


def message(**given):
    row = dict.fromkeys(NAMES)
    row.update(given)
    row["values"] = None if row["values"] is None else [float(x) for x in np.asarray(row["values"], "float32").ravel()]
    return tuple(row[n] for n in NAMES)


def frame(spark, rows):
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def fa_run(fields, steps, nj=5, ni=7, date=20260819, seed=3):
    """One file per step; ``fields`` maps a code to a function of (rng, step) giving a grid. Returns rows and truth."""
    rng = np.random.default_rng(seed)
    rows, truth = [], {}
    for step in steps:
        for no, (code, make) in enumerate(fields.items()):
            grid = np.asarray(make(rng, step), "float32").reshape(nj, ni)
            truth[code, step] = grid
            rows.append(message(
                source_file=f"/in/FULLPOS_{date}00_{step:04d}", msg_no=no, fmt="fa", field_id=code, data_date=date,
                data_time=0, step_range="0", ni=ni, nj=nj, lats=[30.0 + y for y in range(nj)],
                lons=[float(x) for x in range(ni)], values=grid))
    return rows, truth


def grib_run(fields, steps, nj=4, ni=6, date=20251022, seed=4):
    """``fields`` maps (short name, level type, level) to a grid function."""
    rng = np.random.default_rng(seed)
    rows, truth = [], {}
    for step in steps:
        for no, ((code, kind, level), make) in enumerate(fields.items()):
            grid = np.asarray(make(rng, step), "float32").reshape(nj, ni)
            truth[code, kind, level, step] = grid
            lats, lons = np.meshgrid(40.0 - np.arange(nj), np.arange(ni) * 0.5, indexing="ij")
            rows.append(message(
                source_file=f"/in/grib_{date}00_{step:04d}", msg_no=no, fmt="grib", edition=2, field_id=code,
                level_type_raw=kind, level_raw=level, data_date=date, data_time=0, step_range=f"0-{step}",
                discipline=0, category=0, number=0,
                ni=ni, nj=nj, lats=[float(x) for x in lats.ravel()], lons=[float(x) for x in lons.ravel()], values=grid))
    return rows, truth


def as_grid(cells, nj, ni):
    """Cells of one field and time as a 2-D array."""
    out = np.full((nj, ni), np.nan, "float32")
    for r in cells.collect():
        out[r["iy"], r["ix"]] = np.nan if r["value"] is None else r["value"]
    return out
