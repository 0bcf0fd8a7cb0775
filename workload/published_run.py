"""A run of the published size class, made by Spark from the ``embeddings`` table.

350 x 350 points, 40 fields; one message per embedding, so sf0.1 (2,000 rows) gives 50 hourly steps and 245 million
cells. The 64 numbers of an embedding are repeated over the grid.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.rules import literal

SIDE = 350
CODES = (
    ["CLSTEMPERATURE", "CLSVENT.ZONAL", "CLSVENT.MERIDIEN", "CLSU.RAF.MOD.XFU", "CLSV.RAF.MOD.XFU", "CLSHUMI.RELATIVE",
     "CLSHUMI.SPECIFIQ", "MSLPRESSURE", "SURFPRESSION", "SURFCAPE.POS.F00", "SURFACCPLUIE", "SURFACCNEIGE",
     "SURFPREC.EAU.CON", "SURFPREC.EAU.GEC", "SURFNEBUL.TOTALE", "SURFNEBUL.BASSE"]
    + [f"P{hpa * 100:05d}{name}" for hpa in (300, 500, 700, 850, 925)
       for name in ("TEMPERATURE", "HUMI_RELATIV", "GEOPOTENTIEL", "VENT_ZONAL")]
    + [f"V00{pvu}0{name}" for pvu in (15, 20) for name in ("TEMPERATURE", "VENT_ZONAL")])
RUNNING_TOTALS = ["SURFACCPLUIE", "SURFACCNEIGE", "SURFPREC.EAU.CON", "SURFPREC.EAU.GEC"]


def messages(spark: SparkSession, sf_dir: str, side: int = SIDE) -> DataFrame:
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    n, cells = len(CODES), side * side
    step = F.floor(F.col("vec_id") / n).cast("int")
    code = F.get(literal(CODES, "array<string>"), (F.col("vec_id") % n).cast("int"))
    whole = F.slice(F.flatten(F.array_repeat("embedding", cells // 64 + 1)), 1, cells)
    total = F.transform(whole, lambda x: F.abs(x) + F.col("step").cast("float"))
    axis = lambda start: F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda i: F.lit(start) + i * 0.05)
    return emb.select("vec_id", "embedding", step.alias("step"), code.alias("field_id")).select(
        F.format_string("/run/FULLPOS_2026081900_%04d", "step").alias("source_file"),
        (F.col("vec_id") % n).cast("int").alias("msg_no"), F.lit("fa").alias("fmt"), F.lit(1).alias("edition"),
        "field_id", *[F.lit(None).cast("int").alias(c) for c in ("discipline", "category", "number",
                                                                 "indicator_of_parameter")],
        F.lit(None).cast("string").alias("level_type_raw"), F.lit(None).cast("int").alias("level_raw"),
        F.lit(20260819).alias("data_date"), F.lit(0).alias("data_time"), F.lit("0").alias("step_range"),
        F.lit(side).alias("ni"), F.lit(side).alias("nj"), F.lit(cells).alias("n_values"),
        axis(30.0).alias("lats"), axis(0.0).alias("lons"),
        F.when(F.col("field_id").isin(*RUNNING_TOTALS), total).otherwise(whole).alias("values"))


@F.pandas_udf(T.BinaryType())
def _packed(values: pd.Series, step: pd.Series) -> pd.Series:
    """Packed float32; each point gets its own last digits, so that the data does not compress to nothing."""
    def one(v: np.ndarray, s: int) -> bytes:
        digits = (np.arange(len(v), dtype="uint32") * np.uint32(2654435761) + np.uint32(s * 40503)) >> np.uint32(22)
        return (v + digits * np.float32(1e-4)).astype("<f4").tobytes()

    return pd.Series([one(v, s) for v, s in zip(values, step)])


def write(spark: SparkSession, sf_dir: str, path: str, side: int = SIDE, packed: bool = True) -> int:
    """Write the run, evenly over files as a parallel decoder would; returns the number of cells."""
    made = messages(spark, sf_dir, side)
    if packed:
        made = made.withColumn("values", _packed("values", "msg_no"))
    made.repartition(32).write.parquet(path)
    return spark.read.parquet(path).count() * side * side
