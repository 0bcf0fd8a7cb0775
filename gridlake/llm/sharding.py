"""Sharding: proportional stratified interleaving, so that every shard has the mixture of the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups_for

#: Rows a window of one bucket holds on average.
PER_BUCKET = 20_000


def unit(hash_column):
    """A 64-bit hash as a number in [0, 1), from its upper 53 bits."""
    return F.shiftrightunsigned(hash_column, 11).cast("double") / F.lit(float(1 << 53))


def interleave(rows: DataFrame, shards: int, strata: str = "source", seed: int = 11, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard).

    Within each stratum rows are shuffled by a seeded hash and ranked; rank r of n gets the fraction ``(r - 1 + phase) / n``, where
    the phase is a seeded number of the stratum, so that many small strata do not meet at one fraction. Sorted by fraction,
    any run of rows holds each stratum in proportion up to one row. The sorted order is cut into shards whose counts
    differ by one at most.

    No window or sort holds more than a bucket of about ``per_bucket`` rows: ranks are counted inside buckets of the hash and positions inside
    buckets of the fraction, each after the total of the buckets before it. A stratum with a third of all rows has
    a third of the buckets. The bucket totals, one row per 20,000 rows, are all that is ranked beyond a bucket.

    A null stratum is a stratum. Repeated rows and doc_ids are dealt one by one; rows equal in every column are interchangeable. The law is one of
    rows: equal texts in different rows are dealt like any rows and may come into several shards. An empty table gives no rows. All columns are kept
    whatever their names; earlier ``shard`` and ``slot`` are replaced. Long texts travel with their row, so shard narrow rows and join back by key.
    """
    rows = rows.drop("shard", "slot")
    n = rows.count()
    buckets = groups_for(n, per_bucket)
    kept = [c for c, t in rows.dtypes if not t.startswith(("map", "variant"))]
    mixed = F.xxhash64(*[F.col(f"`{c}`") for c in kept], F.lit(seed))
    # A row travels as one column, so that no name of the caller's meets one of these.
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    keyed = rows.select(whole, mixed.alias("_h"), F.coalesce(F.col(f"`{strata}`").cast("string"), F.lit("\x00null")).alias("_s"))
    keyed = keyed.withColumn("_b", F.least(F.floor(unit(F.col("_h")) * buckets), F.lit(buckets - 1)).cast("int"))

    totals = keyed.groupBy("_s", "_b").agg(F.count("*").alias("_c"))
    by_stratum = Window.partitionBy("_s")
    starts = totals.select(
        "_s", "_b", (F.sum("_c").over(by_stratum.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")).alias("_before"),
        F.sum("_c").over(by_stratum).alias("_n"))
    order = [F.col("_h"), *[F.col(f"row.`{c}`") for c, t in rows.dtypes if not t.startswith(("map", "array", "struct", "variant"))]]
    ranked = keyed.withColumn("_r", F.row_number().over(Window.partitionBy("_s", "_b").orderBy(*order)))
    phase = unit(F.xxhash64(F.col("_s"), F.lit(seed + 1)))
    placed = ranked.join(starts, ["_s", "_b"]).withColumn(
        "_f", (F.col("_before") + F.col("_r") - 1 + phase) / F.col("_n"))
    placed = placed.withColumn("_g", F.least(F.floor(F.col("_f") * buckets), F.lit(buckets - 1)).cast("int"))

    inside = F.row_number().over(Window.partitionBy("_g").orderBy("_f", "_s", *order))
    first = placed.groupBy("_g").agg(F.count("*").alias("_c")).select(
        "_g", (F.sum("_c").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")).alias("_start"))
    numbered = placed.withColumn("_i", inside).join(first, "_g").withColumn("_pos", F.col("_start") + F.col("_i") - 1)
    numbered = numbered.withColumn("shard", F.expr(f"cast(_pos * {shards} div {max(n, 1)} as int)"))
    # First position of shard s is ceil(s * n / shards).
    return numbered.withColumn("slot", F.expr(f"_pos - (shard * {n}L + {shards - 1}) div {shards}")).select("row.*", "shard", "slot")
