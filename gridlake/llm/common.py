"""Helpers shared by the operators: table reading, lineage cuts, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes and rows of an Arrow batch: texts may hold hundreds of kilobytes each, and short ones give many rows out for one in.
BATCH_BYTES, BATCH_ROWS = "16m", "512"
#: Links that a task contracts in memory, some 200 bytes each.
CONTRACTED = 500_000


def text_batches(spark: SparkSession) -> SparkSession:
    """Set the Arrow batch size the text operators are laid out for; plans read it when they run, so it stays set."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, so that later steps neither recompute nor depend on lost executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint()


def folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only for a local master without that setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="gridlake-llm-")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table written below the checkpoint folder: compressed and columnar, for results with many rows."""
    path = f"{folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of ``written``. Only for one whose every use is settled or written itself."""
    spark = table.sparkSession
    for place in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose result is settled: it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def groups_for(rows: int, per_group: int) -> int:
    """Number of groups that hold about ``per_group`` rows each."""
    return max(1, -(-rows // per_group))


def smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, by doubling."""
    out, have = hashes, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def union(parent: dict, a, b) -> bool:
    """Join the trees of ``a`` and ``b`` under the smaller root; whether they were apart."""
    while parent.get(a, a) != a:
        a = parent[a]
    while parent.get(b, b) != b:
        b = parent[b]
    if a == b:
        return False
    parent[max(a, b)] = min(a, b)
    return True


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links ``a, b`` of a task as one link of every id to the smallest one it reaches by them."""
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            while (up := parent.get(a, a)) != a:
                parent[a] = a = parent.get(up, up)
            while (up := parent.get(b, b)) != b:
                parent[b] = b = parent.get(up, up)
            if a != b:
                parent[max(a, b)] = min(a, b)
    for a in sorted(parent):  # parents are smaller, so they are done before
        parent[a] = parent.get(parent[a], parent[a])
    yield pa.RecordBatch.from_arrays([pa.array(list(parent), pa.int64()), pa.array(list(parent.values()), pa.int64())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` of every id in ``links(a, b)``: the smallest id reachable.

    At first each task contracts the links it holds, at most about ``CONTRACTED``; if there are no more, that is all. Else rounds follow.
    Each round hangs every neighbour of an id below the smallest id around it, first the larger neighbours, then the
    smaller ones; both are a grouped minimum, pre-aggregated before its shuffle, and a join with that unique side, so
    the centre of a large star is split like any skewed join key. A round is checkpointed. It ends when all trees are stars.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct())
    tasks = groups_for(edges.count(), CONTRACTED)
    edges = settle(edges.coalesce(tasks).mapInArrow(contracted, "a long, b long"))
    if tasks == 1:
        return labelled(edges)
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = settle(small.unionByName(low.withColumnRenamed("low", "b")).where("a <> b").distinct())
        # Equal edge sets have equal sums; a sum of hashes that stays the same over a round ends the loop.
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            break
        mark = found
    return labelled(edges)


def labelled(stars: DataFrame) -> DataFrame:
    """``(id, component_id)`` of the ends of ``stars(a, b)``, whose centres ``b`` hang below nothing."""
    roots = stars.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(roots)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree in ``keys``, put together across batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        data = pa.Table.from_batches([batch])
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        starts = [0, *np.nonzero(change)[0].tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            here = tuple(batch.column(key)[start].as_py() for key in keys)
            if held and here != last:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(data.slice(start, end - start))
            last = here
    if held:
        yield pa.concat_tables(held).combine_chunks()
