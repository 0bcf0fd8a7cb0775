"""Line deduplication by a deletion-neighbourhood join: a line goes if it, or a line one edit away, stands earlier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, release, settle, written

#: Shorter lines (in characters) are neither removed nor compared.
LEAST = 20
#: Variants that a task holds at most, in numbers of some 60 bytes with their copy for Spark.
VARIANTS = 1 << 16


def line_rows(docs: DataFrame, least: int, with_keys: bool) -> DataFrame:
    """``doc, sub, no, h1, h2`` of the lines of ``docs(doc, sub, text)`` with at least ``least`` characters, and ``halves``: their keys by halves."""
    lines = docs.select("doc", "sub", F.posexplode(F.split("text", "\n", -1)).alias("no", "line")).withColumn("n", F.char_length("line"))
    lines = lines.where(F.col("n") >= least).withColumn("q", quarter())
    made = ["doc", "sub", "no", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(7)).alias("h2")]
    return lines.select(*made, half_keys().alias("halves")) if with_keys else lines.select(*made)


def quarter() -> F.Column:
    """A quarter of a line of n characters: its length in steps of eight. At a step a line that is one shorter has the quarter below, so both count."""
    return (F.floor(F.col("n") / 8) * 2).cast("int")


def half_keys() -> F.Column:
    """Keys of the halves of a line: it agrees with a line one edit away in the first or in the last 2 * q characters."""
    parts = ("substring(line, 1, 2 * ({q}))", "substring(line, -2 * ({q}), 2 * ({q}))")
    made = [f"xxhash64({part.format(q=q)}, {side}, {q})" for q in ("q", "q - 2") for side, part in enumerate(parts)]
    return F.expr(f"if(n % 8 = 0, array({', '.join(made)}), array({', '.join(made[:2])}))")


def keyed_lines(lines: DataFrame) -> DataFrame:
    """``h1, side, q, key`` of ``lines(line, h1)``: keys of the parts that a line shares with a line one edit away.

    Both agree before and behind the edit, so with quarters of q characters they agree in three of four quarters: in front, behind, or on
    both sides. Half of a line's hash is enough here, since two lines that share it only share candidates. There is a row for each q before the keys
    are made: with all keys of both in one expression the method Spark generates is longer than the JVM compiles.
    """
    q = quarter()
    lines = lines.withColumn("n", F.char_length("line")).select(
        "h1", "line", F.explode(F.when(F.col("n") % 8 == 0, F.array(q, q - 2)).otherwise(F.array(q))).alias("q"))
    parts = ("substring(line, 1, 3 * q)", "substring(line, 1, 2 * q), substring(line, -q, q)", "substring(line, 1, q), substring(line, -2 * q, 2 * q)", "substring(line, -3 * q, 3 * q)")
    keys = F.array(*[F.expr(f"xxhash64({part}, {side}, q)") for side, part in enumerate(parts)])
    return lines.select("h1", "q", F.posexplode(keys).alias("side", "key"))


def shared(keyed: DataFrame) -> DataFrame:
    """The rows of ``keyed(h1, key)`` whose key another line has as well."""
    keys = keyed.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo < hi").select("key")
    return keyed.join(keys, "key")


def line_variants(line: str, sides: list[dict], codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``key, at`` of the variants of a line, in parts of at most ``VARIANTS``; a shared front of f and end of e characters leaves the places f to length - e."""
    odd = np.uint64(0x9E3779B97F4A7C15)
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(points)
    with np.errstate(over="ignore"):
        value = codes[points & 0xFFFF] + (points >> 16).astype(np.uint64)
        up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, odd)]))
        total = np.concatenate([[np.uint64(0)], np.cumsum(value * up[:n])])
    del points, value, up
    wanted = np.zeros(n, bool)
    for s in sides:
        wanted[(3 - s["side"]) * s["q"]:n - s["side"] * s["q"]] = True
    # Behind the gap each character moves one place to the front.
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    for start in range(0, n, VARIANTS):
        at = start + np.nonzero(wanted[start:start + VARIANTS])[0]
        if len(at):
            with np.errstate(over="ignore"):
                yield (total[at] + (total[n] - total[at + 1]) * inverse + np.uint64(n - 1)).astype(np.int64), at.astype(np.int32)
    with np.errstate(over="ignore"):
        yield (total[n:] + np.uint64(n)).astype(np.int64), np.array([-1], np.int32)


def variant_rows(lines: DataFrame) -> DataFrame:
    """``key, at, h1, h2``: hashes of each line without one character, where it may differ, and of the whole line (``at`` -1).

    ``lines(line, h1, h2, sides)``. A batch of some megabytes of text may have as many variants as characters, so they leave in batches of their own
    and never stand in memory together: at most 2 * ``VARIANTS``, and some 40 bytes a character of one line.
    """

    def packed(held: list[tuple]) -> pa.RecordBatch:
        counts = [len(at) for _, at, _, _ in held]
        columns = [np.concatenate([keys for keys, _, _, _ in held]), np.concatenate([at for _, at, _, _ in held]),
                   *(np.repeat(np.array([h[i] for h in held], np.int64), counts) for i in (2, 3))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "at", "h1", "h2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = np.random.default_rng(31).integers(1, 2**63, 1 << 16, dtype=np.uint64) | np.uint64(1)
        held: list[tuple] = []
        rows = 0
        for batch in batches:
            for line, h1, h2, sides in zip(*(batch.column(c).to_pylist() for c in ("line", "h1", "h2", "sides")), strict=True):
                for keys, at in line_variants(line, sides, codes):
                    held.append((keys, at, h1, h2))
                    rows += len(at)
                    if rows >= VARIANTS:
                        yield packed(held)
                        held, rows = [], 0
        if held:
            yield packed(held)

    return lines.select("line", "h1", "h2", "sides").mapInArrow(run, "key long, at int, h1 long, h2 long")


def dedup_lines(documents: DataFrame, least: int = LEAST, edits: int = 1) -> DataFrame:
    """``documents`` with the lines that stay in ``text``, and ``n_lines``, ``n_removed`` (any columns of these names are replaced).

    A line of at least ``least`` characters goes if the same line, or with ``edits`` 1 a line that differs by one inserted, deleted or
    replaced character, starts earlier: in a document of smaller id or further up in the same one. Shorter lines stay.

    1. Equal lines are one, known by 128 bits of hash, with its first place.
    2. Lines that share three quarters with a different line are candidates (a lossless filter); the others drop out. Most do by their halves,
       whose keys are stored, so that only lines that share a half are fetched and compared by quarters.
    3. Candidates emit the hashes of their variants without one character. Equal variants with the gap at one place are a
       replacement, a variant that equals a whole line is an insertion. Such a group holds no more lines than there are characters (times the
       length), so none is large, whatever the corpus.
    4. The earliest line of each group is verified by its edit distance.

    Counts and first places are pre-aggregated, and joins back have a unique side, so a line that a third of all documents
    hold is split like any skewed join key. A null text stays null and has no lines; null ids come first; rows that share id and text are
    one document; texts that share an id otherwise come in the order of a hash. An empty table stays empty; other columns are kept.
    """
    if edits not in (0, 1):
        raise ValueError("edits is 0 or 1")
    spark = documents.sparkSession
    place = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("sub")]
    docs = documents.where("text is not null").select(*place, "text")
    narrow = written(line_rows(docs, least, edits > 0))
    firsts = settle(narrow.groupBy("h1", "h2").agg(F.min(F.struct("doc", "sub", "no")).alias("first"), F.count("*").alias("c")))
    gone = None
    if edits:
        halves = shared(narrow.select("h1", F.explode("halves").alias("key"))).select("h1").distinct()
        wanted = written(halves.join(firsts, "h1").select("h1", "h2", "first.*"))
        release(spark)
        by_doc = wanted.groupBy("doc", "sub").agg(F.collect_list(F.struct("no", "h1", "h2")).alias("w"))
        found = docs.join(by_doc, ["doc", "sub"]).select(F.split("text", "\n", -1).alias("all"), "doc", "sub", F.explode("w").alias("w")).select(
            F.expr("all[w.no]").alias("line"), "w.h1", "w.h2", F.struct("doc", "sub", "w.no").alias("first"))
        fetched = written(found)
        release(spark)
        discard(wanted)
        # Written as well, so that its size is known before texts are joined with it, and the keys are gone.
        sides = written(shared(keyed_lines(fetched)).groupBy("h1").agg(F.collect_set(F.struct("side", "q")).alias("sides")))
        release(spark)
        candidates = settle(fetched.join(sides, "h1").dropDuplicates(["h1", "h2"]))
        release(spark)
        discard(fetched)
        discard(sides)
        variants = variant_rows(candidates).join(candidates.select("h1", "h2", "first"), ["h1", "h2"])
        by_key, by_place = Window.partitionBy("key"), Window.partitionBy("key", "at")
        whole = F.min(F.when(F.col("at") < 0, F.col("first"))).over(by_key)
        longer = F.min(F.when(F.col("at") >= 0, F.col("first"))).over(by_key)
        same = F.min("first").over(by_place)
        earlier = variants.withColumn("e", F.when(F.col("at") < 0, longer).otherwise(F.least(whole, same))).where("e < first")
        pairs = earlier.select("h1", "h2", "e").distinct()
        other = candidates.select(F.col("first").alias("e"), F.col("line").alias("other"))
        gone = settle(pairs.join(other, "e").join(candidates.select("h1", "h2", "line"), ["h1", "h2"])
                      .where(F.levenshtein("line", "other", 1).between(0, 1)).select("h1", "h2").distinct().withColumn("near", F.lit(True)))
    known = firsts.where("c > 1").withColumn("near", F.lit(False)) if gone is None else (
        firsts.join(gone, ["h1", "h2"], "left").withColumn("near", F.coalesce("near", F.lit(False))).where("near or c > 1"))
    dropped = narrow.join(known, ["h1", "h2"]).where(F.col("near") | (F.struct("doc", "sub", "no") != F.struct("first.doc", "first.sub", "first.no")))
    lists = settle(dropped.groupBy("doc", "sub").agg(F.collect_set("no").alias("gone")))
    release(spark)
    discard(narrow)
    # The row travels as one column, so that no name of the caller's meets one of these.
    columns = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), place[0], place[1])
    joined = rows.join(lists, ["doc", "sub"], "left")
    text = F.col("row.text")
    kept = F.expr("array_join(filter(split(row.text, '\\n', -1), (l, i) -> not array_contains(gone, i)), '\\n')")
    return joined.select(
        *[F.when(F.col("gone").isNull(), text).otherwise(kept).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns],
        F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
