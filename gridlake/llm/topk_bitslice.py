"""Exact top-k search by inner product on a bit-sliced index.

A block of rows is stored as one bitmap per dimension and bit of the quantised components. A query's scores come out of bitmap
arithmetic alone: the bitmaps of its digits are added by carry-save adders into the bitmaps of the score, and the best rows
are taken from the most significant of these downward. Rows that stay equal to the last bit are settled by their id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups_for

#: Rows of an index block, queries that meet a block in one task, the size from which a component fits no long, and the greatest long.
BLOCK, QUERIES, REACH, LONG = 16_384, 1_024, 1 << 62, (1 << 63) - 1
INDEX = "dims int, block int, n int, bits int, ids binary, low binary, slices binary"


def quantised(vectors: DataFrame, factor: int = 64) -> DataFrame:
    """``vec_id, q`` with q = floor(factor * x), for the vectors that take part.

    Left out are vectors that are null, empty or hold null or non-finite components or such of ``2**62 / factor`` and more in size, whose integer
    fits no long, and rows without id. An id that occurs several times counts once, with the smallest of its vectors. Other columns are not read.
    """
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("q", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= REACH))
    return (vectors.select(F.col("vec_id").cast("long"), F.transform(v, lambda x: x * factor).alias("q"))
            .where(F.col("vec_id").isNotNull() & (F.size("q") > 0) & ~bad)
            .groupBy("vec_id").agg(F.min("q").alias("q")).select("vec_id", F.transform("q", lambda x: F.floor(x)).alias("q")))


def build_index(rows: DataFrame, per_block: int = BLOCK) -> DataFrame:
    """One row per block of about ``per_block`` rows of ``rows(vec_id, q)``, dealt by a hash of the id."""
    blocks = groups_for(rows.count(), per_block)

    def slice_up(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        q = np.array(group["q"].combine_chunks().flatten().to_numpy()).reshape(group.num_rows, -1)
        low = q.min(axis=0)
        bits = max(1, int((q.max(axis=0) - low).max()).bit_length())
        above = (q - low).astype(np.uint64)
        width = -(-group.num_rows // 64) * 64
        slices = np.zeros((q.shape[1], bits, width // 8), np.uint8)
        for bit in range(bits):
            packed = np.packbits((above.T >> np.uint64(bit) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
            slices[:, bit, :packed.shape[1]] = packed
        return pa.table({
            "dims": pa.array([q.shape[1]], pa.int32()), "block": group["block"][:1].cast(pa.int32()), "n": pa.array([group.num_rows], pa.int32()),
            "bits": pa.array([bits], pa.int32()), "ids": pa.array([group["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
            "low": pa.array([low.astype("<i8").tobytes()], pa.binary()), "slices": pa.array([slices.tobytes()], pa.binary())})

    keyed = rows.select(F.size("q").alias("dims"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "q")
    return keyed.groupBy("dims", "block").applyInArrow(slice_up, INDEX)


def signed_digits(value: int) -> Iterator[tuple[int, int]]:
    """``(position, +1 or -1)`` of the fewest powers of two that add up to ``value``."""
    at = 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            yield at, digit
            value -= digit
        value >>= 1
        at += 1


class Block:
    """One block of the index."""

    def __init__(self, row: dict):
        self.n, self.bits, dims = row["n"], row["bits"], row["dims"]
        self.ids, self.low = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["low"], "<i8")
        plain = np.frombuffer(row["slices"], np.uint8).view("<u8").reshape(dims * self.bits, -1)
        self.bitmaps = np.concatenate([plain, ~plain])  # a slice is taken away by adding its complement
        self.turned = dims * self.bits
        self.all = np.zeros(plain.shape[1] * 8, np.uint8)
        filled = np.packbits(np.ones(self.n, np.uint8), bitorder="little")
        self.all[:len(filled)] = filled
        self.all = self.all.view("<u8")

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the scores, least significant first, and what is to be added to every score."""
        wanted: dict[int, list[int]] = {}
        constant = sum(a * b for a, b in zip(query.tolist(), self.low.tolist(), strict=True))
        for d, value in enumerate(query.tolist()):
            for at, digit in signed_digits(value):
                base = d * self.bits + (self.turned if digit < 0 else 0)
                if digit < 0:
                    constant -= ((1 << self.bits) - 1) << at
                for bit in range(self.bits):
                    wanted.setdefault(at + bit, []).append(base + bit)
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        at = 0
        last = max(wanted, default=-1)
        zero = np.zeros_like(self.all)[None]
        while at <= last or carried:
            parts = [self.bitmaps[wanted[at]]] if at in wanted else []
            rows = np.concatenate(parts + carried) if parts or carried else zero
            carried = []
            while len(rows) > 1:
                third = len(rows) // 3
                if third:
                    a, b, c = rows[:third], rows[third:2 * third], rows[2 * third:3 * third]
                    odd = a ^ b
                    carried.append((a & b) | (c & odd))
                    odd ^= c
                    rows = np.concatenate([odd, rows[3 * third:]]) if len(rows) > 3 * third else odd
                else:
                    carried.append(rows[:1] & rows[1:])
                    rows = rows[:1] ^ rows[1:]
            out.append(rows[0])
            at += 1
        return out, constant

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
        """Ids and scores of the ``k`` best rows without ``query_id``, from the most significant slice downward."""
        slices, constant = self.score_slices(query)
        maybe = self.all.copy()
        own = int(np.searchsorted(self.ids, query_id))
        if own < self.n and self.ids[own] == query_id:
            maybe[own >> 6] &= ~np.uint64(1 << (own & 63))
        sure = np.zeros_like(maybe)
        for bitmap in reversed(slices):
            upper = sure | (maybe & bitmap)
            found = int(np.bitwise_count(upper).sum())
            if found > k:
                maybe &= bitmap
            else:
                sure = upper
                maybe &= ~bitmap
                if found == k:
                    maybe[:] = 0
                    break
        taken = positions(sure)
        if len(taken) < k:  # what is left has equal scores; ids ascend with the position
            taken = np.concatenate([taken, positions(maybe)[:k - len(taken)]])
        scores = [constant] * len(taken)
        for at, bitmap in enumerate(slices):
            here = (bitmap[taken >> 6] >> (taken & 63).astype(np.uint64) & np.uint64(1)).tolist()
            scores = [s + (int(b) << at) for s, b in zip(scores, here, strict=True)]
        return self.ids[taken], scores


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.nonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))[0]


def top_k(index: DataFrame, queries: DataFrame, k: int = 20, per_task: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of the index for every row of ``queries(vec_id, q)``, without itself.

    Blocks of rows meet blocks of queries, each pair in a task of its own, which passes on ``k`` rows a query; ties go to the smaller id.
    Queries meet rows with as many dimensions only. No queries or an empty index give no rows. Rows of a block are ranked by their exact scores;
    a score that fits no long is given as the greatest or least long, and such scores of different blocks tie.
    """
    shares = groups_for(queries.count(), per_task)
    asked = queries.select(F.size("q").alias("dims"), F.pmod(F.xxhash64("vec_id"), F.lit(shares)).cast("int").alias("share"),
                           F.col("vec_id").alias("query_id"), "q")
    blocks = index.agg(F.max("block")).first()[0] or 0
    left = index.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks))))

    def answer(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[int, np.ndarray, list[int]]] = []
        if rows.num_rows:
            block = Block(rows.to_pylist()[0])
            out = [(i, *block.best(i, np.array(q, np.int64), k)) for i, q in zip(wanted["query_id"].to_pylist(), wanted["q"].to_pylist(), strict=True)]
        return pa.table({"query_id": pa.array([i for i, ids, _ in out for _ in ids], pa.int64()),
                         "vec_id": pa.array([x for _, ids, _ in out for x in ids.tolist()], pa.int64()),
                         "score": pa.array([max(-LONG, min(LONG, x)) for _, _, scores in out for x in scores], pa.int64())})

    key = ["dims", "block", "share"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(answer, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
