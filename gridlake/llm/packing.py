"""Packing: token sequences of bounded length, filled by first-fit decreasing over a tournament tree of bin capacities."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_for, settle

#: Fixed value: the vocabulary's one added token, whose id follows those of the ranks. It is recognised inside a text.
END_OF_TEXT = "<|endoftext|>"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


@lru_cache(maxsize=2)
def tokenizer(ranks_file: str) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file; ids equal those of the JSON file with the same vocabulary."""
    with open(public_tokenizers.path(ranks_file), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})


def token_pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 1, with_ids: bool = False,
                 ranks_file: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """The token ids of every ``text``, then ``end_id``, cut into pieces of at most ``capacity`` tokens.

    Null and empty texts give the end id alone. The added token is one id where it stands in a text, as in the library. Only ``doc_id`` and
    ``text`` are read; other columns are ignored. ``with_ids`` adds the ids themselves (``ids``, array of int).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(ranks_file)
        for batch in batches:
            rows: list[tuple] = []
            arrays: list[np.ndarray] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*coder.encode(text or "", allowed_special="all"), end_id], dtype="<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece), len(ids)))
                    arrays.append(piece)
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
            if with_ids:
                columns.append(pa.array([a.astype("i4") for a in arrays], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=NAMES + ["ids"] * with_ids)

    schema = ", ".join(f"{name} long" for name in NAMES) + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


class Tournament:
    """Free room of bins in a complete binary tree whose inner nodes hold the larger room of their children.

    The leftmost bin with room for a piece is found from the root in as many steps as the tree is high.
    """

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [room] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Take ``length`` from the leftmost bin that has it: ``(bin, room before)``."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < length:
                at += 1
        before = room[at]
        room[at] = before - length
        leaf, at = at, at // 2
        while at:
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
            at //= 2
        return leaf - self.leaves, before


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length. As many bins as lengths always suffice."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = Tournament(len(lengths), capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i], before = tree.place(int(lengths[i]))
        offsets[i] = capacity - before
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 2048, per_group: int = 8192, seed: int = 7) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: no sequence holds more than ``capacity`` tokens.

    Pieces are dealt into groups of about ``per_group`` by a seeded hash of document and start, and each group is packed on its
    own, so work and memory of a task do not depend on the corpus; the padding lost to grouping is part of one sequence a
    group. Groups are dealt by row, so a document or source of any size spreads over all of them. Equal pieces are
    told apart by nothing but their place in the sort and are interchangeable. Other columns (``ids``) are carried along; ``_grp``,
    ``sequence_id`` and ``offset`` are refused.
    """
    taken = {"_grp", "sequence_id", "offset"} & set(pieces.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are made here")
    groups = groups_for(pieces.count(), per_group)
    keyed = pieces.withColumn("_grp", F.pmod(F.xxhash64("doc_id", "start", F.lit(seed)), F.lit(groups)))
    names = [*pieces.columns, "sequence_id", "offset"]

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending"), ("length", "ascending")])
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        key = group["_grp"][0].as_py()
        out = group.append_column("sequence_id", pa.array(bins + (key << 32))).append_column("offset", pa.array(offsets))
        return out.select(names)

    kinds = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return keyed.groupBy("_grp").applyInArrow(fill, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 1, per_group: int = 8192, seed: int = 7,
                   with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack ``docs``: one row per piece.

    Defined for null and empty texts (the end id alone), null and repeated doc_ids (each row is its own document), very long
    texts (cut into full sequences and a rest), an empty table (no rows) and extra columns (ignored).
    """
    pieces = settle(token_pieces(docs, capacity, end_id, with_ids))
    return pack(pieces, capacity, per_group, seed)
