"""Periodic runs of words by Baier grouping.

The first phase of a suffix sorter that groups suffixes by their longest Lyndon prefix leaves the Lyndon array behind. It is taken
under an order of the words and under the reverse order; each Lyndon root is extended through common extensions to both sides into a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "struct<start:bigint, length:bigint, period:bigint>"


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, for numbers below ``len(ranks)``: phase one of Baier's sorter.

    Groups are taken from the greatest to the least. For each member of a group the nearest place in front that is in a lower group is looked
    up; that place's context grows by one copy of the group's context for each member that names it, and it moves to a new group right above
    its old one, above those with fewer copies. Contexts of taken groups no longer change and are the longest Lyndon prefixes.
    """
    n = len(ranks)
    members: list[list[int]] = [[] for _ in range(max(ranks, default=-1) + 1)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    group = list(ranks)
    length = [1] * len(members)
    below = list(range(-1, len(members) - 1))  # next lower group
    above = [*range(1, len(members)), -1]
    out = [0] * n
    # front[i + 1] is i + 1 while place i is in a group not yet taken, else a place further in front (0: none).
    front = list(range(n + 1))
    g = len(members) - 1
    while g >= 0:
        size = length[g]
        here = [i for i in members[g] if group[i] == g]
        members[g] = []
        for i in here:
            out[i] = size
            front[i + 1] = i
        named: dict[int, int] = {}
        for i in here:
            j = i
            while front[j] != j:
                front[j] = front[front[j]]
                j = front[j]
            if j:
                named[j - 1] = named.get(j - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, copies in named.items():
            moved.setdefault((copies, group[j]), []).append(j)
        for copies, old in sorted(moved, reverse=True):
            new = len(members)
            places = moved[copies, old]
            members.append(places)
            length.append(length[old] + copies * size)
            for j in places:
                group[j] = new
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
        g = below[g]
    return out


def _equal_ahead(w: np.ndarray, a: int, b: int) -> int:
    """Number of equal words from ``a < b`` on, compared in blocks that double."""
    found, step, n = 0, 16, len(w)
    while b + found < n:
        size = min(step, n - b - found)
        differ = np.nonzero(w[a + found:a + found + size] != w[b + found:b + found + size])[0]
        if len(differ):
            return found + int(differ[0])
        found += size
        step *= 2
    return found


def _equal_behind(w: np.ndarray, a: int, b: int) -> int:
    """The same to the front, from ``a - 1`` and ``b - 1`` on."""
    found, step = 0, 16
    while a > found:
        size = min(step, a - found)
        differ = np.nonzero(w[a - found - size:a - found] != w[b - found - size:b - found])[0]
        if len(differ):
            return found + size - 1 - int(differ[-1])
        found += size
        step *= 2
    return found


def runs_of(words: np.ndarray, least_length: int, least_exponent: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of at least ``least_length`` words and ``least_exponent`` (two or more) periods, in order.

    A run holds its Lyndon root, under one of the two orders, at one of its first q places and every q places from there, so the
    array shows q at each of at least ``least_exponent`` - 1 such places. Where it does not, nothing is extended. A place inside a run that is
    known for its period is not extended again, so all extensions together cost what the runs are long.
    """
    ranks = np.unique(words, return_inverse=True)[1]
    top, n = int(ranks.max(initial=-1)), len(ranks)
    found: set[tuple[int, int, int]] = set()
    for order in (ranks, top - ranks):
        roots = np.array(lyndon_lengths(order.tolist()), np.int64)
        place = np.arange(n)
        wanted = place + (least_exponent - 1) * roots <= n
        for k in range(1, least_exponent - 1):
            at = np.minimum(place + k * roots, n - 1)
            wanted &= roots[at] == roots
        ends: dict[int, int] = {}
        for i in np.nonzero(wanted)[0].tolist():
            q = int(roots[i])
            if i + q <= ends.get(q, 0):
                continue
            ahead = _equal_ahead(ranks, i, i + q)
            if ahead < q:
                continue
            start = i - _equal_behind(ranks, i, i + q)
            end = i + q + ahead
            ends[q] = end
            if end - start >= max(least_length, least_exponent * q):
                found.add((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _repeated(words: np.ndarray, least_length: int, least_exponent: int) -> list[tuple[int, int]]:
    """Stretches ``(start, end)`` that can hold a run: those of which every gram of ``w`` words occurs again within the document.

    In a run of L words and period q a gram of w words has an equal one q places on or before, for every gram, if L >= 2q + w - 1. With
    L >= max(least_length, least_exponent * q) the greatest w that holds for all q is below.
    """
    w = min(max(least_length, least_exponent * q) - 2 * q + 1 for q in range(1, least_length + 1))
    n = len(words)
    if n < least_length:
        return []
    with np.errstate(over="ignore"):
        key = np.zeros(n - w + 1, np.uint64)
        for k in range(w):
            key = (key ^ words[k:n - w + 1 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key) + 2, bool)
    again[1 + order[1:][same]] = True
    again[1 + order[:-1][same]] = True
    edges = np.nonzero(again[1:] != again[:-1])[0]
    return [(int(a), int(b) + w - 1) for a, b in zip(edges[::2], edges[1::2], strict=True) if b + w - 1 - a >= least_length]


def document_runs(words: np.ndarray, least_length: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    """Runs of one document. Stretches in which some gram occurs only once hold none and are left out before sorting; a run lies within one."""
    out = []
    for start, end in _repeated(words, least_length, least_exponent):
        out += [(start + s, length, q) for s, length, q in runs_of(words[start:end], least_length, least_exponent)]
    return out


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def collapse_runs(documents: DataFrame, least_length: int = 6, least_exponent: int = 4) -> DataFrame:
    """``documents`` with periodic runs of words reduced to their first period, and what was found.

    Words are separated by ASCII white space. A run is a stretch of words with smallest period q that no neighbour extends, of at least
    ``least_length`` words and ``least_exponent`` (three or more) periods. A word goes if a run contains it behind the run's first q words; the
    words that stay are joined by single spaces in ``text``.

    New columns (earlier ones of these names are replaced): ``n_words``, ``runs`` (array of ``struct<start, length, period>`` by start, then period)
    and ``best``, the run of the greatest length / period, compared exactly (ties: smallest start, then period), NULL without runs.
    NULL and empty texts have no words and become empty. Rows are worked on one by one without a shuffle, so repeated rows, ids and other columns
    stay as they are and an empty table stays empty. A task holds one batch of texts and some 150 bytes a word of the stretches
    that repeat; the longest text bounds it.
    """
    if least_exponent < 3 or least_length < 3:
        raise ValueError("runs of at least three words and three periods only")
    added = ["n_words", "runs", "best"]
    names = [c for c in documents.columns if c not in (*added, "text")]
    # Plain names on the way: a map over Arrow batches takes none with a dot.
    keep = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(k, documents.schema[c].dataType) for k, c in zip(keep, names, strict=True)]).add("text", "string") \
        .add("n_words", "long").add("runs", T.DataType.fromDDL(f"array<{RUN}>")).add("best", T.DataType.fromDDL(RUN))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def as_row(run: tuple[int, int, int]) -> dict:
        return {"start": run[0], "length": run[1], "period": run[2]}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, runs, best = [], [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                counts.append(len(words))
                number: dict[bytes, int] = {}
                found = document_runs(np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words)),
                                      least_length, least_exponent)
                if found:
                    words = [words[i] for i in np.nonzero(_kept(len(words), found))[0].tolist()]
                texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                runs.append([as_row(r) for r in found])
                strongest = found[:1]
                for r in found[1:]:
                    if r[1] * strongest[0][2] > strongest[0][1] * r[2]:
                        strongest = [r]
                best.append(as_row(strongest[0]) if strongest else None)
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(run_type)), pa.array(best, run_type)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", *added])

    plain = documents.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(keep, names, strict=True)], "text")
    return plain.mapInArrow(work, schema).toDF(*names, "text", *added)
