"""Suffix-array deduplication: bytes covered by a string of ``length`` bytes that also starts earlier are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, release, runs, smallest, written

#: Length of an anchor, bytes of pieces that are sorted at once, and bytes of a text that are hashed at once.
ANCHOR, SHARD, SLICE = 32, 4_000_000, 1 << 26
#: Different characters up to which a bucket is dealt out as a whole; a string of more is dealt out suffix by suffix.
BUCKETS = 2_000
ODD = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def byte_codes() -> np.ndarray:
    return np.random.default_rng(17).integers(1, 2**63, 256, dtype=np.uint64)


def power(k: int) -> np.uint64:
    return np.uint64(pow(ODD, k, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


class Hashes:
    """Hashes of the strings of a byte array, put together from those whose sizes are powers of two."""

    def __init__(self, data: np.ndarray, longest: int):
        self.powers, width = {1: byte_codes()[data]}, 1
        while 2 * width <= min(longest, len(data)):
            have = self.powers[width]
            self.powers[2 * width] = have[:-width] * power(width) + have[width:]
            width *= 2

    def grams(self, size: int) -> np.ndarray:
        """Of all strings of ``size`` bytes."""
        out, at = None, 0
        n = len(self.powers[1]) - size + 1
        for width in sorted((w for w in self.powers if size & w), reverse=True):
            part = self.powers[width][at:at + n]
            out = part if out is None else out * power(width) + part
            at += width
        return mixed(out)

    def of(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of the strings at ``starts`` with ``sizes``."""
        out, at = np.zeros(len(starts), np.uint64), starts.copy()
        for width in sorted(self.powers, reverse=True):
            has = np.nonzero(sizes & width)[0]
            out[has] = out[has] * power(width) + self.powers[width][at[has]]
            at[has] += width
        return mixed(out + sizes.astype(np.uint64))


def anchors(data: np.ndarray, ends: np.ndarray, length: int, size: int) -> tuple[np.ndarray, ...]:
    """Anchors of concatenated texts: hash, first start and number of the strings of ``length`` bytes that have it, hash of the piece.

    The anchor of a string is its ``size``-gram of least hash, the leftmost of equals. Equal strings have equal anchors at equal
    places, so whatever repeats meets at its anchor. The piece of an anchor spans its strings. ``ends`` are the ends of the
    texts; no string crosses one.
    """
    hashes = Hashes(data, 2 * length - size)
    grams = hashes.grams(size)
    marked = (grams & ~np.uint64((1 << 28) - 1)) | np.arange(len(grams), dtype=np.uint64)
    at = (smallest(marked, length - size + 1) & np.uint64((1 << 28) - 1)).astype(np.int64)
    inside = np.ones(len(at), bool)
    for back in range(1, length):
        spot = ends - back
        inside[spot[(spot >= 0) & (spot < len(at))]] = False
    starts = np.nonzero(inside)[0]
    at = at[starts]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.nonzero(new)[0]
    count = np.diff(np.append(first, len(at)))
    return grams[at[first]].astype(np.int64), starts[first], count, hashes.of(starts[first], count + length - 1).astype(np.int64)


def found_anchors(docs: DataFrame, length: int, size: int) -> DataFrame:
    """``h, p, doc, sub, start, n``: the anchors of ``docs(doc, sub, text)``.

    Short texts are hashed together, a long one in slices that overlap, so that every string lies in one slice whole. A piece that a slice cuts
    becomes two with one anchor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, subs, texts = (batch.column(c) for c in ("doc", "sub", "text"))
            raw, row, offset = [], [], []
            for i, text in enumerate(texts.to_pylist()):
                whole = text.encode("utf-8")
                for start in range(0, max(1, len(whole) - length + 1), SLICE):
                    raw.append(whole[start:start + SLICE + length - 1])
                    row.append(i)
                    offset.append(start)
            row, offset = np.array(row, np.int64), np.array(offset, np.int64)
            at = 0
            while at < len(raw):
                end, total = at, 0
                while end < len(raw) and (end == at or total + len(raw[end]) <= 1_000_000):
                    total += len(raw[end])
                    end += 1
                if total >= length:
                    ends = np.cumsum([len(x) for x in raw[at:end]])
                    h, starts, n, p = anchors(np.frombuffer(b"".join(raw[at:end]), np.uint8), ends, length, size)
                    of = np.searchsorted(ends, starts, "right")
                    rows = pa.array(row[of + at])
                    begins = np.concatenate([[0], ends[:-1]])[of] - offset[of + at]
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(p), docs_.take(rows), subs.take(rows), pa.array((starts - begins).astype(np.int32)),
                                                      pa.array(n.astype(np.int32))], names=["h", "p", "doc", "sub", "start", "n"])
                at = end

    return docs.mapInArrow(run, "h long, p long, doc long, sub int, start int, n int")


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of small integers that end with a unique least one, by induced sorting.

    Buckets are filled one after the other. All suffixes that a bucket induces are dealt out at once, in order, or one by one where
    buckets are many and small. The sorted leftmost-smaller substrings get names; the string of names is sorted by the same function, until all
    names differ. Each level has at most half the length of the one before, and its work is linear in it.
    """
    n, sigma = len(s), int(s.max()) + 1
    if n == 1:
        return np.zeros(1, np.int64)
    if sigma <= 1 << 16:
        s = s.astype(np.uint16)  # short integers are sorted by counting
    change = np.nonzero(s[:-1] != s[1:])[0]
    following = change[np.searchsorted(change, np.arange(n - 1))]  # where the run of equals around a place ends
    smaller = np.append(s[following] < s[following + 1], True)
    left = np.zeros(n, bool)
    left[1:] = smaller[1:] & ~smaller[:-1]
    lms = np.nonzero(left)[0]
    sizes = np.bincount(s, minlength=sigma)
    tails = np.cumsum(sizes)
    heads = tails - sizes

    def induced(order: np.ndarray) -> np.ndarray:
        """All suffixes, from leftmost-smaller ones in the given order."""
        table = np.full(n, -1, np.int64)
        by_char = order[np.argsort(s[order], kind="stable")]
        firsts = np.bincount(s[order], minlength=sigma)
        begin = tails - firsts
        table[np.repeat(begin, firsts) + np.arange(len(order)) - np.repeat(np.cumsum(firsts) - firsts, firsts)] = by_char
        fill = heads.copy()

        def deal(sources: np.ndarray, upward: bool) -> None:
            before = sources[sources > 0] - 1
            before = before[smaller[before] != upward]
            if not len(before):
                return
            chars = s[before]
            sort = np.argsort(chars, kind="stable")
            counts = np.bincount(chars, minlength=sigma)
            rank = np.arange(len(before)) - np.repeat(np.cumsum(counts) - counts, counts)
            place = np.repeat(fill, counts)
            table[place + rank if upward else place - 1 - rank] = before[sort]
            fill[:] += counts if upward else -counts

        for c in range(sigma):
            done = heads[c]
            while done < fill[c]:
                done, todo = fill[c], table[done:fill[c]]
                deal(todo.copy(), True)
            deal(table[begin[c]:tails[c]].copy(), True)
        larger = fill.copy()  # ends of the larger-type suffixes of each bucket
        fill = tails.copy()
        for c in range(sigma - 1, -1, -1):
            done = tails[c]
            while done > fill[c]:
                done, todo = fill[c], table[fill[c]:done][::-1]
                deal(todo.copy(), False)
            deal(table[heads[c]:larger[c]][::-1].copy(), False)
        table[0] = n - 1
        return table

    def one_by_one(order: np.ndarray) -> np.ndarray:
        """The same without a step per bucket."""
        chars, upward, table = s.tolist(), smaller.tolist(), [-1] * n
        fill = tails.tolist()
        for j in reversed(order.tolist()):
            fill[chars[j]] -= 1
            table[fill[chars[j]]] = j
        fill = heads.tolist()
        for i in range(n):
            j = table[i] - 1
            if j >= 0 and not upward[j]:
                c = chars[j]
                table[fill[c]] = j
                fill[c] += 1
        fill = tails.tolist()
        for i in range(n - 1, -1, -1):
            j = table[i] - 1
            if j >= 0 and upward[j]:
                c = chars[j]
                fill[c] -= 1
                table[fill[c]] = j
        return np.array(table, np.int64)

    if sigma > BUCKETS:
        induced = one_by_one
    if len(lms) <= 1:
        return induced(lms)
    table = induced(lms)
    ordered = table[left[table]]
    ends = np.append(lms[1:], n - 1)
    length = np.zeros(n, np.int64)
    length[lms] = ends - lms + 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    active, depth = np.nonzero(same)[0], 0
    while len(active):
        differ = s[a[active] + depth] != s[b[active] + depth]
        same[active[differ]] = False
        active = active[~differ]
        depth += 1
        active = active[length[a[active]] > depth]
    names = np.zeros(n, np.int64)
    names[ordered] = np.concatenate([[0], np.cumsum(~same)])
    reduced = names[lms]
    if int(reduced.max()) + 1 == len(reduced):
        rank = np.argsort(reduced)
    else:
        rank = suffix_array(reduced)
    return induced(lms[rank])


def common_prefixes(s: np.ndarray, table: np.ndarray, limit: int) -> np.ndarray:
    """By place in the text: the common prefix with the suffix before it in the array, exact up to ``limit``.

    Only places whose preceding characters differ are compared; at all others the prefix is one shorter than at the place before.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[table[1:]] = table[:-1]
    fresh = np.ones(n, bool)
    fresh[1:] = (before[1:] <= 0) | (s[:-1] != s[before[1:] - 1])
    places = np.nonzero(fresh)[0]
    prefix = np.zeros(len(places), np.int64)
    active = np.nonzero(before[places] >= 0)[0]
    depth = 0
    while len(active):  # common prefixes end at the last character, which is unique
        x, y = places[active] + depth, before[places[active]] + depth
        active = active[s[x] == s[y]]
        depth += 1
        prefix[active] = depth
    at = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    full = np.zeros(n, np.int64)
    full[places] = prefix
    return np.minimum(full[at] - (np.arange(n) - at), limit)


def repeated_in(pieces: list[bytes], keys: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Strings of ``length`` bytes of the pieces that another piece has at a smaller key: piece, first and last start.

    ``keys`` orders the first starts of the pieces; the key of a later start is as much larger as it is further on.
    """
    sizes = np.array([len(p) for p in pieces])
    stop = np.cumsum(sizes + 1) - 1
    begin = stop - sizes
    s = np.ones(int(stop[-1]) + 2, np.uint16)
    s[-1] = 0
    body = np.ones(len(s), bool)
    body[stop] = body[-1] = False
    s[body] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 2
    table = suffix_array(s)
    prefix = common_prefixes(s, table, length)
    of = np.repeat(np.arange(len(pieces)), sizes + 1)
    of = np.append(of, len(pieces) - 1)
    place = np.arange(len(s))
    whole = place + length <= stop[of]
    whole[-1] = False
    starts = table[whole[table]]
    equal = prefix[starts] >= length
    group = np.nonzero(~equal)[0]
    if len(group) == len(starts):
        return []
    key = keys[of[starts]] + starts - begin[of[starts]]
    least = np.repeat(np.minimum.reduceat(key, group), np.diff(np.append(group, len(starts))))
    late = np.sort(starts[key > least])
    if not len(late):
        return []
    new = np.ones(len(late), bool)
    new[1:] = (late[1:] != late[:-1] + 1) | (of[late[1:]] != of[late[:-1]])
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(late)) - 1
    piece = of[late[first]]
    return list(zip(piece.tolist(), (late[first] - begin[piece]).tolist(), (late[last] - begin[piece]).tolist(), strict=True))


def remove_repeats(documents: DataFrame, length: int = 100, size: int = ANCHOR, shard: int = SHARD, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; ``with_text`` adds ``spans`` and ``kept`` (binary).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of smaller id, or earlier in
    the same one. Steps:

    1. Anchors: every such string has one, and equal strings have equal ones. Anchors that occur once are dropped.
    2. Pieces: the strings of an anchor overlap and form a piece. Of pieces that are equal, all but the first are repeats.
    3. Suffix arrays: first pieces that share an anchor with a different piece are sorted, group after group in shards of about
       ``shard`` bytes, and strings whose common prefix with their neighbour is long enough are repeats but for the first.
    4. The spans of each document are merged and cut out.

    Counts and first places are pre-aggregated before they are shuffled, and joins back to them have a unique side, so a passage in a
    third of all documents is split like any skewed join key. Texts are shuffled twice, never grouped with each other.

    Pieces count as equal if 128 bits of hash agree; of n pieces two different ones do so with a chance below n * n / 2 ** 128. A task holds some 64 bytes
    for a byte of the longest text, up to a slice of 64 MB, and of a shard. A text of 2 GB or more fits no row of Spark.

    A null text is empty; a null id comes before all others. Rows that share id and text are one document and get the same result; texts that
    share an id otherwise come in the order of a hash. An empty table gives no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.expr("cast(xxhash64(text) & 2147483647 as int)").alias("sub"), "text")
    long_enough = docs.where(F.octet_length("text") >= length).select("doc", "sub", "text")
    marks = found_anchors(long_enough, length, size)
    common = marks.select("h").groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    seen = written(marks.join(common, "h"))
    release(spark)
    firsts = written(seen.groupBy("h", "p").agg(F.min(F.struct("doc", "sub", "start", "n")).alias("first"), F.count("*").alias("c")))
    release(spark)
    later = written(seen.join(firsts.where("c > 1").select("h", "p", "first"), ["h", "p"]).where(
        F.struct("doc", "sub", "start") > F.struct("first.doc", "first.sub", "first.start")).select("doc", "sub", F.col("start").alias("a"), F.expr("start + n - 1").alias("b")))
    discard(seen)
    release(spark)
    several = firsts.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    wanted = firsts.join(several, "h").select("h", "first.*").groupBy("doc", "sub").agg(F.collect_list(F.struct("h", "start", "n")).alias("w"))
    lines = long_enough.join(wanted, ["doc", "sub"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w["h"], doc, sub, w["start"], raw[w["start"]:w["start"] + w["n"] + length - 1])
                    for doc, sub, text, wants in zip(*(batch.column(c).to_pylist() for c in ("doc", "sub", "text", "w")), strict=True)
                    for raw in [text.encode("utf-8")] for w in wants]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["h", "doc", "sub", "start", "piece"])

    pieces = lines.mapInArrow(cut, "h long, doc long, sub int, start int, piece binary")
    dealt = pieces.repartition("h").sortWithinPartitions("h", "doc", "sub", "start")

    def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        total = 0
        for group in runs(batches, ["h"]):
            if group.num_rows > 1:
                held.append(group)
                total += group.num_rows * (length + 34)
            if total >= shard:
                yield sorted_shard(held)
                held, total = [], 0
        if held:
            yield sorted_shard(held)

    def sorted_shard(groups: list[pa.Table]) -> pa.RecordBatch:
        data = pa.concat_tables(groups).combine_chunks()
        doc, sub, start = (data.column(c).to_numpy() for c in ("doc", "sub", "start"))
        order = np.lexsort((sub, doc))
        change = np.append(False, (doc[order][1:] != doc[order][:-1]) | (sub[order][1:] != sub[order][:-1]))
        rank = np.empty(len(doc), np.int64)
        rank[order] = np.cumsum(change)
        found = repeated_in(data.column("piece").to_pylist(), (rank << 36) + start, length)
        piece, a, b = (np.array(c, np.int64) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        return pa.RecordBatch.from_arrays([pa.array(doc[piece]), pa.array(sub[piece]), pa.array((start[piece] + a).astype(np.int32)),
                                           pa.array((start[piece] + b).astype(np.int32))], names=["doc", "sub", "a", "b"])

    repeats = written(dealt.mapInArrow(sort_shards, "doc long, sub int, a int, b int"))
    discard(firsts)
    release(spark)
    spans = repeats.unionByName(later).groupBy("doc", "sub").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("r"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, repeated in zip(batch.column("text").to_pylist(), batch.column("r").to_pylist(), strict=True):
                raw = text.encode("utf-8")
                merged: list[list[int]] = []
                for r in repeated or ():
                    a, b = r["a"], r["b"] + length
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                edges = [0, *[x for m in merged for x in m], len(raw)]
                kept = b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True))
                row = (len(raw), len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest())
                rows.append((*row, merged, kept) if with_text else row)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()][:6 if with_text else 4]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["spans", "kept"] * with_text
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", spans array<array<long>>, kept binary" * with_text
    return docs.join(spans, ["doc", "sub"], "left").select("doc_id", "text", "r").mapInArrow(finish, schema)
