"""N-gram Jaccard join by prefixes and bitmaps: documents link if their sets of word n-grams overlap enough."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, discard, release, settle, union, written

#: Counters of the frequency sketch, sets compared in one group, and texts that are hashed together (bytes).
COUNTERS, PART, CHUNK = 1 << 20, 1000, 1_000_000
#: Prefixes are made for overlaps this many points of percent lower, so that linked sets share several n-grams of them.
SLACK = 5
#: Ids of documents up to which these are sent to all tasks to pick the texts of candidates, some 16 bytes each; beyond, texts are picked by shuffle.
SENT = 1_000_000
ODD = 0xD6E8FEB86659FD93


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.random.default_rng(29).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
    up, down = np.full(size, ODD, np.uint64), np.full(size, pow(ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return codes, np.multiply.accumulate(up), np.multiply.accumulate(down)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, one after the other, and the text of each.

    Words are runs of other bytes than ASCII white space, in ASCII lower case. A text with fewer words is one n-gram.
    """
    raw = [(t or "").encode("utf-8").lower() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    size = max(2 * CHUNK, 1 << (len(data) + 1).bit_length())
    codes, up, down = powers(size)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(space.astype(np.int8), prepend=1)
    starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    ends = ends[-len(starts):] if len(starts) else ends[:0]
    total = np.concatenate([[np.uint64(0)], np.cumsum(codes[data] * up[:len(data)])])
    word = scrambled((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    stops = np.cumsum([len(r) + 1 for r in raw])
    of = np.searchsorted(stops, starts, "right")
    out, n = np.zeros(len(word), np.uint64), len(word)
    counts = np.bincount(of, minlength=len(raw))
    left = np.cumsum(counts)[of] - np.arange(n)  # words from here to the end of the text
    for k in range(words):
        use = np.nonzero(left > k)[0]
        out[use] = out[use] * np.uint64(ODD) + word[use + k]
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    keep = (left >= words) | ((counts[of] < words) & (np.arange(n) == first[of]))
    return scrambled(out[keep] + np.uint64(words)), of[keep]


def batches_of(batch: pa.RecordBatch) -> Iterator[tuple[int, list]]:
    """Texts of a batch in chunks of bounded size, with the row of the first."""
    texts, at = batch.column("text").to_pylist(), 0
    while at < len(texts):
        end = total = 0
        end = at
        while end < len(texts) and (end == at or total + len(texts[end] or "") <= CHUNK // 2):
            total += len(texts[end] or "")
            end += 1
        yield at, texts[at:end]
        at = end


def frequency_levels(docs: DataFrame, words: int) -> np.ndarray:
    """Per counter a level of how many n-grams of all documents fall on it, relative to the mean.

    The table has a fixed size whatever the corpus. It only sets the global order of n-grams, frequent ones last.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, texts in batches_of(batch):
                hashes, _ = shingle_hashes(texts, words)
                counts += np.bincount((hashes >> np.uint64(44)).astype(np.int64), minlength=COUNTERS)
        yield packed(counts)

    def packed(counts: np.ndarray) -> pa.RecordBatch:
        kind = np.int64 if counts.max() >= 1 << 31 else np.int32
        return pa.RecordBatch.from_arrays([pa.array([zlib.compress(counts.astype(kind).tobytes(), 1)], pa.binary()), pa.array([kind is np.int64])], names=["c", "wide"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for blob, wide in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts += np.frombuffer(zlib.decompress(blob), np.int64 if wide else np.int32)
        yield packed(counts)

    parts = docs.select("text").mapInArrow(count, "c binary, wide boolean")
    counts = np.zeros(COUNTERS, np.int64)
    for row in parts.repartition(8).mapInArrow(added, "c binary, wide boolean").collect():
        counts += np.frombuffer(zlib.decompress(row[0]), np.int64 if row[1] else np.int32)
    return np.minimum(127, 8 * np.log2(1 + counts / max(1.0, counts.mean()))).astype(np.uint8)


def ordered_sets(texts: list, words: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of all texts, each in the global order (level, hash), and where each ends."""
    hashes, of = shingle_hashes(texts, words)
    key = (levels[(hashes >> np.uint64(44)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (hashes & np.uint64((1 << 56) - 1))
    ends = np.searchsorted(of, np.arange(len(texts)), "right").tolist()
    for start, end in zip([0, *ends], ends, strict=False):
        key[start:end].sort()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
    key, of = key[new], of[new]
    return key, np.searchsorted(of, np.arange(len(texts)), "right")


def parity_bits(keys: np.ndarray, percent: int) -> bytes:
    """Parities of the n-grams that fall on each bit; a power of two of bits, at least 64 and at least eight for each n-gram in which a set
    may differ from a linked one of its size, so that few of these hide each other and sets of other texts differ far more."""
    size = max(64, 1 << (16 * len(keys) * (100 - percent) // (100 + percent)).bit_length())
    counts = np.bincount((keys & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: int, size: int, to: int) -> int:
    """A bitmap of ``size`` bits, half upon half until ``to`` are left, which keeps parities."""
    while size > to:
        size //= 2
        bits = bits >> size ^ bits & (1 << size) - 1
    return bits


def candidates(cards: list[tuple], percent: int, merge: bool, across: bool) -> Iterator[tuple[int, int]]:
    """Pairs of sets of different labels among ``cards(sid, n, bits, label, early, part)`` that may be linked. With ``merge`` a pair is taken for
    a link, and its labels become one; with ``across`` only sets of different parts are compared.

    ``early`` tells which sets hold the n-gram they meet at early enough to be the smaller set of a link; of each pair one does. N-grams of
    one set alone are at least as many as parities that differ, so no pair of linked sets is left.
    """
    order = sorted(cards, key=lambda card: card[1])
    maps = [{8 * len(bits): int.from_bytes(bits, "little")} for _, _, bits, *_ in order]
    widths = [8 * len(bits) for _, _, bits, *_ in order]
    parent: dict[int, int] = {}
    for x, (sid, size, _, label, early, part) in enumerate(order):
        for y in range(x + 1, len(order)):
            other, larger, _, label_y, early_y, part_y = order[y]
            if 100 * size < percent * larger:
                break
            if label == label_y or across and part == part_y or not (early or early_y):
                continue
            width, both = min(widths[x], widths[y]), size + larger
            ends = []
            for k in (x, y):
                if width not in maps[k]:
                    maps[k][width] = folded(maps[k][widths[k]], widths[k], width)
                ends.append(maps[k][width])
            if (ends[0] ^ ends[1]).bit_count() <= both - 2 * -(-percent * both // (100 + percent)) and (not merge or union(parent, label, label_y)):
                yield sid, other


def join_sets(members: DataFrame, percent: int, merge: bool) -> DataFrame:
    """Candidates ``a, b, raw`` within the groups ``(g, i, j)`` of ``members(g, i, j, raw, part, label, early, sid, n, bits)``; ``raw`` is the
    n-gram they met at."""
    key = ["g", "i", "j"]
    names = [*key, "raw", "sid", "n", "bits", "label", "early", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True))
        for (_, i, j, raw), group in groupby(rows, key=lambda row: row[:4]):
            pairs = list(candidates([row[4:] for row in group], percent, merge, i != j))
            if pairs:
                ends = [pa.array([p[side] for p in pairs], pa.int64()) for side in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ends, pa.array([raw] * len(pairs), pa.int64())], names=["a", "b", "raw"])

    placed = members.select(*names).withColumns({c: F.col(c).cast("int") for c in ("i", "j")})
    return placed.repartition(*key).sortWithinPartitions(*key, "raw", "sid").mapInArrow(run, "a long, b long, raw long")


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``pairs(a, b, ...)`` with ``linked``: whether the whole sets of the two documents overlap enough.

    Whole texts move only for documents that are in a pair, and once for pairs that met at several n-grams. A document in many pairs is on the unique side of the joins, so it is split like
    any skewed join key.
    """
    met = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *[c for c in pairs.columns if c not in ("a", "b")])
    pairs = met.select("a", "b").distinct()
    wanted = met.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = docs.join(F.broadcast(wanted) if wanted.count() <= SENT else wanted, "doc_id", "left_semi")
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for texts in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
                x, y = (np.unique(shingle_hashes([t], words)[0]) for t in texts)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return met.join(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean"), ["a", "b"])


def tiled(members: DataFrame, sizes: DataFrame, pairs: bool) -> DataFrame:
    """Members with their part of the group, and the tile of each; all pairs of parts of a large group, or each part alone with the group's
    smallest set beside it, so that parts of near copies fall under one label."""
    out = members.join(sizes, "g").withColumn("parts", F.ceil(F.col("c") / PART).cast("int"))
    out = out.withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    if not pairs:
        out = out.withColumn("i", F.explode(F.when(F.col("sid") == F.col("first"), every).otherwise(F.array("part"))))
        return out.withColumn("j", F.col("i"))
    out = out.withColumn("o", F.explode(every))
    return out.withColumn("i", F.least("part", "o")).withColumn("j", F.greatest("part", "o"))


def size_band(percent: int):
    """Linked sets are in one band of sizes or in adjacent ones."""
    return F.floor(F.log("n") / max(1e-9, 1.0001 * math.log(100 / percent)))


def by_size(rows: DataFrame, percent: int) -> DataFrame:
    """``rows(sid, n, g, label, early)`` of large groups, with ``g`` narrowed to sets of like size.

    A set joins the group of its band (``own``) and that of the band above; a group without own members has met one band below.
    """
    return rows.withColumn("up", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "sid", "n", F.xxhash64("g", size_band(percent) + F.col("up")).alias("g"), F.col("g").alias("raw"), "label", "early", (F.col("up") == 0).alias("own"))


def telling(rows: DataFrame, percent: int) -> DataFrame:
    """``rows(sid, n, g, label, early)`` cut to what linked sets of different labels need to meet.

    Linked sets share at least ``share`` n-grams of their prefixes: the greater one of N n-grams shares ``percent`` of them, and fewer
    than ``percent - SLACK`` lie behind its prefix. So a set with fewer n-grams that sets of another label and of like size hold too links with
    none of another label. Of the others the last ``share - 1`` such n-grams are left out: the first n-gram a pair shares is not among them.
    """
    share = F.expr(f"int(greatest(1, ({percent - lowered(percent)}L * n) div 100))")
    rows = rows.withColumn("band", size_band(percent))
    ends = rows.groupBy("g", "band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    bands = ends.groupBy("g").agg(F.collect_list(F.struct("band", "low", "high")).alias("bands"), F.min("low").alias("low"), F.max("high").alias("high"))
    like = F.expr("exists(bands, x -> abs(x.band - band) <= 1 and (x.low <> label or x.high <> label))")
    met = rows.join(bands.where("low <> high").select("g", "bands"), "g").where(like)
    held = met.groupBy("sid", "n", "label").agg(F.sort_array(F.collect_set(F.struct("g", "early"))).alias("gs"))
    held = held.withColumn("share", share).where(F.size("gs") >= F.col("share"))
    return held.select("sid", "n", "label", F.inline(F.slice("gs", F.lit(1), F.size("gs") - F.col("share") + 1)))


def lowered(percent: int) -> int:
    return max(1, percent - SLACK)


def meetings(rows: DataFrame, percent: int) -> DataFrame:
    """``sid, n, g, raw, label, early, own`` of the sets of ``rows(sid, n, g, label, early)`` that have something to meet: groups with several labels and
    an early member; those beyond ``PART`` sets are narrowed by size."""
    groups = rows.groupBy("g").agg(F.count("*").alias("c"), F.min("label").alias("low"), F.max("label").alias("high"), F.max("early").alias("any"))
    groups = groups.where("low <> high and any").select("g", "c")
    held = rows.join(groups, "g")
    few = held.where(F.col("c") <= PART).select("sid", "n", "g", F.col("g").alias("raw"), "label", "early", F.lit(True).alias("own"))
    return few.unionByName(by_size(held.where(F.col("c") > PART), percent))


def near_documents(documents: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id``: per row the size of its set and the smallest doc_id reachable by links.

    Two documents link if ``100 * intersection >= percent * union`` of their sets of ``words``-word n-grams.

    1. A sketch of fixed size over all documents gives the global order: frequent n-grams last.
    2. Equal sets are joined once, under their smallest doc_id. A set's prefix, its first ``size - ceil((percent - SLACK) * size) + 1``
       n-grams, shares several n-grams with that of every set it links to; n-grams that one prefix alone holds drop out.
    3. Sets meet at their first shared n-gram, in groups of at most about ``PART`` sets. Only a card of each travels there: size and a
       bitmap of some one to two bits an n-gram, a fortieth of the set. Bitmaps give candidates, and these are verified on whole sets. What
       links gets one label, so that large groups of near copies fall under few labels.
    4. Sets that share enough n-grams with other labels and like sizes (see :func:`telling`) meet likewise at each of those; larger groups
       are narrowed by size and cut into parts that meet in pairs. A candidate is taken for a link within its group, so that near copies do not give all their
       pairs; groups in which verification proves that wrong give all their candidates in one more round. So every link is found or joins
       what is joined already.

    N-grams are known by 64 bits of hash, sets by their size and two sums of 64 bits. The longest text bounds the memory of a task, some 60
    bytes a word.

    Texts without words have no n-gram and link with nothing, neither do rows without doc_id (their component is null). Rows that share a
    doc_id are one node. An empty table gives no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    levels = spark.sparkContext.broadcast(frequency_levels(docs, words))  # one byte per counter
    wide = written(described(docs, words, percent, levels))
    sets = written(wide.select("doc_id", "n", "f1", "f2"))
    full = sets.where("n > 0 and doc_id is not null")
    distinct = full.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("sid"))
    chosen = wide.where("n > 0 and doc_id is not null").join(distinct, ["n", "f1", "f2"]).where("doc_id = sid")
    # Of two linked sets the smaller one shares an n-gram of a shorter prefix, sized for partners at least as large as itself.
    early = F.expr(f"pos <= n - ({2 * percent}L * n + {99 + percent}) div {100 + percent}").alias("early")
    prefixes = chosen.select("sid", "n", F.posexplode("prefix").alias("pos", "g")).select("sid", "n", "g", early)
    held = F.count("*").over(Window.partitionBy("g"))  # prefixes travel once; few n-grams are held twice, so counts do not shrink before the shuffle
    shared = written(prefixes.withColumn("c", held).where("c > 1").select("sid", "n", "g", "early"))
    wanted = written(shared.groupBy("sid", "n").agg(F.min("g").alias("g")))
    cards = written(chosen.select("sid", "n", "bits").join(wanted.select("sid"), "sid", "left_semi").distinct())  # repeated rows give one card
    discard(wide)  # as large as a tenth of the texts
    release(spark)

    made: list[DataFrame] = [shared, wanted, cards]

    def met(rows: DataFrame, pairs: bool, merge: bool = True) -> DataFrame:
        """Pairs that meet in the groups of ``rows``, verified."""
        rows = written(rows)  # used twice below
        sizes = rows.groupBy("g").agg(F.count("*").alias("c"), F.min("label").alias("low"), F.max("label").alias("high"), F.min("sid").alias("first"),
                                      F.max("own").alias("any_own"), F.max("early").alias("any_early"))
        sizes = sizes.where("low <> high and any_own and any_early").select("g", "c", "first")
        found = written(join_sets(tiled(rows, sizes, pairs).join(cards, ["sid", "n"]), percent, merge))
        release(spark)
        out = written(verified(found, docs, words, percent))
        discard(found)
        discard(rows)
        made.append(out)
        release(spark)
        return out

    first = wanted.withColumns({"raw": F.col("g"), "label": F.col("sid"), "own": F.lit(True), "early": F.lit(True)})
    links = met(first, False).where("linked").select("a", "b")
    labels = settle(components(links))
    release(spark)
    # A doc_id on several rows is one node, so the sets of these rows belong together.
    several = full.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    same = full.join(several, "doc_id").join(distinct, ["n", "f1", "f2"]).select(F.col("doc_id").alias("a"), F.col("sid").alias("b"))

    def labelled(labels: DataFrame) -> DataFrame:
        rows = shared.join(labels, shared.sid == labels.id, "left")
        made.append(named := written(rows.select("sid", "n", "g", F.coalesce("component_id", "sid").alias("label"), "early")))
        return telling(named, percent)

    last = met(meetings(labelled(labels), percent), True)
    links = links.unionByName(last.where("linked").select("a", "b"))
    wrong = last.where("not linked").select(F.col("raw").alias("g")).distinct()
    if wrong.take(1):
        labels = settle(components(links))
        again = labelled(labels).join(wrong, "g", "left_semi")
        links = links.unionByName(met(meetings(again, percent), True, merge=False).where("linked").select("a", "b"))
    final = settle(components(links.unionByName(same)))
    for table in made:
        discard(table)
    release(spark)
    named = distinct.join(final, distinct.sid == final.id, "left").select("n", "f1", "f2", F.coalesce("component_id", "sid").alias("component_id"))
    out = sets.join(named, ["n", "f1", "f2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def described(docs: DataFrame, words: int, percent: int, levels: Broadcast) -> DataFrame:
    """``doc_id, n, f1, f2, prefix, bits``: size, fingerprint, prefix, and the bitmap of the set's card."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in batches_of(batch):
                key, ends = ordered_sets(texts, words, levels.value)
                begins = np.concatenate([[0], ends[:-1]])
                n = ends - begins
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(scrambled(key + np.uint64(salt)))]) for salt in (1, 2)]
                f1, f2 = ((s[ends] - s[begins]).astype(np.int64) for s in sums)
                size = np.where(n > 0, n - -(-lowered(percent) * n // 100) + 1, 0)
                stops = np.cumsum(size)
                index = np.repeat(begins - (stops - size), size) + np.arange(int(stops[-1]))
                prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]).astype(np.int32)), pa.array(key[index].astype(np.int64)))
                bits = [parity_bits(part, percent) for part in np.split(key, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array(n), pa.array(f1), pa.array(f2), prefix, pa.array(bits, pa.binary())],
                    names=["doc_id", "n", "f1", "f2", "prefix", "bits"])

    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, prefix array<long>, bits binary")
