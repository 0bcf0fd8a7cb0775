"""Spelling variants: the vocabulary acceptor composed with a one-edit transducer and with itself again.

The vocabulary is cut by initial states: the states its acceptor is in after half of a word, read from the front, and after the other half, read
from the end. Two words one edit apart agree in one of the two halves, so they start from the same state of one of the acceptors. Each
such part is minimised and composed in a task, and the composition is walked for accepted pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle, written

#: Words of an initial state are taken in one piece up to this number; beyond it the state is replaced by states half as far from the end.
STATE_WORDS = 20_000


class Acceptor:
    """Minimal acceptor states: equal sets of remaining letters are one state, whichever word they belong to."""

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.edges: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.common: dict[tuple[int, int], bool] = {}

    def build(self, words: list[str], depth: int = 0) -> int:
        """State that accepts ``words`` (sorted, each once) from ``depth`` on."""
        final = bool(words) and len(words[0]) == depth
        rest = words[1:] if final else words
        edges = {letter: self.build(list(part), depth + 1) for letter, part in groupby(rest, key=lambda x: x[depth])}
        key = (final, *edges.items())
        if key not in self.register:
            self.register[key] = len(self.edges)
            self.edges.append(edges)
            self.final.append(final)
        return self.register[key]

    def meet(self, a: int, b: int) -> bool:
        """Whether some rest is accepted from both states."""
        if a == b:
            return True
        key = (a, b) if a < b else (b, a)
        if key not in self.common:
            x, y = self.edges[a], self.edges[b]
            self.common[key] = (self.final[a] and self.final[b]) or any(c in y and self.meet(s, y[c]) for c, s in x.items())
        return self.common[key]

    def rests(self, a: int, b: int, read: str = "") -> Iterator[str]:
        """Rests accepted from both states: what is left of the composition once the edit is made."""
        if not self.meet(a, b):
            return
        if self.final[a] and self.final[b]:
            yield read
        for c, s in self.edges[a].items():
            if c in self.edges[b]:
                yield from self.rests(s, self.edges[b][c], read + c)

    def replaced(self, a: int, read: str = "") -> Iterator[tuple[str, str]]:
        """Pairs with one letter replaced, the smaller first: both sides read the same up to the edit, then any rest common to both."""
        edges = sorted(self.edges[a].items())
        for i, (c, s) in enumerate(edges):
            for d, t in edges[i + 1:]:
                for rest in self.rests(s, t):
                    yield read + c + rest, read + d + rest
            yield from self.replaced(s, read + c)

    def inserted(self, a: int, b: int, read: str = "") -> Iterator[tuple[str, str]]:
        """Pairs of a word from ``a`` and one from ``b`` with one letter more. In a row of equal letters the last one counts as inserted."""
        for d, t in self.edges[b].items():
            if self.final[a] and self.final[t]:
                yield read, read + d
            for c, s in self.edges[a].items():
                if c != d and c in self.edges[t]:
                    for rest in self.rests(s, self.edges[t][c]):
                        yield read + c + rest, read + d + c + rest
        for c, s in self.edges[a].items():
            if c in self.edges[b]:
                yield from self.inserted(s, self.edges[b][c], read + c)


def state_rows(words: DataFrame) -> DataFrame:
    """``c, a, b, key, word, n``: each word under the initial states it can share with a word one edit away.

    ``c`` is the length of the shorter word of a pair, so a word stands for its own length and for one less. With the first ``a`` letters fixed
    the edit lies behind them, with the last ``b`` letters fixed in front of them.
    """
    cuts = F.expr("""transform(filter(array(char_length(word), char_length(word) - 1), c -> c > 0),
                     c -> array(named_struct('c', c, 'a', c div 2, 'b', 0L), named_struct('c', c, 'a', 0L, 'b', c - c div 2)))""")
    return words.select("word", "n", F.inline(F.flatten(cuts))).select(
        "c", F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), "word", "n").withColumn("key", _fixed())


def _fixed() -> F.Column:
    """The fixed letters; none can be a line feed, which keeps front and end apart."""
    return F.concat(F.left("word", F.col("a")), F.lit("\n"), F.expr("right(word, b)"))


def calm_states(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with every state of more than ``most`` words replaced by two: half of its free letters fixed in front, or the rest of them at the end.

    A pair of such a state agrees in one of the halves. The letters that are free become half as many each time; with one left a state
    holds at most an alphabet of shorter words and its square of longer ones, so the split ends.
    """
    state, calm = ["c", "a", "b", "key"], None
    while True:
        hot = settle(rows.groupBy(*state).count().where((F.col("count") > most) & (F.col("c") - F.col("a") - F.col("b") > 1)).select(*state))
        if not hot.take(1):
            return rows if calm is None else calm.unionByName(rows)
        still = rows.join(hot, state, "left_anti")
        calm = still if calm is None else calm.unionByName(still)
        free = F.expr("c - a - b")
        front, end = F.ceil(free / 2).cast("int"), F.floor(free / 2).cast("int")
        halves = F.array(F.struct((F.col("a") + front).alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), (F.col("b") + end).alias("b")))
        rows = settle(rows.join(hot, state, "left_semi").select("c", "word", "n", F.inline(halves)).withColumn("key", _fixed()).select("c", "a", "b", "word", "n", "key"))


def near_pairs(words: DataFrame, most: int = STATE_WORDS) -> DataFrame:
    """``(u, n_u, v, n_v)``: every pair of ``words(word, n)`` that differs by one inserted, deleted or replaced code point, once or more."""
    rows = calm_states(state_rows(words), most).repartition("c", "a", "b", "key").sortWithinPartitions("c", "a", "b", "key", "word")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, str, int]] = []
        entries = (row for batch in batches for row in zip(*(batch.column(x).to_pylist() for x in ("c", "a", "b", "key", "word", "n")), strict=True))
        for (c, a, b, _), part in groupby(entries, key=lambda r: r[:4]):
            held = {word: n for *_, word, n in part}
            if len(held) < 2:
                continue
            # With letters fixed in front the rest is read forward, with letters fixed at the end only it is read backward.
            turn = -1 if b > a else 1
            middle = {word[a:len(word) - b][::turn]: word for word in held}
            short = sorted(m for m, word in middle.items() if len(word) == c)
            long = sorted(m for m, word in middle.items() if len(word) > c)
            if not short:
                continue
            machine = Acceptor()
            left, right = machine.build(short), machine.build(long)
            for pairs in (machine.replaced(left), machine.inserted(left, right) if long else ()):
                for x, y in pairs:
                    u, v = middle[x], middle[y]
                    out.append((u, held[u], v, held[v]))
            if len(out) >= 10_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return rows.mapInArrow(walk, "u string, n_u long, v string, n_v long")


def _pairs(rows: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
    kinds = [("u", pa.string()), ("n_u", pa.int64()), ("v", pa.string()), ("n_v", pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[k for k, _ in kinds])


def vocabulary(words: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """``(word, n)`` of the words of ``words(word)`` that are long and frequent enough; counted before the shuffle."""
    return words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def roots(links: DataFrame) -> DataFrame:
    """``(word, root)`` at the end of the chain ``word -> form`` of each word of ``links(word, form)``.

    Chains are halved each round: a form that has a form itself is replaced by it. The side joined to is unique, so a form that
    many words share is split like any skewed join key. Chains must not close; counts that grow along them see to that.
    """
    now = settle(links.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settle(now.join(step, "root", "left"))
        now = moved.select("word", F.coalesce("further", "root").alias("root"))
        if not moved.where("further is not null").take(1):
            return now


def group_variants(words: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, most: int = STATE_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words(word)``, one row an occurrence, that is long and frequent enough.

    ``n``: occurrences; ``n_near``: words one inserted, deleted or replaced code point away; ``form``: the one of them with the greatest n (ties:
    smallest in code-point order) if that is at least ``ratio`` times the word's, else NULL, with ``form_n``; ``root``: end of the chain of forms.

    NULL and empty words count for nothing, repeated rows are occurrences, an empty table gives an empty one, other columns are not read.
    A word must hold no line feed. A word of any length is taken; its states hold its half. A task holds the words of one initial state, at
    most ``most`` or an alphabet's square (see :func:`calm_states`). ``least_length`` is at least 2.
    """
    if least_length < 2:
        raise ValueError("least_length is 2 or more")
    known = written(vocabulary(words.select("word").where("word is not null"), least_length, least_count))
    pairs = near_pairs(known, most)
    # A pair whose inserted letter stands in a row of its like may come from both halves.
    once = pairs.groupBy("u", "v").agg(F.first("n_u").alias("n_u"), F.first("n_v").alias("n_v"))
    both = once.select(F.inline(F.array(
        F.struct(F.col("u").alias("word"), F.col("v").alias("near"), F.col("n_v").alias("near_n")),
        F.struct(F.col("v").alias("word"), F.col("u").alias("near"), F.col("n_u").alias("near_n")))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    formed = F.col("best").isNotNull() & (-F.col("best.m") >= ratio * F.col("n"))
    rated = settle(known.join(best, "word", "left").select(
        "word", F.when(formed, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, -F.col("best.m")).alias("form_n")))
    discard(known)
    ends = roots(rated.where("form is not null").select("word", "form"))
    return rated.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
