"""Toxicity: Levenshtein automata over a lexicon trie find terms and their misspellings, windows around them give the score.

The lexicon is learned from labelled documents: words and word beginnings that stand in toxic documents and hardly in others. So are the cues of
reporting: words that stand next to a term where the document is not toxic. A hit inside a quotation, however long that is, or next to a
cue counts less than one that is said outright.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Marks around words, and those that open and close a quotation.
MARKS = "\"'`.,;:!?()[]{}<>|*#%&$-_~=+/\\«»“”„‘’…"
OPENING, CLOSING = "\"“„«‘", "\"”“»’"
STEMS = range(3, 9)
#: Words on both sides of a hit among which a cue of reporting counts, and the length of the window whose hits are added.
CONTEXT, WINDOW = 4, 50
#: States of the automaton a worker keeps; beyond it the automaton is started again.
STATES = 200_000
#: Words kept per worker whose match is known.
KNOWN = 500_000


def tokens(text: str) -> list[str]:
    return text.lower().split()


def terms_of(words: set[str]) -> set[str]:
    """Words as ``=word``, beginnings as ``word``; words over 40 characters give beginnings only."""
    bare = {w.strip(MARKS) for w in words}
    return {"=" + w for w in bare if 2 < len(w) <= 40} | {w[:k] for w in bare for k in STEMS if len(w) >= k and w[:k].isalpha()}


class Lexicon:
    """A trie of terms and the automaton of all strings within the edit bound of one, built state by state as words need it.

    A state is the set of (trie node, edits so far) that the characters read can lead to; it is worked out once per character and
    then looked up. Words up to four characters and beginnings must match exactly, longer words within one edit, from eight
    characters on within two.
    """

    EXACT, MISSPELT, MORE = 1.0, 0.7, 0.4

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.bound, self.ends, self.begins = [0], [-1], [False]
        for term in terms:
            word, at = term.lstrip("="), 0
            edits = 0 if not term.startswith("=") or len(word) < 5 else 1 if len(word) < 8 else 2
            self.bound[0] = max(self.bound[0], edits)
            for c in word:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.bound.append(0)
                    self.ends.append(-1)
                    self.begins.append(False)
                at = self.children[at][c]
                self.bound[at] = max(self.bound[at], edits)
            if term.startswith("="):
                self.ends[at] = edits
            else:
                self.begins[at] = True
        self.letters = {c for node in self.children for c in node}
        self.known: set[str] = set()
        self.found: dict[str, float] = {}
        self.restart()

    def restart(self) -> None:
        """The automaton without the states worked out so far."""
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.accept: list[float] = []
        self.dead = self.state(frozenset())
        self.start = self.state(self.closed({(0, 0)}))

    def closed(self, found: set[tuple[int, int]]) -> frozenset:
        """With the nodes reached by leaving out characters of a term."""
        todo = list(found)
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.bound[child] and (child, edits + 1) not in found:
                    found.add((child, edits + 1))
                    todo.append((child, edits + 1))
        return frozenset(found)

    def state(self, found: frozenset) -> int:
        if found not in self.states:
            self.states[found] = len(self.sets)
            self.sets.append(found)
            self.steps.append({})
            edits = [e for node, e in found if e <= self.ends[node]]
            strength = (self.EXACT, self.MISSPELT, self.MORE)[min(edits)] if edits else 0.0
            self.accept.append(-1.0 if any(self.begins[node] and not e for node, e in found) else strength)
        return self.states[found]

    def step(self, state: int, c: str) -> int:
        found = set()
        for node, edits in self.sets[state]:
            for letter, child in self.children[node].items():
                if letter == c:
                    found.add((child, edits))
                elif edits < self.bound[child]:
                    found.add((child, edits + 1))
            if edits < self.bound[node]:
                found.add((node, edits + 1))
        self.steps[state][c] = reached = self.state(self.closed(found))
        return reached

    def strength(self, word: str) -> float:
        """0 for no match, 1 for a term as it stands, less for a misspelling."""
        state, steps, accept = self.start, self.steps, self.accept
        for c in word:
            if c not in self.letters:
                c = ""
            following = steps[state].get(c)
            state = self.step(state, c) if following is None else following
            if accept[state] < 0:
                return self.EXACT
            if state == self.dead:
                return 0.0
        return accept[state]

    def hits(self, words: set[str]) -> dict[str, float]:
        if len(self.known) >= KNOWN:
            self.known.clear()
            self.found.clear()
        if len(self.sets) >= STATES:
            self.restart()
        for word in words - self.known:
            strength = self.strength(word.strip(MARKS))
            if strength:
                self.found[word] = strength
        self.known |= words
        return {w: self.found[w] for w in words & self.found.keys()} if not words.isdisjoint(self.found) else {}


@lru_cache(maxsize=2)
def lexicon_of(terms: tuple[str, ...]) -> Lexicon:
    return Lexicon(list(terms))


def quotations(words: list[str]) -> list[bool]:
    """Whether each word lies in a quotation: between a word that opens one and the next that closes one, over the whole text."""
    inside, start = [False] * len(words), -1
    for at, word in enumerate(words):
        if start < 0 and word[:1] in OPENING:
            start = at
        if start >= 0:
            end = word.rstrip(".,;:!?")
            if end[-1:] and end[-1] in CLOSING and (at > start or len(end) > 1):
                inside[start:at + 1] = [True] * (at + 1 - start)
                start = -1
    return inside


def nearby(words: list[str], at: int) -> set[str]:
    """Bare words around a place, without the word itself."""
    around = words[max(0, at - CONTEXT):at] + words[at + 1:at + CONTEXT + 1]
    return {w for w in (x.strip(MARKS) for x in around) if len(w) > 1}


def features(text: str, lexicon: Lexicon, cues: frozenset = frozenset()) -> tuple[list[float], list[tuple[int, float]]]:
    """What the score is made of, and the hits (place of the word, strength after context)."""
    words = tokens(text)
    strengths = lexicon.hits(set(words))
    hits: list[tuple[int, float]] = []
    quoted = 0.0
    inside = quotations(words) if strengths else []
    for at, word in enumerate(words) if strengths else ():
        strength = strengths.get(word)
        if not strength:
            continue
        if inside[at] or not cues.isdisjoint(nearby(words, at)):
            quoted += strength
            strength *= 0.3
        hits.append((at, strength))
    best = total = first = 0
    running = 0.0
    for at, strength in hits:
        running += strength
        total += strength
        while hits[first][0] <= at - WINDOW:
            running -= hits[first][1]
            first += 1
        best = max(best, running)
    return [math.log1p(total), math.log1p(best), math.log1p(quoted), min(1.0, 20 * total / (len(words) + 20))], hits


@dataclass
class Model:
    """Terms, cues of reporting and the weights of a logistic score; the last weight is the constant."""

    terms: list[str]
    weights: list[float] = field(default_factory=lambda: [0.0] * 5)
    cues: list[str] = field(default_factory=list)

    def score(self, found: list[float]) -> float:
        z = self.weights[-1] + sum(w * x for w, x in zip(self.weights, found, strict=False))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def counted(rows: DataFrame, found_in: Callable[[str], Iterable[str]]) -> DataFrame:
    """Documents per term of ``rows(text, toxic)``: ``term, toxic, n``; each partition adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((term, toxic) for term in found_in(text or ""))
            if len(counts) > 400_000:
                yield made(counts)
                counts = Counter()
        yield made(counts)

    def made(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([t for t, _ in counts], pa.string()), pa.array([k for _, k in counts], pa.int32()),
                                           pa.array(list(counts.values()), pa.int64())], names=["term", "toxic", "n"])

    return rows.select("text", "toxic").mapInArrow(count, "term string, toxic int, n long").groupBy("term", "toxic").agg(F.sum("n").alias("n"))


def gain(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Log-likelihood ratio of a term, positive if it stands in toxic documents more often."""
    def part(k: float, n: float) -> float:
        return k * math.log(k / n) if k and n else 0.0

    seen, total = toxic + clean, all_toxic + all_clean
    value = (part(toxic, seen) + part(clean, seen) + part(all_toxic - toxic, total - seen) + part(all_clean - clean, total - seen)
             - part(all_toxic, total) - part(all_clean, total))
    return 2 * value if toxic * all_clean > clean * all_toxic else 0.0


def chosen(counts: dict[str, tuple[int, int]], all_toxic: int, all_clean: int, least_gain: float, least_share: float, most: int) -> list[str]:
    """Terms that tell toxic documents apart, in order of gain.

    A beginning that another one continues without losing documents is left to the longer one, a word that its beginning
    covers with the same certainty to the beginning.
    """
    good = {t: g for t, (x, y) in counts.items() if x >= least_share * (x + y) and (g := gain(x, y, all_toxic, all_clean)) >= least_gain}
    longest: dict[str, str] = {}
    for t in sorted(good, key=lambda t: (len(t.lstrip("=")), t.startswith("="))):
        word = t.lstrip("=")
        above = next((longest[word[:k]] for k in STEMS if word[:k] in longest), None)
        if above is None:
            longest[word if not t.startswith("=") else t] = t
        elif counts[t][0] >= 0.97 * counts[above][0]:
            for k, v in list(longest.items()):
                if v == above:
                    longest[k] = t
    return sorted(set(longest.values()), key=lambda t: (-good[t], t))[:most]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> list[float]:
    """Weights of a logistic regression by Newton's steps; few rows of one kind give weights near zero."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.diag([1.0] * (x.shape[1] - 1) + [0.01])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 100_000, fit_rows: int = 20_000, most_terms: int = 2_000, least_gain: float = 26.0,
          least_share: float = 0.9, candidate_share: float = 0.01) -> Model:
    """A model of ``labels(doc_id, toxic)`` on ``docs(doc_id, text)``, fitted on a bounded sample of labelled rows.

    ``sample_rows``: the labelled ids that come first by a hash; terms and cues are counted in their documents. ``fit_rows``: those of them, in the same
    order, on which the weights are fitted. The ids are a bounded list, so it goes to where the texts are, and no text is moved. A
    candidate term stands in at least 6 toxic documents and a share ``candidate_share`` of them. ``most_terms`` bounds the lexicon that every
    executor holds: those of the greatest gain. Null labels and ids are left out; repeated ids count once each.
    """
    known = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("toxic")]
    first = known.orderBy(*order).limit(sample_rows)
    labelled = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(first), "doc_id").select("doc_id", "text", "toxic")
    sizes = {r[0]: r[1] for r in labelled.groupBy("toxic").count().collect()}
    all_toxic, all_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not all_toxic or not all_clean:
        return Model([], [0.0] * 4 + [math.log((all_toxic + 1) / (all_clean + 9))])
    least = max(6, math.ceil(candidate_share * all_toxic))
    terms_in = lambda text: terms_of(set(tokens(text)))
    toxic = {r[0]: r[2] for r in counted(labelled.where("toxic = 1"), terms_in).where(F.col("n") >= least).collect()}
    candidates = frozenset(toxic)
    clean = {r[0]: r[2] for r in counted(labelled.where("toxic = 0"), lambda text: terms_in(text) & candidates).collect()}
    terms = chosen({t: (n, clean.get(t, 0)) for t, n in toxic.items()}, all_toxic, all_clean, least_gain, least_share, most_terms)
    cues = reporting_cues(labelled, terms, least_gain)
    fitted = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(known.orderBy(*order).limit(fit_rows)), "doc_id")
    rows = [r[:] for r in scored(fitted, Model(terms, cues=cues), ["toxic"]).select("features", "toxic").collect()]
    return Model(terms, fit(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)), cues)


def reporting_cues(labelled: DataFrame, terms: list[str], least_gain: float) -> list[str]:
    """Words that stand next to a term in documents that are not toxic, and hardly next to one in toxic documents."""

    def around(text: str) -> set[str]:
        own, words = lexicon_of(tuple(terms)), tokens(text)
        strengths = own.hits(set(words))
        return {w for at, word in enumerate(words) if word in strengths for w in ("", *nearby(words, at))} if strengths else set()

    counts: dict[str, list[int]] = {}
    for term, toxic, n in counted(labelled, around).where("n >= 3").collect():  # at most two words a side of each hit, of a bounded sample
        counts.setdefault(term, [0, 0])[1 - toxic] += n
    with_hit = counts.pop("", [0, 0])
    return sorted(w for w, (bad, good) in counts.items() if not own_term(w, terms)
                  and good >= 0.5 * (good + bad) and gain(good, bad, with_hit[1], with_hit[0]) >= least_gain)


def own_term(word: str, terms: list[str]) -> bool:
    return lexicon_of(tuple(terms)).strength(word) > 0


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` with ``score``, ``n_hits``, ``hit_words`` (places of the words) and ``features``."""
    keep = keep if keep is not None else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cues = lexicon_of(tuple(model.terms)), frozenset(model.cues)
        for batch in batches:
            found = [features(t or "", own, cues) for t in batch.column(batch.num_columns - 1).to_pylist()]
            arrays = [pa.array([model.score(x) for x, _ in found], pa.float64()), pa.array([len(h) for _, h in found], pa.int32()),
                      pa.array([[at for at, _ in h] for _, h in found], pa.list_(pa.int32())),
                      pa.array([x for x, _ in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=names)

    names = [*keep, "score", "n_hits", "hit_words", "features"]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"))
    kinds = ", ".join(f"`{n}` {t}" for n, t in source.drop("_text").dtypes)
    return source.mapInArrow(run, f"{kinds}, score double, n_hits int, hit_words array<int>, features array<double>")


def rate(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, learned from rows outside the held-out third.

    Null and empty texts get the score of a text without hits. Null doc_ids are rated and never learned from. Each row is rated
    on its own, so repeated rows get equal scores; an empty table gives no rows. ``lang``, ``source`` and other columns are not read.
    """
    fold = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3
    model = learn(docs.where(fold != 1), labels.where(fold != 1), **options)
    return scored(docs.withColumn("doc_id", F.col("doc_id").cast("long")), model).select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", "n_hits", "hit_words",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
