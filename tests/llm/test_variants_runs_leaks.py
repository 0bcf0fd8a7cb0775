"""Spelling variants, periodic runs and decontamination against brute force, with nulls, ties, repeats, long texts and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import decontaminate, periodic_runs, queries, spelling_variants

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = "abcdeéßÀ"


def put(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def docs_table(texts, ids=None):
    ids = ids or range(len(texts))
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)], DOCS


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# 11 spelling variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:]


def brute_variants(counts, ratio):
    out = {}
    for w, n in counts.items():
        near = sorted((-m, x) for x, m in counts.items() if one_edit(w, x))
        form = near[0][1] if near and -near[0][0] >= ratio * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    roots = {}
    for w in counts:
        at = w
        while out[at][0] is not None:
            at = out[at][0]
        roots[w] = at
    return {w: (f, roots[w], n, k, fn) for w, (f, n, k, fn) in out.items()}


def word_pool(seed, n, least=3, most=6, alphabet=LETTERS):
    rng = random.Random(seed)
    pool = {"".join(rng.choice(alphabet) for _ in range(rng.randint(least, most))) for _ in range(n)}
    # Rows of equal letters, where an inserted letter can stand in several places.
    return sorted(pool | {"a" * k for k in range(least, 9)} | {"ab" + "c" * k for k in range(least, 9)} | {"c" * k + "ab" for k in range(least, 9)})


@pytest.mark.parametrize("most", [spelling_variants.STATE_WORDS, 3])
def test_pairs_equal_brute_force_with_and_without_split_states(spark, most):
    pool = word_pool(1, 500, alphabet="abé")
    words = spark.createDataFrame([(w, i) for i, w in enumerate(pool)], "word string, n long")
    found = {(r["u"], r["v"]) for r in rows_of(spelling_variants.near_pairs(words, most))}
    assert {tuple(sorted(p)) for p in found} == {(a, b) for a in pool for b in pool if a < b and one_edit(a, b)}


def test_forms_roots_and_ties(spark):
    rng = random.Random(4)
    counts = {w: rng.choice([2, 2, 3, 20, 30, 200, 300, 3000]) for w in word_pool(2, 150)}
    rows = [(w, "x") for w, n in counts.items() for _ in range(n)] + [(None, "x"), ("", "x"), ("ab", "x"), ("single", "x")]
    words = spark.createDataFrame(rows, "word string, n string")  # the other column has the name of a result
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in rows_of(spelling_variants.group_variants(words, least_length=3, least_count=2))}
    assert got == brute_variants(counts, 10)
    assert spelling_variants.group_variants(words.limit(0)).count() == 0


def test_variant_query_types_words_as_stated(spark, tmp_path):
    rng = random.Random(5)
    pool = ["Kilometer", "kilometre", "Übergang", "strasse", "gäbeéßà", "naïvely", "Zeitung×a"]
    texts = [None, "", "short"] + [" ".join(rng.choice(pool) for _ in range(60)) + "," for _ in range(60)]
    folder = put(spark, tmp_path, documents=docs_table(texts))
    counts = {}
    for i, text in enumerate(texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                counts[w] = counts.get(w, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows_of(queries.op11_spelling_variants(spark, folder))}
    assert got == brute_variants(counts, 10) and any(v[0] for v in got.values())


def test_minimal_acceptor_shares_states():
    machine = spelling_variants.Acceptor()
    machine.build(sorted(a + b + "ing" for a in "abcdef" for b in "xyz"))
    assert len(machine.edges) == 6  # start, after one letter, after two, and one for each letter of the shared end but the last


# 12 periodic runs


def brute_lyndon(r):
    out = []
    for i in range(len(r)):
        best = 1
        for k in range(1, len(r) - i + 1):
            w = r[i:i + k]
            if all(w < w[j:] for j in range(1, k)):
                best = k
        out.append(best)
    return out


def test_phase_one_gives_lyndon_lengths():
    rng = random.Random(6)
    for _ in range(400):
        n, k = rng.randint(0, 24), rng.randint(1, 4)
        r = [rng.randrange(k) for _ in range(n)]
        used = sorted(set(r))
        r = [used.index(x) for x in r]
        assert periodic_runs.lyndon_lengths(r) == brute_lyndon(r), r


def brute_runs(words, least_length=6, exponent=4):
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e > s:
                start, length = s, e - s + q
                if length >= max(least_length, exponent * q) and not any(
                        q % d == 0 and all(words[i] == words[i + d] for i in range(start, start + length - d)) for d in range(1, q)):
                    out.append((start, length, q))
            s = e + 1
    return sorted(set(out), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(7)
    seen = 0
    for _ in range(600):
        parts = []
        while len(parts) < rng.randint(0, 90):
            root = [rng.randrange(3) for _ in range(rng.randint(1, 5))]
            parts += root * rng.choice([1, 1, 2, 4, 7]) + root[:rng.randint(0, len(root))]
        words = np.array(parts, np.int64)
        want = brute_runs(parts)
        assert periodic_runs.document_runs(words) == want, parts
        assert periodic_runs.runs_of(words, 3, 3) == brute_runs(parts, 3, 3), parts
        seen += len(want)
    assert seen > 300


def loop(i, words):
    h, n = zlib.crc32(str(i).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def test_run_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    texts = [None, "", " \t\n", "a", "x " * 50, "a b " * 40 + "c " * 9, "é ü " * 12 + "\x0b\x0cq"]
    texts += ["  ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 120))) for _ in range(120)]
    texts.append(" ".join(rng.choice("ab") for _ in range(5000)))
    folder = put(spark, tmp_path, documents=docs_table(texts))
    got = {r["doc_id"]: r for r in rows_of(queries.op12_periodic_runs(spark, folder))}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = loop(i, [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w])
        runs = brute_runs(words)
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        assert got[i] == {
            "doc_id": i, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": best[0] if best[0] is None else 1000 * best[1] // best[2],
            "runs_sha256": sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            "collapsed_sha256": sha(" ".join(w for k, w in enumerate(words) if k not in gone))}, i


def test_collapse_keeps_rows_and_columns(spark):
    rows = [(1, "z z z z z z y", "own"), (1, "z z z z z z y", "own"), (None, None, "own"), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = periodic_runs.collapse_runs(docs.withColumn("a.b", F.lit(1)))
    assert out.columns == ["doc_id", "a.b", "text", "n_words", "runs", "best"]
    got = sorted((r["doc_id"] or 0, r["text"], r["n_words"], len(r["runs"])) for r in rows_of(out))
    assert got == [(0, "", 0, 0), (1, "z y", 7, 1), (1, "z y", 7, 1), (2, "", 0, 0)]
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0


def test_long_repetitive_text_stays_linear():
    words = np.array([0, 1, 0, 0, 1] * 40_000, np.int64)
    assert (0, 200_000, 5) in periodic_runs.document_runs(words)


# 13 decontamination


def leak_words(text):
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text or "")) if w]


def brute_leaks(texts, items, size=10):
    windows = []
    for item, text in items:
        w = leak_words(text)
        k = min(size, len(w))
        windows += [(item, tuple(w[i:i + k])) for i in range(len(w) - k + 1) if k]
    out = []
    for text in texts:
        w, hit, named = leak_words(text), set(), set()
        for item, gram in windows:
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i:i + len(gram)]) == gram:
                    hit |= set(range(i, i + len(gram)))
                    named.add(item)
        out.append((len(w), hit, sorted(str(x) for x in named)))
    return out


def leak_fixture():
    rng = random.Random(9)
    pool = ["Ärger", "word", "I", "1984", "x9", "ﬁn", "done", "İst"]
    line = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [(1, line(30)), (2, line(10)), (10, "Two words"), (3, None), (4, ""), (5, " .,"), (6, line(12))]
    items.append((7, items[0][1].split(" ", 8)[8]))  # shares windows with item 1
    texts = [None, "", "two", "TWO-words, and two\nWORDS", line(300), items[0][1], items[1][1].upper(), "pre " + items[6][1] + " post"]
    texts += [f"{line(20)}; {items[0][1][20:90]}! {line(5)}" for _ in range(6)] + [items[0][1]] * 4 + [line(4000) + " " + items[6][1]]
    return texts, items


def test_leak_query_equals_brute_force(spark, tmp_path):
    texts, items = leak_fixture()
    folder = put(spark, tmp_path, documents=docs_table(texts), benchmark=(items, "item_id long, text string"))
    got = {r["doc_id"]: r for r in rows_of(queries.op13_decontaminate(spark, folder))}
    for i, (n, hit, named) in enumerate(brute_leaks(texts, items)):
        assert got[i] == {"doc_id": i, "n_words": n, "n_hit": len(hit), "n_items": len(named), "items_sha256": sha(",".join(named)), "contaminated": bool(hit)}, i


def test_leaks_without_broadcast(spark, tmp_path, monkeypatch):
    texts, items = leak_fixture()
    docs = spark.createDataFrame(*docs_table(texts))
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(str, rows_of(decontaminate.report(docs, tests))))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert sorted(map(str, rows_of(decontaminate.report(docs, tests)))) == want


def test_leaks_without_python_workers(spark, tmp_path):
    texts, items = leak_fixture()
    folder = put(spark, tmp_path, documents=docs_table(texts), benchmark=(items, "item_id long, text string"))
    plan = queries.op13_decontaminate(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_spans_and_documents_are_removed(spark):
    texts, items = leak_fixture()
    rows = [(i, t, "mine") for i, t in enumerate(texts)] + [(None, "two words", "mine"), (3, texts[3], "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").withColumn("row", F.lit(1)).withColumn("_doc", F.lit(2))
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks([r[1] for r in rows], items)
    cleaned = decontaminate.decontaminate(docs, tests)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    for r, (text, n, hit) in zip(sorted(rows_of(cleaned.where("doc_id is not null").dropDuplicates(["doc_id"])), key=lambda r: r["doc_id"]),
                                 [(t, n, h) for t, (n, h, _) in zip(texts, want)], strict=False):
        if not hit:
            assert r["text"] == text
        else:
            assert leak_words(r["text"]) == [w for k, w in enumerate(leak_words(text)) if k not in hit]
    left = rows_of(decontaminate.decontaminate(docs, tests, remove="documents"))
    assert sorted(r["doc_id"] for r in left) == sorted(i for (i, *_), (_, hit, _) in zip(rows, want) if not hit)
    none = decontaminate.report(docs, tests.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(rows)
    assert decontaminate.report(docs.limit(0), tests).count() == 0
