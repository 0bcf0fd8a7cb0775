"""The training-data operators against brute force, the tokenizer libraries, exact round trips and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridlake.llm import common, line_dedup, ngram_join, packing, pii, piece_codec, queries, sharding, suffix_dedup, topk_bitslice, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ta", "re", "mo", "li", "su", "ne", "ko", "vi") for b in ("ran", "lo", "pim", "ters", "ga", "d", "mu", "stel")]


def put(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def docs_table(texts, ids=None):
    ids = ids or range(len(texts))
    return [(i, t, "en", "hot" if i % 3 else f"s{i % 5}", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)], DOCS


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_texts(seed=1):
    """Null, empty, blank, one-word, long and repeated texts, copies with a change, shared passages and lines."""
    rng = random.Random(seed)
    passage, line = sentence(rng, 30), sentence(rng, 9)
    texts = [None, "", " \n\t", "one", sentence(rng, 6000), "é€😀 ﬁ Ａ １  x　y  z", "A B", "a  b", "x" * 400]
    for k in range(14):
        texts.append(f"{sentence(rng, 40)}\n{line}\n{passage} {sentence(rng, 20)}\n{sentence(rng, 8)}")
    base = sentence(rng, 80)
    for k in range(12):
        words = base.split()
        words[(7 * k) % 80] = words[(7 * k) % 80] if k < 5 else f"w{k}"
        texts.append(" ".join(words))
    texts += [line[:5] + "q" + line[6:], line[:4] + line[5:], line + "s"]
    return texts


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def reach(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return [top(x) for x in range(n)]


def brute_sets(text, words):
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if x]
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())


def brute_near(texts, words, percent):
    sets = [brute_sets(t, words) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [len(s) for s in sets], reach(len(sets), links)


def brute_lines(texts, least):
    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        i = 0
        while i < min(len(a), len(b)) and a[i] == b[i]:
            i += 1
        return a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:]

    seen, out = [], []
    for text in texts:
        kept = []
        for line in [] if text is None else text.split("\n"):
            if len(line) >= least:
                gone = any(one_edit(line, s) for s in seen)
                seen.append(line)
                if gone:
                    continue
            kept.append(line)
        out.append(None if text is None else "\n".join(kept))
    return out


# 1 exact top-k


def test_topk_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=(300, 16)), 2)
    v[100:140] = v[7]  # ties
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(300, None), (320, [1.0] * 15 + [None]), (340, [float("nan")] * 16), (360, [float("inf")] * 16), (380, [0.0] * 16), (None, [1.0] * 16)]
    found = defaultdict(list)
    folder = put(spark, tmp_path, embeddings=(rows, "vec_id long, embedding array<double>"))
    for r in queries.op1_bitslice_topk(spark, folder).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    q = {i: np.floor(64 * np.array(x)).astype(int) for i, x in rows if i is not None and x and all(c is not None and math.isfinite(c) for c in x)}
    assert set(found) == {i for i in q if i % 20 == 0}
    for i, hits in found.items():
        want = sorted(((-int(q[i] @ q[j]), j) for j in q if j != i))[:20]
        assert hits == [(k + 1, j, -s) for k, (s, j) in enumerate(want)]


def test_topk_of_few_or_no_rows(spark, tmp_path):
    folder = put(spark, tmp_path / "a", embeddings=([(0, [0.5]), (1, [0.25])], "vec_id long, embedding array<float>"))
    assert rows_of(queries.op1_bitslice_topk(spark, folder)) == [{"query_id": 0, "rank": 1, "vec_id": 1, "score": 512}]
    folder = put(spark, tmp_path / "b", embeddings=([], "vec_id long, embedding array<float>"))
    assert rows_of(queries.op1_bitslice_topk(spark, folder)) == []


def test_topk_several_blocks(spark):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(i, [int(x) for x in r]) for i, r in enumerate(rng.integers(-5, 6, (200, 4)))], "vec_id long, q array<long>")
    one = topk_bitslice.top_k(topk_bitslice.build_index(rows), rows, k=7).collect()
    many = topk_bitslice.top_k(topk_bitslice.build_index(rows, per_block=30), rows, k=7).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


# 2 embedding near-dedup


def test_lattice_links(spark, tmp_path):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 32))
    v = [b + rng.normal(size=32) * rng.choice([0.02, 0.1, 0.2]) for b in base for _ in range(8)]
    v += [v[0]] * 30
    rows = [(i, [float(x) for x in r], "l") for i, r in enumerate(v)]
    n = len(rows)
    rows += [(n, None, None), (n + 1, [0.0] * 32, ""), (n + 2, [float("nan")] * 32, ""), (n + 3, [None] * 32, ""), (n + 4, [], ""), (None, rows[0][1], "")]
    folder = put(spark, tmp_path, embeddings=(rows, "vec_id long, embedding array<double>, label string"))
    found = {r.vec_id: r for r in queries.op2_lattice_dedup(spark, folder).collect()}
    assert len(found) == len(rows)
    u = np.array(v) / np.linalg.norm(v, axis=1, keepdims=True)
    close = u @ u.T >= 0.95
    np.fill_diagonal(close, False)
    counts = np.array([found[i].n_links for i in range(n)])
    assert (counts <= close.sum(1)).all() and counts.sum() >= 0.98 * close.sum()
    whole = reach(n, zip(*np.nonzero(np.triu(close)), strict=True))
    same = sum(found[i].component_id == whole[i] for i in range(n))
    assert same >= 0.98 * n and all(whole[found[i].component_id] == whole[i] for i in range(n))
    for i in range(n, n + 5):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    parts = {r.vec_id: r.n_links for r in queries.lattice_dedup.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"), part=16).collect()}
    assert parts == {i: r.n_links for i, r in found.items()}


# 3 personal data


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms_keep_form_and_links(spark):
    texts = ["card 4111 1111 1111 1111, again 4111-1111-1111-1111.", "4111111111111111", "bad 4111 1111 1111 1112 stays", "born 1987-03-12 or 12.03.1987; 2023-02-30 stays",
             "me@site.org wrote to me@site.org", "ip 10.20.30.40 not 300.1.1.1", "ssn 123-45-6789 not 000-45-6789", "IBAN DE89 3704 0044 0532 0130 00", None, "", "plain " * 5000]
    rows = [(i, t, 9, "k") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pii int, _key string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, "key").collect()}
    assert pii.pseudonymise(df, "key").columns == ["doc_id", "text", "_key", "n_pii"] or set(pii.pseudonymise(df, "key").columns) == {"doc_id", "text", "_key", "n_pii"}
    one, two = re.findall(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", got[0].text)
    digits = one.replace(" ", "")
    assert digits == two.replace("-", "") == got[1].text != "4111111111111111" and luhn(digits)
    assert got[2].text == texts[2] and got[2].n_pii == 0
    y, d = re.search(r"\d{4}-\d\d-\d\d", got[3].text)[0], re.search(r"\d\d\.\d\d\.\d{4}", got[3].text)[0]
    assert y.split("-") == d.split(".")[::-1] and y != "1987-03-12" and "2023-02-30 stays" in got[3].text
    a, b = re.findall(r"[a-z]+@site\.org", got[4].text)
    assert a == b != "me@site.org"
    assert "300.1.1.1" in got[5].text and "10.20.30.40" not in got[5].text
    assert "000-45-6789" in got[6].text and "123-45-6789" not in got[6].text
    iban = got[7].text[5:].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and [len(x) for x in got[7].text[5:].split()] == [4, 4, 4, 4, 4, 2]
    assert (got[8].text, got[9].text, got[10].text) == (None, "", texts[10])
    other = {r.doc_id: r.text for r in pii.pseudonymise(df, key="another").collect()}
    assert other[1] != got[1].text


def test_pseudonyms_are_a_permutation(spark):
    dates = spark.range(3000).select(F.expr("cast(date_add(date'1990-01-01', cast(id as int)) as string)").alias("text"))
    got = [r.text for r in pii.pseudonymise(dates, "key").collect()]
    assert len(set(got)) == 3000 and all(re.fullmatch(r"\d{4}-\d\d-\d\d", t) for t in got)
    assert pii.pseudonymise(dates.limit(0), "key").count() == 0


# 4 sharding


def test_shards_match_the_mixture(spark, tmp_path):
    texts = [None, "", "ü", *(f"text {i % 400}" for i in range(1200))]
    folder = put(spark, tmp_path, documents=docs_table(texts))
    got = rows_of(queries.op4_stratified_shards(spark, folder))
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    by = defaultdict(list)
    for r in got:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 8, zlib.crc32(text), "rows")
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    total = Counter(r["source"] for r in got)
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        here = Counter(r["source"] for r in rows)
        assert all(abs(here[s] - n / 24) <= 2 for s, n in total.items())


def test_shards_of_small_buckets_nulls_and_nothing(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, "a").alias("source"), F.lit(1).alias("n"))
    got = sharding.interleave(df, shards=7, per_bucket=20).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [71] * 4 + [72] * 3
    assert len({(r.shard, r.slot) for r in got}) == 500
    assert sharding.interleave(df.limit(0), shards=7).collect() == []


# 5 toxicity


def toxic_corpus(n=900):
    rng = random.Random(9)
    bad = ["grumpfol", "zackelwurm", "pimpeltrop"]
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, 25).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                term = rng.choice(bad)
                if i % 30 == 0:
                    term = term[:3] + "x" + term[4:]
                words.insert(rng.randrange(25), term)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows + [(n, None), (n + 1, ""), (None, "ta")], labels + [(n + 7, None)]


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = toxicity.rate(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    judged = [(truth[r.doc_id], r.predicted) for r in held if r.doc_id in truth]
    assert sum(p for t, p in judged if t) >= 0.9 * sum(t for t, _ in judged) and not any(p for t, p in judged if not t)
    assert all(r.predicted == 0 for r in got if r.doc_id is None or r.doc_id >= 900)


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.rate(docs, none).collect()] == [0, 0]
    assert toxicity.rate(docs.limit(0), none).collect() == []


# 6 suffix arrays


def brute_repeats(texts, length):
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if s in seen:
                gone[i:i + length] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, tmp_path, seed):
    texts = odd_texts(seed) + ["ab" * 300, "abc" * 200 + "tail", "ü" * 180]
    folder = put(spark, tmp_path, documents=docs_table(texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op6_suffix_dedup(spark, folder).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, 100)


def test_repeats_of_short_strings_nulls_and_nothing(spark):
    texts = ["abcabcabc", "xabcx", None, "bcabx", ""]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, length=3, size=2).collect()}
    assert [got[i] for i in range(5)] == brute_repeats(texts, 3)
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    s = np.append(rng.integers(1, 3 + seed * 20, 400), 0).astype(np.uint16)
    if seed % 2:
        s[:-1] = np.tile(s[:40], 10)
    table = suffix_dedup.suffix_array(s)
    assert table.tolist() == sorted(range(401), key=lambda i: s[i:].tolist())
    prefix = suffix_dedup.common_prefixes(s, table, 50)
    for a, b in zip(table[:-1].tolist(), table[1:].tolist(), strict=True):
        n = 0
        while s[a + n] == s[b + n]:
            n += 1
        assert prefix[b] == min(n, 50)


# 7 pieces


def test_pieces_equal_the_library(spark, tmp_path):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(2)
    texts = odd_texts() + ["  a  b ", "▁x▁▁y", "<s> </s> <unk> <0x0A>", "a\r\n\tb\x00c", "…½™ ŉ Ǆ ﷺ", "سلام 你好 हिन्दी", "aaaaaaaaaaaaaaaa" * 40]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FF), rng.randrange(0x3000, 0x4FFF), rng.randrange(0x1F300, 0x1F6FF)])) for _ in range(80)) for _ in range(60)]
    folder = put(spark, tmp_path, documents=docs_table(texts))
    got = {r.doc_id: r for r in queries.op7_piece_codec(spark, folder).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), t
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest(), t


def test_pieces_round_trip_and_nothing(spark):
    df = spark.createDataFrame([(1, "Some plain words, twice some."), (2, None)], "doc_id long, text string")
    coded = piece_codec.encode_documents(df, with_ids=True)
    assert {"doc_id", "ids"} <= set(coded.columns)
    assert piece_codec.encode_documents(df.limit(0)).collect() == []


# 8 lines


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = odd_texts(seed)
    pool = [sentence(rng, rng.randrange(3, 9)) for _ in range(25)]
    for _ in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            line = rng.choice(pool)
            at = rng.randrange(len(line))
            lines.append(rng.choice([line, line[:at] + line[at + 1:], line[:at] + "#" + line[at:], line[:at] + "~" + line[at + 1:], sentence(rng, 7)]))
        texts.append("\n".join(lines))
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_lines string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts, line_dedup.LEAST)
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []


class Captured:
    """A table that only keeps what ``mapInArrow`` is given."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_variants_of_long_lines_leave_in_small_batches(monkeypatch):
    rng = random.Random(7)
    lines = ["".join(rng.choice("abcdefgh 0123456789") for _ in range(n)) for n in (30_000, 20, 21, 64, 1500, 900, 9000)] + ["x\U0001F600" * 40]
    sides = [[{"side": s, "q": len(x) // 8 * 2} for s in rng.sample(range(4), k)] for x, k in zip(lines, (4, 1, 0, 4, 3, 2, 4, 1), strict=True)]
    batch = pa.RecordBatch.from_arrays([pa.array(lines), pa.array(range(8), pa.int64()), pa.array(range(8, 0, -1), pa.int64()),
                                        pa.array(sides, pa.list_(pa.struct([("side", pa.int32()), ("q", pa.int32())])))], names=["line", "h1", "h2", "sides"])
    monkeypatch.setattr(line_dedup, "VARIANTS", 500, raising=False)
    out = list(line_dedup.variant_rows(Captured())([batch, batch.slice(0, 0), batch.slice(1, 3)]))
    assert max(b.num_rows for b in out) <= 1000
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    want, text_of = [], {}
    for i in [*range(8), 1, 2, 3]:
        n = len(lines[i])
        places = sorted({p for s in sides[i] for p in range((3 - s["side"]) * s["q"], n - s["side"] * s["q"])})
        want += [(p, i, 8 - i) for p in [*places, -1]]
    assert [r[1:] for r in rows] == want
    for key, at, i, _ in rows:
        if len(lines[i]) < 2000:
            left = lines[i] if at < 0 else lines[i][:at] + lines[i][at + 1:]
            assert text_of.setdefault(key, left) == left
    assert len(set(text_of.values())) == len(text_of)


def test_keys_of_lines_are_made_once_and_compiled(spark, monkeypatch):
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("abcdefgh\u00e9\U0001F600 0123456789") for _ in range(n))
    near, alone = [], []
    for n in (20, 23, 24, 40, 47, 48, 200):
        base, at = line(n), rng.randrange(n)
        near += [base, rng.choice([base[:at] + "#" + base[at:], base[:at] + "#" + base[at + 1:]])]
        other = line(80)
        alone += [other, other[:40] + line(40), line(40) + other[40:], line(n)]  # sharing a half is not enough
    made, asked = [], []
    rows, variants = line_dedup.line_rows, line_dedup.variant_rows
    monkeypatch.setattr(line_dedup, "line_rows", lambda *a: made.append(rows(*a)) or made[-1])
    monkeypatch.setattr(line_dedup, "variant_rows", lambda lines: asked.extend(r.line for r in lines.select("line").collect()) or variants(lines))
    texts = [*near, *alone, near[0], alone[0]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts, line_dedup.LEAST)
    assert sorted(asked) == sorted(near)
    assert len(made) == 1
    sizes = []
    for keys in (made[0], line_dedup.keyed_lines(df.select(F.col("text").alias("line"), F.xxhash64("text").alias("h1")))):
        code = spark._jvm.PythonSQLUtils.explainString(keys._jdf.queryExecution(), "codegen")
        sizes += map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))
    assert len(sizes) >= 2 and max(sizes) < 8000  # longer methods are never compiled by the JVM


# 9 n-gram join


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_join_equals_brute_force(spark, words, percent, monkeypatch):
    texts = odd_texts() + odd_texts(2) + odd_texts(1)[9:20]
    if words == 2:
        monkeypatch.setattr(ngram_join, "PART", 3)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_documents(df, words, percent).collect()}
    sizes, classes = brute_near(texts, words, percent)
    assert [got[i] for i in range(len(texts))] == list(zip(sizes, classes, strict=True))


def test_join_of_null_ids_and_nothing(spark):
    df = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (9, "A B  C D"), (7, None)], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in ngram_join.near_documents(df).collect()}
    assert got == {(None, None), (4, 4), (9, 4), (7, 7)}
    assert ngram_join.near_documents(df.limit(0)).collect() == []


# 10 packing


def check_packing(texts, rows, capacity=2048):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for i, t in texts.items():
        ids, at = [*tok.encode(t or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing_covers_all_tokens(spark, tmp_path):
    texts = odd_texts() + ["<|endoftext|> x", "y" * 9000]
    folder = put(spark, tmp_path, documents=docs_table(texts))
    rows = rows_of(queries.op10_tournament_packing(spark, folder))
    used = check_packing(dict(enumerate(texts)), rows)
    assert used <= math.ceil(sum(r["length"] for r in rows) / 2048) + 1


def test_first_fit_decreasing_equals_plain_search():
    lengths = np.random.default_rng(1).integers(1, 100, 300)
    bins, offsets = packing.first_fit_decreasing(lengths, 128)
    room = []
    for i in np.argsort(-lengths, kind="stable"):
        at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        if at == len(room):
            room.append(128)
        assert (bins[i], offsets[i]) == (at, 128 - room[at])
        room[at] -= lengths[i]


# pipeline


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    rows, labels = toxic_corpus(400)
    rng = random.Random(4)
    texts = [t for i, t in rows if i is not None]
    texts += [t for t in odd_texts() if t != "x" * 400] + [f"{sentence(rng, 30)}\ncall 4111 1111 1111 1111 now please\n{sentence(rng, 30)}"]
    folder = put(spark, tmp_path, documents=docs_table(texts), labels=(labels, "doc_id long, toxic int"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
            out.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            after = {r.doc_id: r.text for r in docs.collect()}
        ids = sorted(before)
        if name == "toxicity":
            truth = dict(labels)
            gone = set(before) - set(after)
            assert all(truth.get(i) for i in gone) and len(gone) >= 0.85 * sum(t or 0 for t in truth.values())
        elif name == "line_dedup":
            want = dict(zip(ids, brute_lines([before[i] for i in ids], line_dedup.LEAST), strict=True))
            assert after == {i: t for i, t in want.items() if t == before[i] or (t and t.strip())}
        elif name == "ngram_join":
            classes = brute_near([before[i] for i in ids], 5, 80)[1]
            assert after == {i: before[i] for k, i in enumerate(ids) if classes[k] == k}
        elif name == "pii":
            assert set(after) == set(before)
            changed = {i for i in ids if after[i] != before[i]}
            assert changed == {len(texts) - 1} and "4111" not in after[len(texts) - 1]
        else:
            check_packing(before, rows_of(out))
        kept.append(len(before))
    assert kept == sorted(kept, reverse=True) and kept[-1] > 250
    assert corpus_pipeline.run(spark, folder).select("doc_id").distinct().count() == kept[-1]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    folder = put(spark, tmp_path, documents=([], DOCS), labels=([], "doc_id long, toxic int"))
    assert corpus_pipeline.run(spark, folder).collect() == []


@pytest.mark.parametrize("sent", [0, 1_000_000])
def test_a_candidate_met_at_several_ngrams_is_verified_once(spark, monkeypatch, sent):
    monkeypatch.setattr(ngram_join, "SENT", sent)
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "other words stand here"), (4, None)], "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 2, 7), (2, 1, 8), (1, 2, 9), (3, 1, 7)], "a long, b long, raw long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ngram_join.verified(pairs, docs, 3, 90)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, found.select("a", "b", "raw", "linked").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(1, 2, 7, True), (1, 2, 8, True), (1, 2, 9, True), (1, 3, 7, False)]
    assert ("BroadcastHashJoin [doc_id" in plan) == (sent > 0)  # texts that are in no pair stay where they are


def test_sets_of_unlike_size_do_not_meet(spark):
    rows = [(sid, n, g, sid, True) for sid, n, first in ((1, 100, 0), (2, 300, 0), (3, 100, 50), (4, 105, 50)) for g in range(first, first + 30)]
    kept = ngram_join.telling(spark.createDataFrame(rows, "sid long, n long, g long, label long, early boolean"), 90)
    assert {(r.sid, r.n) for r in kept.collect()} == {(3, 100), (4, 105)}


def test_cards_are_small_and_tell_texts_apart():
    keys = np.random.default_rng(5).integers(0, 1 << 56, 3000, dtype=np.uint64)
    sets = {1: keys[:1000], 2: keys[40:1030], 3: keys[1000:2000], 4: keys[300:1300]}
    cards = [(sid, len(k), ngram_join.parity_bits(k, 90), sid, True, 0) for sid, k in sets.items()]
    assert all(len(bits) <= 256 for _, _, bits, *_ in cards)
    assert [set(pair) for pair in ngram_join.candidates(cards, 90, False, False)] == [{1, 2}]
    assert list(ngram_join.candidates(cards, 90, False, True)) == []


@pytest.mark.parametrize("part", [3, 1000])
def test_near_copies_about_the_threshold(spark, monkeypatch, part):
    monkeypatch.setattr(ngram_join, "PART", part)
    rng, texts = random.Random(8), []
    for base in (sentence(rng, 130), sentence(rng, 160)):
        for _ in range(40):
            words = base.split()
            for at in rng.sample(range(len(words)), rng.randrange(4)):
                words[at] += "x"
            texts.append(" ".join(words[rng.randrange(6):]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_documents(df, 3, 90).collect()}
    assert [got[i] for i in range(len(texts))] == list(zip(*brute_near(texts, 3, 90), strict=True))


@pytest.mark.parametrize("least", [7, 500_000])
def test_components_of_links_in_one_task_and_in_several(spark, monkeypatch, least):
    monkeypatch.setattr(common, "CONTRACTED", least)
    rng = random.Random(4)
    links = [(i + 1, i) for i in range(30)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(35)] + [(300, 300 + i) for i in range(20)]
    low = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in low:
        for a, b in links:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    got = common.components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()
    assert len(got) == len(low) and {r.id: r.component_id for r in got} == low
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []
