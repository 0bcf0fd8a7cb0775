"""Top-k of large numbers, pseudonyms undone by an independent Feistel, the automaton against edit distance, context, sharding by a plain sort, clashing names."""

import hashlib
import random
import re
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import line_dedup, packing, pii, piece_codec, sharding, suffix_dedup, topk_bitslice, toxicity

KEY = "a key"


# 1 exact top-k


def test_large_components_take_part(spark):
    rng = np.random.default_rng(1)
    v = [[float(x) for x in rng.normal(size=3)] for _ in range(60)]
    v += [[3e6, 1.0, 0.0], [1e9, -2.0, 0.5], [-4e10, 0.25, 1.0], [0.5, 1e12, 3.0]]
    rows = spark.createDataFrame([(i, x, 1) for i, x in enumerate([*v, v[3]])], "vec_id long, embedding array<double>, q int")
    again = rows.unionByName(rows.where("vec_id = 5"))  # the same row twice counts once
    quantised = topk_bitslice.quantised(again)
    got = topk_bitslice.top_k(topk_bitslice.build_index(quantised), quantised.where("vec_id < 4 or vec_id >= 60"), k=5)
    q = {i: [int(np.floor(64 * x)) for x in e] for i, e in enumerate([*v, v[3]])}
    for i in [*range(4), *range(60, 65)]:
        want = sorted(((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j) for j in q if j != i))[:5]
        hits = got.where(F.col("query_id") == i).orderBy("rank").collect()
        limit = (1 << 63) - 1
        if all(abs(s) <= limit for s, _ in want):
            assert [(r["vec_id"], r["score"]) for r in hits] == [(j, -s) for s, j in want]


# 3 personal data: the permutation once more, in Python


def noise(kind, turn, half, key=KEY):
    return int(hashlib.sha256(f"{key}|{kind}|{turn}|{half}".encode()).hexdigest()[:15], 16)


def feistel(kind, left, right, left_size, right_size, back=False):
    for i in range(8, 0, -1) if back else range(1, 9):
        sign = -1 if back else 1
        if i % 2 == 0:
            left = (left + sign * noise(kind, i, right)) % left_size
        else:
            right = (right + sign * noise(kind, i, left)) % right_size
    return left, right


def day_turned(n, back=False):
    left, right = feistel("date", n // 773, n % 773, 189, 773, back)
    return left * 773 + right


def undone_date(text):
    """The date behind a pseudonym with slashes: month first if that is a date, else day first."""
    a, b, y = (int(x) for x in text.split("/"))
    start = date(1800, 1, 1)
    if a <= 12:
        n = day_turned((date(y, a, b) - start).days, back=True)
        return (start + timedelta(n)).strftime("%m/%d/%Y")
    n = day_turned((date(y, b, a) - start).days, back=True)
    while (start + timedelta(n)).day <= 12:
        n = day_turned(n, back=True)
    return (start + timedelta(n)).strftime("%d/%m/%Y")


def pseudonyms(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string").repartition(4)
    return [r["text"] for r in pii.pseudonymise(df, KEY).orderBy("doc_id").collect()]


def test_slash_dates_are_permuted_and_can_be_undone(spark):
    days = [date(1900, 1, 1) + timedelta(k) for k in range(80_000)]
    values = sorted({d.strftime("%m/%d/%Y") for d in days} | {d.strftime("%d/%m/%Y") for d in days})
    assert len(values) > 100_000
    got = pseudonyms(spark, values)
    assert len(set(got)) == len(values)
    assert [undone_date(x) for x in got[::37]] == values[::37]


def test_social_security_numbers_stay_valid(spark):
    rng = random.Random(3)
    valid = re.compile(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}")
    values = sorted({f"{rng.randint(1, 899):03}-{rng.randint(1, 99):02}-{rng.randint(1, 9999):04}" for _ in range(20_000)} - {f"666-{0:02}"})
    values = [v for v in values if valid.fullmatch(v)]
    got = pseudonyms(spark, values)
    assert all(valid.fullmatch(x) for x in got) and len(set(got)) == len(values)

    def undone(text):
        digits = text.replace("-", "")
        while True:
            left, right = feistel("ssn", int(digits[:4]), int(digits[4:]), 10_000, 100_000, back=True)
            digits = f"{left:04}{right:05}"
            if valid.fullmatch(f"{digits[:3]}-{digits[3:5]}-{digits[5:]}"):
                return f"{digits[:3]}-{digits[3:5]}-{digits[5:]}"

    assert [undone(x) for x in got[::101]] == values[::101]


def test_cards_phones_and_addresses_equal_the_plain_permutation(spark):
    got = pseudonyms(spark, ["call 555-123-4567", "10.20.30.40", "4111 1111 1111 1111"])
    left, right = feistel("phone", 55512, 34567, 100_000, 100_000)
    assert got[0] == "call {}-{}-{}".format(*(lambda d: (d[:3], d[3:6], d[6:]))(f"{left:05}{right:05}"))
    left, right = feistel("ip", 10 * 256 + 20, 30 * 256 + 40, 65536, 65536)
    assert got[1] == f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    left, right = feistel("card", 4111111, 11111111, 10**7, 10**8)
    assert got[2].replace(" ", "")[:15] == f"{left:07}{right:08}"


def test_letters_of_all_alphabets_are_replaced(spark):
    values = ["ссылка@site.org", "ünalçelik@site.org", "名前名前@site.org", "ünalçelik@site.org"]
    got = pseudonyms(spark, values)
    assert got[1] == got[3] and all(g.endswith("@site.org") and len(g) == len(v) for g, v in zip(got, values, strict=True))
    for g, v in zip(got[:3], values[:3], strict=True):
        local, was = g.split("@")[0], v.split("@")[0]
        assert sum(a != b for a, b in zip(local, was, strict=True)) >= len(was) - 2
        assert all(ord(a) // 32 == ord(b) // 32 for a, b in zip(local, was, strict=True) if ord(b) > 127)


def test_pseudonyms_keep_columns_rows_and_need_a_key(spark):
    rows = [(1, "ssn 123-45-6789", "own"), (1, "ssn 123-45-6789", "own"), (2, None, None), (3, "x 1 " * 60_000 + "123-45-6789", "own")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _pii string")
    out = pii.pseudonymise(df, KEY).collect()
    assert sorted((r["_pii"] or "") for r in out) == ["", "own", "own", "own"]
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[3]["n_pii"] == 1 and by_id[3]["text"][-11:] == by_id[1]["text"][-11:]
    with pytest.raises(ValueError):
        pii.pseudonymise(df, "")


# 4 sharding by a plain sort


def test_interleaving_equals_a_plain_sort(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("aaaaaabbc") if i % 50 else None, f"t{i % 40}", i % 7, "x") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, _h int, slot string")
    got = sharding.interleave(df, shards=9, per_bucket=50)
    assert got.columns == ["doc_id", "source", "text", "_h", "shard", "slot"]
    # The order once more: rank within the stratum by hash, a seeded phase, then one sort of everything.
    plain = df.drop("slot")
    keyed = plain.select("*", F.xxhash64(*plain.columns, F.lit(11)).alias("h"), F.coalesce("source", F.lit("\x00null")).alias("s"))
    keyed = keyed.withColumn("phase", sharding.unit(F.xxhash64("s", F.lit(12)))).collect()
    by_stratum = {}
    for r in sorted(keyed, key=lambda r: (r["h"] % (1 << 64), r["h"], r["doc_id"])):
        by_stratum.setdefault(r["s"], []).append(r)
    order = sorted((((k + r["phase"]) / len(held), s, k), r["doc_id"]) for s, held in by_stratum.items() for k, r in enumerate(held))
    want, n = {}, len(rows)
    for at, (_, doc) in enumerate(order):
        shard = at * 9 // n
        want[doc] = (shard, at - -(-shard * n // 9))
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got.collect()} == want


# 5 toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(6)
    letters = "abcdé"
    word = lambda least, most: "".join(rng.choice(letters) for _ in range(rng.randint(least, most)))
    whole = sorted({word(3, 11) for _ in range(25)})
    beginnings = sorted({word(4, 5) for _ in range(4)})
    lexicon = toxicity.Lexicon([*("=" + w for w in whole), *beginnings])
    words = {word(1, 12) for _ in range(2500)}
    for w in whole:
        for _ in range(25):
            letters_of = list(w)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(letters_of) + 1)
                letters_of[at:at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters), "z"])
            words.add("".join(letters_of))
    for w in words:
        if any(w.startswith(b) for b in beginnings):
            want = 1.0
        else:
            near = [d for t in whole if (d := distance(w, t)) <= (0 if len(t) < 5 else 1 if len(t) < 8 else 2)]
            want = (1.0, 0.7, 0.4)[min(near)] if near else 0.0
        assert lexicon.strength(w) == want, w


def test_automaton_restarts_within_bounds(monkeypatch):
    monkeypatch.setattr(toxicity, "STATES", 20)
    lexicon = toxicity.Lexicon(["=horrible", "=dreadful"])
    rng = random.Random(7)
    for _ in range(50):
        lexicon.hits({"".join(rng.choice("abcdefhilorub") for _ in range(9)) for _ in range(5)} | {"horible"})
        assert len(lexicon.sets) < 20 + 200
    assert lexicon.hits({"horible"}) == {"horible": 0.7}


def test_a_hit_deep_inside_a_quotation_is_weaker():
    lexicon = toxicity.Lexicon(["=zorgle"])
    filler = " ".join(f"w{k}" for k in range(40))
    hit = lambda text, cues=frozenset(): toxicity.features(text, lexicon, cues)[1]
    assert hit(f'he wrote “{filler} zorgle {filler}” and left') == [(42, 0.3)]
    assert hit(f"{filler} zorgle {filler}") == [(40, 1.0)]
    assert hit(f'“{filler}” zorgle “{filler}”') == [(40, 1.0)]
    assert hit(f'“{filler} zorgle {filler}') == [(40, 1.0)]  # never closed
    assert hit(f"{filler} allegedly zorgle", frozenset({"allegedly"})) == [(41, 0.3)]


def test_cues_are_learned(spark):
    rng = random.Random(8)
    filler = lambda: " ".join(rng.choice(["north", "river", "stone", "lamp", "green"]) for _ in range(12))
    docs = [(i, f"{filler()} zorgle {filler()}", 1) for i in range(400)]
    docs += [(i, f"{filler()} allegedly zorgle {filler()}", 0) for i in range(400, 440)] + [(i, filler(), 0) for i in range(440, 900)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = toxicity.learn(frame.drop("toxic"), frame.select("doc_id", "toxic"))
    assert model.cues == ["allegedly"]
    rows = spark.createDataFrame([(1, "you zorgle"), (2, "allegedly zorgle"), (3, "you zorgle"), (4, "word " * 50_000), (None, None)], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(rows, model).collect()}
    assert scores[1] == scores[3] > scores[2] and scores[4] == pytest.approx(scores[None], abs=0.2)


def test_learning_moves_no_text(spark):
    """The sample is a bounded list of ids that goes to the texts."""
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    first = docs.select("doc_id", F.lit(1).alias("toxic")).orderBy(F.xxhash64("doc_id")).limit(10)
    plan = docs.join(F.broadcast(first), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


# 7, 8, 10: round trips and clashing names


def test_documents_decode_to_what_was_encoded(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["Hello  world", "é€😀 ﬁ", "", "a\nb\tc", "word " * 300]
    ids = spark.createDataFrame([(i, library.encode(t)) for i, t in enumerate(texts)], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in piece_codec.decode_documents(ids).collect()}
    assert got == {i: library.decode(library.encode(t)) for i, t in enumerate(texts)}


def test_line_columns_of_any_name_are_kept(spark):
    line = "a line that is long enough to count"
    rows = [(1, f"{line}\nshort", "g", 7, 8, 9), (2, line, "h", 7, 8, 9), (2, line, "h", 7, 8, 9), (3, None, None, None, None, None), (4, "x " * 100_000, "i", 1, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone string, _doc int, doc int, row int").withColumn("a.b", F.lit(1))
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed"]
    got = sorted((r["doc_id"], r["text"], r["_gone"], r["_doc"], r["doc"], r["row"], r["a.b"], r["n_removed"]) for r in out.where("doc_id < 3").collect())
    assert got == [(1, f"{line}\nshort", "g", 7, 8, 9, 1, 0), (2, "", "h", 7, 8, 9, 1, 1), (2, "", "h", 7, 8, 9, 1, 1)]
    assert out.where("doc_id = 4").first()["text"] == "x " * 100_000


def test_packing_refuses_its_own_names(spark):
    pieces = spark.createDataFrame([(1, 0, 3, 9, 3)], "doc_id long, start long, length long, ids_crc32 long, offset long")
    with pytest.raises(ValueError):
        packing.pack(pieces)


# 6 suffix arrays


def text_of(size, seed, letters):
    rng = np.random.default_rng(seed)
    body = rng.integers(2, 2 + letters, size)
    for _ in range(30):  # copied passages, as in a corpus
        a, b, n = rng.integers(0, size - 5000, 2).tolist() + [int(rng.integers(50, 4000))]
        body[b:b + n] = body[a:a + n]
    body[size // 2:size // 2 + 3000] = 5  # a run of one character
    return np.append(body, 0)


@pytest.mark.parametrize(("size", "letters"), [(1_000_000, 30), (300_000, 3)])
def test_suffix_array_of_a_megabyte(size, letters):
    s = text_of(size, size, letters)
    table = suffix_dedup.suffix_array(s)
    assert np.array_equal(np.sort(table), np.arange(len(s)))
    raw = s.astype(np.uint8).tobytes()
    order = table.tolist()
    assert all(raw[a:a + 64] < raw[b:b + 64] or raw[a:] < raw[b:] for a, b in zip(order, order[1:], strict=False))


def test_long_texts_in_slices(spark, monkeypatch):
    rng = random.Random(9)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = line(700)
    rows = [(1, line(900) + passage + line(300)), (2, line(100) + passage[50:] + line(2000) + passage), (3, passage[:400]), (3, passage[:400])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, suffix_dedup.remove_repeats(df, 100).collect()))
    monkeypatch.setattr(suffix_dedup, "SLICE", 256)
    assert sorted(map(str, suffix_dedup.remove_repeats(df, 100).collect())) == want
