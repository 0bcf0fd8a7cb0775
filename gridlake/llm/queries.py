"""One registered query per operator, with production parameters over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, lattice_dedup, line_dedup, ngram_join, packing, periodic_runs, pii, piece_codec, sharding, spelling_variants,
               suffix_dedup, topk_bitslice, toxicity)
from .common import settle, table, text_batches


def op1_bitslice_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk_bitslice.quantised(table(text_batches(spark), sf_dir, "embeddings"), factor=64)
    index = settle(topk_bitslice.build_index(rows))
    return topk_bitslice.top_k(index, rows.where("vec_id % 20 = 0"), k=20)


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(table(text_batches(spark), sf_dir, "embeddings"), least=0.95)


def op3_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pseudonym_key(spark)).select("doc_id", "text", "n_pii")


def pseudonym_key(spark: SparkSession) -> str:
    """The secret of the session (``spark.gridlake.pseudonym.key``). The tables here are invented, so a stated one serves where none is set."""
    return spark.conf.get("spark.gridlake.pseudonym.key", None) or "no secret: invented tables"


def op4_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return sharding.interleave(rows, shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"), "source")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(text_batches(spark), sf_dir, "documents")
    return toxicity.rate(docs, table(spark, sf_dir, "labels"), threshold=0.7).select("doc_id", "held_out", "score", "predicted", "n_hits")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(text_batches(spark), sf_dir, "documents"), length=100)


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_documents(table(text_batches(spark), sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(text_batches(spark), sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_documents(table(text_batches(spark), sf_dir, "documents"), words=3, percent=90)


def op10_tournament_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(text_batches(spark), sf_dir, "documents"), capacity=2048, end_id=1)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(typed_words(table(text_batches(spark), sf_dir, "documents")), least_length=7, least_count=2, ratio=10)


def typed_words(docs: DataFrame) -> DataFrame:
    """``word``: runs of letters of seven or more, A-Z lower-cased, with one letter gone from those whose hash with the document's id says so."""
    run = F.regexp_extract_all("text", F.lit("([A-Za-z\u00C0-\u00FF]{7,})"), F.lit(1))
    words = docs.select("doc_id", F.explode(run).alias("w")).withColumn("w", F.translate("w", decontaminate.UPPER, decontaminate.LOWER))
    words = words.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "w").cast("binary")))
    gone = F.expr("concat(left(w, int(h % char_length(w))), substring(w, int(h % char_length(w)) + 2))")
    return words.select(F.when(F.col("h") % 31 == 0, gone).otherwise(F.col("w")).alias("word"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(text_batches(spark), sf_dir, "documents").select("doc_id", "text")
    rows = periodic_runs.collapse_runs(looped(docs), least_length=6, least_exponent=4)
    listing = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))


def looped(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with the end of each tenth text, by the hash of its id, replaced by repetitions of a stretch of its words."""
    cut = docs.withColumns({"h": F.crc32(F.col("doc_id").cast("string").cast("binary")),
                            "w": F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")})
    chosen = F.coalesce((F.col("h") % 10 == 0) & (F.size("w") > 0), F.lit(False))
    sized = cut.withColumns({"g": F.floor(F.col("h") / 10), "n": F.size("w").cast("long")}).withColumn("a", F.col("g") % F.greatest(F.col("n"), F.lit(1)))
    sized = sized.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.expr("array_join(transform(sequence(0L, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return sized.select("doc_id", F.when(chosen, again).otherwise(F.col("text")).alias("text"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=10)
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), ids.alias("items_sha256"), "contaminated")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_bitslice_topk, op2_lattice_dedup, op3_feistel_pii, op4_stratified_shards, op5_toxicity, op6_suffix_dedup, op7_piece_codec,
    op8_line_dedup, op9_ngram_join, op10_tournament_packing, op11_spelling_variants, op12_periodic_runs, op13_decontaminate)}

# CRC-32 of a text, by the reflected polynomial, a byte at a time.
CRC_SQL = """crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i, [1::bigint, 2, 3, 4, 5, 6, 7, 8]), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i)))"""


def crc_sql(text: str) -> str:
    """SQL for the unsigned CRC-32 of the UTF-8 bytes of ``text``, with ``crc_table.t`` in scope."""
    byte = f"cast(('0x' || substr(hex(encode({text})), 2 * k - 1, 2)) as bigint)"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, octet_length(encode({text})) + 1), lambda k: {byte})), "
            "lambda c, b: xor(c >> 8, crc_table.t[1 + (xor(c, b) & 255)])))")


SQL = {
    "op1_bitslice_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as query_id, b.vec_id as vec_id,
         cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20""",
    "op2_lattice_dedup": """
with recursive v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings),
pairs as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id as a, vec_id as b from v union select r.a, p.b from reach r join pairs p on r.b = p.a),
classes as (select a, min(b) as component_id from reach group by a),
degrees as (select a, count(*) as n from pairs group by a)
select v.vec_id, coalesce(d.n, 0) as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join classes c on c.a = v.vec_id left join degrees d on d.a = v.vec_id""",
    "op8_line_dedup": """
with cut as (select doc_id, string_split(text, chr(10)) as l from documents where text is not null),
lines as (select doc_id, unnest(range(len(l))) as no, unnest(l) as line from cut),
kinds as (select line, min((doc_id, no)) as first from lines where length(line) >= 20 group by line),
variants as (
  select line, first, i, substr(line, 1, i - 1) || substr(line, i + 1) as v
  from (select line, first, unnest(range(1, length(line) + 1)) as i from kinds)),
near as (
  select a.line from variants a join variants b on a.v = b.v and a.i = b.i and b.first < a.first
  union select a.line from variants a join kinds b on a.v = b.line and b.first < a.first
  union select b.line from variants a join kinds b on a.v = b.line and a.first < b.first),
judged as (
  select l.doc_id, l.no, l.line,
         k.line is not null and (k.first <> (l.doc_id, l.no) or n.line is not null) as gone
  from lines l left join kinds k on k.line = l.line left join near n on n.line = l.line),
kept as (
  select doc_id, count(*) as n_lines, cast(count(*) filter (gone) as bigint) as n_removed,
         md5(coalesce(string_agg(line, chr(10) order by no) filter (not gone), '')) as kept_md5
  from judged group by doc_id)
select d.doc_id, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed, k.kept_md5
from documents d left join kept k using (doc_id)""",
    "op9_ngram_join": r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
grams as (select doc_id, len(s) as n, unnest(s) as g from sets),
rare as (select *, row_number() over (partition by doc_id order by c, g) as r from (select *, count(*) over (partition by g) as c from grams)),
cand as (
  select distinct a.doc_id as a, b.doc_id as b from rare a join rare b
  on a.g = b.g and a.doc_id < b.doc_id and a.r <= a.n - ceil(0.9 * a.n) + 2 and b.r <= b.n - ceil(0.9 * b.n) + 2),
pairs as (
  select a, b from cand join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * len(list_intersect(x.s, y.s)) >= 90 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))),
both_ways as (select a, b from pairs union select b, a from pairs),
reach as (select doc_id as a, doc_id as b from sets union select r.a, p.b from reach r join both_ways p on r.b = p.a),
classes as (select a, min(b) as component_id from reach group by a)
select s.doc_id, coalesce(len(s.s), 0) as n_shingles, c.component_id from sets s join classes c on c.a = s.doc_id""",
    "op11_spelling_variants": f"""
with recursive {CRC_SQL},
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w
  from documents),
each_run as (select doc_id, w, count(*) as k from runs where length(w) >= 7 group by doc_id, w),
hashed as (select w, k, {crc_sql("doc_id || ':' || w")} as h from each_run, crc_table),
typed as (select k, case when h % 31 = 0 then substr(w, 1, cast(h % length(w) as int)) || substr(w, cast(h % length(w) as int) + 2) else w end as word from hashed),
vocab as (select word, cast(sum(k) as bigint) as n from typed where length(word) >= 7 group by word having sum(k) >= 2),
cuts as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as v from (select word, n, unnest(range(1, length(word) + 1)) as i from vocab)),
pairs as (
  select a.word as u, b.word as v from cuts a join cuts b on a.v = b.v and a.i = b.i and a.word <> b.word
  union select a.word, b.word from cuts a join vocab b on a.v = b.word
  union select b.word, a.word from cuts a join vocab b on a.v = b.word),
near as (select p.u as word, p.v as near, q.n as near_n from pairs p join vocab q on q.word = p.v),
best as (select word, count(*) as n_near, min((-near_n, near)) as b from near group by word),
rated as (
  select v.word, v.n, coalesce(b.n_near, 0) as n_near, case when -b.b[1] >= 10 * v.n then b.b[2] end as form,
         cast(case when -b.b[1] >= 10 * v.n then -b.b[1] end as bigint) as form_n
  from vocab v left join best b on b.word = v.word),
chain as (select word, word as at, form from rated union all select c.word, c.form, r.form from chain c join rated r on r.word = c.form)
select r.word, r.form, c.at as root, r.n, r.n_near, r.form_n from rated r join chain c on c.word = r.word and c.form is null""",
    "op13_decontaminate": r"""
with cut as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
items as (
  select cast(item_id as varchar) as item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
sized as (select *, least(len(w), 10) as n from items where len(w) > 0),
grams as (select distinct item, n, array_to_string(w[p:p + n - 1], ' ') as gram from (select *, unnest(range(1, len(w) - n + 2)) as p from sized)),
lengths as (select distinct n from grams),
spots as (select doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') as gram
          from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p from cut, lengths where len(w) >= n)),
found as (select s.doc_id, s.p, s.n, g.item from spots s join grams g on g.n = s.n and g.gram = s.gram),
words as (select distinct doc_id, unnest(range(p, p + n)) as at from (select distinct doc_id, p, n from found)),
hit as (select doc_id, count(*) as n_hit from words group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct doc_id, item from found) group by doc_id)
select c.doc_id, cast(len(c.w) as bigint) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(m.n_items, 0) as n_items,
       sha256(coalesce(m.ids, '')) as items_sha256, h.n_hit is not null as contaminated
from cut c left join hit h using (doc_id) left join named m using (doc_id)""",
}
