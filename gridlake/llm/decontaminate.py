"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every token window of the corpus.

Built-in expressions and joins only. Words are runs of digits, letters and code points beyond ASCII; A-Z are lower-cased, nothing else is.
An item's windows are its ``words`` consecutive words, or all its words if it has fewer. Windows of documents are hashed where they lie, looked
up in the set, and a hit is verified on its text, so a collision of hashes takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything between words, before and after lower-casing.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A set of n-grams is broadcast up to this many bytes of text; a larger one is joined by shuffle.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    """Normalised words of a text; none for NULL."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(plain, GAP), "")


def item_windows(items: DataFrame, words: int) -> DataFrame:
    """``h, len, gram, item`` of every window of ``items(item_id, text)``, each once an item."""
    cut = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
    cut = cut.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(words)))
    at = cut.select("item", "w", "len", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("p"))
    window = F.slice("w", F.col("p"), F.col("len"))
    return at.select(F.xxhash64(window).alias("h"), "len", F.array_join(window, " ").alias("gram"), "item").distinct()


def bounded(grams: DataFrame) -> DataFrame:
    """``grams`` marked for broadcast if their measured size allows it, else as they are."""
    size = grams.agg(F.sum(F.octet_length("gram") + 32)).first()[0] or 0
    return F.broadcast(grams) if size <= BROADCAST_BYTES else grams


def occurrences(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, sub, p, len, gram`` of every window of ``documents(doc_id, text)`` that is in ``windows``; ``p`` counts words from 0.

    The text of a window is put together only where its hash is in the set: the comparison is written as two bounds, so it stays a
    condition on matches instead of becoming part of the join key.
    """
    grams = windows.select(F.col("h").alias("_h"), F.col("len").alias("_len"), F.col("gram").alias("_gram")).distinct()
    lengths = sorted(r[0] for r in grams.select("_len").distinct().collect())  # at most as many as a window has words
    docs = documents.select("doc_id", F.xxhash64("text").alias("sub"), words_of(F.col("text")).alias("w"))
    at = docs.where(F.size("w") > 0).select("doc_id", "sub", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("p"))
    if len(lengths) > 1:
        at = at.withColumn("len", F.explode(F.array(*[F.lit(n) for n in lengths])))
    else:
        at = at.withColumn("len", F.lit(lengths[0] if lengths else 1))
    at = at.where(F.col("p") + F.col("len") - 1 <= F.size("w"))
    window = F.slice("w", F.col("p"), F.col("len"))
    at = at.select("doc_id", "sub", "p", "len", F.xxhash64(window).alias("h"), F.array_join(window, " ").alias("gram"))
    same = (F.col("h") == F.col("_h")) & (F.col("gram") >= F.col("_gram")) & (F.col("gram") <= F.col("_gram"))
    chosen = bounded(grams.withColumnRenamed("_gram", "gram")).withColumnRenamed("gram", "_gram")
    return at.join(chosen, same).select("doc_id", "sub", (F.col("p") - 1).alias("p"), "len", "gram")


def merged(places: Column) -> Column:
    """``array<struct<start, end>>`` of the stretches covered by ``places``, an array of ``struct<p, len>``; ends lie behind the last word."""
    start = F.expr("cast(array() as array<struct<start:int, end:int>>)")

    def take(spans: Column, one: Column) -> Column:
        last = F.element_at(spans, -1)
        end = one["p"] + one["len"]
        grown = F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1),
                         F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end"))))
        new = F.concat(spans, F.array(F.struct(one["p"].alias("start"), end.alias("end"))))
        return F.when((F.size(spans) > 0) & (F.try_element_at(spans, F.lit(-1))["end"] >= one["p"]), grown).otherwise(new)

    return F.aggregate(F.sort_array(places), start, take)


def contamination(documents: DataFrame, items: DataFrame, words: int = 10) -> DataFrame:
    """``doc_id, sub, spans, items`` of the documents that hold a window of an item.

    ``spans``: hit words as sorted stretches ``struct<start, end>``; ``items``: ids of the items as text, sorted, each once. ``sub`` is a hash of the
    text; rows that share id and text are one row here. Places and items of a document are made distinct before they are
    collected, so a list is no longer than its text. An item without id hits words and is not listed.
    """
    windows = item_windows(items, words)
    found = occurrences(documents, windows)
    # The corpus is scanned once: what the two uses below need is written, and is as small as what the documents share with the items.
    held = written(found.groupBy("doc_id", "sub").agg(F.collect_set(F.struct("p", "len")).alias("places"), F.collect_set("gram").alias("grams")))
    spans = held.select("doc_id", "sub", merged(F.col("places")).alias("spans"))
    grams = held.select("doc_id", "sub", F.explode("grams").alias("gram"))
    named = grams.join(bounded(windows.where("item is not null").select("gram", "item")), "gram").select("doc_id", "sub", "item").distinct()
    listed = named.groupBy("doc_id", "sub").agg(F.sort_array(F.collect_list("item")).alias("items"))
    b = listed.select(F.col("doc_id").alias("_d"), F.col("sub").alias("_s"), "items")
    joined = spans.join(b, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("sub").eqNullSafe(F.col("_s")), "left")
    return joined.select("doc_id", "sub", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def with_hits(documents: DataFrame, items: DataFrame, words: int = 10, extra: dict[str, Column] | None = None) -> DataFrame:
    """``row, <extra>, spans, items`` for every row of ``documents``: ``row`` is the row as a struct, ``spans`` and ``items`` are empty if clean.

    ``extra`` names expressions over the columns of ``documents`` to be computed before the join, so that ``row`` need not travel if unused.
    """
    hits = contamination(documents, items, words).withColumnsRenamed({"doc_id": "_d", "sub": "_s"})
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col("doc_id").alias("_doc"),
                           F.xxhash64("text").alias("_sub"), *[c.alias(n) for n, c in (extra or {}).items()])
    out = own.join(hits, F.col("_doc").eqNullSafe(F.col("_d")) & F.col("_sub").eqNullSafe(F.col("_s")), "left")
    none = {"spans": "array<struct<start:int, end:int>>", "items": "array<string>"}
    return out.select("row", *(extra or {}), *[F.coalesce(n, F.array().cast(kind)).alias(n) for n, kind in none.items()])


def report(documents: DataFrame, items: DataFrame, words: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items, contaminated`` for every row of ``documents(doc_id, text)``.

    A word is hit if it lies in any occurrence of a window of an item of ``items(item_id, text)``. NULL and empty texts have no words; rows that
    share id and text get equal results, each its own row; a NULL id is an id like others. An empty table gives an empty table, without items
    every document is clean. Texts may have any length: a document is cut up where it lies, and one very long
    document costs one task memory in proportion to it. Other columns are not read.
    """
    rows = with_hits(documents.select("doc_id", "text"), items, words,
                     {"doc_id": F.col("doc_id"), "n_words": F.size(words_of(F.col("text"))).cast("long")})
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return rows.select("doc_id", "n_words", hit.alias("n_hit"), "spans", "items", (F.size("spans") > 0).alias("contaminated"))


def decontaminate(documents: DataFrame, items: DataFrame, words: int = 10, remove: str = "spans") -> DataFrame:
    """``documents`` without what ``items`` holds: hit words with the gap behind them (``spans``), or whole rows (``documents``).

    All columns are kept whatever their names, ``text`` is replaced; clean texts stay as they are, byte by byte. For NULL, empty and repeated rows
    see :func:`report`.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is spans or documents")
    rows = with_hits(documents, items, words)
    if remove == "documents":
        return rows.where(F.size("spans") == 0).select("row.*")
    text = F.col("row.text")
    # Word and the gap behind it; what stands before the first word stays.
    pieces = F.regexp_extract_all(text, F.lit(r"([0-9A-Za-z\x{80}-\x{10FFFF}]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"), F.lit(1))
    front = F.regexp_extract(text, r"^([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)", 1)
    kept = F.filter(pieces, lambda piece, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    cleaned = F.when(F.size("spans") > 0, F.concat(front, F.array_join(kept, ""))).otherwise(text)
    return rows.select(F.col("row").withField("text", cleaned).alias("row")).select("row.*")
