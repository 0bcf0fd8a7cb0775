"""SentencePiece encoding and decoding with a merge-type model, by a prefix table.

Every prefix of a text has one last token. A piece that ends a prefix is that token if it is compatible with the last token of the
prefix before it, which means that the two, written together, encode to just these two. So one pass over the automaton's
matches fills a table of last tokens, and the ids are read from its end backwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Chunks kept per worker in each of two generations, and the longest one that is kept.
CACHE, CACHE_CHARS = 600_000, 40


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str = "piece_bpe_32k.model"):
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model_file))
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.of_byte = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(size) if model.is_control(i)}
        self.unknown = model.unk_id()
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in normal}
        self.rank = {i: -model.get_score(i) for i in normal}
        self.chars = {p for p in self.ids if len(p) == 1}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [i]:  # a piece that merging never reaches ends no prefix
                self.matcher.add_word(piece, (i, len(piece)))
        self.matcher.make_automaton()
        #: Character pairs that stand together in a piece; no merge crosses any other place.
        self.joins = {p[k - 1:k + 1] for p in self.ids for k in range(1, len(p))}
        # Strings only: the collector of cyclic garbage need not walk them.
        self.cache: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.texts = {str(i): p.replace(SPACE, " ") for i, p in enumerate(self.pieces) if i in self.rank} | {
            str(i): chr(b) for i, b in self.of_byte.items() if b < 128}
        # Marks that no piece joins to a letter or digit are cut off at once, so that fewer different chunks are looked up.
        inner = {c for c in self.chars if c.isalpha() or c in "0123456789"}
        marks, more = self.chars - inner - {SPACE}, {""}
        while more:
            more = {c for j in self.joins if SPACE not in j for c in j if c in marks and not set(j) <= marks}
            marks -= more
        cut = "\n" + re.escape("".join(sorted(marks)))
        self.cells = re.compile(f"{SPACE}*[^{SPACE}{cut}]+|{SPACE}*[{cut}]+|{SPACE}+").findall
        self.marks = marks

    def merged(self, text: str) -> list[int]:
        """Merging by its definition: the best adjacent pair first, the leftmost of equals. For short strings only."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(self.rank[self.ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ids]
            if not pairs:
                break
            k = min(pairs)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return [self.ids[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        known = self.compatible.get((left, right))
        if known is None:
            known = self.compatible[left, right] = self.merged(self.pieces[left] + self.pieces[right]) == [left, right]
        return known

    def known_run(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        last: list[tuple[int, int]] = [(-1, 0)] * (len(text) + 1)
        compatible, done = self.compatible, 0
        for end, (piece, size) in self.matcher.iter(text):
            end += 1
            if end == done:  # the table already holds the one last token of this prefix
                continue
            before = end - size
            if before:
                left = last[before][0]
                fits = compatible.get((left, piece))
                if not (self.fits(left, piece) if fits is None else fits):
                    continue
            last[end], done = (piece, size), end
        ids, at = [], len(text)
        while at:
            piece, size = last[at]
            ids.append(piece)
            at -= size
        return ids[::-1]

    def plain(self, ids: list[int]) -> str:
        """Text of ids without the rule for the first space."""
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if i in self.of_byte:
                held.append(self.of_byte[i])
                continue
            if held:
                out.append(replaced(held))
                held = bytearray()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.pieces[i].replace(SPACE, " "))
        return "".join(out) + (replaced(held) if held else "")

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.encoded(text)[0].split(",")] if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids: spaces restored, the one before the first piece dropped, byte runs read as UTF-8."""
        shown = [i for i in ids if i not in self.silent]
        text = self.plain(shown)
        return text[1:] if shown and shown[0] in self.rank and self.pieces[shown[0]].startswith(SPACE) else text

    def known(self, chunk: str) -> str:
        """Ids of a chunk, joined by commas."""
        found = self.cache.get(chunk) or self.older.get(chunk)
        if found is None:
            joins = self.joins
            cuts = [k for k in range(1, len(chunk)) if chunk[k - 1:k + 1] not in joins]
            if cuts:
                found = ",".join([self.known(chunk[i:j]) for i, j in zip([0, *cuts], [*cuts, len(chunk)], strict=True)])
            elif self.chars.issuperset(chunk):
                found = ",".join(map(str, self.known_run(chunk)))
            else:  # one character that no piece has becomes its UTF-8 bytes
                found = ",".join([str(self.bytes[b]) for b in chunk.encode("utf-8", "surrogatepass")])
        if len(chunk) <= CACHE_CHARS:
            if len(self.cache) >= CACHE:
                self.older, self.cache = self.cache, {}
            self.cache[chunk] = found
        return found

    def shown(self, ids: str) -> str:
        """Decoded text of ids joined by commas, with the first space. Only bytes beyond ASCII are read in runs."""
        try:
            return "".join(map(self.texts.__getitem__, ids.split(",")))
        except KeyError:
            return self.plain([int(i) for i in ids.split(",")])

    def encoded(self, text: str) -> tuple[str, str]:
        """Ids of ``text``, joined by commas, and what they decode to.

        Pieces hold spaces only in front, so a text falls apart before every run of spaces, and no merge crosses that place.
        """
        if not text:
            return "", ""
        known = self.cache.get
        ids = ",".join([known(c) or self.known(c) for c in self.cells(SPACE + text.replace(" ", SPACE))])
        return ids, self.shown(ids)[1:]


def replaced(held: bytearray) -> str:
    """Bytes as UTF-8, with the replacement character for every byte that is no part of a valid sequence."""
    out, at = [], 0
    while at < len(held):
        for size in (1, 2, 3, 4):
            try:
                out.append(held[at:at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    return PieceCodec(model_file)


def encode_documents(docs: DataFrame, model_file: str = "piece_bpe_32k.model", with_ids: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, and ``ids`` and ``decoded`` if ``with_ids``.

    Null and empty texts have no tokens. Rows with null or repeated doc_ids are encoded like any other; an empty table
    gives no rows; other columns are ignored. Memory follows the longest text, not the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids, back = own.encoded(text or "")
                row = (ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
                rows.append((*row, [int(x) for x in ids.split(",")] if ids else [], back) if with_ids else row)
            columns = zip(*rows, strict=True) if rows else [[]] * (5 if with_ids else 3)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def decode_documents(rows: DataFrame, model_file: str = "piece_bpe_32k.model") -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for batch in batches:
            texts = [own.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")
