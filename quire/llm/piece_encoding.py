"""SentencePiece BPE encoding that keeps, for every piece, the bytes of the original text it came from."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from quire.llm.common import Memo, table
from quire.llm.merging import merge_pairs
from quire.llm.registry import query

#: The mark for a space, and the piece types of the model file.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """The compiled character map of a model: a double-array trie over UTF-8, then the replacements.

    The file holds the trie's size, its 32-bit units, and replacements that end with a zero byte.
    """

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.replacements = blob[4 + size:]

    @staticmethod
    def _child_base(unit: int) -> int:
        return (unit >> 10) << (8 if unit & 0x200 else 0)

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """(bytes matched, replacement) of the longest key that ``data`` has at ``at``."""
        place, found = self._child_base(self.units[0]), None
        for i in range(at, len(data)):
            place ^= data[i]
            if place >= len(self.units) or (unit := self.units[place]) & 0x800000FF != data[i]:
                break
            place ^= self._child_base(unit)
            if unit & 0x100:
                found = i + 1 - at, self.units[place] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.replacements[start:self.replacements.index(b"\0", start)].decode("utf-8")


class Encoded(NamedTuple):
    ids: bytes  # little-endian 32-bit
    sizes: bytes  # original bytes of each piece, little-endian 32-bit


class PieceEncoder:
    """Encodes texts as the library does for one BPE model, with original byte sizes of all pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        self._load(model)

    @classmethod
    def of(cls, model) -> PieceEncoder:
        self = cls.__new__(cls)
        self._load(model)
        return self

    def _load(self, model) -> None:
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if trainer.model_type != 2 or trainer.treat_whitespace_as_suffix:
            raise ValueError("not a BPE model with spaces before words")
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.dummy, self.escape = spec.add_dummy_prefix, spec.escape_whitespaces
        self.squeeze = spec.remove_extra_whitespaces
        self.fallback = trainer.byte_fallback
        self.ids, ranked, users = {}, {}, []
        for i, piece in enumerate(model.pieces):
            if piece.type in (NORMAL, USER, UNUSED):
                self.ids[piece.piece] = i
                ranked[piece.piece] = piece.score
            if piece.type == USER:
                users.append(piece.piece)
            if piece.type == UNKNOWN:
                self.unknown = i
        if users:
            raise ValueError("models with user-defined pieces are not supported")
        self.bytes = {b: i for i, p in enumerate(model.pieces) if p.type == BYTE
                      for b in [int(p.piece[3:5], 16)]}
        order = {s: r for r, s in enumerate(sorted(set(ranked.values()), reverse=True))}
        self.ranks = {
            (p[:k], p[k:]): order[s] for p, s in ranked.items() for k in range(1, len(p))
            if (k == 1 or p[:k] in ranked) and (k == len(p) - 1 or p[k:] in ranked)}
        # Two characters that stand side by side in no piece never come into one: texts can be cut there.
        self.joined = {p[k:k + 2] for p in ranked for k in range(len(p) - 1)}
        self.by_words = self.escape and not any(MARK in p.lstrip(MARK) for p in ranked)
        self.plain = (self.by_words and self.map is None and self.dummy and not self.squeeze
                      and self.fallback)
        self.words, self.plain_runs = Memo(self._word, 400_000), Memo(self._plain_run, 400_000)
        self.runs = Memo(self._run, 50_000)
        self.units = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.crowded = re.compile(f"^ |  |{MARK}")

    def normalize(self, text: str) -> tuple[str, list[int]]:
        """The normal form, and the number of original bytes behind each of its characters.

        At each place the longest key of the character map is replaced; other characters stay. Bytes of
        a replacement count with its last character, dropped spaces with the character before them.
        """
        data, out, sizes, at = text.encode("utf-8"), [], [], 0
        space, pending, previous = (MARK if self.escape else " "), 0, self.squeeze
        if data and self.dummy:
            out, sizes = [space], [0]
        while at < len(data):
            match = self.map.longest(data, at) if self.map else None
            if match:
                used, shown = match
            else:
                first = data[at]
                used = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                shown = data[at:at + used].decode("utf-8")
            at += used
            if previous:
                shown = shown.lstrip(" ")
            if shown:
                out += shown.replace(" ", space)
                sizes += [0] * (len(shown) - 1) + [used + pending]
                pending = 0
                previous = self.squeeze and shown.endswith(" ")
            elif out:
                sizes[-1] += used
            else:
                pending += used
        while self.squeeze and out and out[-1] == space:
            out.pop()
            left = sizes.pop()
            if sizes:
                sizes[-1] += left
        return "".join(out), sizes

    def _pieces(self, unit: str) -> Iterator[tuple[int, int]]:
        """(id, characters) of the pieces of a run of normal characters; of bytes, the last has the character."""
        _, symbols = merge_pairs(unit, self.ranks)
        unknown = 0
        for symbol in symbols:
            if symbol is None:
                continue
            known = self.ids.get(symbol)
            if known is None and not self.fallback:
                unknown += len(symbol)  # neighbours that are unknown make one piece
                continue
            if unknown:
                yield self.unknown, unknown
                unknown = 0
            if known is not None:
                yield known, len(symbol)
            else:
                *firsts, last = symbol.encode("utf-8")
                for b in firsts:
                    yield self.bytes[b], 0
                yield self.bytes[last], len(symbol)
        if unknown:
            yield self.unknown, unknown

    def _run(self, run: str) -> list[tuple[int, int]]:
        return list(self._pieces(run))

    def _cut(self, unit: str) -> list[tuple[int, int]]:
        """The pieces of a unit, from those of its parts between characters that never join."""
        joined, start, pieces = self.joined, 0, []
        for k in range(1, len(unit)):
            if unit[k - 1:k + 1] not in joined:
                self._extend(pieces, self.runs[unit[start:k]])
                start = k
        self._extend(pieces, self.runs[unit[start:]])
        return pieces

    def _extend(self, pieces: list[tuple[int, int]], more: list[tuple[int, int]]) -> None:
        if not self.fallback and pieces and more and pieces[-1][0] == more[0][0] == self.unknown:
            more = [(self.unknown, pieces.pop()[1] + more[0][1]), *more[1:]]
        pieces += more

    @staticmethod
    def _packed(pieces: list[tuple[int, int]], sizes: list[int]) -> Encoded:
        ids, spans, at = [], [], 0
        for i, n in pieces:
            ids.append(i)
            spans.append(sum(sizes[at:at + n]))
            at += n
        return Encoded(struct.pack(f"<{len(ids)}I", *ids), struct.pack(f"<{len(spans)}I", *spans))

    def _plain_run(self, run: str) -> Encoded:
        """A run in a model without a character map, where each mark stands for a space of one byte."""
        ids, sizes = [], []
        for symbol in merge_pairs(run, self.ranks)[1]:
            if symbol is None:
                continue
            size = len(symbol) if symbol.isascii() else len(symbol.encode("utf-8")) - 2 * symbol.count(MARK)
            known = self.ids.get(symbol)
            if known is not None:
                ids.append(known)
                sizes.append(size)
            else:
                data = symbol.encode("utf-8")
                ids += [self.bytes[b] for b in data]
                sizes += [0] * (len(data) - 1) + [size]
        return Encoded(struct.pack(f"<{len(ids)}I", *ids), struct.pack(f"<{len(sizes)}I", *sizes))

    def _word(self, word: str) -> Encoded:
        """A word after one space, in a model without a character map."""
        unit, joined, start, runs = MARK + word, self.joined, 0, []
        for k in range(1, len(unit)):
            if unit[k - 1:k + 1] not in joined:
                runs.append(self.plain_runs[unit[start:k]])
                start = k
        last = self.plain_runs[unit[start:]]
        if not runs:
            return last
        runs.append(last)
        return Encoded(b"".join([r.ids for r in runs]), b"".join([r.sizes for r in runs]))

    def encode(self, text: str) -> Encoded:
        if not text:
            return Encoded(b"", b"")
        if self.plain and not self.crowded.search(text):
            words = [self.words[w] for w in text.split(" ")]
            sizes = bytearray(b"".join([w.sizes for w in words]))
            # No space stands before the first word; of its pieces the one with the mark is a byte shorter.
            struct.pack_into("<I", sizes, 0, struct.unpack_from("<I", sizes)[0] - 1)
            return Encoded(b"".join([w.ids for w in words]), bytes(sizes))
        normal, sizes = self.normalize(text)
        units = self.units.findall(normal) if self.by_words else [normal] * bool(normal)
        pieces: list[tuple[int, int]] = []
        for unit in units:
            self._extend(pieces, self._cut(unit))
        return self._packed(pieces, sizes)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


@lru_cache(maxsize=2)
def library(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def bos_eos(path: str) -> tuple[bytes, bytes]:
    model = library(path)
    return struct.pack("<I", model.bos_id()), struct.pack("<I", model.eos_id())


def round_trip(text: Column, path: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256, covered): digests of the ids and of their decoding.

    ``covered`` is the number of bytes of the text that the pieces stand for; all of them, if none is lost.
    """

    @F.arrow_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string,covered:long>")
    def digest_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode, decode, (begin, end) = encoder(path).encode, library(path).decode, bos_eos(path)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            rows = []
            for t in batch:
                found = encode(t.as_py())
                ids = begin + found.ids + end
                shown = decode(np.frombuffer(ids, "<u4").tolist())
                rows.append((len(ids) // 4, sha(ids), sha(shown.encode("utf-8")),
                             int(np.frombuffer(found.sizes, "<u4").sum(dtype="i8"))))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.int64()))],
                ["n_tokens", "ids_sha256", "decoded_sha256", "covered"])

    return digest_texts(F.coalesce(text, F.lit("")))


IDS_AT_ONCE = 1 << 20


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, ends) per row of ``docs``: begin id, pieces and end id, and where each ends in the text.

    ``ends`` are bytes; a piece's bytes start where the piece before it ends. A null text is empty. Ids may be
    null or repeated. Rows are handed on as soon as ``IDS_AT_ONCE`` pieces are together, so memory doesn't
    grow with the texts of a batch.
    """

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (begin, end) = encoder(path).encode, bos_eos(path)
        ids, ends, lengths = [], [], []

        def flush(doc_ids: pa.Array) -> pa.RecordBatch:
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            columns = [pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(parts), "<i4")))
                       for parts in (ids, ends)]
            for parts in (ids, ends, lengths):
                parts.clear()
            return pa.RecordBatch.from_arrays([doc_ids, *columns], ["doc_id", "ids", "ends"])

        for batch in batches:
            start = together = 0
            for i, text in enumerate(batch.column(1)):
                found = encode(text.as_py())
                sizes = np.frombuffer(b"\0" * 4 + found.sizes + b"\0" * 4, "<u4")
                ids.append(begin + found.ids + end)
                ends.append(np.cumsum(sizes, dtype="<i4").tobytes())
                lengths.append(len(sizes))
                together += len(sizes)
                if together >= IDS_AT_ONCE or i == batch.num_rows - 1:
                    yield flush(batch.column(0).slice(start, i + 1 - start))
                    start, together = i + 1, 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        encode_rows, f"doc_id {kind}, ids array<int>, ends array<int>")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, covered) per row; see ``round_trip``.

    A null text is empty: it has the begin and end ids and decodes to nothing.
    """
    return docs.select("doc_id", round_trip(F.col("text"), path).alias("e")).select("doc_id", "e.*")


@query("op10_piece_encoding")
def op10_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
