"""Token ids on disk: blocks of fixed size, transposed into byte or bit planes, each compressed by itself."""

from __future__ import annotations

import json
import re
import string
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from tokenizers import Tokenizer

from quire.llm.common import table
from quire.llm.registry import query
from quire.session import new_shared_path

END_ID = 2
BLOCK_IDS = 65_536
LEVEL = 3


#: What the chunks below rely on: the steps of the file's normaliser and pre-tokenizer, as fixed values.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(maxsize=1)
def _apart() -> frozenset[str]:
    """Letters that composition or lower case turns into something with a mark."""
    letters = (c for c in map(chr, range(0x80, 0x110000)) if c.isalpha())
    return frozenset(c for c in letters if not unicodedata.normalize("NFC", c).lower().isalpha())


class ChunkEncoder:
    """Encodes texts with the tokenizers library, white-space-free chunks one by one.

    The normaliser (composition, white space, lower case) and the pattern of this kind of file never join
    what white space parts, so a text's ids are those of its chunks in a row; nor do they join letters and signs
    after them, so these are parts of their own. The letters must be letters after normalisation: some
    decompose into a letter and a mark, and a mark joins the signs. Chunks met before are kept. The new ones of
    many texts go to the library in one text, a word each, and their ids are told apart by the suffix of a
    word's last token. A file with another normaliser or pattern is an error.
    """

    odd = "\x1c\x1d\x1e\x1f"  # what str.split() takes for white space, though the pattern does not
    blank = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    def __init__(self, path: str, limit: int = 800_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        shapes = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        rest = [(s.get("type"), s.get("add_prefix_space"), s.get("use_regex")) for s in shapes[1:]]
        first = {k: shapes[0].get(k) for k in ("type", "pattern", "behavior", "invert")}
        if spec["normalizer"] != _NORMALIZER or rest != [("ByteLevel", False, False)] or first != {
                "type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}:
            raise ValueError(f"not a file of this normaliser and pattern: {path}")
        self.tokenizer, self.limit, self.known = Tokenizer.from_file(path), limit, {}
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        suffix = spec["model"].get("end_of_word_suffix")
        if not suffix:
            raise ValueError(f"not a file that marks the ends of words: {path}")
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, plain: list[str], others: Iterable[str]) -> None:
        """Keep the ids of words of letters only, met in one text, and of other chunks, met one by one."""
        known = self.known
        for chunk in others:
            known[chunk] = np.array(self._ids(chunk), "<u4").tobytes()
        if not plain:
            return
        ids = np.array(self._ids(" ".join(plain)), "<u4")
        data, ends = ids.tobytes(), (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
        if len(ends) != len(plain) or ends[-1] != len(data):
            raise ValueError("the file has letters without an end")
        for chunk, start, end in zip(plain, [0, *ends], ends):
            known[chunk] = data[start:end]

    def _learn_chunks(self, new: Iterable[str]) -> None:
        """Keep the ids of chunks: those of their letters, plain ones without their case, and of the signs that follow.

        Chunks of another make are learnt whole. The chunks of plain characters are put in lower case together.
        """
        known, signs, ascii_only, chunks, cores, tails, whole = self.known, string.punctuation, [], [], [], [], []
        wide = []
        for chunk in new:
            (ascii_only if chunk.isascii() else wide).append(chunk)
        for chunk, low in zip(ascii_only, " ".join(ascii_only).lower().split(" ")):
            core = low.rstrip(signs)
            if core.isalpha():
                chunks.append(chunk)
                cores.append(core)
                tails.append(low[len(core):])
            else:
                whole.append(chunk)
        for chunk in wide:
            core = chunk.rstrip(signs)
            if core.isascii():
                core = core.lower()
            if core.isalpha() and (core.isascii() or _apart().isdisjoint(core)):
                chunks.append(chunk)
                cores.append(core)
                tails.append(chunk[len(core):])
            else:
                whole.append(chunk)
        self._learn(list(set(cores).difference(known)), set(tails).union(whole).difference(known, ("",)))
        for chunk, core, tail in zip(chunks, cores, tails):
            known[chunk] = known[core] + known[tail] if tail else known[core]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [[c for c in self.blank.split(t) if c] if any(c in t for c in self.odd) else t.split() for t in texts]
        known, used = self.known, set().union(*split)
        if len(known) > self.limit:  # what these texts use stays, and so does all that is frequent
            kept = {c: known[c] for c in used.intersection(known)}
            known.clear()
            known.update(kept)
        new = used.difference(known)
        if new:
            self._learn_chunks(new)
        return [b"".join(map(known.__getitem__, chunks)) for chunks in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _portions(texts: Iterable, size: int = 4 << 20) -> Iterator[list]:
    """Rows (doc_id, text) in lists of about ``size`` characters."""
    held, total = [], 0
    for row in texts:
        held.append(row)
        total += len(row[1])
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """Four byte planes or 32 bit planes of the ids, lowest first."""
    octets = ids.astype("<u4").view("u1").reshape(-1, 4)
    if kind == "byte":
        return [plane.tobytes() for plane in octets.T]
    return [plane.tobytes() for plane in np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        return np.stack([np.frombuffer(p, "u1") for p in planes], axis=1).reshape(-1).view("<u4")
    bits = np.unpackbits(np.stack([np.frombuffer(p, "u1") for p in planes]), axis=1, count=n)
    return np.packbits(bits.T, axis=1, bitorder="little").reshape(-1).view("<u4")


FILE_SCHEMA = (
    "part int, block long, n_ids int, lead int, lead_block long, doc_ids array<long>, n_tokens array<long>, "
    "planes array<binary>"
)
PIECE_SCHEMA = "part int, block long, place int, doc_id long, n_tokens long, within long, piece long, length int, crc long"
_INT, _LONG = pa.int32(), pa.int64()
FILE = pa.schema(zip(
    ("part", "block", "n_ids", "lead", "lead_block", "doc_ids", "n_tokens", "planes"),
    (_INT, _LONG, _INT, _INT, _LONG, pa.list_(_LONG), pa.list_(_LONG), pa.list_(pa.binary()))))
PIECE = pa.schema(zip(
    ("part", "block", "place", "doc_id", "n_tokens", "within", "piece", "length", "crc"),
    (_INT, _LONG, _INT, _LONG, _LONG, _LONG, _LONG, _INT, _LONG)))


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, plane: str = "byte", block_ids: int = BLOCK_IDS, end_id: int = END_ID
) -> None:
    """Encode ``docs`` (doc_id, text) and write the ids in ascending doc_id order to ``path``.

    Documents are dealt by range of doc_id into parts; a part's ids run on from document to document, each
    with ``end_id`` after it, and are cut into blocks of ``block_ids``. A row of the files is a block: part
    and block number; its ids' planes, each a zstandard frame; the doc_id and length of each document that
    starts in it; and how many ids at its start (``lead``) belong to a document that started in an earlier
    block (``lead_block``). By this index a block or a document is found without reading the rest.

    A null text is empty and has the end id only. Null ids come last. Rows that share an id follow each other
    in a fixed order; a tie-breaking number lets their range be cut too.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        F.rand(17).alias("tie")).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress, encode_all = zstandard.ZstdCompressor(level=LEVEL).compress, encoder(tokenizer).encode_all
        part, block, end, size = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes(), 4 * block_ids
        pending, doc_ids, lengths, lead, lead_block = bytearray(), [], [], 0, -1

        def block_row(data: bytes) -> pa.RecordBatch:
            planes = [compress(p) for p in to_planes(np.frombuffer(data, "<u4"), plane)]
            values = part, block, len(data) // 4, lead, lead_block, doc_ids, lengths, planes
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, FILE)], schema=FILE)

        rows = ((doc_id.as_py(), text.as_py()) for batch in batches for doc_id, text in zip(*batch.columns))
        for portion in _portions(rows):
            encoded = encode_all([text for _, text in portion])
            for (doc_id, _), data in zip(portion, encoded):
                data += end
                doc_ids.append(doc_id)
                lengths.append(len(data) // 4)
                left, started = len(data), block
                for at in range(0, len(data), size):
                    pending += data[at:at + size]
                    left -= min(size, len(data) - at)
                    if len(pending) >= size:
                        yield block_row(bytes(pending[:size]))
                        del pending[:size]
                        more = left + len(pending)
                        block, doc_ids, lengths = block + 1, [], []
                        lead, lead_block = (min(more, size) // 4, started) if more else (0, -1)
        if pending:
            yield block_row(bytes(pending))

    dealt.select("doc_id", "text").mapInArrow(pack, FILE_SCHEMA).write.parquet(path)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents' pieces in each block: (block and place there of the document's start, ..., checksum)."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for row in batch.to_pylist():
            data = from_planes([expand(p) for p in row["planes"]], row["n_ids"]).tobytes()
            part, block, at = row["part"], row["block"], row["lead"]
            found = [(part, row["lead_block"], -1, None, None, None, block, at, zlib.crc32(data[:4 * at]))] if at else []
            last = len(row["doc_ids"]) - 1
            for place, (doc_id, n) in enumerate(zip(row["doc_ids"], row["n_tokens"])):
                piece = data[4 * at:4 * (at + n)]
                # Only the last document that starts in a block can go on after it; it has place -1.
                found.append((part, block, -1 if place == last else place, doc_id, n, at, block, len(piece) // 4,
                              zlib.crc32(piece)))
                at += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found), PIECE)], schema=PIECE)


@F.arrow_udf(LongType())
def crc_of_pieces(pieces: pa.Array) -> pa.Array:
    """The checksum of the pieces (piece, length, crc) in a row: what came before is carried over zeros."""
    sums = []
    for row in pieces.to_pylist():
        crc = row[0]["crc"]
        for piece in row[1:]:
            zeros = bytes(4 * piece["length"])
            crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ piece["crc"]
        sums.append(crc)
    return pa.array(sums, pa.int64())


def part_starts(files: DataFrame) -> DataFrame:
    """(part, first): ids before each part. Only the index is read; there is one row per part."""
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))


def read_token_files(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files at ``path``.

    ``start`` counts the ids of all documents before it; the checksum is over its ids as stored, little-endian
    32-bit. Each block is decoded by itself; the checksums of a document's pieces are joined afterwards.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    pieces = files.mapInArrow(_pieces, PIECE_SCHEMA)
    docs = pieces.groupBy("part", "block", "place").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("within").alias("within"),
        F.array_sort(F.collect_list(F.struct("piece", "length", "crc"))).alias("pieces"))
    return docs.join(part_starts(files), "part").select(
        "doc_id", (F.col("first") + F.col("block") * block_ids + F.col("within")).alias("start"), "n_tokens",
        crc_of_pieces("pieces").alias("ids_crc32"))


@query("op7_token_files")
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return read_token_files(spark, path)
