"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are made."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import Memo, table
from quire.llm.merging import merge_pairs
from quire.llm.registry import query

#: Unicode's White_Space characters, and the pattern of byte-level pre-tokens over them.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
UNIT_LIMIT = 512


class MergeCounter:
    """Counts the tokens of a text for one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        shape = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or shape.get("type") != "ByteLevel" or (
                shape["add_prefix_space"] or not shape["use_regex"]):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        pairs = (p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        # Printable bytes stand for themselves, the others for characters from U+0100 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: 256 + i for i, b in enumerate(others)}
        self.pattern = regex.compile(PIECES)
        self.units = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.crowded = re.compile(r"\s ")
        self.piece_counts = Memo(self._count_piece, 500_000)
        self.word_counts = Memo(lambda word: self._count_unit(" " + word))

    def _count_piece(self, piece: str) -> int:
        symbols = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return len(symbols) - merge_pairs(symbols, self.rank)[0]

    def _count_unit(self, unit: str) -> int:
        return sum(map(self.piece_counts.__getitem__, self.pattern.findall(unit)))

    def _count_plain(self, text: str) -> int:
        """No pre-token goes from a non-space into a space, so texts can be cut there."""
        if self.crowded.search(text):  # a space after white space: cut before each run of white space
            return sum(self.word_counts[u[1:]] if u[0] == " " else self._count_unit(u)
                       for u in self.units.findall(text))
        first, *words = text.split(" ")
        return self._count_unit(first) + sum(map(self.word_counts.__getitem__, words))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.special is None:
            return self._count_plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._count_plain, parts))


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One counter, and its cache, per Python worker."""
    return MergeCounter(path)


def n_tokens(text: Column, path: str) -> Column:
    """Tokens of each text by the byte-level BPE file at ``path`` (on every worker). Null counts 0."""

    @F.arrow_udf("long")
    def count_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(path).count
        for batch in batches:
            yield pa.array([count(t.as_py()) for t in batch], pa.int64())

    return count_tokens(F.coalesce(text, F.lit("")))


def token_counts(docs: DataFrame, path: str, limit: int = UNIT_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    A null text is empty: no bytes, no tokens. Rows are judged one by one, so repeated rows and null ids
    give repeated rows and null ids; other columns are not read.
    """
    counted = docs.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        n_tokens(F.col("text"), path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
