"""Loads every module that registers queries."""

from quire.llm import collocations, descent, languages, mixing, multi_index, piece_encoding, secrets, sharding, shingle_join, token_counts, token_files, warc, whitening  # noqa: F401
from quire.llm.registry import ORACLES, QUERIES  # noqa: F401
