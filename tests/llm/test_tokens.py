"""Token counts, piece encoding and token files against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import awkward, awkward_rows, empty
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from quire.llm import piece_encoding as pieces
from quire.llm import token_files as files
from quire.llm.merging import merge_pairs
from quire.llm.token_counts import MergeCounter, token_counts
from quire.session import new_shared_path

BYTES, WORDS, PIECES = map(
    public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ALPHABET = [*"aB Z9.,'\n\t  ", "'s", "'LL", "\r\n", "\x1c", "\x85", "\xa0", " ", "é", "é", "́", "中", "😀",
            "<|endoftext|>", "<s>", "²", "İ", "Σ", "٣", "﻿", "  ", "각", " ", "▁", "\0", "̈́", "the ", " in"]


def strings(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(16))) for _ in range(n)]


def test_merges_take_the_lowest_rank_and_then_the_leftmost():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("c", "c"): 3}
    assert merge_pairs("abc", ranks) == (2, ["abc", None, None])
    assert merge_pairs("ccc", ranks) == (1, ["cc", None, "c"])
    assert merge_pairs("", ranks) == (0, []) and merge_pairs("z", ranks) == (0, ["z"])


def test_counts_equal_the_library():
    own, library = MergeCounter(BYTES), Tokenizer.from_file(BYTES)
    for text in strings(4000):
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_token_counts_of_awkward_rows(spark):
    library = Tokenizer.from_file(BYTES)
    got = sorted(map(tuple, token_counts(awkward(spark), BYTES).collect()), key=repr)
    want = []
    for doc_id, text, *_ in awkward_rows():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 512))
    assert got == sorted(want, key=repr)
    assert token_counts(empty(spark), BYTES).count() == 0


def spans_of(library, text):
    """Ids, and byte ends of the pieces in the text."""
    proto = library.encode(text, return_type="proto")
    return [p.id for p in proto.pieces], [p.end for p in proto.pieces]


def test_pieces_and_their_bytes_equal_the_library():
    own, library = pieces.encoder(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in strings(4000, 2):
        found = own.encode(text)
        ids, ends = spans_of(library, text)
        assert np.frombuffer(found.ids, "<u4").tolist() == ids, repr(text)
        assert np.cumsum(np.frombuffer(found.sizes, "<u4")).tolist() == ends, repr(text)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_a_character_map_is_followed_by_longest_prefix(rule, squeeze):
    with open(PIECES, "rb") as file:
        model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    rules = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = sentencepiece_model_pb2.ModelProto.FromString(rules).normalizer_spec
    model.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = squeeze
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    own = pieces.PieceEncoder.of(model)
    for text in strings(1500, 3) + ["ﬁne ㌔ Ａ① ß", "  x ", " "]:
        found = own.encode(text)
        assert np.frombuffer(found.ids, "<u4").tolist() == library.encode(text), repr(text)
        if found.sizes:
            assert np.frombuffer(found.sizes, "<u4").sum() == len(text.encode())


def test_piece_digests_of_awkward_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for doc_id, text, *_ in awkward_rows():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids).encode()),
                     len((text or "").encode())))
    got = map(tuple, pieces.piece_digests(awkward(spark), PIECES).collect())
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for row in pieces.encode_documents(awkward(spark), PIECES).collect():
        assert len(row.ids) == len(row.ends) and row.ids[0] == 1 and row.ids[-1] == 2
    assert pieces.piece_digests(empty(spark), PIECES).count() == 0


def test_chunks_equal_the_library():
    own, library = files.ChunkEncoder(WORDS), Tokenizer.from_file(WORDS)
    for text in strings(6000, 4):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_letters_before_a_comma_or_full_stop():
    """Among them those that composition takes apart into a letter and a mark, which joins what follows."""
    own, library = files.ChunkEncoder(WORDS), Tokenizer.from_file(WORDS)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha() and not any(a < ord(c) < b for a, b in ((0x3400, 0xA000), (0xAC00, 0xD7A0), (0x17000, 0x19000), (0x20000, 0x323B0)))]
    texts = [f"a{c}{tail} x" for c in letters for tail in ",."] + [
        "হয়, ক়. ড়,", "שּׁ, a", "İ, i.", "a's, b'S. it's' we've?!", "x<|endoftext|>, y.<|", "C++... d'", "'s 's. ''s", "é.* ½, a½."]
    assert len(letters) > 10_000
    for text, found in zip(texts, own.encode_all(texts)):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_another_normaliser_is_refused():
    with pytest.raises(ValueError, match="normaliser"):
        files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype="u8").astype("<u4")
    planes = files.to_planes(ids, kind)
    assert len(planes) == (4 if kind == "byte" else 32)
    assert (files.from_planes(planes, n) == ids).all()


@pytest.mark.parametrize("plane,block_ids", [("byte", 64), ("bit", 50), ("byte", 65_536)])
def test_token_files_round_trip(spark, plane, block_ids):
    library, path = Tokenizer.from_file(WORDS), new_shared_path(spark, "files")
    files.write_token_files(awkward(spark), WORDS, path, plane, block_ids)
    got = [tuple(r) for r in files.read_token_files(spark, path, block_ids).collect()]
    rows = sorted(awkward_rows(), key=lambda r: (r[0] is None, r[0] or 0))
    want, at = [], 0
    for doc_id, text, *_ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    unique = [r for r in want if r[0] is not None]
    assert sorted(r for r in got if r[0] is not None) == unique
    # Rows without id are in any order; they follow all others without a gap.
    assert sorted(r[2:] for r in got if r[0] is None) == sorted(r[2:] for r in want if r[0] is None)
    last = sorted((r[1], r[2]) for r in got if r[0] is None)
    assert last[0][0] == sum(r[2] for r in unique) and last[1][0] == sum(last[0])


def test_no_documents_make_empty_token_files(spark):
    path = new_shared_path(spark, "files")
    files.write_token_files(empty(spark), WORDS, path)
    assert files.read_token_files(spark, path).count() == 0


def test_texts_with_new_words_are_gone_through_once():
    class Counted(dict):
        lookups = 0

        def __getitem__(self, key):
            Counted.lookups += 1
            return super().__getitem__(key)

    made, library = files.ChunkEncoder(WORDS), Tokenizer.from_file(WORDS)
    made.known = Counted()
    made.encode_all(["the cat"])
    Counted.lookups = 0
    texts = ["the cat " * 500 + end for end in ("Zebra,", "ZEBRA", "\u00c9t\u00e9.", "don't ...", "\u0390x", "\u0130a,b", "x\x1cY", "")]
    found = made.encode_all(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Counted.lookups < 1.1 * sum(len(t.split()) for t in texts)
