"""Language identification: each document as a mixture of languages, fitted by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table
from quire.llm.registry import query

FEATURES = 1 << 14
TRAINING_PER_LANGUAGE = 2_000  # expected number of labelled documents that a language is learnt from, at most
MOST_LANGUAGES = 256
SMOOTHING = 0.5
ROUNDS, CLOSE = 12, 1e-3
#: n-grams overlap and so repeat each other: a language must pay this many times half the log of their number.
PENALTY = 3.0
LEAST_SHARE = 0.02
MOST_NOISE = 0.5
UNKNOWN = "und"
PIECE = 1 << 20
_LETTER = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER


def feature_counts(text: str) -> np.ndarray:
    """Counts of hashed letter trigrams over the whole text, lower case; what is no letter is a boundary."""
    total, letters, carried = np.zeros(FEATURES, np.int64), _letters(), np.zeros(1, np.uint32)
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.where(letters[codes], codes, 0)
        codes = np.concatenate([carried, codes] if at + PIECE < len(text) else [carried, codes, [0]]).astype(np.uint32)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)  # one boundary, however long
        codes = codes[keep]
        if len(codes) > 2:
            mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
            mixed ^= mixed >> np.uint32(15)
            total += np.bincount((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 14), minlength=FEATURES)
        carried = codes[-2:]
    return total


class Model(NamedTuple):
    languages: list[str]
    chances: np.ndarray  # features x (languages, and evenly spread noise at the end)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_language: int = TRAINING_PER_LANGUAGE) -> Model:
    """Trigram chances of each language from labelled documents that are not held out.

    At most ``per_language`` documents of a language are expected to be learnt from, chosen by a checksum of
    their id; their trigrams are counted in Spark and the sums, languages x features at most, collected.
    Languages beyond ``MOST_LANGUAGES`` raise an error. Rows without id, text or language are not learnt from.
    """
    usable = docs.select("doc_id", "text", "lang").where(
        "doc_id is not null and text is not null and lang is not null").where(~held_out(F.col("doc_id")))
    sizes = usable.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], np.full((FEATURES, 1), 1 / FEATURES, np.float32))
    place = {name: i for i, name in enumerate(languages)}
    shares = F.create_map(*(F.lit(v) for r in sizes for v in (r["lang"], int(min(1.0, per_language / r["count"]) * (1 << 20)))))
    draw = F.crc32(F.concat(F.lit("train:"), F.col("doc_id").cast("string")).cast("binary")) % (1 << 20)
    sample = usable.where(draw < shares[F.col("lang")]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(place), FEATURES), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                counts[place[lang.as_py()]] += feature_counts(text.as_py())
        which, feature = counts.nonzero()
        yield pa.RecordBatch.from_arrays(
            [pa.array(which.astype("i4")), pa.array(feature.astype("i4")), pa.array(counts[which, feature])],
            ["language", "feature", "n"])

    sums = sample.mapInArrow(count, "language int, feature int, n long").groupBy("language", "feature").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    counts = np.full((FEATURES, len(languages)), SMOOTHING)
    counts[found.column(1).to_numpy(), found.column(0).to_numpy()] += found.column(2).to_numpy()
    noise = np.full((FEATURES, 1), 1 / FEATURES)
    return Model(languages, np.hstack([counts / counts.sum(0), noise]).astype(np.float32))


class Grams(NamedTuple):
    """The trigrams of some documents one after the other: chances, counts, and where each document starts."""

    chances: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, axis=0)


def _subset(grams: Grams, docs: np.ndarray) -> Grams:
    lengths = grams.lengths[docs]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    rows = np.repeat(grams.starts[docs] - starts, lengths) + np.arange(lengths.sum())
    return Grams(grams.chances[rows], grams.counts[rows], starts, lengths)


def fit(grams: Grams, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log-likelihoods): per document the mixture of its allowed languages that explains it best."""
    shares = allowed / allowed.sum(1, keepdims=True)
    total = grams.sums(grams.counts)[:, None]
    for _ in range(ROUNDS):
        parts = grams.chances * np.repeat(shares, grams.lengths, axis=0)
        likely = parts.sum(1)
        parts *= (grams.counts / likely)[:, None]
        after = grams.sums(parts) / total
        moved = np.abs(after - shares).max()
        shares = after
        if moved < CLOSE:
            break
    likely = (grams.chances * np.repeat(shares, grams.lengths, axis=0)).sum(1)
    return shares, grams.sums(grams.counts * np.log(likely))


def mixtures(counts: list[np.ndarray], model: Model) -> np.ndarray:
    """Shares (documents x languages and noise) of the language sets chosen by penalised likelihood.

    A set starts with the language that explains the document best. The language with the largest share of
    the full mixture outside the set joins it if the likelihood gains more than the penalty. Documents have
    a trigram each.
    """
    features = [np.flatnonzero(c) for c in counts]
    lengths = np.array([len(f) for f in features])
    grams = Grams(model.chances[np.concatenate(features)],
                  np.concatenate([c[f] for c, f in zip(counts, features)]).astype(np.float32),
                  np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    n, k = len(counts), len(model.languages)
    everything, _ = fit(grams, np.ones((n, k + 1), np.float32))
    alone = grams.sums(grams.counts[:, None] * np.log(0.9 * grams.chances[:, :k] + 0.1 * grams.chances[:, k:]))
    allowed = np.zeros((n, k + 1), np.float32)
    allowed[np.arange(n), alone.argmax(1)] = allowed[:, k] = 1
    shares, likely = fit(grams, allowed)
    price = PENALTY * 0.5 * np.log(np.maximum(grams.sums(grams.counts), 2))
    active = np.arange(n)
    for _ in range(k - 1):
        outside = np.where(allowed[active, :k] > 0, 0, everything[active, :k])
        active, joins = active[outside.max(1) >= LEAST_SHARE], outside.argmax(1)[outside.max(1) >= LEAST_SHARE]
        if not len(active):
            break
        wider = allowed[active]
        wider[np.arange(len(active)), joins] = 1
        wider_shares, wider_likely = fit(_subset(grams, active), wider)
        gains = wider_likely - likely[active] > price[active]
        active = active[gains]
        allowed[active], shares[active], likely[active] = wider[gains], wider_shares[gains], wider_likely[gains]
    return shares


RESULT = "struct<lang_pred:string,score:double,noise:double,languages:array<string>,shares:array<double>>"


def identify(text: Column, model: Model, docs_at_once: int = 256, features_at_once: int = 400_000) -> Column:
    """struct(lang_pred, score, noise, languages, shares) of each text; only the text is looked at.

    ``languages`` are those of the chosen set by share, ``lang_pred`` and ``score`` the first of them, ``noise``
    the share that no language explains. Texts that are null or have no letter, and all texts if no language
    was learnt, are ``und`` with score 0.
    """

    @F.arrow_udf(RESULT)
    def identify_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows: list = [None] * len(batch)
            places, counts, features = [], [], 0

            def settle() -> None:
                if places:
                    for place, share in zip(places, mixtures(counts, model).astype(float)):
                        order = [i for i in np.argsort(-share[:-1], kind="stable") if share[i] > 0]
                        names = [model.languages[i] for i in order]
                        rows[place] = (names[0], float(min(1.0, share[order[0]])), float(share[-1]), names, share[order].tolist())
                places.clear()
                counts.clear()

            for place, text in enumerate(batch):
                found = feature_counts(text.as_py()) if text.is_valid and model.languages else None
                if found is None or not found.any():
                    rows[place] = (UNKNOWN, 0.0, 0.0, [], [])
                    continue
                places.append(place)
                counts.append(found)
                features += np.count_nonzero(found)
                if len(places) >= docs_at_once or features >= features_at_once:
                    settle()
                    features = 0
            settle()
            kinds = pa.string(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())
            columns = list(zip(*rows)) or [()] * 5
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["lang_pred", "score", "noise", "languages", "shares"])

    return identify_texts(F.when(text.rlike(r"\p{L}"), text))


def identify_languages(docs: DataFrame, per_language: int = TRAINING_PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, noise, languages, shares) per row of ``docs``.

    Learns from the labelled rows that are not held out; see ``train`` and ``identify``. A null id is not held
    out. Repeated rows give repeated rows; other columns are not read.
    """
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        identify(F.col("text"), train(docs, per_language)).alias("found"))
    return found.select("doc_id", "held_out", "found.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is in no learnt language: no letter, or more noise than language."""
    found = docs.select(F.struct(*docs.columns).alias("doc"), identify(F.col("text"), train(docs)).alias("found"))
    return found.where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.noise") <= MOST_NOISE)).select("doc.*")


@query("op8_language_mixtures")
def op8_language_mixtures(spark: SparkSession, folder: str) -> DataFrame:
    return identify_languages(table(spark, folder, "documents"))
