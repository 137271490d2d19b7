"""Phrase collocations by best-first branch and bound over phrase counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import table, written
from quire.llm.registry import query
from quire.session import new_shared_path

LONGEST, LEAST_COUNT, TOP = 5, 100, 2000
#: Words of a block, and bits of a map. Both bound memory whatever the corpus; neither changes a result.
BLOCK_BYTES, MAP_BITS = 3 << 20, 1 << 26
#: Blocks are long rows, so a reader must not meet many at once.
_FEW_ROWS = {"compression": "zstd", "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
#: The first frontier holds words of up to this many times the least count.
FIRST_FRONTIER = 16
#: Characters that end a piece; they become one mark, which no word can hold.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_MARK = b"."
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _ENDS, bytes(range(97, 123)) + _MARK * len(_ENDS))
_BLOCK = "lang string, words binary, hashes binary, codes binary"


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode()))


def _longer_hash(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of the phrases without their last word and of that word."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15) + last
    return mixed ^ (mixed >> np.uint64(29))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one language as codes into the block's own words, with 0 between pieces.

    A block closes when it holds enough bytes, all blocks close when together they hold four times as much,
    and a text of many MB is cut into several blocks where a piece ends.
    """
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def close(lang: str) -> pa.RecordBatch:
        del sizes[lang]
        words = _MARK.join(held.pop(lang)).replace(_MARK, b" . ").split()
        coded = pa.array([_MARK, *words], pa.binary()).dictionary_encode()
        names = coded.dictionary.to_pylist()
        hashes = np.array([_word_hash(lang, w) for w in names], np.uint64)
        codes = coded.indices.to_numpy(zero_copy_only=False).astype("<i4")[1:]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([b" ".join(names)], pa.binary()), pa.array([hashes.tobytes()], pa.binary()),
             pa.array([codes.tobytes()], pa.binary())], ["lang", "words", "hashes", "codes"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            folded, start = text.translate(_FOLD), 0
            while start < len(folded):
                end = len(folded)
                if end - start > 2 * BLOCK_BYTES:
                    found = folded.find(_MARK, start + BLOCK_BYTES)
                    end = end if found < 0 else found
                held.setdefault(lang, []).append(folded[start:end])
                sizes[lang] = sizes.get(lang, 0) + end - start
                start = end
                if sizes[lang] >= BLOCK_BYTES:
                    yield close(lang)
            if sum(sizes.values()) >= 4 * BLOCK_BYTES or len(sizes) > 512:
                for name in list(sizes):
                    yield close(name)
    for name in list(sizes):
        yield close(name)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """(language, words, hashes, codes) of each block."""
    for batch in batches:
        for lang, words, hashes, codes in zip(*batch.columns, strict=True):
            yield (lang.as_py(), pa.array(words.as_py().split(b" "), pa.binary()),
                   np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(codes.as_buffer(), "<i4"))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words, _, codes in _opened(batches):
        seen = np.bincount(codes, minlength=len(words))
        seen[0] = 0
        used = np.flatnonzero(seen)
        yield _counted(lang, words.take(pa.array(used)), seen[used])


def _counted(lang: str, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(counts), pa.string()), phrases.cast(pa.string()), pa.array(counts, pa.int64())],
        ["lang", "phrase", "f"])


def _in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(MAP_BITS - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _bit_map(phrases: DataFrame) -> np.ndarray:
    """A map of the hashes of (lang, phrase) rows, of a fixed size. Chance hits only let more phrases be counted."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                words = phrase.encode().split(b" ")
                h = np.array([_word_hash(lang, words[0])], np.uint64)
                for word in words[1:]:
                    h = _longer_hash(h, np.uint64(_word_hash(lang, word)))
                at.append(int(h[0]) & (MAP_BITS - 1))
            at = np.array(at, np.int64)
            bits = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bits)], ["slot", "bits"])

    slots = phrases.select("lang", "phrase").mapInArrow(hashed, "slot long, bits long").groupBy("slot").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    found = np.zeros(MAP_BITS >> 6, np.uint64)
    found[slots.column("slot").to_numpy()] = slots.column("bits").to_numpy().view(np.uint64)
    return found


def _phrase_counts(blocks: DataFrame, length: int, frequent, frontier, shorter) -> DataFrame:
    """Counts of phrases of ``length`` words whose first or last word is in the frontier map.

    A phrase is followed only while all its words are frequent and its first words, and its last ones, were
    frequent at the length before wherever they were counted there: counts never grow with length.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, hashes, codes in _opened(batches):
            known, rare = _in_map(frequent.value, hashes), _in_map(frontier.value, hashes)
            known[0] = False
            size = len(codes) - length + 1
            if size < 1:
                continue
            fits, here = known[codes], rare[codes]
            at = np.flatnonzero(fits[:size] & fits[length - 1:] & (here[:size] | here[length - 1:]))
            for k in range(1, length - 1):
                at = at[fits[at + k]]
            if shorter is not None and len(at):
                for start in (0, 1):
                    h = hashes[codes[at + start]]
                    for k in range(1, length - 1):
                        h = _longer_hash(h, hashes[codes[at + start + k]])
                    counted = here[at + start] | here[at + start + length - 2]
                    at = at[~counted | _in_map(shorter.value, h)]
            if not len(at):
                continue
            first, ids = at, codes[at].astype(np.int64)
            for k in range(1, length):
                keys = ids * len(words) + codes[at + k]
                _, first, ids, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            places = at[first]
            parts = [words.take(pa.array(codes[places + k])) for k in range(length)]
            yield _counted(lang, pc.binary_join_element_wise(*parts, b" "), counts)

    return blocks.mapInArrow(count, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(
        F.sum("f").alias("f"))


def _scored(counts: DataFrame, frontiers: DataFrame) -> DataFrame:
    """Surviving candidates of which all that can decide about them is counted: first and last word in the frontier.

    ``frontiers`` has (lang, n, most). A phrase is dropped if a longer one is as frequent; then one that is
    longer by a single word is, since counts do not grow with length, and it shares the first or last word.
    """
    split = counts.withColumn("words", F.size(F.split("phrase", " "))).where("words > 1")
    longer = split.where("words > 2")
    head = F.expr("substring_index(phrase, ' ', words - 1)")
    tail = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    within = longer.select("lang", head.alias("phrase"), "f").unionByName(longer.select("lang", tail.alias("phrase"), "f"))
    within = within.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    cut = split.select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cut = cut.withColumn("left", F.expr("substring_index(phrase, ' ', cut)")).withColumn(
        "right", F.expr("substring_index(phrase, ' ', cut - words)"))
    side = lambda name, value: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    cut = cut.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(frontiers, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    product = (wide("a") * wide("n")).cast("decimal(38,0)") * F.lit(1000).cast("decimal(4,0)")
    cut = cut.withColumn("product", product).withColumn("sides", (wide("l") * wide("r")).cast("decimal(38,0)"))
    cut = cut.withColumn("score", F.expr("product div sides"))
    # The first and the last cut have the first and the last word on their own.
    best = cut.groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "cut")).alias("best"),
        F.max(F.when(F.col("cut") == 1, F.col("l"))).alias("first"),
        F.max(F.when(F.col("cut") == F.col("words") - 1, F.col("r"))).alias("last"), F.max("most").alias("most"))
    best = best.where(F.greatest("first", "last") <= F.col("most")).select("lang", "phrase", "best.*")
    return best.join(within, ["lang", "phrase"], "left").where("around IS NULL OR around < a").drop("around")


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """Rows of rank 1 to ``top`` in each language; parts of a language are cut to ``top`` rows each before they meet."""
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(4096)))
    for parts in (4096, 64, 1):
        order = Window.partitionBy("lang", F.pmod("part", F.lit(parts))).orderBy(*best)
        scored = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return scored.drop("part")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    ``docs`` has ``text`` and ``lang``; a null language is ``und``, a null or empty text has no words, other
    columns are not looked at. A score is bounded by 1000 n over the count of the first word and of the last
    one. So phrases grow from a frontier of the rarest frequent words, whose bounds are the highest: all
    phrases that begin or end with a word of the frontier are counted, from two words on, each length only
    where the shorter phrase was frequent. Where the bound of the words outside is below the language's score
    of rank ``top``, no phrase outside can come in, nor tie, and the language is settled. Otherwise the
    frontier grows: to the count at which that score says it is settled, or by ``FIRST_FRONTIER`` times while
    there are fewer than ``top`` phrases. A language with fewer phrases ends with all frequent words.

    Texts are split once, into blocks of codes in the shared folder. Maps of hashes of a fixed size tell tasks
    which phrases to count; a chance hit counts a phrase too many and changes no result, as counts, bounds
    and survival are taken from the phrases themselves.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    path = new_shared_path(spark, "phrase-blocks")
    texts.where("octet_length(text) > 0").mapInArrow(_blocks, _BLOCK).write.options(**_FEW_ROWS).parquet(path)
    blocks = spark.read.schema(_BLOCK).parquet(path)
    words = written(blocks.select("lang", "words", "hashes", "codes").mapInArrow(
        _word_counts, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"), F.max("f").alias("largest"))
    frequent_words = written(words.where(F.col("f") >= least), "frequent-words")
    open_langs = written(totals.withColumn("most", F.lit(least * FIRST_FRONTIER).cast("long")), "phrase-frontier")
    frequent = spark.sparkContext.broadcast(_bit_map(frequent_words))
    done = None
    while True:
        here = frequent_words.join(open_langs, "lang")
        frontier = spark.sparkContext.broadcast(_bit_map(here.where("f <= most")))
        counts, shorter = here.select("lang", "phrase", "f"), None
        mine = blocks.join(open_langs.select("lang"), "lang", "left_semi") if done is not None else blocks
        for length in range(2, longest + 1):
            level = written(_phrase_counts(mine, length, frequent, frontier, shorter).where(F.col("f") >= least), "phrase-counts")
            counts = counts.unionByName(level)
            if length < longest:
                shorter = spark.sparkContext.broadcast(_bit_map(level))
        ranked = written(_ranked(_scored(counts, open_langs), top), "phrase-ranks")
        reached = ranked.where(F.col("rank") == top).select("lang", F.col("score").alias("settling"))
        checked = written(open_langs.join(reached, "lang", "left").withColumn(
            "needed", F.expr("CASE WHEN settling IS NULL THEN largest ELSE least(largest, CAST(n AS DECIMAL(19,0)) * 1000 div settling) END")
        ).withColumn("settled", F.col("most") >= F.col("needed")), "phrase-settled")
        final = ranked.join(checked.where("settled").select("lang"), "lang", "left_semi")
        done = final if done is None else done.unionByName(final)
        left = checked.where("NOT settled")
        if left.isEmpty():
            return done.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        open_langs = left.select("lang", "n", "largest", F.when(
            F.col("settling").isNull(), F.col("most") * FIRST_FRONTIER).otherwise(F.col("needed")).alias("most"))


_GRAMS = "\n".join(
    f"    UNION ALL SELECT lang, array_to_string(w[i:i + {k - 1}], ' ') AS phrase, {k} AS words FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k})"
    for k in range(2, LONGEST + 1))
_SQL = f"""WITH folded AS (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents WHERE text IS NOT NULL),
  cut AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM folded),
  pieces AS (SELECT lang, w FROM (SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM cut) WHERE len(w) > 0),
  grams AS (SELECT lang, unnest(w) AS phrase, 1 AS words FROM pieces
{_GRAMS}),
  total AS (SELECT lang, count(*) AS n FROM grams WHERE words = 1 GROUP BY lang),
  f AS (SELECT lang, phrase, any_value(words) AS words, count(*) AS a FROM grams GROUP BY lang, phrase HAVING count(*) >= {LEAST_COUNT}),
  cuts AS (SELECT lang, phrase, words, a, unnest(range(1, words)) AS k, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
  s AS (SELECT c.lang, c.phrase, c.words, c.a, k, x.a AS l, y.a AS r, n, CAST(1000::HUGEINT * c.a * n // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM cuts c JOIN total USING (lang) JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[:k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
  low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  part AS (SELECT lang, a, words, unnest(range(2, words)) AS size, string_split(phrase, ' ') AS w FROM f WHERE words > 2),
  inside AS (SELECT lang, a, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, words - size + 2)) AS i FROM part)),
  around AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
  kept AS (SELECT low.* FROM low LEFT JOIN around o ON o.lang = low.lang AND o.phrase = low.phrase WHERE o.most IS NULL OR 100 * o.most < 100 * low.a)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept) WHERE rank <= {TOP}"""


@query("op13_phrase_collocations", _SQL)
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
