"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, row_key, running_start, table, tied, written
from quire.llm.registry import query

WEIGHTS = (5, 2, 1)
MOST = 3.0
TOLERANCE = 1e-11
NEWTON_STEPS = 8
UNIT = 1 << 24  # fractions of a copy are summed as whole numbers, so that sums don't depend on their order
SEED = 11


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A source's name without nulls; no source comes after all others and can't be taken for one of them."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("~"))


def capped_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(key, source_size, target) of (key, source_size): the whole size shared by weight, at most ``most`` times
    a source's own size, the excess going to the others by weight.

    Weights repeat along the keys in code point order. With sources in the order in which they reach their
    bound, the first that stays below it gives the level that all that stay below share.
    """
    everything, ahead = Window.partitionBy(), Window.orderBy(F.col("bound") / F.col("weight"), "key")
    up_to = ahead.rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(Window.orderBy("key")) - 1
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(up_to), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(up_to), F.lit(0.0))
    level = F.min_by("share", "turn").over(everything)
    return (
        sizes.select("key", "source_size", F.element_at(cycle, (place % len(weights) + 1).cast("int")).alias("weight"),
                     (F.col("source_size") * most).alias("bound"))
        .withColumn("share", left / weight_left).withColumn("turn", F.row_number().over(ahead))
        .withColumn("turn", F.when(F.col("bound") >= F.col("weight") * F.col("share"), F.col("turn")))
        .withColumn("level", level)
        .select("key", "source_size", F.least("bound", F.coalesce(F.col("weight") * F.col("level"), "bound")).alias("target"))
    )


def entropy_balance(
    cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, most_rounds: int = 200
) -> dict[str, DataFrame]:
    """Multipliers of the rates nearest to 1 in relative entropy that meet every target.

    ``cells`` has one column per margin, without nulls, and ``mass``, the words of the documents in the cell;
    ``targets[margin]`` has (key, target). A document's rate is the exponential of the sum of its margins'
    multipliers: the solution of the convex dual, the sum over documents of words * rate less that of target *
    multiplier. A round takes Newton steps in the block of each margin in turn. Within a block the second
    derivatives are diagonal, so a key's step is its own: what is missing over the words it takes now; a few
    such steps follow one sum over the cells, which Spark works out. Only whether a gap is left comes to the
    driver. Returned frames have (key, multiplier); a key whose target is 0 has the multiplier of rate 0 (null).
    """
    cells = written(cells.groupBy(*targets).agg(F.sum("mass").cast("double").alias("mass")), "mix-cells")
    tilts = {m: t.select("key", "target", F.when(F.col("target") > 0, F.lit(0.0)).alias("multiplier"),
                         F.lit(0.0).alias("gap")) for m, t in targets.items()}
    for _ in range(most_rounds):
        for margin in targets:
            tilted = cells
            for m, tilt in tilts.items():
                tilted = tilted.join(tilt.select(F.col("key").alias(m), F.col("multiplier").alias(f"_{m}")), m)
            rate = F.exp(sum((F.col(f"_{m}") for m in tilts), F.lit(0.0)))
            taken = tilted.groupBy(F.col(margin).alias("key")).agg(
                F.coalesce(F.sum(F.col("mass") * rate), F.lit(0.0)).alias("taken"))
            ratio = F.col("target") / F.col("taken")
            steps = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), F.lit(0.0),
                                lambda at, _: at + ratio * F.exp(-at) - 1)
            step = F.when(F.col("taken") > 0, steps)
            tilts[margin] = written(
                tilts[margin].drop("gap").join(taken, "key", "left").select(
                    "key", "target", (F.col("multiplier") + F.coalesce(step, F.lit(0.0))).alias("multiplier"),
                    F.coalesce(F.abs(step), F.lit(0.0)).alias("gap")), "mix-tilt")
        if not any(t.where(F.col("gap") > tolerance).where("multiplier is not null").limit(1).count()
                   for t in tilts.values()):
            return {m: t.select("key", "multiplier") for m, t in tilts.items()}
    raise ValueError("the targets of the margins contradict each other")


def copies_of(docs: DataFrame, rate: str) -> DataFrame:
    """Add ``copies``: the rate rounded to a whole number, so that the words of each ``key`` come out.

    In each key, documents are in order of size class, then of a seeded number. A document gets one more copy
    when the running sum of the fractions passes a half: in each size class as many do as should.
    """
    parts = max(1, round(docs.count() ** 0.5 / 8))
    docs = (
        docs.withColumn("_unit", tied(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), SEED))
        .withColumn("_base", F.floor(rate)).withColumn("_part", F.round((F.col(rate) - F.floor(rate)) * UNIT).cast("long"))
        .withColumn("_class", F.floor(F.log2(F.greatest("size", F.lit(1))) * 4).cast("long"))
        .withColumn("_bucket", F.col("_class") * parts + F.floor(F.col("_unit") * parts / float(1 << 52)).cast("long"))
    )
    docs = running_start(docs, ["key"], "_bucket", ["_unit", "doc_id", "size"], "_part", "_start")
    passed = [F.floor((F.col("_start") + more + UNIT // 2) / UNIT) for more in (F.lit(0), F.col("_part"))]
    return docs.withColumn("copies", (F.col("_base") + passed[1] - passed[0]).cast("long")).drop(
        "_unit", "_base", "_part", "_class", "_bucket", "_start")


def rated_copies(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``sizes`` (doc_id, size, key, ...) with source_size, target, rate and copies."""
    targets = written(capped_targets(sizes.groupBy("key").agg(F.sum("size").alias("source_size")), weights, most),
                      "mix-targets")
    tilt = entropy_balance(sizes.select("key", F.col("size").alias("mass")), {"key": targets.select("key", "target")})
    rates = targets.join(tilt["key"], "key").select(
        "key", F.col("source_size").cast("long").alias("source_size"), "target",
        F.least(F.round(F.coalesce(F.exp("multiplier"), F.lit(0.0)), 9), F.lit(most)).alias("rate"))
    return copies_of(sizes.join(rates, "key"), "rate")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, rate) per row of ``docs`` (doc_id, text, source).

    Sizes are words; a null or empty text has none and is not taken. Rows without a source are a source of
    their own, the last. Targets add up to all words. Repeated rows count as often as they stand there; which
    of the rows that agree in id and size gets a copy more makes no difference to the result.
    """
    sizes = written(docs.select("doc_id", word_count(F.col("text")).alias("size"),
                                source_key(F.col("source")).alias("key")), "mix-sizes")
    return rated_copies(sizes, weights, most).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Rows without a word have no part in the mix and go.

    Texts are shuffled once, by a key of id and text; rows that agree in both share out their copies.
    """
    sizes = written(docs.select("doc_id", word_count(F.col("text")).alias("size"), source_key(F.col("source")).alias("key"),
                                row_key(docs).alias("row")), "mix-sizes")
    copies = rated_copies(sizes, weights, most).where("size > 0").groupBy("row").agg(F.sum("copies").alias("copies"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), row_key(docs).alias("row"))
    taken = rows.groupBy("row").agg(F.first("doc").alias("doc")).join(copies.where("copies > 0"), "row")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


#: The level is found by trying each source as the first that stays below its bound.
MIX_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce('s' || source, '~') AS key,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS unit
  FROM documents),
sources AS (
  SELECT key, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY key COLLATE C) - 1) % 3] AS weight
  FROM docs GROUP BY key),
tried AS (
  SELECT a.key, (SELECT sum(source_size)::DOUBLE FROM sources) -
         sum(CASE WHEN 3 * b.source_size / b.weight < 3 * a.source_size / a.weight THEN 3 * b.source_size ELSE 0 END)
           AS room,
         sum(CASE WHEN 3 * b.source_size / b.weight < 3 * a.source_size / a.weight THEN 0 ELSE b.weight END) AS weights,
         any_value(3 * a.source_size / a.weight) AS bound
  FROM sources a, sources b GROUP BY a.key),
level AS (SELECT min_by(room / weights, bound) AS level FROM tried WHERE bound >= room / weights),
rated AS (
  SELECT key, source_size, least(3.0 * source_size, weight * level) AS target,
         CASE WHEN source_size = 0 THEN 0 ELSE
           least(round(least(3.0 * source_size, weight * level) / source_size, 9), 3.0) END AS rate
  FROM sources, level),
parts AS (SELECT greatest(1, round(sqrt(count(*)) / 8))::BIGINT AS n FROM docs),
placed AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.rate, round((r.rate - floor(r.rate)) * {UNIT})::BIGINT AS part,
         sum(round((r.rate - floor(r.rate)) * {UNIT})::BIGINT) OVER (
           PARTITION BY key ORDER BY floor(log2(greatest(d.size, 1)) * 4) * n + floor(d.unit * n / {float(1 << 52)}),
           d.unit, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS until
  FROM docs d JOIN rated r USING (key), parts)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies, rate
FROM (SELECT *, (floor(rate) + floor((until + {UNIT // 2}) / {UNIT})
                 - floor((until - part + {UNIT // 2}) / {UNIT}))::BIGINT AS copies FROM placed)
"""


@query("op6_entropy_mixing", MIX_SQL)
def op6_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"))
