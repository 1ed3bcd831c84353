"""Mixing sources to target weights: repetition rates per source, whole copies plus one seeded Bernoulli copy.

Sources in code-point order, null last, get the weights in turn. They share all words of the input by weight; a share
stops at `ceiling` times the source's own words and the excess goes to the others by weight. The rate of a source is its
target over its words, and each of its documents is emitted floor(rate) times plus once more with probability
rate - floor(rate), decided by a hash of seed and id. The hashes of a source may be turned round the unit interval by
sixteenths; each turn gives every document the same probability, and the one whose words come nearest to the target is
taken. Nothing is gathered per source: the shuffles carry partial sums per source and task, whatever share of the rows a
source holds.

Defined cases: a null text has size 0; a null source is a source of its own; a source without words has rate 0; rows with
equal ids draw alike, and a null id draws by its text; an empty table gives an empty result; other columns pass through,
and a column with the name of an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import lookup, numbered_rows, running_totals, stage, stage_counted

WORD = r"[^\x20\x09-\x0D]+"
TURNS = 16


def words(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(seed: int) -> Column:
    """A number in [0, 1) from 52 bits of a hash of a document's id; the same in every run."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.col("text")), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(
    sized: DataFrame, weights: Sequence[float] = (5, 2, 1), ceiling: float = 3.0
) -> tuple[DataFrame, int]:
    """One row per source with `source_size` and `target`, and the number of sources, from (source, size).

    Capped sources come first in the order of size over weight, so one running total replaces the repeated resharing.
    """
    sizes, count = stage_counted(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = numbered_rows(
        sizes.withColumn("_missing", F.col("source").isNull()), ["_missing", "source"], "_rank", rows=count
    )
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighted = ranked.withColumn("_weight", F.get(turn, F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")))
    run = running_totals(
        weighted.withColumn("_ratio", F.col("source_size") / F.col("_weight")),
        [],
        ["_ratio", "_rank"],
        ["source_size", "_weight"],
        rows=count,
    )
    cap = ceiling * F.col("source_size")
    level = (F.col("source_size_total") - ceiling * F.col("source_size_before")) / (
        F.col("_weight_total") - F.col("_weight_before")
    )
    levelled = run.withColumn("_level", level).withColumn("_capped", cap <= F.col("_level") * F.col("_weight"))
    first_open = levelled.filter(~F.col("_capped")).agg(F.min_by("_level", F.struct("_ratio", "_rank"))).first()[0]
    share = F.lit(first_open).cast("double") * F.col("_weight")  # one number, read on the driver
    targets = levelled.select(
        "source", "source_size", F.when(F.col("_capped"), cap).otherwise(F.least(cap, share)).alias("target")
    )
    return targets, count


def _copies(turn: Column, hashed: Column) -> Column:
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    turned = hashed + turn / F.lit(float(TURNS))
    return F.floor(rate) + (turned - F.floor(turned) < rate - F.floor(rate)).cast("bigint")


def repetitions(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), ceiling: float = 3.0, *, seed: int = 42
) -> DataFrame:
    """Each document with `source_size`, `target` and `copies`, the number of times the mix takes it."""
    docs = docs.drop("source_size", "target", "copies", "_turn")
    sized = stage(docs.select("source", words(F.col("text")).alias("size"), draw(seed).alias("hashed")), "sized")
    targets, count = source_targets(sized, weights, ceiling)
    rated = lookup(sized, targets, ["source"], table_rows=count)
    taken = [F.sum(F.col("size") * _copies(F.lit(k), F.col("hashed"))) for k in range(TURNS)]
    off = [F.struct(F.abs(t - F.col("target")).alias("off"), F.lit(k).alias("turn")) for k, t in enumerate(taken)]
    turned = rated.groupBy("source", "source_size", "target").agg(F.array_min(F.array(*off))["turn"].alias("_turn"))
    found = lookup(docs, stage(turned, "turned"), ["source"], table_rows=count)
    return found.withColumn("copies", _copies(F.col("_turn"), draw(seed))).drop("_turn")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), ceiling: float = 3.0, *, seed: int = 42) -> DataFrame:
    """The mixed table: the input's columns, each document as often as the mix takes it."""
    taken = repetitions(docs, weights, ceiling, seed=seed).filter("copies > 0")
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    spare = max(docs.columns, key=len) + "_"  # the name of no column
    return taken.select(*docs.columns, times.alias(spare)).drop(spare)


def mix_report(docs: DataFrame) -> DataFrame:
    """Query of the operator: what the mix takes of each document, repeats counted."""
    sized = repetitions(docs.select("doc_id", "source", "text")).withColumn("size", words(F.col("text")))
    return sized.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source),
weighted AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(rank - 1) % 3 + 1] AS weight FROM sources),
run AS (
  SELECT *, source_size / weight AS ratio,
         coalesce(sum(source_size) OVER before, 0) AS size_before, coalesce(sum(weight) OVER before, 0) AS weight_before,
         sum(source_size) OVER () AS size_total, sum(weight) OVER () AS weight_total
  FROM weighted
  WINDOW before AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levelled AS (
  SELECT *, (size_total - 3.0::DOUBLE * size_before) / (weight_total - weight_before) AS level FROM run),
marked AS (SELECT *, 3.0::DOUBLE * source_size <= level * weight AS capped FROM levelled),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN 3.0::DOUBLE * source_size
              ELSE least(3.0::DOUBLE * source_size,
                         weight * (SELECT level FROM marked WHERE NOT capped ORDER BY ratio, rank LIMIT 1)) END AS target
  FROM marked),
rated AS (
  SELECT sized.source, doc_id, size, source_size, target, coalesce(target / nullif(source_size, 0), 0) AS rate,
         ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, 'text:' || text, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS h
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
turned AS (
  SELECT source, turn, abs(sum(size * (floor(rate)::BIGINT
           + (h + turn / 16.0::DOUBLE - floor(h + turn / 16.0::DOUBLE) < rate - floor(rate))::INT)) - any_value(target)) AS off
  FROM rated, range(16) t(turn) GROUP BY source, turn),
best AS (SELECT source, arg_min(turn, (off, turn)) / 16.0::DOUBLE AS turn FROM turned GROUP BY source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + (h + turn - floor(h + turn) < rate - floor(rate))::INT) AS taken
FROM rated JOIN best ON rated.source IS NOT DISTINCT FROM best.source"""
