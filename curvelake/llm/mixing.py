"""Mixing sources to target weights by capped water-filling, on DataFrame operations only.

Sizes are words.  All sources share ``budget`` times the words there are, by weight; a source
stops at ``max_epochs`` times its size, and what it can't take is shared again by weight among
the others, until none is above its cap (or all are at it).  Each round is one small aggregate
over the sources, of which the driver sees two sums.

A source with target ``t`` and size ``s`` is repeated ``t / s`` times: every document as
often as the whole part says, and a seeded sample of its documents once more for the
fraction.  For the sample a source's documents are dealt by a seeded hash into buckets of
about BUCKET_ROWS and ordered by another in their bucket; documents are taken in this order
until the bucket's share of words is reached, and the document at the border gives its first
words only.  So every source meets its target to within a word per bucket, no window holds a
whole source, and a rerun with the same seed agrees.

Defined results: a null text counts as empty (size 0, nothing to take); a null source is a
source of its own, after all others; rows that repeat a doc_id are documents of their own
(equal rows stand side by side in the order, so it doesn't matter which is which); with no
words at all every target is 0.  Extra columns are ignored by ``mix`` and kept by
``mixed_documents``.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import free_name, stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MAX_EPOCHS = 2.0
BUCKET_ROWS = 4096
SEED = 20


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` (one row each) with ``number``: 0 and up by code point, null last.

    Range partitions are numbered apart; only one count per partition is summed up.
    """
    first = F.col("source").isNull()
    parts = stage(sources.repartitionByRange(first, "source").withColumn("part", F.spark_partition_id()), "sources")
    before = (parts.groupBy("part").agg(F.count("*").alias("n"))
              .select(F.col("part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(first, "source"))
    return (parts.withColumn("inside", inside).join(before, "part")
            .withColumn("number", F.col("before") + F.col("inside") - 1).drop("part", "inside", "before"))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources`` (source_size, weight, ...) with ``target``."""
    cap = F.col("source_size") * F.lit(max_epochs)
    level = 0.0  # words per weight that a source gets which is not at its cap
    while True:
        at_cap = F.col("weight") * F.lit(level) >= cap
        row = sources.agg(F.sum(F.when(at_cap, cap)).alias("capped"),
                          F.sum(F.when(~at_cap, F.col("weight"))).alias("weights")).first()
        if not row.weights:
            break
        higher = (total - (row.capped or 0.0)) / row.weights
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and a key of the text, staged so that texts are read once."""
    return stage(docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"),
                             F.xxhash64("text").alias("text_key")), "sizes")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, documents, weight, target: one row per source."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    of = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("number", F.lit(len(weights))) + 1).cast("int"))
    weighted = stage(numbered(per_source).withColumn("weight", of).drop("number"), "weights")
    words = weighted.agg(F.sum("source_size")).first()[0] or 0
    return water_fill(weighted, budget * words, max_epochs)


def taken_words(sizes: DataFrame, per_source: DataFrame, bucket_rows: int = BUCKET_ROWS, seed: int = SEED) -> DataFrame:
    """``sizes`` with source_size, target, taken, whole (repetitions of the whole document)
    and part (words of a further, cut one)."""
    s = per_source.select(F.col("source").alias("s"), "source_size", "documents", "target")
    rows = sizes.join(s, sizes["source"].eqNullSafe(s["s"])).drop("s")
    # MD5 of seed and doc_id: its first half deals into buckets, the whole orders a bucket
    rows = rows.withColumn("draw", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))))
    first = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", first % F.ceil(F.col("documents") / F.lit(bucket_rows)))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    bucket = Window.partitionBy("source", "bucket")
    before = F.sum("size").over(bucket.orderBy("draw", "doc_id", "text_key")
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    share = F.floor((epochs - F.floor(epochs)) * F.sum("size").over(bucket) + 0.5)
    rows = rows.withColumn("before", before).withColumn("share", share).withColumn("epochs", F.floor(epochs))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("share") - F.col("before")))
    return (rows.withColumn("extra", extra).withColumn("taken", F.col("epochs") * F.col("size") + F.col("extra"))
            .withColumn("whole", F.col("epochs") + ((F.col("extra") == F.col("size")) & (F.col("size") > 0)).cast("long"))
            .withColumn("part", F.when(F.col("extra") < F.col("size"), F.col("extra")).otherwise(F.lit(0)))
            .select("doc_id", "source", "text_key", "size", "source_size", "target", "taken", "whole", "part"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS,
        bucket_rows: int = BUCKET_ROWS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): doc_id, size, source_size, target, taken."""
    sizes = sized(docs)
    plan = targets(sizes, weights, budget, max_epochs)
    return taken_words(sizes, plan, bucket_rows, seed).select("doc_id", "size", "source_size", "target", "taken", "source")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
                    max_epochs: float = MAX_EPOCHS, bucket_rows: int = BUCKET_ROWS, seed: int = SEED,
                    length: str | None = None) -> DataFrame:
    """The mix itself: rows of ``docs`` repeated as often as it takes them, with all columns;
    a cut repetition has the first words of the text.  Documents without words are not in a mix.
    ``length`` names a column to set to the number of code points of a cut text."""
    columns, sizes = docs.columns, sized(docs)
    plan = taken_words(sizes, targets(sizes, weights, budget, max_epochs), bucket_rows, seed)
    # rows that agree in doc_id, source and text share what was planned for them
    plan = (plan.where("size > 0 and (whole > 0 or part > 0)").groupBy("doc_id", "source", "text_key")
            .agg(F.sum("whole").alias("whole"), F.collect_list(F.when(F.col("part") > 0, F.col("part"))).alias("parts")))
    key, p_whole = [free_name(docs, f"_mix_{c}") for c in ("id", "source", "text")], free_name(docs, "_mix_copies")
    plan = plan.select(F.col("doc_id").alias(key[0]), F.col("source").alias(key[1]), F.col("text_key").alias(key[2]),
                       F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col("whole").cast("int")), "parts").alias(p_whole))
    text_key = free_name(docs, "_mix_key")
    unique = docs.withColumn(text_key, F.xxhash64("text")).dropDuplicates(["doc_id", "source", text_key])
    joined = unique.join(plan, unique["doc_id"].eqNullSafe(plan[key[0]])
                         & unique["source"].cast("string").eqNullSafe(plan[key[1]]) & (unique[text_key] == plan[key[2]]))
    cut = free_name(docs, "_mix_cut")
    rows = joined.withColumn(cut, F.explode(p_whole))
    words = F.concat(F.lit(r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){"), F.col(cut).cast("string"), F.lit("}+"))
    first = F.regexp_substr(F.col("text"), words)
    rows = rows.withColumn("text", F.when(F.col(cut) < 0, F.col("text")).otherwise(first))
    if length:
        kind = docs.schema[length].dataType
        rows = rows.withColumn(length, F.when(F.col(cut) < 0, F.col(length)).otherwise(F.length("text").cast(kind)))
    return rows.select(*columns)
