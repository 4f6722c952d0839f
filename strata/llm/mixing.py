"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Every document of a source has the same expected number of copies, the source's target
over its size. Within a source the documents stand in order of their size; the prefix
sum of expected copies, shifted by one random offset per source, crosses an integer as
often as a document is emitted. Neighbours have about the same size, so the words taken
differ from the target by little more than the largest document.

The rank of a document in its source, which the prefix sum needs, never gathers a source
in one task: rows are counted by (source, size, bucket of the id); the counts of sizes
are added up within a source and the counts of buckets within a size, and only the few
rows of one bucket are numbered one by one.

Defined cases: a NULL text has size 0; NULL is a source of its own, last in order; a NULL
id is an id like any other; repeated rows count as separate documents; sources without a
word have target 0; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # by position of the source, repeating
SHARE = 1.5  # words of the mix per word of the corpus
STOP = 2  # no target above this many times its source's size
BUCKETS = 4093  # a prime, so that regular ids spread


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: str) -> Column:
    """The source as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, stop: int = STOP) -> DataFrame:
    """``source, __source, source_size, target`` from rows of ``__source, size``.

    Shares by weight are capped at ``stop`` times the source's size and the excess is
    shared again. In order of cap per weight the capped sources come first: the level
    ``(total - caps before) / weights from here on`` rises over them and falls after, so
    its maximum is the level all others get. One row per source goes through the windows.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rising = Window.orderBy(F.col("source_size") / F.col("__weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    name = F.when(F.col("__source") != "", F.substring("__source", 2, 1 << 30))
    sources = sizes.groupBy("__source").agg(F.sum("size").alias("source_size")).withColumn("source", name)
    weighted = sources.withColumn(
        "__weight",
        F.element_at(F.array(*[F.lit(w) for w in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    level = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * stop
    ) / (F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0)))
    levels = weighted.withColumn("__level", level)
    return levels.select(
        "source", "__source", "source_size",
        F.least((F.col("source_size") * stop).cast("double"),
                F.col("__weight") * F.max("__level").over(everything)).alias("target"))


def ranked(sizes: DataFrame) -> DataFrame:
    """``sizes`` (``__source, size, doc_id``) with ``__rank`` from 1 in order of size, by source."""
    rows = sizes.withColumn(
        "__bucket", F.coalesce(F.pmod("doc_id", F.lit(BUCKETS)), F.lit(-1)).cast("int"))
    cells = rows.groupBy("__source", "size", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    smaller = (Window.partitionBy("__source").orderBy("size")
               .rowsBetween(Window.unboundedPreceding, -1))
    sooner = (Window.partitionBy("__source", "size").orderBy("__bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    steps = cells.groupBy("__source", "size").agg(F.sum("__n").alias("__n")).select(
        "__source", "size", F.coalesce(F.sum("__n").over(smaller), F.lit(0)).alias("__smaller"))
    offsets = cells.withColumn("__sooner", F.coalesce(F.sum("__n").over(sooner), F.lit(0))).join(
        steps, ["__source", "size"]).select(
        "__source", "size", "__bucket", (F.col("__smaller") + F.col("__sooner")).alias("__before"))
    inside = Window.partitionBy("__source", "size", "__bucket").orderBy("doc_id")
    return rows.join(offsets, ["__source", "size", "__bucket"]).withColumn(
        "__rank", F.col("__before") + F.row_number().over(inside)).drop("__bucket", "__before")


def offset(key: Column, seed: str) -> Column:
    """The random offset of a source, in [0, 1): 20 bits of a keyed hash."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 5)
    return F.conv(digits, 16, 10).cast("double") / 1048576


def copies_per_row(docs: DataFrame, seed: str = "mix", **shares) -> DataFrame:
    """One row per document: ``doc_id, size, source, __source, source_size, target, copies``.

    Sizes are counted in one pass over the texts and written; all else reads those rows.
    """
    sizes = cut_lineage(docs.select(
        "doc_id", _key("source").alias("__source"), word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = source_targets(sizes, **shares)
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    start = offset(F.col("__source"), seed)
    crossed = (F.floor(F.col("__rank") * rate + start)
               - F.floor((F.col("__rank") - 1) * rate + start)).cast("long")
    return ranked(sizes).join(targets, "__source").select(
        "doc_id", "size", "source", "__source", "source_size", "target", crossed.alias("copies"))


def mix(docs: DataFrame, seed: str = "mix", **shares) -> DataFrame:
    """The rows of ``docs``, each emitted once per integer boundary crossed.

    Texts meet their number of copies through one shuffle by id; rows that share an id,
    source and size take the numbers of copies in turn.
    """
    plan = copies_per_row(docs, seed, **shares).groupBy("doc_id", "__source", "size").agg(
        F.sort_array(F.collect_list("copies"), asc=False).alias("__copies"))
    plan = plan.select(
        F.col("doc_id").alias("__id"), F.col("__source").alias("__of"), F.col("size").alias("__size"),
        "__copies")
    # The document travels as one column, so its names cannot clash with the plan's.
    rows = docs.select(
        F.struct("*").alias("__row"), F.col("doc_id").alias("__doc"), _key("source").alias("__key"),
        word_count(F.col("text")).alias("__words"))
    joined = rows.join(
        plan, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__of"))
        & (F.col("__words") == F.col("__size")))
    turn = Window.partitionBy("__id", "__of", "__size").orderBy(F.xxhash64("__row.text"))
    times = F.get("__copies", F.row_number().over(turn) - 1).cast("int")
    return (
        joined.withColumn("__times", times)
        .filter(F.col("__times") > 0)
        .select("__row", F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__copy"))
        .select("__row.*"))
