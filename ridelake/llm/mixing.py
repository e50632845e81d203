"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated as often as its target
may need. A document's virtual finish time is the number of words its source has queued up to
its end, divided by the source's target, so a source with twice the target is served twice as
fast. All copies are sorted globally by that time, and the mix is what fits into the total budget:
nothing but the place in this order decides. Near virtual time 1, where the budget ends, all
sources have had their target but for what one queue entry holds; so that a long document does
not make that much, it queues in packets of a ``GRAIN``-th of its source's target (of ``LEAST`` words
at least), and what it has in the mix are its packets there, the last of all cut at the budget.

Defined cases: null text has size 0; a null source is a source of its own, last in order; rows
with equal doc_id, or equal in all, are rows of their own; very long texts queue in packets; a source
without words has target 0 and gives nothing; an empty table gives an empty mix. Columns other
than doc_id, text and source are not read; ``mixed`` keeps them all, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.steps import Scratch, running_total, solid_words


GRAIN = 1000
LEAST = 32


@dataclass(frozen=True)
class Mixture:
    weights: tuple[int, ...] = (3, 1, 2)  # repeated over the sources in code point order, null last
    share: float = 1.5  # the budget, as a multiple of all words
    most: float = 2.0  # a source is repeated this often at most


def _shuffled() -> Column:
    return F.xxhash64(F.lit(7), "doc_id", "text")


def sized(docs: DataFrame) -> DataFrame:
    """row (a number of this run), doc_id, source, size in words, and a pseudo-random rank that depends on doc_id and text."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "source",
        F.size(solid_words(F.col("text"))).cast("long").alias("size"),
        _shuffled().alias("shuffled"),
    )


def targets(scratch: Scratch, rows: DataFrame, mixture: Mixture) -> DataFrame:
    """One row per source: source_size, the words of the sources before it, its weight and target.

    Targets are min(most * size, level * weight) at the one level that shares the whole
    budget. The level only rises while sources reach their cap and leave their excess to the
    others, so it is found by summing again without the capped ones until none is new.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = sizes.withColumn("one", F.lit(1).cast("long"))
    placed = running_total(scratch, "sources", sizes, ["source"], "one", "place")
    cycle = F.array(*(F.lit(float(w)) for w in mixture.weights))
    placed = placed.withColumn("weight", F.element_at(cycle, (F.col("place") % len(mixture.weights) + 1).cast("int")))
    placed = placed.withColumn("most", F.col("source_size") * F.lit(mixture.most))
    placed = running_total(scratch, "weighed", placed, ["source"], "source_size", "before")
    placed = scratch.freeze(placed, "placed")

    level = 0.0
    while True:
        capped = F.col("most") <= F.lit(level) * F.col("weight")
        sums = placed.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(capped, F.col("most"))).alias("capped"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
        ).first()
        free = mixture.share * (sums.words or 0) - (sums.capped or 0.0)
        if not sums.open or free / sums.open <= level:
            break
        level = free / sums.open
    target = F.least(F.col("most"), F.lit(level) * F.col("weight"))
    return placed.select("source", "source_size", "before", "weight", target.alias("target"))


def mix(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The queue entries in order: every document once for each pass over its source, long ones in packets.

    Columns: row (tells rows with equal doc_id apart), doc_id, source, size, shuffled, source_size,
    target, copy (0 for the first pass over the source), packet (from 0), words (of the packet),
    virtual_finish, position (words of all entries before this one) and taken (its words in the mix).
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.freeze(sized(docs), "sized")
    goal = scratch.freeze(targets(scratch, rows, mixture), "targets")
    queued = running_total(scratch, "queues", rows, ["source", "shuffled", "row"], "size", "queued")
    same = F.col("source").eqNullSafe(F.col("of"))
    queued = queued.join(goal.withColumnRenamed("source", "of"), same).drop("of")
    passes = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("target") / F.col("source_size")) - 1, F.lit(0)).cast("int"))
    copies = queued.withColumn("copy", F.explode(F.when(F.col("source_size") > 0, passes).otherwise(F.array(F.lit(0)))))
    begin = F.col("queued") - F.col("before") + F.col("copy") * F.col("source_size")
    copies = copies.withColumn("begin", begin)
    # Whatever begins at twice the target or later ends beyond the budget by far; it stays whole.
    grain = F.greatest(F.ceil(F.col("target") / GRAIN), F.lit(LEAST)).cast("long")
    grain = F.when(F.col("begin") < 2 * F.col("target"), grain).otherwise(F.greatest(F.col("size"), F.lit(1)))
    copies = copies.withColumn("grain", grain)
    last = F.greatest(F.ceil(F.col("size") / F.col("grain")) - 1, F.lit(0)).cast("int")
    packets = copies.withColumn("packet", F.explode(F.sequence(F.lit(0), last)))
    end = F.least(F.col("size"), (F.col("packet") + 1) * F.col("grain"))
    finish = F.when(F.col("target") > 0, (F.col("begin") + end) / F.col("target")).otherwise(0.0)
    packets = packets.select(
        "row", "doc_id", "source", "size", "shuffled", "source_size", "target", "copy", "packet",
        (end - F.col("packet") * F.col("grain")).alias("words"), finish.alias("virtual_finish"),
    )
    order = ["virtual_finish", "source", "shuffled", "row", "copy", "packet"]
    ordered = running_total(scratch, "order", packets, order, "words", "position")
    budget = goal.agg(F.coalesce(F.ceil(F.sum("target")), F.lit(0)).alias("budget")).first().budget
    taken = F.greatest(F.lit(0), F.least(F.col("words"), F.lit(budget) - F.col("position"))).cast("long")
    return ordered.withColumn("taken", taken)


def taken_words(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """Per document: doc_id, size, source_size, target and taken, its words in the mix with repeats."""
    of_document = mix(docs, mixture).groupBy("row", "doc_id", "size", "source_size", "target")
    return of_document.agg(F.sum("taken").alias("taken")).drop("row")


def mixed(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The documents in the mix, a row for each of theirs, all columns.

    Added are size, source_size, target, taken (words of all repeats) and position (words of the
    mix before the document first comes up); where docs has such a column, with mix_ in front.
    """
    added = ("size", "source_size", "target", "taken", "position")
    entries = mix(docs, mixture).where("taken > 0").groupBy("row", "doc_id", "shuffled", "source", "size", "source_size", "target")
    entries = entries.agg(F.sum("taken").alias("taken"), F.min("position").alias("position"))
    key = ("doc_id", "shuffled", "source")
    # Rows equal in doc_id, text and source are told apart by a number on either side.
    served = entries.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("row")))
    served = served.select(F.struct(*key, "nth").alias("of"), *(F.col(c).alias(f"mix_{c}") for c in added))
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        F.struct("doc_id", _shuffled().alias("shuffled"), "source").alias("key"),
        F.xxhash64(*(docs[c] for c in docs.columns)).alias("rest"),
    )
    nth = F.row_number().over(Window.partitionBy("key").orderBy("rest"))
    rows = rows.select("row", F.struct("key.*", nth.alias("nth")).alias("at"))
    names = {c: f"mix_{c}" if c in docs.columns else c for c in added}
    return rows.join(served, F.col("at").eqNullSafe(F.col("of"))).select(
        *(F.col(f"row.`{c}`") for c in docs.columns), *(F.col(f"mix_{c}").alias(name) for c, name in names.items())
    )
