"""Benchmark decontamination as a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of an item (the whole item if it has fewer). A window that
occurs in a document brings all of its shingles along, so its rarest shingle is the prefix that
a containment of 100 % needs. Every document is split into words once; of its shingles those
that any window has are kept with their places. Rarity is counted over all of these, only the
prefixes are joined with them, the place of the prefix inside its window bounds where the window
can lie, and every candidate is verified: the document must have the window's first and last
shingles at their places, which together are all of its words. Texts never travel.

Only column functions are used. The windows' shingles are broadcast if there are at most
``BROADCAST_SHINGLES`` of them, a few numbers each; beyond it the joins shuffle. Shingles are
compared by hashes of 64 bits, so that a window of ten words agrees in 128; shorter windows, of
fewer words than a shingle, by a second hash.

Defined cases: null texts have no words and hit nothing; an item without words has no window; a
null item_id marks words but is not listed; repeated items count once per item_id; repeated rows
of documents get equal results; very long texts are split whole; an empty benchmark hits nothing,
and no documents give no rows. Columns other than doc_id, item_id and text are not read, and those of
documents may have any names. Words are compared after lower-casing A-Z.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.steps import Scratch, plain_words

WINDOW = 10
SHINGLE = 5
BROADCAST_SHINGLES = 1_000_000  # with their numbers 32 MB at most

#: The row that every document has among its shingles; its place tells the number of words.
EVERY = 0


def _shingles(words: str, size: int) -> Column:
    """Structs (at, shingle, check) of all runs of ``size`` words; empty if there are fewer. Full shingles need no check."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(size))
    check = f"xxhash64({size + SHINGLE}, {parts})" if size < SHINGLE else "0L"
    run = f"transform(sequence(0, size({words}) - {size}), i -> struct(i AS at, xxhash64({size}, {parts}) AS shingle, {check} AS check))"
    return F.expr(f"CASE WHEN size({words}) >= {size} THEN {run} ELSE array() END")


def windows(benchmark: DataFrame) -> DataFrame:
    """The distinct windows of all items: window (its words), n, and items (the item_ids that have it)."""
    items = benchmark.select("item_id", plain_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - WINDOW, F.lit(0))
    runs = items.select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    runs = runs.select("item_id", F.slice("words", F.col("i") + 1, F.lit(WINDOW)).alias("window"))
    return runs.groupBy("window").agg(F.collect_set("item_id").alias("items")).withColumn("n", F.size("window"))


def _tokens(found: DataFrame, sizes: list[int]) -> DataFrame:
    """The shingles of all windows: id, n, at, shingle, check."""
    size = F.least(F.col("n"), F.lit(SHINGLE))
    parts = [found.where(size == k).select("id", "n", F.inline(_shingles("window", k))) for k in sizes or [SHINGLE]]
    return reduce(DataFrame.unionByName, parts)


def known_shingles(scratch: Scratch, docs: DataFrame, tokens: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """doc_id, version (a hash of the text), place, shingle and check of every shingle that a window has too.

    One more row per document has the shingle ``EVERY`` and, as its place, the number of words
    below zero less one.
    """
    split = docs.select("doc_id", F.xxhash64("text").alias("version"), plain_words(F.col("text")).alias("words"))
    every = f"array(struct(-size(words) - 1 AS at, {EVERY}L AS shingle, 0L AS check))"
    parts = F.concat(F.expr(every), *(_shingles("words", k) for k in sizes))
    rows = split.select("doc_id", "version", F.inline(parts))
    wanted = tokens.select("shingle").union(tokens.sparkSession.range(1).select(F.lit(EVERY).cast("long"))).distinct()
    kept = rows.join(F.broadcast(wanted) if small else wanted, "shingle")
    return scratch.freeze(kept.select("doc_id", "version", F.col("at").alias("place"), "shingle", "check"), "shingles")


def occurrences(scratch: Scratch, benchmark: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where windows occur (doc_id, version, start, n, items: one row per window and place), and the documents (doc_id, version, n_words)."""
    found = scratch.freeze(windows(benchmark).withColumn("id", F.monotonically_increasing_id()), "windows")
    sizes = sorted(r[0] for r in found.select(F.least(F.col("n"), F.lit(SHINGLE))).distinct().collect())  # SHINGLE values at most
    tokens = scratch.freeze(_tokens(found, sizes), "tokens")
    small = tokens.count() <= BROADCAST_SHINGLES

    def sent(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if small else frame

    known = known_shingles(scratch, docs, tokens, sizes, small)
    rows = known.where(F.col("shingle") == EVERY).where("place < 0")
    rows = rows.select("doc_id", "version", (-F.col("place") - 1).alias("n_words"))
    known = known.where("place >= 0").select(F.struct("doc_id", "version").alias("of"), "place", "shingle", "check")

    # A shingle the corpus does not have is the rarest of all: its windows need no join.
    counts = known.groupBy("shingle").agg(F.count("*").alias("n_seen"))
    ranked = tokens.join(counts, "shingle", "left").withColumn("n_seen", F.coalesce("n_seen", F.lit(0)))
    rarest = ranked.groupBy("id").agg(F.min(F.struct("n_seen", "at", "shingle", "check")).alias("first")).where("first.n_seen > 0")
    prefixes = scratch.freeze(rarest.select("id", "first.at", "first.shingle", F.col("first.check").alias("own_check")), "prefixes")
    met = known.join(sent(prefixes), "shingle").where("check = own_check AND place >= at")
    candidates = met.select("of", "id", (F.col("place") - F.col("at")).alias("start")).distinct()

    ends = tokens.where(F.col("at").isin(0) | (F.col("at") == F.col("n") - SHINGLE)).select("id", "at", "shingle")
    due = candidates.join(sent(ends), "id").select("of", (F.col("start") + F.col("at")).alias("place"), "shingle", "id", "start")
    around = known.join(candidates.select("of").distinct(), "of", "left_semi").select("of", "place", "shingle").distinct()
    there = due.join(around, ["of", "place", "shingle"]).groupBy("of", "id", "start").agg(F.count("*").alias("n_there"))
    whole = there.join(sent(found.select("id", "n")), "id").where("n_there = IF(n > {0}, 2, 1)".format(SHINGLE))
    whole = whole.join(found.select("id", "items"), "id")
    return whole.select("of.doc_id", "of.version", "start", "n", "items"), rows


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: doc_id, version (a hash of the text), n_words, n_hit, n_items, items (sorted, as text), items_sha256, contaminated."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    found, rows = occurrences(scratch, benchmark, docs.select("doc_id", "text"))
    spans = found.groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.transform("items", lambda i: i.cast("string")))))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    spans = spans.select(F.col("doc_id").alias("id"), F.col("version").alias("of"), covered.alias("n_hit"), "items")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("of"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(spans, same, "left").select(
        "doc_id",
        "version",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any window of the benchmark, all columns."""
    hit = decontaminate(docs, benchmark).where("contaminated")
    hit = hit.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version")).distinct()
    same = docs["doc_id"].eqNullSafe(hit["__id"]) & (F.xxhash64(docs["text"]) == hit["__version"])
    return docs.join(hit, same, "left_anti")
