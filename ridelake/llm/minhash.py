"""Near-duplicate documents by one-permutation MinHash.

A document is its set of distinct five-word shingles. One hash per shingle both picks a bin and
is the value of which the bin keeps the least; an empty bin takes over the value of the first
non-empty bin in an order that is the same for all documents (optimal densification). Four bins
make a band; documents that agree on a band share a bucket. A bucket of n documents gives n - 1
candidate pairs: a star around its most popular member, the one that shares buckets with the
most documents, which in a family of edited copies is the original. Candidates are confirmed on
the full shingle sets.

A document left outside the component of a bucket's center may still have a link to another
member. Of such open documents and those they share a bucket with, shingles are ordered by
rarity; two sets as similar as asked for share a shingle among the rarest of either (15 % of them
at 0.85, 20 % at 0.8), so only pairs that do are compared. Nothing is capped, and no bucket is
expanded into its pairs.

How similar linked sets are at least is a parameter, in per cent. Two documents share none of the
32 bands with probability 6e-11 at a similarity of 0.85, and 5e-8 at 0.8.

Defined cases: null texts, and texts without words, have the empty set and are linked with
nothing; very long texts are read whole; an empty table gives no rows; fewer than five words make one shingle of all; rows with a null doc_id are linked with
nothing, have no component and are kept; rows with equal doc_id are one node, linked by any of
their texts. Only doc_id and text are read; ``one_of_each`` keeps all columns, whatever their names. Sets are compared by 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.components import components
from ridelake.llm.steps import Scratch
from ridelake.llm.textbytes import SOLID, Words, mix, pair, pieces, shingles

SHINGLE = 5
BINS, ROWS = 128, 4
BIN_BITS = 7
SIMILARITY = 85  # per cent, where nothing else is asked for

_EMPTY = np.uint64(2**64 - 1)
#: For every bin the order in which an empty one asks the others.
_PROBES = np.argsort(np.random.RandomState(17).rand(BINS, BINS), axis=1).T


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, one text after the other, and where each begins."""
    words = Words(texts, SOLID, lower=True)
    hashes, of = words.hashes(), words.text_of()
    names, owner = [], []
    for size in range(1, SHINGLE + 1):
        runs = shingles(hashes, size)
        whole = of[: len(runs)] == of[size - 1 :][: len(runs)]
        if size < SHINGLE:  # a text of exactly so many words
            whole &= words.counts[of[: len(runs)]] == size
        names.append(runs[whole])
        owner.append(of[: len(runs)][whole])
    name, text = np.concatenate(names), np.concatenate(owner)
    order = np.lexsort((name, text))
    name, text = name[order], text[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
    name, text = name[new], text[new]
    return name, np.searchsorted(text, np.arange(len(texts) + 1))


def band_keys(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bucket keys, one row of bands per text; texts with an empty set get meaningless ones."""
    n = len(at) - 1
    text = np.repeat(np.arange(n), np.diff(at))
    slot = text * BINS + (names >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]  # ascending hashes: the least of a bin comes first
    bins = np.full(n * BINS, _EMPTY)
    bins[slot[first]] = names[first]
    bins = bins.reshape(n, BINS)
    own = bins.copy()
    row, column = np.nonzero((own == _EMPTY) & (np.diff(at) > 0)[:, None])
    for probe in _PROBES:
        if not len(row):
            break
        value = own[row, probe[column]]
        found = value != _EMPTY
        bins[row[found], column[found]] = value[found]
        row, column = row[~found], column[~found]
    keys = np.broadcast_to(np.arange(BINS // ROWS, dtype=np.uint64), (n, BINS // ROWS))
    for k in range(ROWS):
        keys = pair(keys, bins[:, k::ROWS])
    return keys


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set (f1, f2) and bands, its bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                names, at = shingle_sets(piece.column("text"))
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(names + np.uint64(k)))]) for k in (1, 2)]
                prints = [(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums]
                keys = band_keys(names, at).view(np.int64)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(np.diff(at)), *map(pa.array, prints), bands],
                    ["doc_id", "n_shingles", "f1", "f2", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", "text")
    return read.mapInArrow(run, f"doc_id {kind}, n_shingles long, f1 long, f2 long, bands array<long>")


def _confirm(pairs: DataFrame, sizes: DataFrame, texts: DataFrame, similarity: int) -> DataFrame:
    """Add ``linked``: whether the full sets of a and b are as similar as asked for.

    Pairs whose sizes alone rule a link out are left out before any text is fetched.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    sized = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
    alike = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity
    with_b = sized.where(alike).select("a", "b").distinct().join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text_a", "text_b"):
                (xs, x_at), (ys, y_at) = shingle_sets(piece.column("text_a")), shingle_sets(piece.column("text_b"))
                linked = np.zeros(piece.num_rows, bool)
                for k in range(piece.num_rows):
                    x, y = xs[x_at[k] : x_at[k + 1]], ys[y_at[k] : y_at[k + 1]]
                    small, large = (x, y) if len(x) < len(y) else (y, x)
                    if 100 * len(small) >= similarity * len(large) and len(small):
                        place = np.minimum(np.searchsorted(large, small), len(large) - 1)
                        common = int((large[place] == small).sum())
                        linked[k] = 100 * common >= similarity * (len(x) + len(y) - common)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("a"), piece.column("b"), pa.array(linked)], ["a", "b", "linked"]
                )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}, linked boolean")


def linked_components(scratch: Scratch, docs: DataFrame, prints: DataFrame, similarity: int) -> DataFrame:
    """node and component of the documents that have a link, among one document per distinct set."""
    first = prints.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("f1", "f2", "n_shingles")
    first = first.agg(F.min("doc_id").alias("doc_id"))
    node = ["doc_id", "f1", "f2"]
    nodes = prints.join(first.select(*node), node, "left_semi").dropDuplicates(node)  # a repeated row is one node
    bands = nodes.select("doc_id", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    entries = scratch.freeze(bands.join(shared, "bucket"), "entries")
    popular = entries.groupBy("doc_id").agg(F.sum("n").alias("popular"))
    known = entries.join(popular, "doc_id")
    centers = known.groupBy("bucket").agg(F.max_by("doc_id", F.struct("popular", "doc_id")).alias("center"))
    entries = scratch.freeze(entries.join(centers, "bucket").select("bucket", "doc_id", "center"), "stars")

    sizes = prints.join(popular.select("doc_id"), "doc_id", "left_semi").select("doc_id", "n_shingles").distinct()
    sizes = scratch.freeze(sizes, "sizes")  # of a doc_id with several texts, all
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("version"))
    texts = texts.join(popular.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "version"])
    texts = scratch.freeze(texts.select("doc_id", "text"), "texts")
    scratch.drop("entries")
    pairs = entries.where("doc_id <> center").select(F.col("center").alias("a"), F.col("doc_id").alias("b")).distinct()
    compared = scratch.freeze(_confirm(pairs, sizes, texts, similarity), "compared")
    links = compared.where("linked").select("a", "b")
    labels = components(scratch, "by-stars", links)

    stars = _with_component(_with_component(entries, labels, "doc_id"), labels, "center")
    open_ = scratch.freeze(stars.where("doc_id_component <> center_component").select("bucket", "doc_id"), "open")
    if open_.isEmpty():
        scratch.drop("stars", "sizes", "texts", "compared", "open")
        return labels
    pairs = _pairs_by_prefix(scratch, entries, open_, texts, labels, similarity)
    pairs = pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
    pairs = pairs.join(compared.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    more = scratch.freeze(_confirm(pairs, sizes, texts, similarity), "compared-open")
    scratch.drop("stars", "sizes", "texts", "open", "prefixes")
    labels = components(scratch, "all", links.unionByName(more.where("linked").select("a", "b")))
    scratch.drop("compared", "compared-open")
    return labels


def _shingle_rows(texts: DataFrame) -> DataFrame:
    """doc_id, n (its set's size) and shingle, a row for each of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                names, at = shingle_sets(piece.column("text"))
                sizes = np.diff(at)
                owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").take(owner), pa.array(np.repeat(sizes, sizes)), pa.array(names.view(np.int64))],
                    ["doc_id", "n", "shingle"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, shingle long")


def _pairs_by_prefix(
    scratch: Scratch, entries: DataFrame, open_: DataFrame, texts: DataFrame, labels: DataFrame, similarity: int
) -> DataFrame:
    """Pairs of an open document and another of its buckets' that share one of their rarest shingles.

    At a similarity of s a set of n with a link has at least ceil(s n) shingles in common with the
    other, so at least one among its rarest n - ceil(s n) + 1, in any order that all sets agree on; the
    rarest of the common ones is in both prefixes. If it is the i-th of one set and the j-th of the
    other, no more than what follows there can be common too, which must be enough for a link.
    """
    around = entries.join(open_.select("bucket").distinct(), "bucket", "left_semi").select("doc_id").distinct()
    rows = _shingle_rows(texts.join(around, "doc_id", "left_semi"))
    rows = scratch.freeze(rows, "shingles")
    seen = rows.groupBy("shingle").agg(F.count("*").alias("seen")).where("seen > 1")
    ranked = rows.join(seen, "shingle").groupBy("doc_id", "n")  # shingles of one document only pair nothing
    ranked = ranked.agg(F.array_sort(F.collect_list(F.struct("seen", "shingle"))).alias("common"))
    alone = F.col("n") - F.size("common")  # in no other set, and so the rarest
    reach = F.floor((F.lit(100 - similarity) * F.col("n")) / 100) + 1 - alone
    prefix = F.slice("common", F.lit(1), F.greatest(reach, F.lit(0)).cast("int"))
    prefixes = ranked.select("doc_id", "n", alone.alias("alone"), F.posexplode(F.transform(prefix, lambda t: t["shingle"])))
    after = F.col("n") - F.col("alone") - F.col("pos")  # the shingle and what follows it
    prefixes = prefixes.select("doc_id", "n", after.alias("after"), F.col("col").alias("shingle"))
    prefixes = scratch.freeze(_with_component(prefixes, labels, "doc_id"), "prefixes")
    scratch.drop("shingles")
    mine = prefixes.join(open_.select("doc_id").distinct(), "doc_id", "left_semi")
    mine = mine.select(
        F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("after").alias("after_a"), "shingle",
        F.col("doc_id_component").alias("of_a"),
    )
    enough = (100 + similarity) * F.least("after_a", "after") >= similarity * (F.col("n_a") + F.col("n"))
    met = mine.join(prefixes, "shingle").where((F.col("of_a") != F.col("doc_id_component")) & enough)
    return met.select(F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b")).distinct()


def _with_component(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_component``; a document without links is its own."""
    of = labels.select(F.col("node").alias(column), F.col("component").alias("__component"))
    joined = rows.join(of, column, "left")
    return joined.withColumn(f"{column}_component", F.coalesce("__component", column)).drop("__component")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least doc_id reachable by links) and kept (whether that is its own).

    ``similarity`` is the least Jaccard similarity of linked sets, in per cent.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    prints = scratch.freeze(signatures(docs), "signatures")
    labels = linked_components(scratch, docs, prints, similarity)
    known = prints.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "n_shingles", "f1", "f2")
    first = known.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("first"))
    placed = _with_component(known.join(first, ["f1", "f2", "n_shingles"]), labels, "first")
    of_doc = placed.groupBy("doc_id").agg(F.min("first_component").alias("component"), F.max("first_component").alias("other"))
    # A doc_id with several texts ties their components together.
    ties = of_doc.where("component <> other").select(F.col("component").alias("a"), F.col("other").alias("b"))
    if not ties.isEmpty():
        nodes = placed.select(F.col("doc_id").alias("a"), F.col("first_component").alias("b")).distinct()
        merged = components(scratch, "ties", nodes)
        of_doc = of_doc.select("doc_id").join(merged.withColumnRenamed("node", "doc_id"), "doc_id")
    of_doc = of_doc.select("doc_id", F.col("component").alias("component_id"))
    component = F.coalesce("component_id", "doc_id")
    return prints.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One row of every group of near-duplicates, all columns; rows with an empty set all stay.

    Here every row counts, whatever its doc_id: those with a null doc_id are linked too, and copies
    under one doc_id are copies. The row with the least doc_id stays (null last), of equal ones that
    with the least hash of its text, of rows that agree in both any one.
    """
    kind = docs.schema["doc_id"].dataType
    number = F.coalesce("doc_id", F.lit(0).cast(kind)) if kind.simpleString() != "string" else F.coalesce("doc_id", F.lit(""))
    node = F.struct(
        F.col("doc_id").isNull().cast("int").alias("nameless"), number.alias("number"), F.xxhash64("text").alias("version")
    )
    found = near_duplicates(docs.select(node.alias("doc_id"), "text"), similarity).where("n_shingles > 0")
    found = found.groupBy("doc_id").agg(F.max(~F.col("kept")).alias("goes"), F.count("*").alias("copies"))
    found = found.where("goes OR copies > 1").select(F.col("doc_id").alias("node"), "goes")
    found = Scratch(docs.sparkSession, "minhash-gone").freeze(found, "found")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), node.alias("node"))
    alone = rows.join(found, "node", "left_anti").select("row")
    repeated = rows.join(found.where("NOT goes").select("node"), "node", "left_semi")
    one = repeated.groupBy("node").agg(F.first("row").alias("row")).select("row")
    return alone.unionByName(one).select(*(F.col(f"row.`{c}`") for c in docs.columns))
