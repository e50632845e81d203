"""Substring dedup over words by recompression.

Texts are rewritten in rounds that depend on nothing but the symbols themselves: runs of an equal
word become a symbol, and twice, adjacent symbols become one where the left is from the left half
of the alphabet and the right from the right half, a coin that the symbol's name decides. A name
is a hash of what it stands for (the word and its number, or the two halves), so all tasks name
alike, and equal substrings get the same symbols except near their ends. What a symbol depends
on is known: itself, and the neighbour that could have taken it away. ``ROUNDS`` pairings make symbols of
up to four words that depend on three words more on either side, which is the last level of which
every window of ``WINDOW`` words holds one whole, unless runs take up its middle. A window is represented
by the least-named symbol that it holds with all it depends on, under the name of both; equal
windows have the same one.

Spark gathers the symbols that represent windows, one row per document and symbol, and finds
those that several documents share (``symbols`` lists all of all levels with what they stand for). Only around those are segments named: all words of the
windows one symbol represents. Equal segments prove their windows repeated at once; where
documents share a symbol but not the segment, that is at the ends of repeats and around edits,
windows are named and compared one by one. Names that decide are 128-bit hashes.

A word goes if it lies in a window whose words also start in a document with a smaller doc_id;
windows are judged on the input. Defined cases: null and empty texts have no words and no
window, nor have texts of fewer than ``WINDOW`` words; very long texts are read whole; windows that hold no
symbol whole (inside long runs) are segments of their own, one for as many equal ones as follow
each other; rows with a null doc_id have no order, so they neither lose words nor make
others lose any; rows with equal doc_id do not count as smaller than each other; no documents
give no rows. Only doc_id and text are read, other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.llm.steps import Scratch
from ridelake.operators.lookups import spread_join
from ridelake.llm.textbytes import SOLID, Words, pair, pieces, powers

WINDOW = 13
ROUNDS = 2  # of pairing, after the runs
#: Bits of a name that say which half of the alphabet a symbol is in, one for each round.
COINS = (np.uint64(1 << 60), np.uint64(1 << 59))

_NONE = np.uint64(2**64 - 1)
_FAR = 1 << 30
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_INVERSES = tuple(pow(b, -1, 2**64) for b in _BASES)


class Symbols:
    """A piece's texts at one level: where symbols begin and end (words), what they stand for, and what they depend on.

    ``left`` and ``right`` are the word and its number, or the names of the two halves, where asked for. A symbol is there
    whenever the words from ``first`` to before ``last`` are, whatever is around them.
    """

    def __init__(self, begin, end, name, left, right, first, last, text):
        self.begin, self.end, self.name, self.left, self.right = begin, end, name, left, right
        self.first, self.last, self.text = first, last, text

    @classmethod
    def runs(cls, hashes: np.ndarray, text: np.ndarray) -> Symbols:
        """Level 0: maximal runs of a word. That it ends depends on the words before and after it."""
        n = len(hashes)
        new = np.ones(n, bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], n)[: len(begin)]
        word, times = hashes[begin], (end - begin).astype(np.uint64)
        of = text[begin]
        begin, end = begin.astype(np.int32), end.astype(np.int32)
        return cls(begin, end, pair(word, times), word, times, begin - 1, end + 1, of)

    def paired(self, coin: np.uint64, productions: bool) -> Symbols:
        """The next level. A symbol of the left half can only join its right neighbour, one of the right half its left."""
        n = len(self.name)
        lefts = (self.name & coin) == 0
        joins = np.zeros(n, bool)
        same = self.text[:-1] == self.text[1:]
        joins[:-1] = lefts[:-1] & ~lefts[1:] & same
        taken = np.zeros(n, bool)
        taken[1:] = joins[:-1]
        after, before = np.full(n, _FAR, np.int32), np.full(n, -_FAR, np.int32)  # what lies beyond the text is unknown
        after[:-1] = np.where(same, self.last[1:], _FAR)
        before[1:] = np.where(same, self.first[:-1], -_FAR)
        first = np.where(lefts, self.first, np.minimum(self.first, before))
        last = np.where(lefts, np.maximum(self.last, after), self.last)
        head = np.flatnonzero(~taken)
        two = joins[head]
        tail = np.minimum(head + 1, max(n - 1, 0))

        def of(pairs: np.ndarray, singles: np.ndarray) -> np.ndarray:
            return np.where(two, pairs, singles[head])

        return Symbols(
            self.begin[head], of(self.end[tail], self.end), of(pair(self.name[head], self.name[tail]), self.name),
            *((of(self.name[head], self.left), of(self.name[tail], self.right)) if productions else (None, None)),
            of(self.first[head], first), of(self.last[tail], last), self.text[head],
        )


class Parse:
    """Words, windows and the symbols that represent them, for the texts of a piece."""

    def __init__(self, texts: pa.Array, productions: bool = False):
        self.words = Words(texts, SOLID)
        self.hashes = self.words.hashes()
        self.text = self.words.text_of()
        n = len(self.hashes)
        count = max(n - WINDOW + 1, 0)
        whole = self.text[:count] == self.text[WINDOW - 1 :][:count]
        self.windows = np.flatnonzero(whole)  # first words of the windows
        self.levels = [Symbols.runs(self.hashes, self.text)]
        for coin in COINS[:ROUNDS]:
            self.levels.append(self.levels[-1].paired(coin, productions))
        top = self.levels[-1]
        sums = self._sums(0)
        known = np.flatnonzero((top.first >= self.words.at[top.text]) & (top.last <= self.words.at[top.text + 1]))
        # Many documents share a short symbol; with the words it depends on, which a window must hold anyway, few do.
        around = pair(top.name[known], self._span(0, sums, top.first[known], top.last[known]))
        begin, far = top.begin[known], 127
        name, before, after = np.full(n, _NONE), np.full(n, far, np.int8), np.full(n, far, np.int8)
        name[begin] = around >> np.uint64(1)
        before[begin] = np.minimum(begin - top.first[known], far)
        after[begin] = np.minimum(top.last[known] - begin, far)
        best, place = np.full(count, _NONE), np.full(count, -1, np.int8)
        for step in range(1, WINDOW - 1):  # symbols that begin so many words into each window
            held = (before[step : step + count] <= step) & (after[step : step + count] <= WINDOW - step)
            least = np.where(held, name[step : step + count], _NONE)
            place[least < best] = step
            np.minimum(best, least, out=best)
        best, place = best[self.windows], place[self.windows]
        self.border = np.where(place >= 0, self.windows + place, -1)  # where the representing symbol begins
        lone = best == _NONE
        if lone.any():
            best[lone] = pair(self._span(0, sums, self.windows[lone], self.windows[lone] + WINDOW), np.full(lone.sum(), 13, np.uint64))
        self.name = best

    def _sums(self, which: int) -> np.ndarray:
        n = len(self.hashes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hashes * powers(_BASES[which], n), out=sums[1:])
        return sums

    def _span(self, which: int, sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return pair((sums[end] - sums[first]) * powers(_INVERSES[which], len(sums))[first], (end - first).astype(np.uint64))

    def spans(self, first: np.ndarray, end: np.ndarray, extra: np.ndarray) -> list[pa.Array]:
        """A 128-bit name of the words from first to end, in two columns."""
        return [
            pa.array(pair(self._span(k, self._sums(k), first, end), extra.astype(np.uint64)).view(np.int64)) for k in (0, 1)
        ]

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first window of every segment, and how many windows it has."""
        n = len(self.windows)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = self.text[self.windows]
        new = np.ones(n, bool)
        new[1:] = (self.border[1:] != self.border[:-1]) | (self.name[1:] != self.name[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        return first, np.diff(np.append(first, n))

    def place(self, word: np.ndarray) -> np.ndarray:
        """The number of a word within its text."""
        return word - self.words.at[self.text[word]]


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _symbol_rows(docs: DataFrame) -> DataFrame:
    """The symbols that represent windows and doc_id, once per document or little more; a window without one is a symbol of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                parse = Parse(piece.column("text"))
                first, _ = parse.segments()
                owner, name = parse.text[parse.windows[first]], parse.name[first]
                order = np.lexsort((name, owner))
                owner, name = owner[order], name[order]
                new = np.ones(len(name), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[new].view(np.int64)), piece.column("doc_id").take(pa.array(owner[new]))], ["symbol", "doc_id"]
                )

    return docs.mapInArrow(run, f"symbol long, doc_id {_kind(docs)}")


def symbols(docs: DataFrame) -> DataFrame:
    """All symbols of all levels: level, symbol, left, right, n_words, n (occurrences) and n_docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                for level, of in enumerate(Parse(piece.column("text"), productions=True).levels):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(of.name), level, np.int32)),
                            *(pa.array(x.view(np.int64)) for x in (of.name, of.left, of.right)),
                            pa.array((of.end - of.begin).astype(np.int64)),
                            piece.column("doc_id").take(pa.array(of.text)),
                        ],
                        ["level", "symbol", "left", "right", "n_words", "doc_id"],
                    )

    rows = docs.select("doc_id", "text").mapInArrow(
        run, f"level int, symbol long, left long, right long, n_words long, doc_id {_kind(docs)}"
    )
    per_doc = rows.groupBy("level", "symbol", "left", "right", "n_words", "doc_id").agg(F.count("*").alias("n"))
    return per_doc.groupBy("level", "symbol", "left", "right", "n_words").agg(F.sum("n").alias("n"), F.count("*").alias("n_docs"))


def _segment_rows(docs: DataFrame) -> DataFrame:
    """The segments of the symbols listed in ``borders``: border, s1 and s2 (name), doc_id, version, first (word), n (windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                parse = Parse(piece.column("text"))
                first, n = parse.segments()
                owner, name = parse.text[parse.windows[first]], parse.name[first]
                wanted = piece.column("borders")
                of = np.repeat(np.arange(piece.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
                known = pair(wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64), of.astype(np.uint64))
                take = np.flatnonzero(np.isin(pair(name, owner.astype(np.uint64)), known))
                start = parse.windows[first[take]]
                lone = parse.border[first[take]] < 0  # equal windows, named as one of them
                offset = np.where(lone, 0, parse.border[first[take]] - start)
                end = start + np.where(lone, 1, n[take]) + WINDOW - 1
                doc = pa.array(owner[take])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(name[take].view(np.int64)),
                        *parse.spans(start, end, offset),
                        piece.column("doc_id").take(doc),
                        piece.column("version").take(doc),
                        pa.array(parse.place(start).astype(np.int32)),
                        pa.array(n[take].astype(np.int32)),
                    ],
                    ["border", "s1", "s2", "doc_id", "version", "first", "n"],
                )

    kind = _kind(docs)
    return docs.mapInArrow(run, f"border long, s1 long, s2 long, doc_id {kind}, version long, first int, n int")


def _window_rows(docs: DataFrame) -> DataFrame:
    """The single windows of the segments listed in ``segments``: w1 and w2 (name), doc_id, version, first (word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                parse = Parse(piece.column("text"))
                listed = piece.column("segments")
                of = np.repeat(np.arange(piece.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
                parts = listed.flatten()
                n = parts.field("n").to_numpy()
                start = np.repeat(parse.words.at[of] + parts.field("first").to_numpy(), n)
                start += np.arange(len(start)) - np.repeat(np.cumsum(n) - n, n)
                doc = pa.array(np.repeat(of, n))
                yield pa.RecordBatch.from_arrays(
                    [
                        *parse.spans(start, start + WINDOW, np.zeros(len(start))),
                        piece.column("doc_id").take(doc),
                        piece.column("version").take(doc),
                        pa.array(parse.place(start).astype(np.int32)),
                    ],
                    ["w1", "w2", "doc_id", "version", "first"],
                )

    return docs.mapInArrow(run, f"w1 long, w2 long, doc_id {_kind(docs)}, version long, first int")


def _with_least(rows: DataFrame, name1: str, name2: str) -> DataFrame:
    """Add ``least``, the least doc_id among the rows of a 128-bit name.

    The minimum is combined in the tasks; on the way back the rows of a name that very many share
    are cut into pieces, each with a copy of its minimum.
    """
    least = rows.groupBy(name1, name2).agg(F.min("doc_id").alias("least")).withColumnRenamed(name2, "__name2")
    numbered = rows.withColumn("__row", F.xxhash64("doc_id", "first"))
    met = spread_join(numbered, least, name1, "__row", "inner")
    return met.where(F.col(name2) == F.col("__name2")).drop("__name2", "__row")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Runs of windows that also start in a document with a smaller doc_id: doc_id, version (a hash of the text), first, n."""
    scratch = Scratch(docs.sparkSession, "recompress")
    read = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("version"), "text")

    named = scratch.freeze(_symbol_rows(read.select("doc_id", "text")), "named")
    shared = named.groupBy("symbol").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    wanted = named.join(shared.where("least < most").select("symbol"), "symbol", "left_semi")
    wanted = wanted.groupBy("doc_id").agg(F.collect_set("symbol").alias("borders"))
    wanted = scratch.freeze(wanted, "wanted")
    segments = scratch.freeze(_segment_rows(read.join(wanted, "doc_id").select("doc_id", "version", "text", "borders")), "segments")
    scratch.drop("named", "wanted")

    judged = _with_least(segments, "s1", "s2")
    judged = scratch.freeze(judged.select("border", "s1", "doc_id", "version", "first", "n", "least"), "judged")
    scratch.drop("segments")
    whole = judged.where("least < doc_id").select("doc_id", "version", "first", "n")

    # A segment that no smaller document has may still share windows with others of its border.
    lead = judged.where("least = doc_id").select("border", "s1", "doc_id", "version", "first", "n")
    mixed = lead.groupBy("border").agg(
        F.min("s1").alias("s_least"), F.max("s1").alias("s_most"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
    )
    mixed = mixed.where("s_least <> s_most AND least < most").select("border")
    listed = lead.join(mixed, "border").groupBy("doc_id", "version").agg(F.collect_list(F.struct("first", "n")).alias("segments"))
    listed = scratch.freeze(listed, "listed")
    windows = _window_rows(read.join(listed, ["doc_id", "version"]).select("doc_id", "version", "text", "segments"))
    windows = scratch.freeze(windows, "windows")
    scratch.drop("listed")
    single = _with_least(windows, "w1", "w2").where("least < doc_id")
    return whole.unionByName(single.select("doc_id", "version", "first", F.lit(1).alias("n")))


def edited_rows(docs: DataFrame) -> DataFrame:
    """Per row: the whole row as a struct ``row``, n_words, n_removed and kept, the words that stay joined by one space."""
    scratch = Scratch(docs.sparkSession, "recompress-spans")
    runs = repeated_windows(docs).groupBy("doc_id", "version").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    runs = scratch.freeze(runs.select(F.col("doc_id").alias("id"), F.col("version").alias("of"), "runs"), "runs")
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    read = docs.select(whole, F.xxhash64("text").alias("version"))
    joined = read.join(runs, (F.col("row.doc_id") == F.col("id")) & (F.col("version") == F.col("of")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                words = Words(piece.column("text"), SOLID)
                removed = _covered(words, piece.column("runs"))
                gone = np.add.reduceat(np.append(removed, False).astype(np.int64), words.at[:-1]) * (words.counts > 0)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(words.counts), pa.array(gone), _joined(words, ~removed)],
                    ["row", "n_words", "n_removed", "kept"],
                )

    counts = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    schema = T.StructType([read.schema["row"], *counts, T.StructField("kept", T.StringType())])
    return joined.select("row", F.col("row.text").alias("text"), "runs").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and kept, the words that stay joined by one space."""
    return edited_rows(docs.select("doc_id", "text")).select("row.doc_id", "n_words", "n_removed", "kept")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows with their repeats cut out, all columns.

    A text that loses nothing stays as it is, white space included; a row of which nothing is
    left goes; n_chars follows the new text.
    """
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(F.col("row.n_chars"))
    left = edited_rows(docs).where("n_words = 0 OR n_removed < n_words")
    return left.select(*(new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns))


def _covered(words: Words, runs: pa.Array) -> np.ndarray:
    """Whether each word lies in one of its text's runs of windows."""
    lengths = runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    parts = runs.flatten()
    begin = np.repeat(words.at[:-1], lengths) + parts.field("first").to_numpy(zero_copy_only=False)
    end = begin + parts.field("n").to_numpy(zero_copy_only=False) + WINDOW - 1
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth)[:-1] > 0


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of every text, with one space between them."""
    data = np.append(words.bytes, np.uint8(0x20))
    starts, ends = words.starts[kept], words.ends[kept]
    text = words.text_of()[kept]
    depth = np.zeros(len(data) + 1, np.int8)
    depth[starts] += 1
    depth[ends] -= 1
    take = np.cumsum(depth[:-1]) > 0
    later = np.ones(len(text), bool)
    later[:1] = False
    later[1:] = text[1:] == text[:-1]
    gap = starts[later] - 1  # words of one text are never adjacent bytes
    take[gap] = True
    data[gap] = 0x20
    sizes = np.zeros(len(data) + 1, np.int64)
    np.cumsum(take, out=sizes[1:])
    at = sizes[words.text_at].astype(np.int64)
    out = data[take]
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(out)).cast(pa.string())
