"""Substring dedup over bytes by a distributed merge sort of suffixes.

A string of ``LENGTH`` bytes that also starts elsewhere is removed wherever it occurs. Not every
suffix has to be sorted to find them: every window of that length is represented by the one
position in it whose next ``SEED`` bytes hash least, equal windows by the same one, and positions
whose seed occurs once in the corpus cannot belong to a repeat. The suffixes that are left, each
with the bytes before it that a window can reach, are sorted inside the tasks, equal ones counted
once. The sorted runs travel front-coded, an entry as the length it shares with the one before
it and the rest. A bucket receives all suffixes with the same seeds and merges its runs with a
loser tree: every entry carries the prefix it is known to share with the last one put out, and
only bytes beyond that are ever compared. These prefixes decide: a window that begins d bytes
before its entry is a repeat if an entry that shares the ``LENGTH`` - d bytes after it, a neighbour in
the merged order, has the same d bytes before it, or if its entry was counted twice. Of seeds
beyond ``HOT_SEED`` occurrences, which no bucket may hold, every window is a row under a 128-bit name that Spark counts.

Defined cases: null counts as an empty text; very long texts are read whole; an empty table gives
no rows; texts shorter than ``LENGTH`` lose nothing; matches
never cross texts; texts that occur several times lose all they have if long enough; strings
are judged on the input, not on what is left. Rows with equal or null doc_id are texts of their
own. What remains is bytes, as a cut may fall inside a character. Only doc_id and text are read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.steps import Scratch
from ridelake.llm.textbytes import BASE, BASE_INVERSE, BYTE_VALUE, flat, mix, pair, pieces, powers

LENGTH = 200
SEED = 64
REACH = LENGTH - SEED  # bytes a window may have before its representative
RUN_ENTRIES = 50_000  # suffixes sorted at once in a task
BUCKET_ENTRIES = 20_000  # suffixes a merge is to receive on average
GROUP_ENTRIES = 4_096  # suffixes whose windows are named at once, in whole groups
HOT_ENTRIES = 2_048  # distinct suffixes of hot seeds whose windows are named at once
HOT_SEED = 16_384  # occurrences of a seed beyond which its windows are counted by Spark
NAMES_AT_ONCE = 1 << 18  # windows of a group that are named at once, by their distance

#: Base and byte values of the second half of a 128-bit name.
BASE_2 = 0xC2B2AE3D27D4EB4F
BYTE_VALUE_2 = mix(BYTE_VALUE) | np.uint64(1)


class Texts:
    """The bytes of a piece and the positions that represent its windows."""

    def __init__(self, texts: pa.Array):
        self.bytes, self.at = flat(texts)
        n = len(self.bytes)
        sizes = np.diff(self.at)
        windows = np.maximum(sizes - LENGTH + 1, 0)
        if not windows.sum():
            self.positions = np.zeros(0, np.int64)
            self.seeds = np.zeros(0, np.uint64)
            self.text = np.zeros(0, np.int64)
            return
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[self.bytes] * powers(BASE, n), out=sums[1:])
        count = n - SEED + 1
        hashes = mix((sums[SEED:] - sums[:count]) * powers(BASE_INVERSE, n)[:count])
        # The place in the low half makes the first of equal hashes the least.
        ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
        least = _sliding_least(ranked, REACH + 1)
        starts = np.repeat(self.at[:-1], windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        self.positions = np.unique((least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64))
        self.seeds = hashes[self.positions]
        self.text = np.searchsorted(self.at, self.positions, side="right") - 1


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values, from minima towards both ends of blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _versioned(docs: DataFrame) -> DataFrame:
    """Texts under a 128-bit name; equal texts have equal results, so no other key is needed."""
    return docs.where("text IS NOT NULL").select(
        F.xxhash64(F.lit(1), "text").alias("v1"), F.xxhash64(F.lit(2), "text").alias("v2"), "text"
    )


def _seed_counts(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                seeds, n = np.unique(Texts(piece.column("text")).seeds, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(n)], ["seed", "n"])

    return texts.select("text").mapInArrow(run, "seed long, n long")


def _seed_rows(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = Texts(piece.column("text"))
                of = pa.array(found.text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.seeds.view(np.int64)), piece.column("v1").take(of), piece.column("v2").take(of)],
                    ["seed", "v1", "v2"],
                )

    return texts.mapInArrow(run, "seed long, v1 long, v2 long")


def common(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix of two strings that share ``known`` bytes at least."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while a[known : known + 32] == b[known : known + 32]:
        known += 32
    x, y = a[known : known + 32], b[known : known + 32]
    m = min(len(x), len(y))
    differ = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
    return known + m if not differ else known + m - (differ.bit_length() + 7) // 8


_ENTRY = struct.Struct("<HHHHIB")


def encode(entries: list[tuple[bytes, bytes, int, int]]) -> bytes:
    """A front-coded run of (suffix, reversed bytes before it, number, 1 or 2 for several), ascending."""
    heads, tails, last, last_left = [], [], b"", b""
    for suffix, left, number, times in entries:
        shared, shared_left = common(last, suffix, 0), common(last_left, left, 0)
        heads.append(_ENTRY.pack(shared, len(suffix) - shared, shared_left, len(left) - shared_left, number, times))
        tails += [suffix[shared:], left[shared_left:]]
        last, last_left = suffix, left
    return struct.pack("<I", len(entries)) + b"".join(heads) + b"".join(tails)


def decode(run: bytes) -> Iterator[tuple[bytes, bytes, int, int, int]]:
    """The entries of a run and, last, the length each shares with the one before it."""
    (n,) = struct.unpack_from("<I", run)
    at, suffix, left = 4 + n * _ENTRY.size, b"", b""
    for shared, more, shared_left, more_left, number, times in _ENTRY.iter_unpack(run[4:at]):
        suffix = suffix[:shared] + run[at : at + more]
        at += more
        left = left[:shared_left] + run[at : at + more_left]
        at += more_left
        yield suffix, left, number, times, shared


def merge(runs: list[Iterator[tuple[bytes, bytes, int, int, int]]]) -> Iterator[tuple[int, int, tuple]]:
    """(prefix shared with the one before, run, entry) of all runs in ascending order, by a loser tree.

    ``shared`` of a run is what its current entry has in common with the last entry put out. Of
    two entries, the one that shares more comes first; only if they share equally much are they
    compared, from there on, and the later one's share is then relative to the earlier one.
    """
    k = len(runs)
    now: list[tuple | None] = [next(r, None) for r in runs]
    shared = [0] * k

    def first(a: int, b: int) -> tuple[int, int]:
        """The run whose entry comes first, then the other, whose share is kept up."""
        if b < 0 or now[b] is None:
            return a, b
        if a < 0 or now[a] is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = now[a][0], now[b][0]
        m = common(x, y, shared[a])
        if m == len(x) or (m < len(y) and x[m] < y[m]):
            shared[b] = m
            return a, b
        shared[a] = m
        return b, a

    size = 1
    while size < k:
        size *= 2
    winners = [-1] * size + [i if i < k else -1 for i in range(size)]
    losers = [-1] * size
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = first(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    while best >= 0 and now[best] is not None:
        yield shared[best], best, now[best]
        entry = next(runs[best], None)
        now[best] = entry
        if entry is not None:
            shared[best] = entry[4]
        node = (best + size) // 2
        while node:
            best, losers[node] = first(best, losers[node])
            node //= 2


#: Rows that leave the tasks; each kind fills some of the columns.
_ROW = {
    "bucket": "int", "run": "long", "entries": "binary", "number": "int", "v1": "long", "v2": "long", "place": "long",
    "w1": "long", "w2": "long", "to_left": "int", "to_right": "int",
}
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _row_batch(n: int, **filled) -> pa.RecordBatch:
    """``n`` rows of ``_ROW``, null in the columns that are not given."""
    columns = [pa.array(filled[name], _ARROW[kind]) if name in filled else pa.nulls(n, _ARROW[kind]) for name, kind in _ROW.items()]
    return pa.RecordBatch.from_arrays(columns, list(_ROW))


def _run_rows(texts: DataFrame, buckets: int) -> DataFrame:
    """Front-coded runs (bucket, run, entries), the places of all entries (run, number, v1, v2, place) and,
    of hot seeds, what ``_hot_windows`` gives (run, number, w1, w2, to_left, to_right)."""

    def emit_hot(found: dict[tuple[bytes, bytes], list[int]], owners: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
        run = uuid.uuid4().int >> 65
        numbers = np.zeros(len(owners), np.int32)
        for number, places in enumerate(found.values()):
            numbers[places] = number
        columns = dict(zip(("v1", "v2", "place"), (list(c) for c in zip(*owners))))
        yield _row_batch(len(owners), run=[run] * len(owners), number=numbers, **columns)
        suffixes, lefts = (list(c) for c in zip(*found))
        times = np.fromiter((min(len(places), 2) for places in found.values()), np.int64, len(found))
        windows = _hot_windows(suffixes, lefts, times)
        n = len(windows["number"])
        yield _row_batch(n, run=[run] * n, **windows)

    def emit(found: dict[tuple[int, bytes, bytes], list[int]], owners: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
        run = uuid.uuid4().int >> 65
        by_bucket: dict[int, list] = {}
        numbers = np.zeros(len(owners), np.int32)
        for number, (bucket, suffix, left) in enumerate(sorted(found)):
            places = found[bucket, suffix, left]
            by_bucket.setdefault(bucket, []).append((suffix, left, number, min(len(places), 2)))
            numbers[places] = number
        n = len(by_bucket)
        yield _row_batch(n, bucket=list(by_bucket), run=[run] * n, entries=[encode(e) for e in by_bucket.values()])
        columns = dict(zip(("v1", "v2", "place"), (list(c) for c in zip(*owners))))
        yield _row_batch(len(owners), run=[run] * len(owners), number=numbers, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, bytes, bytes], list[int]] = {}
        owners: list[tuple[int, int, int]] = []
        hot_found: dict[tuple[bytes, bytes], list[int]] = {}
        hot_owners: list[tuple[int, int, int]] = []
        for batch in batches:
            for piece in pieces(batch):
                texts = Texts(piece.column("text"))
                wanted = piece.column("seeds")
                of = np.repeat(np.arange(piece.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
                known = pair(wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64), of.astype(np.uint64))
                take = np.flatnonzero(np.isin(pair(texts.seeds, texts.text.astype(np.uint64)), known))
                hot_seeds = piece.column("hot").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                hot = np.isin(texts.seeds[take], hot_seeds).tolist()
                data = texts.bytes.tobytes()
                text = texts.text[take]
                v1, v2 = (piece.column(c).to_numpy()[text].tolist() for c in ("v1", "v2"))
                begin, end = texts.at[text].tolist(), texts.at[text + 1].tolist()
                bucket = (texts.seeds[take] % np.uint64(buckets)).astype(np.int64).tolist()
                for k, at in enumerate(texts.positions[take].tolist()):
                    suffix = data[at : min(at + LENGTH, end[k])]
                    left = data[max(at - REACH, begin[k]) : at][::-1]
                    if hot[k]:
                        hot_found.setdefault((suffix, left), []).append(len(hot_owners))
                        hot_owners.append((v1[k], v2[k], at - begin[k]))
                        if len(hot_owners) == RUN_ENTRIES or len(hot_found) == HOT_ENTRIES:
                            yield from emit_hot(hot_found, hot_owners)
                            hot_found, hot_owners = {}, []
                        continue
                    found.setdefault((bucket[k], suffix, left), []).append(len(owners))
                    owners.append((v1[k], v2[k], at - begin[k]))
                    if len(owners) == RUN_ENTRIES:
                        yield from emit(found, owners)
                        found, owners = {}, []
        if owners:
            yield from emit(found, owners)
        if hot_owners:
            yield from emit_hot(hot_found, hot_owners)

    return texts.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in _ROW.items()))


def _fixed(
    strings: list[bytes], width: int, values: np.ndarray = BYTE_VALUE, base: int = BASE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every prefix (0 to width) of the strings, and their lengths."""
    data = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    sums = np.zeros((len(strings), width + 1), np.uint64)
    np.cumsum(values[data] * powers(base, width), axis=1, out=sums[:, 1:])
    return sums, np.fromiter(map(len, strings), np.int64, len(strings))


def reaches(shared: np.ndarray, sizes: np.ndarray, lefts: list[bytes], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the repeated windows of each entry reach to the left and right of it; -1 and -1 if none repeats.

    Entries come in merged order with the prefix each shares with the one before it. A window that
    begins d bytes before its entry is in another one if both share ``LENGTH`` - d bytes, which makes
    them neighbours or has only such ones between them, and the d bytes to the left: the same holds
    in the order of what is to the left, read backwards. So no window is read or named.
    """
    n = len(lefts)
    order = sorted(range(n), key=lefts.__getitem__)
    shared_left = np.array([0, *(common(lefts[a], lefts[b], 0) for a, b in zip(order, order[1:]))])
    left_sizes = np.fromiter(map(len, lefts), np.int64, n)
    to_left, to_right = np.full(n, -1), np.full(n, -1)
    width = max(1, NAMES_AT_ONCE // max(1, n))
    for begin in range(0, REACH + 1, width):  # windows are equal only at the same distance
        ahead = np.arange(begin, min(begin + width, REACH + 1))  # bytes of the window before the entry
        inside = (left_sizes[:, None] >= ahead) & (sizes[:, None] >= LENGTH - ahead)
        right = np.cumsum(shared[:, None] < LENGTH - ahead, axis=0)
        left = np.empty_like(right)
        left[order] = np.cumsum(shared_left[:, None] < ahead, axis=0)
        entry, column = np.nonzero(inside)
        window = ((right * (n + 1) + left) * len(ahead) + np.arange(len(ahead)))[entry, column]
        order_of = np.argsort(window, kind="stable")
        ordered = window[order_of]
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        starts = np.flatnonzero(new)
        total = np.add.reduceat(times[entry[order_of]], starts) if len(starts) else np.zeros(0, np.int64)
        repeated = np.zeros(len(ordered), bool)
        repeated[order_of] = np.repeat(total, np.diff(np.append(starts, len(ordered)))) > 1
        entry, column = entry[repeated], ahead[column[repeated]]
        np.maximum.at(to_left, entry, column)
        np.maximum.at(to_right, entry, LENGTH - column)
    return to_left, to_right


def _hot_windows(suffixes: list[bytes], lefts: list[bytes], times: np.ndarray) -> dict[str, pa.Array | np.ndarray]:
    """number, w1, w2, to_left and to_right, of distinct entries, in two kinds of rows.

    One row for every window name (w1, w2) that occurs among the entries, without a number if it occurs
    more than once, and one without a name for every entry that has such a window, with how far those reach.
    """
    ahead = np.arange(REACH + 1)
    names = []
    for values, base in ((BYTE_VALUE, BASE), (BYTE_VALUE_2, BASE_2)):
        right, right_size = _fixed(suffixes, LENGTH, values, base)
        left, left_size = _fixed(lefts, REACH, values, base)
        inside = (left_size[:, None] >= ahead) & (right_size[:, None] >= LENGTH - ahead)
        name = pair(pair(mix(left[:, ahead]), mix(right[:, LENGTH - ahead])), ahead.astype(np.uint64))
        names.append(name[inside])
    entry, column = np.nonzero(inside)
    order = np.lexsort(names)
    (w1, w2), entry, column = (n[order] for n in names), entry[order], column[order]
    new = np.ones(len(order), bool)
    new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
    starts = np.flatnonzero(new)
    total = np.add.reduceat(times[entry], starts) if len(starts) else np.zeros(0, np.int64)
    twice = np.repeat(total > 1, np.diff(np.append(starts, len(order))))
    to_left, to_right = np.full(len(suffixes), -1), np.full(len(suffixes), -1)
    np.maximum.at(to_left, entry[twice], column[twice])
    np.maximum.at(to_right, entry[twice], LENGTH - column[twice])
    known = np.flatnonzero(to_left >= 0)
    none = pa.nulls(len(known), pa.int64())

    def both(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.concat_arrays([a, b])

    return {
        "number": both(pa.array(entry[starts], pa.int32(), mask=total > 1), pa.array(known, pa.int32())),
        "w1": both(pa.array(w1[starts].view(np.int64)), none),
        "w2": both(pa.array(w2[starts].view(np.int64)), none),
        "to_left": np.concatenate([column[starts], to_left[known]]),
        "to_right": np.concatenate([LENGTH - column[starts], to_right[known]]),
    }


def _merged(key: tuple, table: pa.Table) -> pa.Table:
    """The verdict of a bucket: run, number, to_left and to_right of every entry that has a repeated window."""
    names = table.column("run").to_pylist()
    runs = [decode(entries.as_py()) for entries in table.column("entries")]
    out: list[list[np.ndarray]] = [[], [], [], []]
    group: list[tuple[int, int, int, bytes, int, int]] = []

    def settle() -> None:
        if not group:
            return
        known, run, sizes, lefts, number, times = (list(c) for c in zip(*group))
        to_left, to_right = reaches(np.array(known), np.array(sizes), lefts, np.array(times))
        hit = np.flatnonzero(to_left >= 0)
        for column, values in zip(out, (np.array(run, np.int64), np.array(number, np.int32), to_left, to_right)):
            column.append(values[hit])
        group.clear()

    since = 0
    for shared, run, (suffix, left, number, times, _) in merge(runs):
        if shared < SEED:
            if len(group) - since == 1 and group[-1][5] == 1:
                group.pop()  # it shares its seed with no other entry
            if len(group) >= GROUP_ENTRIES:
                settle()
            since = len(group)
        group.append((shared, names[run], len(suffix), left, number, times))
    settle()
    arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
    return pa.Table.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds)], ["run", "number", "to_left", "to_right"])


def repeated_spans(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """v1, v2 (name of a text) and spans, the (start, end) of its bytes that lie in repeated strings, overlapping and unordered."""
    texts = _versioned(docs)
    seeds = _seed_counts(texts).groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1")
    seeds = scratch.freeze(seeds.select("seed", (F.col("n") > HOT_SEED).alias("is_hot")), "seeds")
    wanted = _seed_rows(texts).join(seeds, "seed").groupBy("v1", "v2")
    wanted = wanted.agg(F.collect_set("seed").alias("seeds"), F.collect_set(F.when(F.col("is_hot"), F.col("seed"))).alias("hot"))
    wanted = scratch.freeze(wanted, "wanted")
    scratch.drop("seeds")
    entries = wanted.agg(F.coalesce(F.sum(F.size("seeds")), F.lit(0)).alias("n")).first().n
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), entries // BUCKET_ENTRIES + 1)
    listed = texts.join(wanted, ["v1", "v2"]).select("v1", "v2", "text", "seeds", "hot")
    rows = scratch.freeze(_run_rows(listed, buckets), "runs")
    scratch.drop("wanted")
    runs = rows.where("bucket IS NOT NULL").select("bucket", "run", "entries")
    verdict = runs.groupBy("bucket").applyInArrow(_merged, "run long, number int, to_left int, to_right int")
    windows = rows.where("w1 IS NOT NULL").select("w1", "w2", "run", "number", "to_left", "to_right")
    shared = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    across = windows.where("number IS NOT NULL").join(shared, ["w1", "w2"], "left_semi").drop("w1", "w2")
    within = rows.where("to_left IS NOT NULL AND w1 IS NULL").select("run", "number", "to_left", "to_right")
    hot = across.unionByName(within).groupBy("run", "number")
    hot = hot.agg(F.max("to_left").alias("to_left"), F.max("to_right").alias("to_right"))
    verdict = scratch.freeze(verdict.unionByName(hot), "verdict")
    places = rows.where("place IS NOT NULL").select("run", "number", "v1", "v2", "place")
    found = places.join(verdict, ["run", "number"])
    span = F.struct((F.col("place") - F.col("to_left")).alias("start"), (F.col("place") + F.col("to_right")).alias("end"))
    spans = scratch.freeze(found.groupBy("v1", "v2").agg(F.collect_set(span).alias("spans")), "spans")
    scratch.drop("runs", "verdict")
    return spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept, the remaining bytes."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    spans = repeated_spans(scratch, docs).select(F.col("v1").alias("of1"), F.col("v2").alias("of2"), "spans")
    names = F.xxhash64(F.lit(1), "text").alias("v1"), F.xxhash64(F.lit(2), "text").alias("v2")
    read = docs.select("doc_id", *names, "text")
    joined = read.join(spans, (F.col("v1") == F.col("of1")) & (F.col("v2") == F.col("of2")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                data, at = flat(piece.column("text"))
                listed = piece.column("spans")
                of = np.repeat(at[:-1], listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                parts = listed.flatten()
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, of + parts.field("start").to_numpy(zero_copy_only=False), 1)
                np.add.at(depth, of + parts.field("end").to_numpy(zero_copy_only=False), -1)
                removed = np.cumsum(depth[:-1]) > 0
                begins = removed.copy()
                begins[1:] &= ~removed[:-1]
                first = at[:-1][np.diff(at) > 0]
                begins[first] = removed[first]
                sums = [np.concatenate([[0], np.cumsum(x)])[at] for x in (removed, begins, ~removed)]
                kept = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(at) - 1, [None, pa.py_buffer(sums[2].astype(np.int64)), pa.py_buffer(data[~removed])]
                )
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *(pa.array(np.diff(x)) for x in (at, sums[0], sums[1])), kept.cast(pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.select("doc_id", "text", "spans").mapInArrow(run, schema)
