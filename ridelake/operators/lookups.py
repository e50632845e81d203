"""Attaching a keyed table to a much larger one.

A side is broadcast only after its size has been measured. Beyond the bound the join
shuffles, and the rows of over-represented keys (and of NULL keys) are spread
over many partitions so that one hot driver or city does not become one long task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ridelake.schemas import INT
from ridelake.schemas import table as declared

# A lookup table up to this measured size is sent to every executor: cheaper than moving
# the trips, and small next to an executor's memory even when several are held at once.
BROADCAST_BYTES = 128 * 1024 * 1024

# The sketch behind ``crowded_keys`` reports as many keys as there are partitions and tracks
# ten candidates for each; this is the most candidates the sketch can hold.
TRACKED_PER_KEY, TRACKED_KEYS = 10, 1_000_000

_PIECE, PIECES = "_piece", "_pieces"


class Size(NamedTuple):
    rows: int
    bytes: int


def table_sizes(frames: Mapping[str, DataFrame]) -> dict[str, Size]:
    """Rows and uncompressed bytes of several tables, measured in one job.

    Only text columns are read; everything else has a fixed width, so for a table
    without text the file footers answer.
    """
    parts = []
    for name, frame in frames.items():
        texts = [field.name for field in frame.schema if isinstance(field.dataType, StringType)]
        fixed = F.lit(16 * (len(frame.columns) + 1))
        width = reduce(add, [F.coalesce(F.octet_length(F.col(text)), F.lit(0)) for text in texts], fixed)
        measured = frame.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
        parts.append(measured.select(F.lit(name).alias("name"), "rows", "bytes"))
    return {row["name"]: Size(row["rows"], row["bytes"]) for row in reduce(DataFrame.union, parts).collect()}


def together(sizes: Mapping[str, Size], uses: Mapping[str, int] | None = None, limit: int | None = None) -> dict[str, int]:
    """Each table's own bound, such that all that are broadcast in one plan stay below the limit.

    The smallest come first. A table that several lookups use is sent once for each of them.
    """
    left, bounds = BROADCAST_BYTES if limit is None else limit, {}
    for name, size in sorted(sizes.items(), key=lambda item: item[1].bytes):
        needed = size.bytes * (uses or {}).get(name, 1)
        bounds[name] = size.bytes if needed <= left else -1
        left -= needed if needed <= left else 0
    return bounds


def partitions(frame: DataFrame) -> int:
    """Shuffle partitions of the session, at least two."""
    return max(2, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def crowds(facts: DataFrame, keys: Sequence[str], pieces: int) -> dict[str, list[tuple[object, int]]]:
    """Per key column, the keys holding more than one partition's fair share, and how many pieces each needs.

    One frequent-items sketch per column finds them, all in one pass over these columns. The
    number of keys is bounded, and so is the sum of all pieces, whatever the data. A key the
    sketch misses only costs balance, never rows. The answer is taken once and then fixed:
    two evaluations of a sketch may differ, and both sides of a join must agree.
    """
    tracked = min(TRACKED_PER_KEY * pieces, TRACKED_KEYS)
    sketches = [F.expr(f"approx_top_k(`{key}`, {min(pieces, tracked)}, {tracked})").alias(f"_{k}") for k, key in enumerate(keys)]
    found = facts.agg(*sketches, F.count(F.lit(1)).alias("total")).first()

    def shares(top) -> list[tuple[object, int]]:
        over = [(item["item"], item["count"] * pieces / found["total"]) for item in top or []]
        return [(item, ceil(share)) for item, share in over if item is not None and share > 1]

    return {key: shares(found[f"_{k}"]) for k, key in enumerate(keys)}


def crowded_keys(facts: DataFrame, key: str, pieces: int) -> list[tuple[object, int]]:
    """The crowded keys of one column."""
    return crowds(facts, [key], pieces)[key]


def key_frame(facts: DataFrame, key: str, crowded: list[tuple[object, int]]) -> DataFrame:
    """The crowded keys as a small frame to join with."""
    return facts.sparkSession.createDataFrame(crowded, declared((key, facts.schema[key].dataType), (PIECES, INT)))


def spread_join(
    facts: DataFrame, table: DataFrame, key: str, row_id: str, how: str, keys_from: DataFrame | None = None,
    crowd: list[tuple[object, int]] | None = None,
) -> DataFrame:
    """Shuffle join on ``key`` with the rows of crowded keys cut into pieces.

    The piece of a fact row is a hash of its id, so a re-run task picks the same one.
    NULL keys match nothing but are spread likewise. ``crowd`` are the crowded keys if the
    caller has them; else they are looked for, in ``keys_from`` if that is cheaper.
    """
    pieces = partitions(facts)
    if crowd is None:
        crowd = crowded_keys(facts if keys_from is None else keys_from, key, pieces)
    crowded = key_frame(facts, key, crowd)
    cuts = F.when(F.col(key).isNull(), F.lit(pieces)).otherwise(F.coalesce(F.col(PIECES), F.lit(1)))
    left = facts.join(F.broadcast(crowded), key, "left").withColumn(_PIECE, F.pmod(F.xxhash64(row_id), cuts).cast("int"))
    copies = F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - 1)
    right = table.join(F.broadcast(crowded), key, "left").withColumn(_PIECE, F.explode(copies)).drop(PIECES)
    return left.drop(PIECES).join(right, [key, _PIECE], how).drop(_PIECE)


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    match: str,
    take: Mapping[str, str | Column],
    *,
    row_id: str,
    size: Size | None = None,
    how: str = "left",
    keys_from: DataFrame | None = None,
    limit: int | None = None,
    crowd: list[tuple[object, int]] | None = None,
) -> DataFrame:
    """Add columns of ``table`` (unique on ``match``) to every fact row.

    ``take`` names the new columns and what each comes from. ``size`` is the table's
    measured size, or an upper bound, if the caller has it; otherwise it is measured
    here. Up to ``limit`` bytes the table is broadcast, beyond it the join spreads.
    """
    picked = table.select(
        F.col(match).alias(key),
        *[(F.col(source) if isinstance(source, str) else source).alias(name) for name, source in take.items()],
    )
    measured = table_sizes({"table": picked})["table"] if size is None else size
    if measured.bytes <= (BROADCAST_BYTES if limit is None else limit):
        return facts.join(F.broadcast(picked), key, how)
    return spread_join(facts, picked, key, row_id, how, keys_from, crowd)


class Step(NamedTuple):
    """One lookup of a chain: a column of the facts, the table it is looked up in, and what is taken."""

    table: str
    key: str
    match: str
    take: Mapping[str, str | Column]
    how: str = "left"


def chain(
    facts: DataFrame,
    tables: Mapping[str, DataFrame],
    steps: Sequence[Step],
    sizes: Mapping[str, Size],
    row_id: str,
    limit: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Several lookups of the same rows: the broadcasts share the limit, and one pass finds the crowded keys of all others."""
    bounds = together({step.table: sizes[step.table] for step in steps}, Counter(step.table for step in steps), limit)
    spread = [step.key for step in steps if sizes[step.table].bytes > bounds[step.table]]
    read = facts if keys_from is None else keys_from
    crowd = crowds(read, list(dict.fromkeys(spread)), partitions(facts)) if spread else {}
    for step in steps:
        facts = lookup(
            facts, tables[step.table], step.key, step.match, step.take, row_id=row_id, size=sizes[step.table],
            how=step.how, limit=bounds[step.table], crowd=crowd.get(step.key),
        )
    return facts


def one_value_lookup(
    facts: DataFrame, table: DataFrame, key: str, match: str, value: str, name: str, *, row_id: str
) -> DataFrame:
    """The scalar-subquery lookup: no match gives NULL, a second match is an error."""
    grouped = table.groupBy(match).agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias("_value"))
    found = lookup(facts, grouped, key, match, {"_n": "_n", "_value": "_value"}, row_id=row_id)
    too_many = F.raise_error(F.lit(f"more than one row of {match} for one {key}"))
    return found.withColumn(name, F.when(F.col("_n") > 1, too_many).otherwise(F.col("_value"))).drop("_n", "_value")


def without_match(rows: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key occurs nowhere among the others (a NULL key stays).

    The others are reduced to distinct keys map-side first, so a hot key never
    travels more than once per task.
    """
    return rows.join(others.select(F.col(other_key).alias(key)).distinct(), key, "left_anti")


def not_in(rows: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """``NOT IN`` with its NULL rules, without broadcasting the subquery's rows.

    A NULL among the others empties the result; a NULL key qualifies only when
    there are no others at all.
    """
    rows_seen, keys_seen = F.count(F.lit(1)), F.count(other_key)
    kind = F.when(rows_seen == 0, "empty").when(keys_seen < rows_seen, "with null").otherwise("plain")
    found = others.agg(kind.alias("kind")).scalar()
    kept = without_match(rows, key, others.where(F.col(other_key).isNotNull()), other_key)
    return kept.where(found.isin(F.lit("empty"), F.when(F.col(key).isNotNull(), "plain")))
