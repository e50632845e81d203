"""Running totals that do not gather one key's whole history in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ridelake.operators.lookups import PIECES, crowded_keys, key_frame, partitions
from ridelake.schemas import table


def running_total(df: DataFrame, per: str, at: str, value: str, name: str) -> DataFrame:
    """Cumulative ``value`` per key in time order; rows at the same time share a total.

    The history of a crowded key is cut into ranges of time of about a partition's share each,
    however short: the window runs over one range, and what came before is added from sums
    per range, which are combined map-side. Rows of the same time never straddle a cut,
    so ties come out as under one window over all. Other keys keep one window each, and the
    rows are shuffled once in either case. ``per`` and ``at`` hold no NULLs.
    """
    crowded = crowded_keys(df, per, partitions(df))
    if not crowded:
        return df.withColumn(name, F.sum(value).over(Window.partitionBy(per).orderBy(at)))

    keys = F.broadcast(cut_times(df, per, at, crowded))
    before = Window.partitionBy(per).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.size(F.filter("_cuts", lambda cut: cut <= F.col(at)))
    earlier = (
        df.join(keys, per)
        .groupBy(per, passed.alias("_cut"))
        .agg(F.sum(value).alias("_sum"))
        .select(per, "_cut", F.sum("_sum").over(before).alias("_before"))
    )
    within = F.sum(value).over(Window.partitionBy(per, "_cut").orderBy(at))
    cut = df.join(keys, per, "left").withColumn("_cut", F.when(F.col("_cuts").isNotNull(), passed).otherwise(0))
    total = F.when(F.col("_before").isNull(), F.col("_within")).otherwise(
        F.col("_before") + F.coalesce(F.col("_within"), F.lit(0))
    )
    summed = cut.withColumn("_within", within).join(earlier, [per, "_cut"], "left")
    return summed.select(*df.columns, total.alias(name))


def cut_times(df: DataFrame, per: str, at: str, crowded: list[tuple[object, int]]) -> DataFrame:
    """The crowded keys with ``_cuts``, the times that cut their histories into as many ranges as each has shares.

    Taken from a sketch of each key's times, one pass over the crowded rows; the cuts of all
    keys together are no more than twice the partitions. Where they lie only decides balance. They are fixed
    once, since both uses must agree.
    """
    most = max(pieces for _, pieces in crowded)
    shares = F.lit([k / (4 * most) for k in range(1, 4 * most)])
    times = F.percentile_approx(at, shares, 10 * 4 * most).alias("_times")
    spread = df.join(F.broadcast(key_frame(df, per, crowded)), per).groupBy(per).agg(F.first(PIECES).alias(PIECES), times)
    # Every key's own number of evenly spaced ones among the same fine steps.
    step = (F.lit(4 * most) / F.col(PIECES)).cast("double")
    places = F.sequence(F.lit(1), F.greatest(F.col(PIECES) - 1, F.lit(1)))
    cuts = F.array_distinct(F.transform(places, lambda k: F.get("_times", F.floor(k * step).cast("int") - 1)))
    found = spread.select(per, F.array_compact(cuts).alias("_cuts")).collect()  # one row a crowded key
    kinds = table((per, df.schema[per].dataType), ("_cuts", ArrayType(df.schema[at].dataType)))
    return df.sparkSession.createDataFrame([(row[per], row["_cuts"]) for row in found], kinds)


def share_of_total(grouped: DataFrame, count: str, name: str, digits: int) -> DataFrame:
    """Each row's percentage of the whole, over an already aggregated (small) frame."""
    whole = F.sum(count).over(Window.partitionBy())
    ratio = F.col(count).cast("decimal(20,0)") * F.lit("100.0").cast("decimal(4,1)") / whole.cast("decimal(20,0)")
    return grouped.withColumn(name, F.round(ratio, digits))
