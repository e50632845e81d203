"""Declared constraints as Spark checks over a whole batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from dataclasses import replace as replace_rows
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ridelake.sources.commits import Load, Store, home
from ridelake.sources.readers import read_table
from ridelake.sources.writers import discard, snapshot, table_exists


@dataclass(frozen=True)
class Rule:
    """A row passes when ``passes`` is true or unknown, as with a CHECK constraint."""

    name: str
    passes: Column

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.passes, F.lit(True))


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", F.col(column).isNotNull())


def between(column: str, low, high) -> Rule:
    return Rule(f"{column}_range", F.col(column).between(low, high))


def at_least(column: str, low) -> Rule:
    return Rule(f"{column}_min", F.col(column) >= low)


def above(column: str, low) -> Rule:
    return Rule(f"{column}_above", F.col(column) > low)


def one_of(column: str, allowed: Sequence[str]) -> Rule:
    return Rule(f"{column}_enum", F.col(column).isin(*allowed))


def max_length(column: str, width: int) -> Rule:
    return Rule(f"{column}_width", F.length(column) <= width)


def fits(column: str, kind: DataType | str) -> Rule:
    """The value survives the cast; must run before the column is narrowed."""
    return Rule(f"{column}_fits", F.col(column).isNull() | F.col(column).try_cast(kind).isNotNull())


def check(name: str, passes: Column) -> Rule:
    return Rule(name, passes)


@dataclass(frozen=True)
class Unique:
    """No two rows share a key; rows with a NULL in it are exempt."""

    keys: Sequence[str]
    where: Column | None = None

    @property
    def name(self) -> str:
        return "_".join(self.keys) + "_unique"


@dataclass(frozen=True)
class References:
    """A non-NULL ``column`` occurs in ``parent.key``."""

    column: str
    parent: DataFrame = field(compare=False)
    key: str

    @property
    def name(self) -> str:
        return f"{self.column}_reference"


def split_by_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the names of the rules they break."""
    failed = F.array_compact(F.array(*[F.when(rule.broken, F.lit(rule.name)) for rule in rules]))
    judged = df.withColumn("failed_rules", failed)
    return judged.where(F.size("failed_rules") == 0).drop("failed_rules"), judged.where(F.size("failed_rules") > 0)


def rule_report(df: DataFrame, rules: Sequence[Rule], row_id: str) -> DataFrame:
    """One line per rule: violations and the first offending row, all in one pass."""
    measures = []
    for at, rule in enumerate(rules):
        measures.append(F.count_if(rule.broken).alias(f"n{at}"))
        measures.append(F.min(F.when(rule.broken, F.col(row_id))).alias(f"r{at}"))
    lines = F.array(
        *[
            F.struct(F.lit(rule.name).alias("rule"), F.col(f"n{at}").alias("violations"), F.col(f"r{at}").alias("first_row"))
            for at, rule in enumerate(rules)
        ]
    )
    return df.agg(*measures).select(F.inline(lines))


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    rows = df if where is None else df.where(where)
    return rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str, row_id: str) -> DataFrame:
    """Foreign-key values with no parent: how many rows carry each, and the first of them.

    Counting per value comes first, so the join sees each value once.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("missing_key"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(row_id).alias("first_row"))
    )
    return used.join(parent.select(F.col(key).alias("missing_key")).distinct(), "missing_key", "left_anti")


def unique_report(df: DataFrame, rule: Unique, row_id: str, stored: DataFrame | None = None) -> DataFrame:
    """Rows beyond the first of each key, and the first row of a repeated key.

    With a ``stored`` table, every row counts whose key is there already.
    """
    keys = list(rule.keys)

    def keyed(rows: DataFrame) -> DataFrame:
        return (rows if rule.where is None else rows.where(rule.where)).dropna(subset=keys)

    groups = keyed(df).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(row_id).alias("first_row"))
    free = F.lit(1)
    if stored is not None:
        taken = keyed(stored).select(*keys).distinct().withColumn("_taken", F.lit(1))
        groups, free = groups.join(taken, keys, "left"), 1 - F.coalesce("_taken", F.lit(0))
    broken = groups.withColumn("n", F.col("n") - free).where(F.col("n") > 0)
    return broken.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"), F.min("first_row").alias("first_row")).select(
        F.lit(rule.name).alias("rule"), "violations", "first_row"
    )


def reference_report(df: DataFrame, rules: Sequence[References], row_id: str) -> DataFrame:
    """One line per foreign key, all of them from one pass over the rows.

    Every row gives one (key, value) pair for each of its keys; pairs are counted first,
    so the one join with the parents' keys sees each value once. A value counts as the
    parent's type has it, so that 1 and 1.00 are one key; one that does not fit that type has no parent.
    """

    def shown(rule: References) -> Column:
        own, column = rule.parent.schema[rule.key].dataType, F.col(rule.column)
        typed = column.try_cast(own)
        same = typed if df.schema[rule.column].dataType == own else F.when(typed == column, typed)
        return F.coalesce(same.cast("string"), F.concat(F.lit("no key: "), column.cast("string")))

    value = [F.struct(F.lit(at).alias("at"), shown(rule).alias("value")) for at, rule in enumerate(rules)]
    used = df.select(F.col(row_id).alias("_row"), F.explode(F.array(*value)).alias("_pair")).where("_pair.value IS NOT NULL")
    used = used.groupBy("_pair.at", "_pair.value").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first_row"))
    known = [rule.parent.select(F.lit(at).alias("at"), F.col(rule.key).cast("string").alias("value")) for at, rule in enumerate(rules)]
    lost = used.join(reduce(DataFrame.union, known).distinct(), ["at", "value"], "left_anti").groupBy("at")
    lost = lost.agg(F.sum("n").alias("violations"), F.min("first_row").alias("first_row"))
    names = df.sparkSession.createDataFrame([(at, rule.name) for at, rule in enumerate(rules)], "at int, rule string")
    return names.join(lost, "at", "left").select("rule", F.coalesce("violations", F.lit(0)).alias("violations"), "first_row")


def batch_report(
    df: DataFrame,
    row_id: str,
    rules: Sequence[Rule] = (),
    unique: Sequence[Unique] = (),
    references: Sequence[References] = (),
    stored: DataFrame | None = None,
) -> DataFrame:
    """Every declared constraint of a batch with its violations and first offending row.

    ``stored`` is the table the batch is bound for: a key that is in it is not unique.
    """
    parts = [rule_report(df, rules, row_id)] if rules else []
    parts += [unique_report(df, rule, row_id, stored) for rule in unique]
    parts += [reference_report(df, references, row_id)] if references else []
    return reduce(DataFrame.unionByName, parts)


class BatchRejected(ValueError):
    """A batch broke a constraint; nothing of it was written."""

    def __init__(self, table: str, rule: str, row, violations: int):
        super().__init__(f"{table}: row {row} breaks {rule} ({violations} violations); nothing was written")
        self.table, self.rule, self.row, self.violations = table, rule, row, violations


@dataclass(frozen=True)
class Batch:
    """Rows bound for one stored table, with the constraints they must meet there."""

    rows: DataFrame
    path: str
    row_id: str
    rules: Sequence[Rule] = ()
    unique: Sequence[Unique] = ()
    references: Sequence[References] = ()
    columns: Sequence[Column | str] = ("*",)
    replaces: bool = False

    def stage(self, load: Load) -> int:
        write = load.replace if self.replaces else load.append
        return write(home(self.path)[1], self.rows.select(*self.columns))

    def stored(self) -> DataFrame | None:
        """What is in the table already, unless the batch takes its place."""
        spark = self.rows.sparkSession
        return None if self.replaces or not table_exists(spark, self.path) else read_table(spark, self.path)

    def assert_valid(self) -> None:
        if not (self.rules or self.unique or self.references):
            return
        report = batch_report(self.rows, self.row_id, self.rules, self.unique, self.references, self.stored())
        broken = report.where(F.col("violations") > 0).orderBy(F.col("first_row").asc_nulls_last(), "rule").limit(1).collect()
        if broken:
            raise BatchRejected(self.path, broken[0]["rule"], broken[0]["first_row"], broken[0]["violations"])


def load_batches(batches: Sequence[Batch]) -> int:
    """All or nothing: every batch is checked before the first one is written, and one record shows them all.

    Rules see the wide rows; ``columns`` narrows them on the way out. The checks and
    the write read the same frozen rows. The tables lie in one folder: they are committed
    together, so a crash between two writes leaves neither. A load that another one
    overtakes fails as a whole, for its checks saw an older state.
    """
    roots = {home(batch.path)[0] for batch in batches}
    if len(roots) != 1:
        raise ValueError("batches that load together need tables in one folder")
    (root,) = roots
    store = Store(batches[0].rows.sparkSession, root)
    kept = [replace_rows(batch, rows=snapshot(batch.rows)) for batch in batches]
    try:
        with store.load() as load:
            for batch in kept:
                batch.assert_valid()
            return sum(batch.stage(load) for batch in kept)
    finally:
        for batch in kept:
            discard(batch.rows)


def load_batch(batch: Batch) -> int:
    """Load one batch whole or raise naming the offending row; returns the rows added."""
    return load_batches([batch])
