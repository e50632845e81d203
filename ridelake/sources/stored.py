"""The stored tables the ride model is projected from, read under declared schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType

from ridelake.operators.lookups import Size, table_sizes
from ridelake.schemas import INT, LONG, MOMENT, TEXT, table
from ridelake.sources.commits import Files
from ridelake.sources.readers import read_table

NUMBER = DoubleType()

TABLES = {
    "nation": table(("n_nationkey", INT), ("n_name", TEXT), ("n_regionkey", INT)),
    "customer": table(
        ("c_custkey", LONG), ("c_name", TEXT), ("c_nationkey", INT), ("c_acctbal", NUMBER), ("c_mktsegment", TEXT)
    ),
    "supplier": table(("s_suppkey", LONG), ("s_name", TEXT), ("s_nationkey", INT), ("s_acctbal", NUMBER)),
    "part": table(
        ("p_partkey", LONG), ("p_name", TEXT), ("p_brand", TEXT), ("p_type", TEXT), ("p_size", INT), ("p_retailprice", NUMBER)
    ),
    "orders": table(
        ("o_orderkey", LONG), ("o_custkey", LONG), ("o_orderstatus", TEXT),
        ("o_totalprice", NUMBER), ("o_orderdate", MOMENT), ("o_orderpriority", TEXT),
    ),
    "lineitem": table(
        ("l_orderkey", LONG), ("l_partkey", LONG), ("l_suppkey", LONG), ("l_linenumber", INT),
        ("l_quantity", NUMBER), ("l_extendedprice", NUMBER), ("l_discount", NUMBER), ("l_tax", NUMBER),
        ("l_returnflag", TEXT), ("l_linestatus", TEXT), ("l_shipdate", MOMENT),
    ),
    "events": table(
        ("event_id", LONG), ("ts", MOMENT), ("user_id", LONG), ("event_type", TEXT), ("value", NUMBER), ("props", TEXT)
    ),
}


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", TABLES[name])


#: Measured sizes, by session, path, columns, and the length and time of the file or folder.
_SIZES: dict[tuple, Size] = {}


def stored_sizes(spark: SparkSession, folder: str, columns: Mapping[str, Sequence[str]]) -> dict[str, Size]:
    """Rows and bytes of columns of stored tables, measured once for each state of their files; one job for all that are new."""
    files = Files(spark, folder)
    keys = {}
    for name, wanted in columns.items():
        state = files.system.getFileStatus(files.path(f"{name}.parquet"))
        seen = (state.getLen(), state.getModificationTime())
        keys[name] = (spark.sparkContext.applicationId, folder, name, *wanted, *seen)
    new = {name: stored(spark, folder, name).select(*columns[name]) for name, key in keys.items() if key not in _SIZES}
    if new:
        _SIZES.update({keys[name]: size for name, size in table_sizes(new).items()})
    return {name: _SIZES[key] for name, key in keys.items()}
