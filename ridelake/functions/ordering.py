"""Sort keys that treat NULL as the largest value.

Spark's own default is the opposite, and the choice decides which rows survive a
top-k, so every sort in the library goes through these two.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def descending(name: str) -> Column:
    return F.col(name).desc_nulls_first()
