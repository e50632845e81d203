"""String helpers built only from native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squash_spaces(text: Column) -> Column:
    """Every run of white space, that of other scripts included, becomes one space."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def halve_double_spaces(text: Column) -> Column:
    """One pass over double spaces: four spaces leave two."""
    return F.replace(text, F.lit("  "), F.lit(" "))


def title_case(text: Column) -> Column:
    """Upper-case the first letter after anything that is not a letter or digit.

    ``F.initcap`` restarts a word after a space only, which would leave
    ``o'brien`` as ``O'brien`` instead of ``O'Brien``.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(0))
    capitalised = F.transform(
        runs, lambda run: F.concat(F.upper(run.substr(1, 1)), run.substr(F.lit(2), F.length(run)))
    )
    return F.array_join(capitalised, "")


def clean_name(text: Column) -> Column:
    """Canonical spelling of a person's name: single spaces, trimmed, title case."""
    return title_case(F.trim(squash_spaces(text)))


def concat_skip_null(*parts: Column) -> Column:
    """Concatenation that ignores NULL parts (``F.concat`` would return NULL)."""
    return F.concat_ws("", *parts)


def zero_padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")
