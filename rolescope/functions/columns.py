"""Column references, aliases and counting expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_ALIAS_CHARS = {"%": "pct", "(": "_", ")": "", "/": "_per_", " ": "_", "-": "_", ".": "_", "`": ""}


def quoted(name: str) -> str:
    """A column name for SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """Reference a top-level column whatever characters its name holds."""
    return F.col(quoted(name))


def safe_alias(prefix: str, name: str) -> str:
    """A plain identifier made of a prefix and an odd column name."""
    return f"{prefix}_{name.translate(str.maketrans(_ALIAS_CHARS))}"


def n_rows() -> Column:
    return F.count(F.lit(1))


def n_where(condition: Column) -> Column:
    """Rows for which the condition is true (NULL counts as not true)."""
    return F.count_if(condition)


def is_blank(column: Column) -> Column:
    """Text that is present but empty after trimming; NULL is not blank."""
    return F.trim(column) == ""


def none_null(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``total``, half-up, 0 when there is nothing to divide by."""
    return F.coalesce(F.round(ratio(part * 100, total), digits), F.lit(0.0))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as a double; NULL when ``den`` is zero (ANSI division would raise)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def rows_from(structs: list[Column]) -> Column:
    """Turn one row of aggregates into one row per struct (a typed unpivot)."""
    return F.inline(F.array(*structs))
