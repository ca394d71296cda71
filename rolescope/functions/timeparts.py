"""Calendar parts of a timestamp and their display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar labels, Sunday is day 1.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

PARTS = {"year": F.year, "month": F.month, "dow": F.dayofweek, "hour": F.hour}
NAMES = {"month": MONTH_NAMES, "dow": DAY_NAMES}


def part(name: str, ts: Column) -> Column:
    """One calendar part as BIGINT; NULL for a NULL timestamp."""
    return PARTS[name](ts).cast("bigint")


def parts(ts: Column, names: tuple[str, ...] = tuple(PARTS)) -> dict[str, Column]:
    return {n: part(n, ts) for n in names}


def part_name(name: str, code: Column) -> Column:
    """Label of a month or weekday code, by position in a literal array (no join)."""
    return F.get(F.array(*[F.lit(v) for v in NAMES[name]]), code.cast("int") - 1)


def day_kind(dow: Column) -> Column:
    return F.when(dow.isin(1, 7), "weekend").when(dow.isNotNull(), "weekday")
