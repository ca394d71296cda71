"""The SQL reports, parameterised by table and column roles.

Tables and columns are bound through the format fields of ``spark.sql``; column names are quoted,
so names with brackets or percent signs work. The row total is a sub-query, never a constant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rolescope.functions.columns import ref
from rolescope.roles import Roles


def register(df: DataFrame, name: str) -> None:
    """Make a table available to ad-hoc SQL."""
    df.createOrReplaceTempView(name)


def rows_by_state(df: DataFrame, roles: Roles) -> DataFrame:
    (state,) = roles.need("state")
    return df.sparkSession.sql(
        "SELECT {state} AS state, COUNT(*) AS cnt FROM {df} GROUP BY {state} "
        "ORDER BY cnt DESC, state", df=df, state=ref(state))


def class_share(df: DataFrame, roles: Roles) -> DataFrame:
    (label,) = roles.need("label")
    return df.sparkSession.sql(
        "WITH c AS (SELECT {label} AS class, COUNT(*) AS cnt FROM {df} GROUP BY {label}) "
        "SELECT class, cnt, "
        "ROUND(CAST(cnt * 100 AS DOUBLE) / (SELECT SUM(cnt) FROM c), 2) AS pct "
        "FROM c ORDER BY class", df=df, label=ref(label))


def top_cities(df: DataFrame, roles: Roles, k: int = 10) -> DataFrame:
    city, state = roles.need("city", "state")
    return df.sparkSession.sql(
        "SELECT {city} AS city, {state} AS state, COUNT(*) AS cnt FROM {df} "
        "WHERE {city} IS NOT NULL GROUP BY {city}, {state} "
        "ORDER BY cnt DESC, city, state LIMIT {k}", df=df, city=ref(city), state=ref(state), k=k)


def rows_by_year(df: DataFrame, roles: Roles) -> DataFrame:
    (start,) = roles.need("start_time")
    return df.sparkSession.sql(
        "SELECT CAST(YEAR({t}) AS BIGINT) AS year, COUNT(*) AS cnt FROM {df} "
        "WHERE {t} IS NOT NULL GROUP BY YEAR({t}) ORDER BY year", df=df, t=ref(start))


def class_by_state(df: DataFrame, roles: Roles) -> DataFrame:
    state, label, classes = roles.need("state", "label", "label_values")
    counters = ", ".join(
        f"COUNT(CASE WHEN {{label}} = {int(c)} THEN 1 END) AS class_{int(c)}" for c in classes)
    return df.sparkSession.sql(
        f"SELECT {{state}} AS state, {counters}, COUNT(*) AS total FROM {{df}} "
        "GROUP BY {state} ORDER BY total DESC, state", df=df, state=ref(state), label=ref(label))


def class_in_states(df: DataFrame, roles: Roles, states: tuple[str, ...]) -> DataFrame:
    state, label = roles.need("state", "label")
    marks = ", ".join(f"{{s{i}}}" for i in range(len(states)))
    return df.sparkSession.sql(
        f"SELECT {{state}} AS state, {{label}} AS class, COUNT(*) AS cnt FROM {{df}} "
        f"WHERE {{state}} IN ({marks}) GROUP BY {{state}}, {{label}} ORDER BY state, class",
        df=df, state=ref(state), label=ref(label), **{f"s{i}": s for i, s in enumerate(states)})
