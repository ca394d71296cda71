"""ANSI SQL giving the expected result of each query, run by DuckDB on the same tables.

Queries without an entry here are checked by tests instead: sketches (their result is only bounded)
and fitted models.
"""

from __future__ import annotations

from rolescope.plans.views import CLASSES

ORDERS = ("SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS class FROM orders")
ORDERS_GEO = (f"SELECT o.*, c_acctbal, c_mktsegment, n_name, r_name FROM ({ORDERS}) o "
              "LEFT JOIN customer ON o_custkey = c_custkey "
              "LEFT JOIN nation ON c_nationkey = n_nationkey "
              "LEFT JOIN region ON n_regionkey = r_regionkey")
ODD = ("SELECT * REPLACE (CASE WHEN {key} % 7 = 0 THEN NULL WHEN {key} % 11 = 0 THEN 99 "
       "ELSE class END AS class) FROM ({view})")
ODD_ORDERS = ODD.format(key="o_orderkey", view=ORDERS)
ODD_GEO = ODD.format(key="o_orderkey", view=ORDERS_GEO)
LINES = ("SELECT *, nullif(l_discount, 0) AS discount, "
         "CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax, "
         "CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS shipped, "
         "l_returnflag = 'R' AS is_returned, l_linestatus <> 'F' AS is_open, "
         "l_discount = 0 AS full_price, l_quantity > 40 AS bulk, l_quantity < 0 AS never "
         "FROM lineitem")
LINES_ORDERS = (f"SELECT l.*, o_orderdate, class FROM ({LINES}) l "
                f"LEFT JOIN ({ORDERS}) o ON l_orderkey = o_orderkey")
EVENTS = ("SELECT *, CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' "
          "THEN 3 WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS class, "
          "CASE WHEN event_type <> 'error' THEN ts END AS trusted_ts, "
          "nullif(event_type, 'view') AS action FROM events")
DOCS = ("SELECT d.*, quality, toxic, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang_other "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
SPLIT = ("CASE WHEN CAST('0x' || substr(md5(CAST({id} AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 "
         "THEN 'train' ELSE 'test' END")
TIME = "'%Y-%m-%d %H:%M:%S'"
FLAGS = ("is_returned", "is_open", "full_price", "bulk", "never")
NUMERIC = ("l_quantity", "l_extendedprice", "discount", "tax")


def pct(part: str, total: str, digits: int = 2) -> str:
    """Exact half-up percentage in integer arithmetic, as DOUBLE."""
    scale = 10 ** digits
    return (f"CAST((CAST({part} AS HUGEINT) * {200 * scale} + ({total})) // (2 * ({total})) "
            f"AS DOUBLE) / CAST({scale} AS DOUBLE)")


def counts(view: str, *keys: str, where: str = "TRUE") -> str:
    """Group counts with the total over all groups."""
    k = ", ".join(keys)
    return (f"SELECT {k}, COUNT(*) AS cnt, "
            f"CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total FROM ({view}) "
            f"WHERE {where} GROUP BY {k}")


def class_counts(prefix: str = "class_") -> str:
    return ", ".join(f"COUNT(*) FILTER (class = {c}) AS {prefix}{c}" for c in CLASSES)


def in_classes(column: str = "class") -> str:
    return f"{column} IN ({', '.join(map(str, CLASSES))})"


OTHER = f"COUNT(*) FILTER (coalesce(NOT ({in_classes()}), TRUE))"


def union(parts) -> str:
    return " UNION ALL ".join(parts)


ORACLE: dict[str, str] = {}

# ---- size, schema, values -------------------------------------------------------------------

ORACLE["row_count"] = "SELECT COUNT(*) AS n FROM orders"
ORACLE["overview"] = f"""
SELECT COUNT(*) AS total_rows, CAST(11 AS BIGINT) AS total_columns,
       COUNT(DISTINCT o_orderkey) AS distinct_ids,
       strftime(MIN(o_orderdate), {TIME}) AS min_time,
       strftime(MAX(o_orderdate), {TIME}) AS max_time,
       COUNT(DISTINCT n_name) AS n_state, COUNT(DISTINCT r_name) AS n_county,
       COUNT(DISTINCT c_mktsegment) AS n_city
FROM ({ORDERS_GEO})"""
ORACLE["overview_long"] = f"""
WITH o AS ({ORACLE['overview']})
""" + union(f"SELECT '{m}' AS metric, CAST({m} AS VARCHAR) AS value FROM o" for m in (
    "total_rows", "total_columns", "distinct_ids", "min_time", "max_time", "n_state",
    "n_county", "n_city"))
COPIES = "SELECT l_orderkey, l_linenumber, COUNT(*) AS cnt FROM lineitem GROUP BY ALL"
ORACLE["duplicate_keys"] = f"""
SELECT CAST(SUM(cnt) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys,
       CAST(SUM(cnt) - COUNT(*) AS BIGINT) AS duplicate_rows,
       COUNT(*) FILTER (cnt > 1) AS repeated_keys, MAX(cnt) AS most_copies FROM ({COPIES})"""
ORACLE["repeated_keys"] = f"SELECT * FROM ({COPIES}) WHERE cnt > 1"
SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
               "TIMESTAMP": "timestamp_ntz"}


def contents(column: str) -> str:
    """Present values and the range of a column, as text."""
    return (f"COUNT({column}) AS non_null, CAST(MIN({column}) AS VARCHAR) AS min_value, "
            f"CAST(MAX({column}) AS VARCHAR) AS max_value")


TYPED = "CASE data_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in SPARK_TYPES.items()) + " END"
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority", "class")
ORACLE["schema_report"] = f"""
WITH t AS (SELECT CAST(column_index AS INTEGER) AS position, column_name AS column, {TYPED} AS type
           FROM duckdb_columns() WHERE table_name = 'orders'
           UNION ALL SELECT 7, 'class', 'int'),
c AS (""" + union(f"SELECT '{c}' AS column, {contents(c)} FROM ({ORDERS})"
                  for c in ORDER_COLUMNS) + """)
SELECT position, t.column, type, non_null, min_value, max_value FROM t JOIN c ON t.column = c.column"""
ORACLE["distinct_values"] = "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type"
ORACLE["distinct_summary"] = f"""
SELECT COUNT(DISTINCT class) AS n_values, MIN(class) AS min_value, MAX(class) AS max_value
FROM ({ORDERS})"""
ORACLE["preview"] = f"""
SELECT o_orderkey, o_orderstatus, o_totalprice, class FROM ({ORDERS})
ORDER BY o_orderkey LIMIT 5"""
ORACLE["sketched_medians"] = f"""
SELECT class, COUNT(o_totalprice) AS cnt, true AS within_error
FROM (SELECT unnest([0, class]) AS class, o_totalprice FROM ({ORDERS})) GROUP BY class"""
ORACLE["input_guard"] = """
SELECT o_orderstatus, COUNT(*) AS cnt, true AS unchanged, true AS noticed
FROM orders GROUP BY o_orderstatus"""
ORACLE["table_fingerprint"] = (
    "SELECT COUNT(*) AS n, CAST(SUM(l_orderkey) AS BIGINT) AS key_sum, "
    + ", ".join(f"{p.upper()}({c}) AS {p}_{c}" for c in ("l_quantity", "l_extendedprice", "l_tax")
                for p in ("min", "max")) + " FROM lineitem")

# ---- classes and crosstabs ------------------------------------------------------------------

ORACLE["class_distribution"] = \
    f"SELECT class, cnt, {pct('cnt', 'total')} AS pct FROM ({counts(ORDERS, 'class')})"
ORACLE["class_by_geo_long"] = \
    f"SELECT n_name, class, COUNT(*) AS cnt FROM ({ORDERS_GEO}) GROUP BY n_name, class"
CLASS_BY_GEO = f"""
SELECT n_name, {class_counts()}, {OTHER} AS class_other, COUNT(*) AS total
FROM ({ODD_GEO}) GROUP BY n_name"""
ORACLE["class_by_geo"] = CLASS_BY_GEO
ORACLE["class_by_geo_top"] = f"{CLASS_BY_GEO} ORDER BY total DESC, n_name LIMIT 15"
ORACLE["topk_then_crosstab"] = f"""
WITH o AS ({ODD_GEO}),
     top AS (SELECT n_name FROM o GROUP BY n_name ORDER BY COUNT(*) DESC, n_name LIMIT 10)
SELECT n_name, {class_counts()}, {OTHER} AS class_other, COUNT(*) AS total
FROM o WHERE n_name IN (SELECT n_name FROM top) GROUP BY n_name"""
ORACLE["topk_members_long"] = f"""
WITH e AS ({EVENTS}),
     top AS (SELECT action FROM e WHERE action IS NOT NULL
             GROUP BY action ORDER BY COUNT(*) DESC, action LIMIT 3)
SELECT action, class, COUNT(*) AS cnt FROM e WHERE action IN (SELECT action FROM top)
GROUP BY action, class"""
ORACLE["crosstab_row_pct"] = f"""
WITH t AS (SELECT o_orderstatus, {class_counts()}, {OTHER} AS class_other, COUNT(*) AS total
           FROM ({ODD_ORDERS}) GROUP BY o_orderstatus)
SELECT o_orderstatus, {', '.join(f"{pct(f'class_{c}', 'total')} AS pct_{c}"
                                 for c in (*CLASSES, 'other'))}
FROM t"""
ORACLE["year_by_class"] = f"""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, {class_counts()} FROM ({ORDERS}) GROUP BY 1"""
ORACLE["flag_class_share"] = "WITH l AS (" + LINES_ORDERS + "), c AS (" + union(
    f"SELECT '{f}' AS flag, class, COUNT(*) AS cnt FROM l WHERE {f} GROUP BY class"
    for f in FLAGS) + f"""),
t AS (SELECT *, CAST(SUM(cnt) OVER (PARTITION BY flag) AS BIGINT) AS flag_total FROM c)
SELECT flag, class, cnt, flag_total, {pct('cnt', 'flag_total')} AS pct FROM t"""

# ---- calendar -------------------------------------------------------------------------------

MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
DAYS = "['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday']"


def part(name: str, ts: str) -> str:
    value = f"dayofweek({ts}) + 1" if name == "dow" else f"{name}({ts})"
    return f"CAST({value} AS BIGINT)"


def by_part(view: str, name: str, ts: str, label: str = "") -> str:
    c = counts(f"SELECT {part(name, ts)} AS {name} FROM ({view})", name)
    return (f"SELECT {name}, {label} cnt, {pct('cnt', 'total')} AS pct FROM ({c}) "
            f"WHERE {name} IS NOT NULL")


ORACLE["time_parts"] = "SELECT event_id, " + ", ".join(
    f"{part(p, 'ts')} AS {p}" for p in ("year", "month", "dow", "hour")) + " FROM events"
ORACLE["by_year"] = by_part(ORDERS, "year", "o_orderdate")
ORACLE["by_month"] = by_part(ORDERS, "month", "o_orderdate", f"{MONTHS}[month] AS name,")
ORACLE["by_dow"] = by_part(EVENTS, "dow", "ts", f"{DAYS}[dow] AS name,")
ORACLE["by_hour"] = by_part(EVENTS, "hour", "ts")
ORACLE["by_hour_known"] = by_part(f"SELECT * FROM ({EVENTS}) WHERE trusted_ts IS NOT NULL",
                                  "hour", "trusted_ts")
HOURS = counts(f"SELECT {part('hour', 'trusted_ts')} AS hour FROM ({EVENTS})", "hour")
ORACLE["by_hour_nulls"] = f"""
WITH h AS (SELECT *, CAST(SUM(cnt) FILTER (hour IS NOT NULL) OVER () AS BIGINT) AS known
           FROM ({HOURS}))
SELECT coalesce(CAST(hour AS VARCHAR), 'unknown') AS hour, cnt, {pct('cnt', 'total')} AS pct_all,
       CASE WHEN hour IS NOT NULL THEN {pct('cnt', 'known')} END AS pct_non_null FROM h"""
ORACLE["time_grouping_sets"] = union(
    f"SELECT '{p}' AS level, {part(p, 'ts')} AS key, COUNT(*) AS cnt FROM events GROUP BY 2"
    for p in ("year", "month", "dow", "hour"))
KIND = "CASE WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END"
ORACLE["weekday_weekend"] = f"""
SELECT day_kind, cnt, {pct('cnt', 'total')} AS pct
FROM ({counts(f"SELECT {KIND} AS day_kind FROM events", 'day_kind')})"""
ORACLE["peak_hour"] = f"{ORACLE['by_hour']} ORDER BY cnt DESC, hour LIMIT 1"
ORACLE["yoy_growth"] = """
WITH y AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, COUNT(*) AS cnt
           FROM orders GROUP BY 1),
     g AS (SELECT a.year, a.cnt, b.cnt AS prev FROM y a LEFT JOIN y b ON b.year = a.year - 1)
SELECT year, cnt, CAST(prev AS DOUBLE) AS prev, sign(cnt - prev)
       * CAST((abs(cnt - prev) * 20000 + prev) // (2 * prev) AS DOUBLE)
       / CAST(100 AS DOUBLE) AS growth_pct FROM g"""

# ---- ranking --------------------------------------------------------------------------------


def top(view: str, keys: tuple[str, ...], k: int, keep: str = "TRUE") -> str:
    names = ", ".join(keys)
    return (f"SELECT {names}, cnt, {pct('cnt', 'total')} AS pct FROM ({counts(view, *keys)}) "
            f"WHERE {keep} ORDER BY cnt DESC, {names} LIMIT {k}")


ORACLE["topk_state"] = top(ORDERS_GEO, ("n_name",), 10)
ORACLE["topk_city"] = top(ORDERS_GEO, ("c_mktsegment", "n_name"), 20)
ORACLE["topk_county"] = top(ORDERS_GEO, ("r_name", "n_name"), 20)
ORACLE["topk_condition"] = top(EVENTS, ("action",), 3, "action IS NOT NULL")
RANKED = f"""
SELECT *, row_number() OVER (ORDER BY cnt DESC, n_name) AS rank, COUNT(*) OVER () AS n_groups
FROM ({counts(ORDERS_GEO, 'n_name')})"""
ORACLE["group_coverage"] = f"""
SELECT rank, n_name, cnt, {pct('cnt', 'total')} AS pct, n_groups FROM ({RANKED})
WHERE rank <= 10"""
ORACLE["cumulative_share"] = f"""
WITH r AS (SELECT *, CAST(SUM(cnt) OVER (ORDER BY rank) AS BIGINT) AS running FROM ({RANKED}))
SELECT rank, n_name, cnt, {pct('running', 'total')} AS cum_pct FROM r WHERE rank <= 10"""
ORACLE["top_values"] = """
SELECT l_quantity, COUNT(*) AS cnt FROM lineitem GROUP BY l_quantity
ORDER BY l_quantity DESC LIMIT 10"""

# ---- SQL reports ----------------------------------------------------------------------------

ORACLE["sql_state"] = \
    f"SELECT n_name AS state, COUNT(*) AS cnt FROM ({ORDERS_GEO}) GROUP BY n_name"
ORACLE["sql_class_share"] = ORACLE["class_distribution"]
ORACLE["sql_top_cities"] = f"""
SELECT c_mktsegment AS city, n_name AS state, COUNT(*) AS cnt FROM ({ORDERS_GEO})
WHERE c_mktsegment IS NOT NULL GROUP BY ALL ORDER BY cnt DESC, city, state LIMIT 10"""
ORACLE["sql_year"] = """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, COUNT(*) AS cnt FROM orders
WHERE o_orderdate IS NOT NULL GROUP BY 1"""
ORACLE["sql_class_by_geo"] = f"""
SELECT n_name AS state, {class_counts()}, COUNT(*) AS total FROM ({ODD_GEO}) GROUP BY n_name"""
ORACLE["sql_in_list_crosstab"] = f"""
SELECT n_name AS state, class, COUNT(*) AS cnt FROM ({ORDERS_GEO})
WHERE n_name IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')
GROUP BY n_name, class"""

# ---- numeric and flag summaries -------------------------------------------------------------

ORACLE["flag_prevalence"] = f"WITH l AS ({LINES}) " + union(
    f"SELECT '{f}' AS flag, COUNT(*) FILTER ({f}) AS true_cnt, "
    f"COUNT(*) FILTER (NOT {f}) AS false_cnt, "
    f"{pct(f'COUNT(*) FILTER ({f})', 'COUNT(*)', 3)} AS true_pct FROM l" for f in FLAGS)


def measures(column: str, digits: int) -> str:
    return (f"round(AVG({column}), {digits}) AS mean, "
            f"round(quantile_disc({column}, 0.5), {digits}) AS median, "
            f"round(MIN({column}), {digits}) AS min, round(MAX({column}), {digits}) AS max")


def numeric_rows(view: str, columns, digits: int = 2) -> str:
    return f"WITH v AS ({view}) " + union(
        f"SELECT '{c}' AS variable, COUNT({c}) AS cnt, COUNT(*) - COUNT({c}) AS missing, "
        f"{pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} AS missing_pct, {measures(c, digits)} FROM v"
        for c in columns)


ORACLE["numeric_summary"] = numeric_rows(LINES, NUMERIC)
ORACLE["extent_summary"] = numeric_rows(ORDERS, ("o_totalprice",), 4)
ORACLE["extent_by_class"] = f"""
SELECT class, COUNT(o_totalprice) AS cnt, {measures('o_totalprice', 4)}
FROM ({ORDERS}) GROUP BY class"""
EDGES = (0, 1, 5, 10, 50, 100, 250, 400, 1000)
BUCKETS = [("0", "value = 0")] + [
    (f"{'0' if a == 0 else f'{a}.0'} - {b}.0", f"value > {a} AND value <= {b}")
    for a, b in zip(EDGES, EDGES[1:])] + [
    ("1000+", "value > 1000"), ("negative", "value < 0"), ("missing", "value IS NULL")]
ORACLE["extent_buckets"] = union(
    f"SELECT CAST({i} AS BIGINT) AS ord, '{label}' AS bucket, COUNT(*) FILTER ({test}) AS cnt, "
    f"{pct(f'COUNT(*) FILTER ({test})', 'COUNT(*)')} AS pct FROM events"
    for i, (label, test) in enumerate(BUCKETS))
ORACLE["numeric_ranges"] = f"WITH l AS ({LINES}) " + union(
    f"SELECT '{c}' AS column, MIN({c}) AS min, MAX({c}) AS max FROM l" for c in NUMERIC)

# ---- missing values, ranges, anomalies ------------------------------------------------------


def per_column(view: str, tests: dict[str, str], count: str) -> str:
    return f"WITH v AS ({view}) " + union(
        f"SELECT '{c}' AS column, COUNT(*) FILTER ({t}) AS {count}, "
        f"{pct(f'COUNT(*) FILTER ({t})', 'COUNT(*)', 4)} AS pct FROM v" for c, t in tests.items())


def nulls(*columns: str) -> dict[str, str]:
    return {c: f"{c} IS NULL" for c in columns}


ORACLE["null_profile"] = per_column(
    LINES, nulls("l_orderkey", "l_quantity", "discount", "tax", "shipped"), "nulls")
ORACLE["null_profile_documents"] = per_column(
    DOCS, nulls("doc_id", "text", "lang", "source", "quality", "toxic"), "nulls")
ORACLE["null_profile_summary"] = f"""
SELECT COUNT(*) FILTER (nulls = 0) AS zero_null_cols, COUNT(*) FILTER (nulls > 0) AS some_null_cols
FROM ({ORACLE['null_profile_documents']})"""
ORACLE["blank_profile"] = per_column(
    DOCS, {c: f"trim({c}) = ''" for c in ("text", "lang", "source", "lang_other")}, "blanks")
ORACLE["null_filter_counts"] = f"""
SELECT COUNT(*) - COUNT(quality) AS null_cnt, COUNT(quality) AS non_null_cnt FROM ({DOCS})"""
ORACLE["time_range"] = "SELECT " + ", ".join(
    f"strftime({f}({c}), {TIME}) AS {f}_{side}" for side, c in (
        ("start", "o_orderdate"), ("end", "l_shipdate")) for f in ("min", "max")
) + f" FROM ({LINES_ORDERS})"
LATE = "COUNT(*) FILTER (l_shipdate < o_orderdate)"
ORACLE["order_violations"] = f"""
SELECT COUNT(*) AS total, {LATE} AS end_before_start, {pct(LATE, 'COUNT(*)', 4)} AS pct
FROM ({LINES_ORDERS})"""
ORACLE["constant_columns"] = f"WITH l AS ({LINES}) " + union(
    f"SELECT '{c}' AS column, COUNT({c}) AS non_null, COUNT(DISTINCT {c}) <= 1 AS is_constant "
    "FROM l" for c in ("l_quantity", "l_returnflag", "l_linestatus", "never"))
LADDER = {
    "l_quantity": ("= 0", "< 5", "> 25", "> 45"),
    "l_extendedprice": ("< 1000", "> 50000", "> 100000"),
    "discount": ("< 0.05", "> 0.08"),
    "tax": ("= 0", "> 0.05"),
}


def ladder_rows():
    for c, tests in LADDER.items():
        for name, test in [("null", f"{c} IS NULL"), *((t, f"{c} {t}") for t in tests)]:
            test = test.replace("0.05", "CAST(0.05 AS DOUBLE)").replace(
                "0.08", "CAST(0.08 AS DOUBLE)")
            yield (f"SELECT '{c}' AS column, '{name}' AS rule, "
                   f"CAST(COUNT(*) FILTER ({test}) AS DOUBLE) AS value FROM l")
        for f in ("min", "max"):
            yield f"SELECT '{c}' AS column, '{f}' AS rule, {f}({c}) AS value FROM l"


ORACLE["threshold_ladder"] = f"WITH l AS ({LINES}) " + union(ladder_rows())


def pairs(view: str, named: dict[str, tuple[str, str]]) -> str:
    rows = []
    for name, (a, b) in named.items():
        for state, test in (("both_null", f"{a} IS NULL AND {b} IS NULL"),
                            ("only_first_null", f"{a} IS NULL AND {b} IS NOT NULL"),
                            ("only_second_null", f"{a} IS NOT NULL AND {b} IS NULL"),
                            ("both_present", f"{a} IS NOT NULL AND {b} IS NOT NULL")):
            rows.append(f"SELECT '{name}' AS pair, '{state}' AS state, "
                        f"COUNT(*) FILTER ({test}) AS cnt, "
                        f"{pct(f'COUNT(*) FILTER ({test})', 'COUNT(*)', 6)} AS pct FROM v")
    return f"WITH v AS ({view}) " + union(rows)


ORACLE["paired_missingness"] = pairs(
    LINES, {"discount_tax": ("discount", "tax"), "tax_shipped": ("tax", "shipped")})
ORACLE["paired_missingness_labels"] = pairs(DOCS, {"quality_toxic": ("quality", "toxic")})
EXTREMES = {"l_quantity > 48": "l_quantity > 48",
            "l_extendedprice > 100000": "l_extendedprice > 100000",
            "l_discount > 0.09": "l_discount > CAST(0.09 AS DOUBLE)"}
ORACLE["extreme_subset"] = union(
    f"SELECT '{name}' AS rule, COUNT(*) FILTER ({test}) AS cnt FROM lineitem"
    for name, test in EXTREMES.items())
ORACLE["extreme_context"] = "WITH c AS (" + union(
    f"SELECT '{name}' AS rule, '{dim}' AS dim, CAST({dim} AS VARCHAR) AS value, "
    f"COUNT(*) AS cnt FROM lineitem WHERE {test} GROUP BY {dim}"
    for name, test in EXTREMES.items() for dim in ("l_returnflag", "l_linenumber")) + """),
r AS (SELECT *, row_number() OVER (PARTITION BY rule, dim ORDER BY cnt DESC, value) AS rank
      FROM c)
SELECT rule, dim, value, cnt, rank FROM r WHERE rank <= 5"""

# ---- reading, writing, gates ----------------------------------------------------------------

ORACLE["csv_roundtrip"] = "SELECT * FROM orders"
ORACLE["parquet_roundtrip"] = "SELECT * FROM orders"
ORACLE["partitioned_roundtrip"] = "SELECT * FROM events"
ORACLE["report_roundtrip"] = CLASS_BY_GEO
ORACLE["copy_check"] = union(f'SELECT \'{c}\' AS "check", TRUE AS passed' for c in (
    "row_count", "column_count", "column_types", "content"))
ORACLE["incremental_conversion"] = """
WITH part AS (SELECT o_orderkey % 3 AS r, COUNT(*) AS n, SUM(o_orderkey) AS s FROM orders GROUP BY 1),
a AS (SELECT n, s FROM part WHERE r = 0), b AS (SELECT n, s FROM part WHERE r = 1)
SELECT 1 AS step, a.n AS converted, a.n AS table_rows, CAST(a.s AS BIGINT) AS key_sum FROM a
UNION ALL SELECT 2, 0, a.n, CAST(a.s AS BIGINT) FROM a
UNION ALL SELECT 3, b.n, a.n + b.n, CAST(a.s + b.s AS BIGINT) FROM a, b
UNION ALL SELECT 4, 0, b.n, CAST(b.s AS BIGINT) FROM b"""
ORACLE["head_in_file_order"] = """
SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 200"""
ORACLE["line_reconciliation"] = """
SELECT COUNT(*) AS parsed_rows, COUNT(*) AS data_lines, CAST(0 AS BIGINT) AS difference
FROM lineitem"""
AUDITED = {"o_orderkey": "0", "o_totalprice": "0",
           "strict_time": "COUNT(*) FILTER (o_orderstatus = 'P')", "plain_time": "0",
           "priority_number": "COUNT(*) FILTER (TRY_CAST(o_orderpriority AS INTEGER) IS NULL)",
           "padded_number": "COUNT(*) FILTER (o_orderkey % 2 = 0)",
           "word_flag": "COUNT(*) FILTER (o_orderstatus IN ('F', 'O'))"}
ORACLE["parse_audit"] = union(
    f"SELECT '{c}' AS column, COUNT(*) AS raw_values, COUNT(*) - {lost} AS parsed, "
    f"CAST({lost} AS BIGINT) AS lost FROM orders" for c, lost in AUDITED.items())
ORACLE["quality_report"] = f"""
WITH o AS (SELECT COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS ids, COUNT(o_orderdate) AS dates,
                  COUNT(o_totalprice) > 0 AS priced, COUNT(*) FILTER ({in_classes()}) AS listed,
                  COUNT(*) FILTER (class IN (1, 2, 3, 4)) AS first_four FROM ({ORDERS})),
c AS (
SELECT 'row_count' AS "check", n::VARCHAR AS expected, n::VARCHAR AS actual FROM o
UNION ALL SELECT 'column_count', '7', '7'
UNION ALL SELECT 'type:o_orderdate', 'timestamp_ntz', 'timestamp_ntz'
UNION ALL SELECT 'unique:o_orderkey', ids::VARCHAR, n::VARCHAR FROM o
UNION ALL SELECT 'no_nulls:o_orderdate', '0', (n - dates)::VARCHAR FROM o
UNION ALL SELECT 'some_values:o_totalprice', 'true', priced::VARCHAR FROM o
UNION ALL SELECT 'classes_cover:class', n::VARCHAR, listed::VARCHAR FROM o
UNION ALL SELECT 'classes_cover:class', n::VARCHAR, first_four::VARCHAR FROM o)
SELECT *, expected = actual AS passed FROM c"""
ORACLE["flag_quality"] = union(
    f"SELECT 'both_flags:{name}' AS \"check\", 'true' AS expected, "
    f"(bool_or({flag}) AND NOT bool_and({flag}))::VARCHAR AS actual, "
    f"bool_or({flag}) AND NOT bool_and({flag}) AS passed FROM lineitem"
    for name, flag in {"is_returned": "l_returnflag = 'R'", "is_open": "l_linestatus <> 'F'",
                       "bulk": "l_quantity > 40", "never": "l_quantity < 0"}.items())
ORACLE["union_all_reports"] = f"""
SELECT 'order_class' AS report, CAST(class AS VARCHAR) AS key, COUNT(*) AS cnt
FROM ({ORDERS}) GROUP BY class
UNION ALL SELECT 'event_type', event_type, COUNT(*) FROM events GROUP BY event_type"""

# ---- features and splits --------------------------------------------------------------------

ORACLE["feature_frame"] = f"""
SELECT l_orderkey, l_linenumber, CAST(class - 1 AS DOUBLE) AS label, l_quantity, discount, tax,
       coalesce(nullif(l_returnflag, 'N'), 'Unknown') AS returned_as,
       {', '.join(f"CAST(coalesce({f}, FALSE) AS DOUBLE) AS {f}" for f in FLAGS)},
       {', '.join(f"coalesce(CAST({part(p, 'shipped')} AS DOUBLE), {x}::DOUBLE) AS {p}"
                  for p, x in (("year", 2020), ("month", 6), ("dow", 4), ("hour", 12)))}
FROM ({LINES_ORDERS})"""
USED = {"numeric": ("l_quantity", "l_extendedprice", "discount", "tax", "p_retailprice"),
        "categorical": ("l_returnflag", "l_linestatus", "p_brand", "p_type"),
        "flag": ("is_returned", "is_open", "full_price", "bulk"),
        "time_part": ("year", "month", "dow", "hour")}
EXCLUDED = ("class", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate",
            "l_shipdate", "shipped", "l_discount", "l_tax", "never")
PART_COLUMNS = "p_brand, p_type, p_retailprice"
MODEL_ROWS = (f"SELECT l.*, {PART_COLUMNS} FROM ({LINES_ORDERS}) l "
              "LEFT JOIN part ON l_partkey = p_partkey")
ORACLE["role_audit"] = f"WITH m AS ({MODEL_ROWS}), a AS (" + union(
    f"SELECT '{c}' AS column, '{role}' AS role, 'used' AS status, "
    + ("CAST(NULL AS BIGINT) AS non_null" if role == "time_part"
       else f"COUNT({c}) AS non_null FROM m")
    for role, columns in USED.items() for c in columns) + " UNION ALL " + union(
    f"SELECT '{c}', 'forbidden', 'excluded', COUNT({c}) FROM m" for c in EXCLUDED) + """)
SELECT * FROM a"""
SIDED = f"SELECT *, {SPLIT.format(id='o_orderkey')} AS split FROM ({ORDERS})"
ORACLE["split_counts"] = \
    f"SELECT split, cnt, {pct('cnt', 'total')} AS pct FROM ({counts(SIDED, 'split')})"
ORACLE["split_class_distribution"] = f"""
WITH c AS (SELECT split, class, COUNT(*) AS cnt FROM ({SIDED}) GROUP BY split, class),
     t AS (SELECT *, CAST(SUM(cnt) OVER (PARTITION BY split) AS BIGINT) AS total FROM c)
SELECT split, class, cnt, {pct('cnt', 'total')} AS pct FROM t"""
WEIGHTS = f"""
SELECT class, COUNT(*) AS n,
       CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / CAST({len(CLASSES)} * COUNT(*) AS DOUBLE) AS weight
FROM ({SIDED}) WHERE split = 'train' GROUP BY class"""
ORACLE["class_weights"] = WEIGHTS
ORACLE["weighted_rows"] = f"""
SELECT o_orderkey, s.class, weight AS class_weight
FROM ({SIDED}) s JOIN ({WEIGHTS}) w ON s.class = w.class WHERE split = 'train'"""
ORACLE["impute_median"] = f"""
WITH l AS (SELECT *, {SPLIT.format(id='l_orderkey')} AS split FROM ({LINES})),
     m AS (SELECT quantile_disc(tax, 0.5) AS m FROM l WHERE split = 'train')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(tax, (SELECT m FROM m)) AS tax
FROM l"""
ORACLE["category_index"] = """
SELECT event_type AS category, COUNT(*) AS cnt,
       row_number() OVER (ORDER BY COUNT(*) DESC, event_type) - 1 AS index
FROM events GROUP BY event_type"""
ORACLE["category_index_wide"] = """
SELECT CAST(l_partkey AS VARCHAR) AS category, COUNT(*) AS cnt,
       row_number() OVER (ORDER BY COUNT(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS index
FROM lineitem GROUP BY l_partkey"""

# ---- evaluation of rule models --------------------------------------------------------------

RULES = f"""
SELECT class AS label,
       CASE WHEN o_totalprice <= 100000 THEN 1 WHEN o_totalprice <= 200000 THEN 2
            WHEN o_totalprice <= 300000 THEN 3 WHEN o_totalprice <= 400000 THEN 4 ELSE 5 END
            AS by_price,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 3 ELSE 5 END AS by_status
FROM ({ORDERS})"""


def confusion(*names: str) -> str:
    listed = f"(VALUES {', '.join(f'({c})' for c in CLASSES)})"
    parts = (f"SELECT '{m}' AS model, a.c AS label, b.c AS prediction, "
             f"COUNT(r.label) AS cnt FROM {listed} a(c) CROSS JOIN {listed} b(c) "
             f"LEFT JOIN ({RULES}) r ON r.label = a.c AND r.{m} = b.c GROUP BY a.c, b.c"
             for m in names)
    return union(parts)


def class_metrics(*names: str) -> str:
    """Unrounded metrics per model and class."""
    return f"""
    SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE CAST(0 AS DOUBLE) END AS f
    FROM (SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), CAST(0 AS DOUBLE)) AS p,
                 coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), CAST(0 AS DOUBLE)) AS r
          FROM (SELECT model, c AS class,
                       CAST(SUM(cnt) FILTER (label = c) AS BIGINT) AS support,
                       CAST(SUM(cnt) FILTER (prediction = c) AS BIGINT) AS predicted,
                       CAST(SUM(cnt) FILTER (label = c AND prediction = c) AS BIGINT) AS tp
                FROM ({confusion(*names)})
                CROSS JOIN (VALUES {', '.join(f'({c})' for c in CLASSES)}) d(c)
                GROUP BY model, c))"""


def model_summary(*names: str) -> str:
    return f"""
    SELECT model, round(CAST(SUM(tp) AS DOUBLE) / SUM(support), 4) AS accuracy,
           round(SUM(p * support) / SUM(support), 4) AS weighted_precision,
           round(SUM(r * support) / SUM(support), 4) AS weighted_recall,
           round(SUM(f * support) / SUM(support), 4) AS weighted_f1,
           round(AVG(f), 4) AS macro_f1
    FROM ({class_metrics(*names)}) GROUP BY model"""


ORACLE["confusion_matrix"] = f"""
WITH t AS (SELECT *, CAST(SUM(cnt) OVER (PARTITION BY model, label) AS BIGINT) AS total
           FROM ({confusion('by_price', 'by_status')}))
SELECT model, label, prediction, cnt, {pct('cnt', 'total')} AS row_pct FROM t"""
ORACLE["per_class_metrics"] = f"""
SELECT model, class, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support
FROM ({class_metrics('by_price', 'by_status')})"""
ORACLE["summary_metrics"] = model_summary("by_status")
ORACLE["model_comparison"] = model_summary("by_price", "by_status")
ORACLE["best_model"] = f"""
SELECT model, macro_f1 AS score FROM ({ORACLE['model_comparison']})
ORDER BY macro_f1 DESC, model LIMIT 1"""

# ---- trained models: what must hold whatever was learned ------------------------------------

MODEL_KEY = ("concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
             "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))")
for _query, _model in (("ml_logistic", "Logistic Regression"), ("ml_tree", "Decision Tree"),
                       ("ml_forest", "Random Forest")):
    ORACLE[_query] = f"""
WITH s AS (SELECT class, {SPLIT.format(id=MODEL_KEY)} AS split FROM ({MODEL_ROWS}))
SELECT '{_model}' AS model, COUNT(*) FILTER (split = 'train' AND {in_classes()}) AS train_rows,
       COUNT(*) FILTER (split = 'test' AND {in_classes()}) AS test_rows,
       COUNT(*) FILTER (coalesce(NOT ({in_classes()}), TRUE)) AS unlabelled,
       {', '.join(f"COUNT(*) FILTER (split = 'test' AND class = {c}) AS support_{c}"
                  for c in CLASSES)},
       TRUE AS gates_passed, TRUE AS recall_is_accuracy, TRUE AS metrics_in_range,
       TRUE AS has_preprocessing FROM s"""
ORACLE["score_batch"] = """
SELECT l_linenumber, COUNT(*) AS n, CAST(SUM(l_orderkey) AS BIGINT) AS key_sum,
       TRUE AS sums_to_one, TRUE AS class_listed, TRUE AS most_likely, TRUE AS described
FROM lineitem GROUP BY l_linenumber"""
ORACLE["scored_sample"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, TRUE AS class_listed FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10"""
