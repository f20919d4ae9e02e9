"""Shared SQL fragments for the DuckDB oracle queries.

The oracle re-derives the retail calendar in SQL (generate_series + the
week rule written in SQL), independently of the driver-side arithmetic the
Spark plans use for their literal window bounds, so a mistake in either
shows up as a mismatch.
"""

# Sunday = 1 weekday number in DuckDB (its dayofweek has Sunday = 0).
def dow(d: str) -> str:
    return f"(dayofweek({d}) + 1)"


def week_no(d: str) -> str:
    j = dow(f"make_date(year({d}), 1, 1)")
    return (f"(CAST(floor((dayofyear({d}) + {j} - 2) / 7) AS INTEGER) + 1"
            f" - CASE WHEN {j} = 7 THEN 1 ELSE 0 END)")


def week_ending(d: str) -> str:
    return f"CAST({d} + CAST(7 - {dow(d)} AS INTEGER) AS DATE)"


def calendar_cte(min_sql: str = "(SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem)",
                 max_sql: str = "(SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)") -> str:
    """``cal(d, y, wk, we)`` over the fact's date span (CALENDAR(min, max))."""
    return (f"cal AS (SELECT d, CAST(year(d) AS INTEGER) AS y, {week_no('d')} AS wk, {week_ending('d')} AS we "
            f"FROM (SELECT CAST(gs AS DATE) AS d FROM generate_series({min_sql}, {max_sql}, INTERVAL 1 DAY) g(gs)))")


POS_FACT_CTE = """pos AS (
  SELECT l.l_partkey AS part_key, l.l_suppkey AS store, CAST(l.l_shipdate AS DATE) AS sale_date,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS value,
         s.s_name AS store_name, r.r_name AS retailer, CAST(r.r_regionkey + 1 AS BIGINT) AS retailer_order,
         r.r_name AS smm, n.n_name AS ssr, (s.s_acctbal >= 0) AS in_coverage,
         upper(trim(p.p_brand)) AS product
  FROM lineitem l
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

CATEGORY_FACT_CTE = """cat AS (
  SELECT o.o_custkey AS store, CAST(o.o_orderdate AS DATE) AS sale_date,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS value, c.c_mktsegment AS category
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""


def blank_sub(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL ELSE coalesce({a}, 0) - coalesce({b}, 0) END)"


def weekly_pct(ty: str, ly: str) -> str:
    r = f"(CAST({ty} AS DOUBLE) / CAST({ly} AS DOUBLE))"
    return (f"(CASE WHEN {ly} IS NULL OR {ly} = 0 OR {ty} IS NULL THEN NULL "
            f"WHEN abs({r}) - 1 = -1 THEN NULL ELSE abs({r}) - 1 END)")


def ytd_pct(ty: str, ly: str) -> str:
    return (f"(CASE WHEN {ly} IS NULL OR {ly} = 0 THEN 0.0 "
            f"ELSE CAST({blank_sub(ty, ly)} AS DOUBLE) / abs(CAST({ly} AS DOUBLE)) END)")


def ratio_pct(x: str, y: str) -> str:
    return (f"(CASE WHEN {y} IS NULL OR {y} = 0 THEN NULL "
            f"ELSE CAST({blank_sub(x, y)} AS DOUBLE) / CAST({y} AS DOUBLE) END)")


def abs_ratio_pct(x: str, y: str) -> str:
    return (f"(CASE WHEN {y} IS NULL OR {y} = 0 THEN NULL "
            f"ELSE CAST({blank_sub(x, y)} AS DOUBLE) / abs(CAST({y} AS DOUBLE)) END)")


def sign(x: str) -> str:
    """-1 / 0 / 1, with BLANK counted as flat (0)."""
    return f"CAST(CASE WHEN {x} < 0 THEN -1 WHEN {x} > 0 THEN 1 ELSE 0 END AS INTEGER)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"
