"""Registry of runnable queries, and the SQL text of the shared views used by their checks."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    rows: tuple[str, ...]  # inventory rows it demonstrates
    run: Run
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def register(name: str, rows: str, run: Run, sql: str | None = None) -> None:
    if name in REGISTRY:
        raise ValueError(f"query {name} is registered twice")
    REGISTRY[name] = Query(name, tuple(rows.split()), run, sql)


def query(rows: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""
    def wrap(run: Run) -> Run:
        register(run.__name__, rows, run, sql)
        return run
    return wrap


TXN = """txn AS (
SELECT o.o_custkey AS card_id, l.l_suppkey AS merchant_id, p.p_type AS merchant_category_id,
       s.s_nationkey AS city_id, n.n_regionkey AS state_id, p.p_size % 10 AS subsector_id,
       o.o_orderdate AS purchase_date, l.l_extendedprice AS purchase_amount,
       CASE l.l_linenumber WHEN 7 THEN 999 WHEN 6 THEN -1 ELSE l.l_linenumber END AS installments,
       CASE WHEN l.l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS authorized_flag,
       CASE WHEN l.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS category_1,
       nullif(CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE), 5.0) AS category_2,
       CASE l.l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' END AS category_3,
       (year(o.o_orderdate) - 2001) * 12 + month(o.o_orderdate) - 6 AS month_lag,
       o.o_orderkey, l.l_linenumber, l.l_partkey
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey)"""

EVENTS = """ev AS (
SELECT user_id AS card_id, json_extract_string(props, '$.k') AS merchant_id, event_type AS merchant_category_id,
       ts AS purchase_date, value AS purchase_amount, event_id FROM events)"""

CARDS = """cards AS (
SELECT c_custkey AS card_id, c_nationkey % 5 + 1 AS feature_1, c_nationkey % 3 + 1 AS feature_2,
       c_custkey % 2 AS feature_3, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS target,
       CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS outlier,
       CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS is_test, fam AS first_active_month
FROM customer LEFT JOIN (SELECT o_custkey, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS fam
                         FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey)"""

MERCHANTS = """merchants AS (
SELECT s_suppkey AS merchant_id, CASE WHEN s_acctbal < 0 THEN 'Y' ELSE 'N' END AS category_4,
       s_nationkey AS merchant_group_id, s_nationkey AS city_id FROM supplier)"""

# The two cleaning variants of the transaction table.
CLEAN = """tx AS (
SELECT * REPLACE (coalesce(category_2, 6) AS category_2,
                  CASE coalesce(category_3, 'B') WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS category_3,
                  CASE installments WHEN -1 THEN 1 WHEN 999 THEN 0 ELSE installments END AS installments,
                  CASE authorized_flag WHEN 'Y' THEN 1 ELSE 0 END AS authorized_flag,
                  CASE category_1 WHEN 'Y' THEN 1 ELSE 0 END AS category_1) FROM txn)"""
CLEAN_BASE = """tx AS (
SELECT * REPLACE (coalesce(category_2, 1.0) AS category_2,
                  CASE coalesce(category_3, 'A') WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS category_3,
                  CASE WHEN installments IN (-1, 999) THEN NULL ELSE installments END AS installments,
                  CASE authorized_flag WHEN 'Y' THEN 1 ELSE 0 END AS authorized_flag,
                  CASE category_1 WHEN 'Y' THEN 1 ELSE 0 END AS category_1,
                  CASE WHEN purchase_amount > 80000 THEN 80000 ELSE purchase_amount END AS purchase_amount) FROM txn)"""

TXN_ORDER_SQL = "purchase_date, o_orderkey, l_linenumber, l_partkey, merchant_id, purchase_amount"
HIST, NEW = "month_lag <= 0", "month_lag > 0"


def with_views(*parts: str) -> str:
    """``WITH`` the given views; the last part is the statement, which may open with a view of its own."""
    *named, last = parts
    own_view = re.match(r"\s*\w+ AS \(", last) is not None
    return "WITH " + ",\n".join(named) + (",\n" if own_view else "\n") + last


def money(column: str = "purchase_amount", where: str | None = None) -> str:
    """Exact sum of cents as a double."""
    guard = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))){guard} AS DOUBLE)"


def counted(column: str, where: str | None = None) -> str:
    return f"COUNT({column})" + (f" FILTER (WHERE {where})" if where else "")


def money_mean(column: str = "purchase_amount", where: str | None = None) -> str:
    return f"{money(column, where)} / nullif({counted(column, where)}, 0)"


# Moves short decimals off the rounding ties that the two engines break differently.
NUDGE = "1.0000000314159"


def digits_sql(expression: str) -> str:
    """Eight significant digits of a double."""
    return f"CAST(printf('%.7e', CAST({expression} AS DOUBLE) * CAST({NUDGE} AS DOUBLE)) AS DOUBLE)"


def floor_days_sql(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS INTEGER)"
