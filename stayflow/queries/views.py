"""SQL text of the stand-in views and helpers to build oracle queries."""
from __future__ import annotations

from collections.abc import Sequence

V1 = """
WITH o AS (SELECT o_custkey AS cust, year(o_orderdate)*12+month(o_orderdate)-1 AS mi,
  count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS rev,
  max(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END) AS f,
  max(CASE WHEN o_orderstatus='P' AND o_orderpriority='5-LOW' THEN 1 ELSE 0 END) AS p
  FROM orders GROUP BY 1,2),
m AS (SELECT DISTINCT mi FROM o),
c AS (SELECT cust, min(mi) AS first_mi FROM o GROUP BY 1),
s AS (SELECT c.cust, m.mi, m.mi-c.first_mi AS tenure, coalesce(o.n,0) AS n,
  coalesce(o.rev,CAST(0 AS DECIMAL(28,2))) AS rev, coalesce(o.f,0) AS f, coalesce(o.p,0) AS p
  FROM c JOIN m ON m.mi>=c.first_mi LEFT JOIN o ON o.cust=c.cust AND o.mi=m.mi)
SELECT s.cust AS chc_id, CAST(floor(s.mi/12)*100+s.mi%12+1 AS INT) AS dt, CAST(s.tenure AS INT) AS tenure,
  CASE WHEN sum(n) OVER w12 > 0 THEN 'ACTIVE' ELSE 'LAPSED' END AS drform,
  CASE WHEN f=1 THEN 'Y' END AS vol_pend_disco,
  CASE WHEN f=1 AND s.cust%2=0 THEN 'VOLUNTARY' END AS pending_drform,
  CASE WHEN p=1 THEN 'FALSE' END AS pending_mover,
  CASE s.cust%4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'B' ELSE 'C' END AS product,
  CAST(rev AS DOUBLE) AS rev_m0, CAST(lag(rev,1) OVER w AS DOUBLE) AS rev_m1,
  CAST(lag(rev,2) OVER w AS DOUBLE) AS rev_m2, CAST(lag(rev,3) OVER w AS DOUBLE) AS rev_m3,
  CAST(n AS INT) AS orders_m0, CAST(sum(n) OVER w6 AS INT) AS orders_6m,
  CASE WHEN s.cust%13<>0 THEN k.c_acctbal END AS acctbal,
  CASE WHEN s.cust%17=0 THEN NULL WHEN s.cust%19=0 THEN '  ' ELSE k.c_mktsegment END AS segment,
  a.n_name AS nation, r.r_name AS area
FROM s JOIN customer k ON k.c_custkey=s.cust JOIN nation a ON a.n_nationkey=k.c_nationkey
JOIN region r ON r.r_regionkey=a.n_regionkey
WINDOW w AS (PARTITION BY s.cust ORDER BY s.mi),
 w12 AS (PARTITION BY s.cust ORDER BY s.mi ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
 w6 AS (PARTITION BY s.cust ORDER BY s.mi ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
"""

V2 = """
WITH l AS (SELECT l_orderkey, CASE WHEN sum(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END)>=3 THEN 1 ELSE 0 END AS y,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS x, CAST(count(*) AS INT) AS n FROM lineitem GROUP BY 1),
q AS (SELECT l_orderkey, y, round(x/(x+90000.0),6) AS p FROM l)
SELECT l_orderkey AS chc_id, y AS original_labels, CASE WHEN p>=0.5 THEN 1 ELSE 0 END AS predicted_label,
  CASE WHEN p>=0.5 THEN p ELSE 1-p END AS prediction_probability FROM q
"""

V3 = "SELECT user_id AS chc_id, event_type, CAST(ts AS DATE) AS reportdate, value FROM events"

V4 = """
WITH r AS (SELECT o_custkey, o_orderpriority AS t, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT o_custkey AS chc_id, coalesce(max(CASE WHEN rn=1 THEN t END),'None') AS tier_m0,
  coalesce(max(CASE WHEN rn=2 THEN t END),'None') AS tier_m1, coalesce(max(CASE WHEN rn=3 THEN t END),'None') AS tier_m2,
  coalesce(max(CASE WHEN rn=4 THEN t END),'None') AS tier_m3, coalesce(max(CASE WHEN rn=5 THEN t END),'None') AS tier_m4,
  CAST(count(*) AS INT) AS n_orders,
  concat('0701', concat(repeat('0', CAST(greatest(0, 6 - length(CAST(o_custkey AS STRING))) AS INT)), CAST(o_custkey AS STRING)), concat(repeat('0', CAST(greatest(0, 2 - length(CAST(o_custkey%100 AS STRING))) AS INT)), CAST(o_custkey%100 AS STRING))) AS corp_house_cust
FROM r GROUP BY o_custkey
"""

V5 = """
SELECT o.o_orderkey AS chc_id, CASE WHEN o.o_orderstatus='F' THEN 1 ELSE 0 END AS status,
  o.o_totalprice AS price, o.o_totalprice*2 AS price_x2, o.o_totalprice AS price_dup,
  CASE WHEN o.o_orderkey%3<>0 THEN c.c_acctbal END AS acctbal_gap,
  CASE WHEN o.o_orderkey%500=0 THEN c.c_acctbal END AS mostly_missing,
  7.0E0 AS const_num, 'k' AS const_cat, year(o.o_orderdate) AS yr, month(o.o_orderdate) AS mon,
  o.o_orderpriority AS priority, o.o_orderpriority AS priority_dup,
  CASE WHEN o.o_orderkey%11=0 THEN ' ' ELSE c.c_mktsegment END AS segment, n.n_name AS nation
FROM orders o JOIN customer c ON c.c_custkey=o.o_custkey JOIN nation n ON n.n_nationkey=c.c_nationkey
"""

_TEXT = {"v1": V1, "v2": V2, "v3": V3, "v4": V4, "v5": V5}


def with_views(names: str, *ctes: str, select: str) -> str:
    """``WITH`` the named views and further CTEs, then the final select."""
    parts = [f"{n} AS MATERIALIZED ({_TEXT[n]})" for n in names.split()]  # built once, however often it is named
    return "WITH " + ",\n".join([*parts, *ctes]) + "\n" + select


def pct2(num: str, den: str) -> str:
    """Percentage rounded half up to two places, in whole numbers."""
    return f"CAST((CAST({num} AS BIGINT)*20000+CAST({den} AS BIGINT))//(2*CAST({den} AS BIGINT)) AS DOUBLE)/100"


def long_numbers(src: str, cols: Sequence[str], keep: str = "") -> str:
    keep = keep + ", " if keep else ""
    return " UNION ALL ".join(f"SELECT {keep}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


def long_levels(src: str, cols: Sequence[str], keep: str = "") -> str:
    keep = keep + ", " if keep else ""
    return " UNION ALL ".join(f"SELECT {keep}'{c}' AS feature, CAST({c} AS VARCHAR) AS level FROM {src}" for c in cols)


def corr(x: str, y: str) -> str:
    """Pearson over complete pairs, null for a constant side."""
    a, b = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


def cut_sql(x: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    """Right-closed bins."""
    out = "CASE"
    if edges[0] != float("-inf"):
        out += f" WHEN {x} <= {edges[0]} THEN NULL"
    for right, label in zip(edges[1:], labels):
        cond = f"{x} IS NOT NULL" if right == float("inf") else f"{x} <= {right}"
        out += f" WHEN {cond} THEN '{label}'"
    return out + " END"
