"""Numeric transforms."""
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.operators import numeric as nu, sampling as sa, trees
from stayflow.operators.stage import union
from stayflow.queries.registry import query
from stayflow.queries.statistics import corr_target_sql, pairs_sql, r
from stayflow.queries.views import with_views

COLS = ["price", "acctbal_gap", "const_num", "mon"]


def _simple(name, fit, exprs, extra="", places=6):
    """``exprs`` gives the SQL of one column ``{c}``; ``extra`` is a CTE named q."""
    ctes = [extra] if extra else []
    sql = with_views("v5", *ctes, select="SELECT chc_id, " + ", ".join(f"round({exprs.format(c=c)}, {places}) AS {c}" for c in COLS) + " FROM v5" + (", q" if extra else ""))
    query(name, sql)(lambda s, sf: (lambda df: r(fit(df).apply(df, ["chc_id"]), places))(fx.wide(s, sf)))


def _q(template: str) -> str:
    return "q AS (SELECT " + ", ".join(template.format(c=c, x=f"CAST({c} AS DOUBLE)") for c in COLS) + " FROM v5)"


X = "CAST({c} AS DOUBLE)"
_simple("universal_transform", lambda df: nu.universal(COLS, lambda x: F.log(F.when(x > 0, x)) * 2), f"coalesce(ln(CASE WHEN {X} > 0 THEN {X} END)*2, 0)")
_simple("num_log1p", lambda df: nu.log1p(COLS), f"CASE WHEN {X} > -1 THEN ln(1+{X}) ELSE 0 END")
_simple("num_sqrt", lambda df: nu.sqrt(COLS), f"CASE WHEN {X} >= 0 THEN sqrt({X}) ELSE 0 END")
_simple("num_reciprocal", lambda df: nu.reciprocal(COLS), f"coalesce(1/nullif({X},0), 0)", places=9)
_simple("num_binarize", lambda df: nu.binarize(COLS, 7.0), f"CASE WHEN {X} > 7 THEN 1.0 WHEN {{c}} IS NOT NULL THEN 0.0 END::DOUBLE")
_simple("scale_standard", lambda df: nu.standard(df, COLS), f"({X} - m_{{c}})/s_{{c}}", _q("avg({x}) AS m_{c}, coalesce(nullif(stddev_pop({x}),0),1) AS s_{c}"))
_simple(
    "scale_robust", lambda df: nu.robust(df, COLS, (5.0, 95.0)), f"({X} - m_{{c}})/s_{{c}}",
    _q("quantile_cont({x},0.5) AS m_{c}, coalesce(nullif(quantile_cont({x},0.95)-quantile_cont({x},0.05),0),1) AS s_{c}"),
)
_simple("scale_minmax", lambda df: nu.minmax(df, COLS), f"({X} - a_{{c}})/s_{{c}}", _q("min({x}) AS a_{c}, coalesce(nullif(max({x})-min({x}),0),1) AS s_{c}"))
_simple("scale_maxabs", lambda df: nu.maxabs(df, COLS), f"{X}/s_{{c}}", _q("coalesce(nullif(max(abs({x})),0),1) AS s_{c}"))
_L1 = "(" + "+".join(f"coalesce(abs(CAST({c} AS DOUBLE)),0)" for c in COLS) + ")"
_simple("row_normalize", lambda df: nu.normalize(COLS, "l1"), f"CASE WHEN {_L1}=0 THEN {X} ELSE {X}/{_L1} END")


def _kbins_sql():
    qs = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) AS e_{c}" for c in COLS)
    # keep the first edge and every edge that ends a bin wider than 1e-8
    kept = ", ".join(f"list_concat([e_{c}[1]], [e_{c}[i] FOR i IN range(2,12) IF e_{c}[i]-e_{c}[i-1] > 1e-8]) AS k_{c}" for c in COLS)
    out = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN CAST(len(list_filter(k_{c}[2:-2], lambda x: x <= CAST({c} AS DOUBLE))) AS DOUBLE) END AS {c}" for c in COLS)
    return with_views("v5", f"q AS (SELECT {qs} FROM v5)", f"k AS (SELECT {kept} FROM q)", select=f"SELECT chc_id, {out} FROM v5, k")


query("kbins_quantile", _kbins_sql())(lambda s, sf: (lambda df: nu.kbins(df, COLS, 10, "ordinal").apply(df, ["chc_id"]))(fx.wide(s, sf)))

_N = 100
_STEPS = "[" + ",".join(repr(k / (_N - 1)) for k in range(_N)) + "]"


def _quantile_sql():
    # landmarks by position; ties take the middle of their span
    parts, outs = [], []
    for c in COLS:
        parts.append(f"q_{c} AS (SELECT quantile_cont(CAST({c} AS DOUBLE), {_STEPS}) AS m FROM v5)")
        parts.append(
            f"""p_{c} AS (SELECT chc_id, CAST({c} AS DOUBLE) AS x, m, len(list_filter(m, lambda e: e < CAST({c} AS DOUBLE))) AS lo,
  len(list_filter(m, lambda e: e <= CAST({c} AS DOUBLE))) AS hi FROM v5, q_{c})"""
        )
        outs.append(
            f"""o_{c} AS (SELECT chc_id, round(CASE WHEN x IS NULL THEN NULL WHEN x >= m[{_N}] THEN 1.0 WHEN x <= m[1] THEN 0.0
  WHEN hi > lo THEN (lo + hi - 1)/2.0/{_N - 1}
  ELSE (hi - 1 + (x - m[hi])/(m[hi+1] - m[hi]))/{_N - 1} END, 6)::DOUBLE AS {c} FROM p_{c})"""
        )
    joins = " ".join(f"JOIN o_{c} USING (chc_id)" for c in COLS[1:])
    return with_views("v5", *parts, *outs, select=f"SELECT chc_id, {', '.join(COLS)} FROM o_{COLS[0]} {joins}")


query("scale_quantile", _quantile_sql())(lambda s, sf: (lambda df: r(nu.quantile(df, COLS, _N).apply(df, ["chc_id"])))(fx.wide(s, sf)))

_PCOLS = ["mon", "price"]


def _power_sql():
    grid = ",".join(repr(g) for g in nu.POWER_GRID)
    parts = []
    for c in _PCOLS:
        # both columns are positive, so only the upper branch is needed
        f = "CASE WHEN lam=0 THEN ln(1+x) ELSE (pow(x+1,lam)-1)/lam END"
        parts += [
            f"t_{c} AS (SELECT lam, var_pop({f}) AS v, avg({f}) AS m, count(x) AS n, sum(ln(1+x)) AS j FROM (SELECT CAST({c} AS DOUBLE) AS x FROM v5), (SELECT unnest([{grid}])::DOUBLE AS lam) GROUP BY lam)",
            f"b_{c} AS (SELECT lam, v, m FROM t_{c} WHERE v > 0 ORDER BY -n/2.0*ln(v)+(lam-1)*j DESC LIMIT 1)",
        ]
    outs = ", ".join(
        f"round((CASE WHEN b_{c}.lam=0 THEN ln(1+CAST({c} AS DOUBLE)) ELSE (pow(CAST({c} AS DOUBLE)+1,b_{c}.lam)-1)/b_{c}.lam END - b_{c}.m)/sqrt(b_{c}.v),6) AS {c}" for c in _PCOLS
    )
    return with_views("v5", *parts, select=f"SELECT chc_id, {outs} FROM v5, " + ", ".join(f"b_{c}" for c in _PCOLS))


query("scale_power", _power_sql())(lambda s, sf: (lambda df: r(nu.power(df, _PCOLS).apply(df, ["chc_id"])))(fx.wide(s, sf)))

query(
    "numeric_union",
    with_views(
        "v5", "q AS (SELECT avg(price) AS m, stddev_pop(price) AS s, max(abs(price)) AS a FROM v5)",
        select="SELECT chc_id, price AS Original_price, round((price-m)/s,6) AS Standard_price, round(price/a,6) AS MaxAbs_price, round(ln(1+price),6) AS Log1p_price FROM v5, q",
    ),
)(
    lambda s, sf: (
        lambda df: r(
            union(
                nu.passthrough(["price"]).renamed("Original"), nu.standard(df, ["price"]).renamed("Standard"),
                nu.maxabs(df, ["price"]).renamed("MaxAbs"), nu.log1p(["price"]).renamed("Log1p"),
            ).apply(df, ["chc_id"])
        )
    )(fx.wide(s, sf))
)

# --- the thinned union: which outputs survive, found by the same rule in SQL ---

_PIPE = ["price", "acctbal_gap", "mon"]
_STAGES = ["Original", "Standard", "Robust", "Quantile", "Binary", "MinMax", "MaxAbs", "Norm", "KBin", "Log1p", "Sqrt", "Reciprocal"]
_TENTHS = "[0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]"


def _pipe_sql():
    f = {
        "Original": "{c}", "Standard": "({c}-m_{c})/s_{c}", "Binary": "CASE WHEN {c}>0 THEN 1.0 WHEN {c} IS NOT NULL THEN 0.0 END",
        "MinMax": "({c}-a_{c})/(b_{c}-a_{c})", "MaxAbs": "{c}/x_{c}", "Log1p": "CASE WHEN {c}>-1 THEN ln(1+{c}) ELSE 0 END",
        "Sqrt": "CASE WHEN {c}>=0 THEN sqrt({c}) ELSE 0 END", "Reciprocal": "coalesce(1/nullif({c},0),0)", "Robust": "({c}-r_{c})/w_{c}",
        "Norm": "CASE WHEN l1=0 THEN {c} ELSE {c}/l1 END", "KBin": "CASE WHEN {c} IS NOT NULL THEN CAST(len(list_filter(k_{c}[2:-2], lambda x: x <= {c})) AS DOUBLE) END",
        "Quantile": f"""CASE WHEN {{c}} IS NULL THEN NULL WHEN {{c}} >= l_{{c}}[{_N}] THEN 1.0 WHEN {{c}} <= l_{{c}}[1] THEN 0.0
  WHEN len(list_filter(l_{{c}}, lambda x: x <= {{c}})) > len(list_filter(l_{{c}}, lambda x: x < {{c}}))
  THEN (len(list_filter(l_{{c}}, lambda x: x < {{c}})) + len(list_filter(l_{{c}}, lambda x: x <= {{c}})) - 1)/2.0/{_N - 1}
  ELSE (len(list_filter(l_{{c}}, lambda x: x <= {{c}})) - 1 + ({{c}} - l_{{c}}[len(list_filter(l_{{c}}, lambda x: x <= {{c}}))])
  /(l_{{c}}[len(list_filter(l_{{c}}, lambda x: x <= {{c}})) + 1] - l_{{c}}[len(list_filter(l_{{c}}, lambda x: x <= {{c}}))]))/{_N - 1} END""",
    }
    d = "d AS (SELECT status, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _PIPE) + " FROM v5)"
    q = "q AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, min({c}) AS a_{c}, max({c}) AS b_{c}, max(abs({c})) AS x_{c}, quantile_cont({c},0.5) AS r_{c}, quantile_cont({c},0.95)-quantile_cont({c},0.05) AS w_{c}, quantile_cont({c}, {_STEPS}) AS l_{c}, quantile_cont({c}, {_TENTHS}) AS e_{c}" for c in _PIPE) + " FROM d)"
    e = "e AS (SELECT *, " + ", ".join(f"list_concat([e_{c}[1]], [e_{c}[i] FOR i IN range(2,12) IF e_{c}[i]-e_{c}[i-1] > 1e-8]) AS k_{c}" for c in _PIPE) + " FROM q)"
    l1 = "+".join(f"coalesce(abs({c}),0)" for c in _PIPE)
    names = [f"{st}_{c}" for st in _STAGES for c in _PIPE]
    u = "u AS (SELECT status, " + ", ".join(f"{f[st].format(c=c)} AS {st}_{c}" for st in _STAGES for c in _PIPE) + f" FROM (SELECT *, {l1} AS l1 FROM d), e)"
    u = u.replace("u AS (", "u AS MATERIALIZED (", 1)
    ctes = [
        d, q, e, u, f"ct AS ({corr_target_sql(names, 'u')})",
        "o AS (SELECT *, split_part(feature,'_',1) AS stage, row_number() OVER (ORDER BY abs(round(corr,9)) DESC NULLS LAST, feature) AS pos FROM ct WHERE round(abs(corr),9) >= 0.002)",
        f"pr AS ({pairs_sql(names, 'u')})",
        "pp AS (SELECT b.feature, a.feature AS early, a.stage = b.stage AS same, round(abs(p.corr),9) > 0.9 AS hit FROM o a JOIN o b ON a.pos<b.pos JOIN pr p ON (p.col_a=a.feature AND p.col_b=b.feature) OR (p.col_a=b.feature AND p.col_b=a.feature))",
        "s1 AS (SELECT feature FROM o WHERE feature NOT IN (SELECT feature FROM pp WHERE same AND hit))",
    ]
    return with_views("v5", *ctes, select="SELECT feature FROM s1 WHERE feature NOT IN (SELECT feature FROM pp WHERE hit AND feature IN (SELECT feature FROM s1) AND early IN (SELECT feature FROM s1))")


def _numeric_pipeline_choice(s, sf):
    df = fx.wide(s, sf)
    chosen = nu.numeric_pipeline(df, _PIPE, "status", 0.002, 0.90)
    return s.createDataFrame([(n,) for n in chosen.outputs], "feature string")


query("numeric_pipeline_choice", _pipe_sql())(_numeric_pipeline_choice)
query("numeric_pipeline")(
    lambda s, sf: (lambda df: nu.numeric_pipeline(df, ["price", "acctbal_gap", "mon", "yr"], target_threshold=0.002).apply(df, ["chc_id", "status"]))(fx.wide(s, sf))
)

# --- trees ---


def _with_folds(s, sf):
    from stayflow.session import materialize

    return materialize(sa.stratified_folds(fx.wide(s, sf).select("chc_id", "status", "price", "acctbal_gap", "mon", "yr"), 3), "folds")


def _tree_discretize(s, sf):
    df = _with_folds(s, sf)
    fitted = trees.tree_stage(trees.fit_trees(df, ["price", "acctbal_gap", "mon", "yr"], corr_threshold=0.0))
    return fitted.renamed("Tree").apply(df, ["chc_id", "status"])


query("tree_discretize")(_tree_discretize)


_PROFILED = ["price", "mon", "acctbal_gap"]


def _tree_profile(s, sf):
    df = fx.wide(s, sf).select("chc_id", "status", *_PROFILED)
    return trees.leaf_ranges(df, _PROFILED)


def _tree_profile_sql(depth=2):
    """Bins by quantiles; at each depth the cut of a node with the lowest Gini impurity, the first on ties."""
    inner = ",".join(repr(k / trees.BINS) for k in range(1, trees.BINS))
    cuts = [f"c_{c} AS (SELECT list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{inner}])) AS cuts FROM v5)" for c in _PROFILED]
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, len(list_filter(cuts, lambda e: e < CAST({c} AS DOUBLE))) AS bin, CAST({c} AS DOUBLE) AS v, status AS y FROM v5, c_{c} WHERE {c} IS NOT NULL" for c in _PROFILED)
    ctes = [*cuts, f"t0 AS (SELECT feature, bin, 0 AS node, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS y, min(v) AS lo, max(v) AS hi FROM ({rows}) GROUP BY feature, bin)",
            "least AS (SELECT feature, floor(0.02*sum(n)) AS small FROM t0 GROUP BY feature)"]
    for d in range(depth):
        ctes += [
            f"""s{d} AS (SELECT feature, node, bin, sum(n) OVER w AS nl, sum(y) OVER w AS yl, sum(n) OVER p - sum(n) OVER w AS nr, sum(y) OVER p - sum(y) OVER w AS yr
  FROM t{d} WINDOW w AS (PARTITION BY feature, node ORDER BY bin), p AS (PARTITION BY feature, node))""",
            f"""k{d} AS (SELECT feature, node, bin AS edge FROM s{d} JOIN least USING (feature) WHERE nl >= small AND nr >= small AND nr > 0 AND yl+yr > 0 AND yl+yr < nl+nr
  QUALIFY row_number() OVER (PARTITION BY feature, node ORDER BY yl*(nl-yl)/greatest(nl,1)+yr*(nr-yr)/greatest(nr,1), bin) = 1)""",
            f"t{d + 1} AS (SELECT t{d}.* REPLACE (node*2 + CASE WHEN bin > edge THEN 1 ELSE 0 END AS node) FROM t{d} LEFT JOIN k{d} USING (feature, node))",
        ]
    leaf = f"SELECT feature, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY node) - 1 AS INT) AS leaf, min(lo) AS lo, max(hi) AS hi, CAST(sum(n) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS y FROM t{depth} GROUP BY feature, node"
    return with_views("v5", *ctes, f"l AS ({leaf})", select="SELECT *, CAST(lo AS VARCHAR)||'_'||CAST(hi AS VARCHAR) AS range FROM l")


query("tree_bins_profile", _tree_profile_sql())(_tree_profile)
