"""Categorical features and encoders."""
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.operators import categorical as ca, prep, sparse
from stayflow.queries.registry import query
from stayflow.queries.statistics import r
from stayflow.queries.views import corr, cut_sql, long_levels, long_numbers, with_views

# --- the sixteen grouping features over the snapshot ---

_G = f"""g AS (SELECT chc_id, dt, tenure AS kom_tenure, rev_m0/2000 AS revenue_m1, rev_m1/2000 AS revenue_m2, rev_m2/2000 AS revenue_m3,
  (rev_m0-rev_m1)/5000 AS chg, (rev_m0-rev_m1)/10000 AS chgp, rev_m0, rev_m1, rev_m2, rev_m3, orders_m0, orders_6m, segment FROM v1)"""
_MEANSQL = "(coalesce(revenue_m1,0)+coalesce(revenue_m2,0)+coalesce(revenue_m3,0))/(CASE WHEN revenue_m1 IS NULL THEN 0 ELSE 1 END+CASE WHEN revenue_m2 IS NULL THEN 0 ELSE 1 END+CASE WHEN revenue_m3 IS NULL THEN 0 ELSE 1 END)"
_INC = "CASE segment WHEN 'AUTOMOBILE' THEN 8000 WHEN 'BUILDING' THEN 43000 WHEN 'FURNITURE' THEN 113000 WHEN 'HOUSEHOLD' THEN 300000 WHEN 'MACHINERY' THEN 63000 END"
_SHARE = f"1200*({_MEANSQL})/({_INC})"


def _feature_maker_sql():
    c = {f"grp_tenure_{k}m": cut_sql("kom_tenure", *ca.step_bins(12, 96, k, "Months", "Under 12 Months")) for k in (3, 1, 6)}
    c["grp_payment_method"] = "CASE greatest(rev_m0,rev_m1,rev_m2,rev_m3) WHEN rev_m0 THEN 'AUTPAY' WHEN rev_m1 THEN 'CREDIT' WHEN rev_m2 THEN 'DEBIT' WHEN rev_m3 THEN 'CASH' END"
    for k in (25, 10):
        c[f"grp_payment_{k}dollar"] = cut_sql(_MEANSQL, *ca.payment_bins(k))
    c["grp_payment_change_5dollar"] = cut_sql("chg", *ca.change_bins(50, 5, "Dollars"))
    c["grp_payment_change_10dollar"] = cut_sql("chg", *ca.change_bins(50, 10, "Dollars", last=5))
    c["grp_payment_change_2pct"] = cut_sql("chgp", *ca.change_bins(20, 2, "Pct"))
    c["grp_payment_change_5pct"] = cut_sql("chgp", *ca.change_bins(30, 5, "Pct"))
    c["ratio_payment_income"] = f"round({_SHARE},9)"
    c["grp_payment_income"] = cut_sql(f"({_SHARE})", ca.INCOME_SHARE_EDGES, ca.INCOME_SHARE_LABELS)
    for n, col, wide in (("csc", "orders_6m", True), ("bill", "orders_m0", False), ("csr", "orders_m0+orders_6m", True), ("tsr", "orders_6m", False)):
        c[f"grp_call_{n}"] = cut_sql(f"({col})", *ca.call_bins(wide))
    return with_views("v1", _G, select="SELECT chc_id, dt, " + ", ".join(f"{v} AS {k}" for k, v in c.items()) + " FROM g")


_INCOME = {"AUTOMOBILE": "a.$1-$14,999", "BUILDING": "d.$35k-$49", "FURNITURE": "g.$100k-$124", "HOUSEHOLD": "l.$250k+", "MACHINERY": "UNKNOWN"}


def _feature_maker(s, sf):
    from stayflow.functions.columns import map_levels

    c = F.col
    df = fx.cust_month(s, sf).select(
        "chc_id", "dt", c("tenure").alias("kom_tenure"), *[(c(f"rev_m{k - 1}") / 2000).alias(f"revenue_m{k}") for k in (1, 2, 3)],
        ((c("rev_m0") - c("rev_m1")) / 5000).alias("chg"), ((c("rev_m0") - c("rev_m1")) / 10000).alias("chgp"),
        *[c(f"rev_m{i}").alias(f"{n}_pay") for i, n in enumerate(["autpay", "credit", "debit", "cash"])],
        map_levels(c("segment"), _INCOME).alias("income_demos"), "orders_m0", "orders_6m",
    )
    fitted = ca.make_group_features(
        methods=("autpay", "credit", "debit", "cash"), method_suffix="_pay", payments=("revenue_m1", "revenue_m2", "revenue_m3"), change="chg", change_pct="chgp",
        calls={"csc": (["orders_6m"], True), "bill": (["orders_m0"], False), "csr": (["orders_m0", "orders_6m"], True), "tsr": (["orders_6m"], False)},
    )
    return r(fitted.apply(df, ["chc_id", "dt"]), 9)


query("feature_maker", _feature_maker_sql())(_feature_maker)

# --- level reduction ---

LEVELS = ["priority", "segment", "nation"]


def _stats_cte(src="v5", cols=LEVELS, label="status"):
    return f"""lv AS ({long_levels(src, cols, label)}),
st AS (SELECT feature, level, count(*) AS n, count(*)/sum(count(*)) OVER (PARTITION BY feature) AS share, avg({label}) AS ym,
  row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, level) AS place, row_number() OVER (PARTITION BY feature ORDER BY avg({label}), level) - 1 AS rp
  FROM lv WHERE level IS NOT NULL GROUP BY feature, level)"""


def _nulled(df):
    """Blank segments read as missing, so the encoders meet missing levels too."""
    return prep.blanks_to_null(df)


V5N = "n5 AS (SELECT * REPLACE (CASE WHEN trim(segment)<>'' THEN segment END AS segment) FROM v5)"


def _mapped(value, default, suffix="", src="n5"):
    return ", ".join(f"coalesce((SELECT {value} FROM st WHERE st.feature='{c}' AND st.level=x.{c}{suffix}), {default.format(c=c)}) AS {c}" for c in LEVELS)


query("rare_category", with_views("v5", V5N, _stats_cte("n5"), "kp AS (SELECT * FROM st WHERE place <= 12 AND share >= 0.03)", select="SELECT chc_id, " + ", ".join(f"CASE WHEN x.{c} IN (SELECT level FROM kp WHERE feature='{c}') THEN x.{c} ELSE 'all_other' END AS {c}" for c in LEVELS) + " FROM n5 x"))(
    lambda s, sf: (lambda df: ca.reduce_rare(df, df, LEVELS, 0.03, 12).select("chc_id", *LEVELS))(_nulled(fx.wide(s, sf)))
)
query("rare_category_common", with_views("v5", V5N, _stats_cte("n5"), "kp AS (SELECT * FROM st WHERE place <= 4 AND share >= 0.03)", select="SELECT chc_id, " + ", ".join(f"CASE WHEN x.{c} IN (SELECT level FROM kp WHERE feature='{c}') THEN x.{c} ELSE (SELECT level FROM kp WHERE feature='{c}' AND place=1) END AS {c}" for c in LEVELS) + " FROM n5 x"))(
    lambda s, sf: (lambda df: ca.reduce_rare(df, df, LEVELS, 0.03, 4, "common").select("chc_id", *LEVELS))(_nulled(fx.wide(s, sf)))
)
query(
    "feature_interaction",
    with_views(
        "v5", V5N,
        select="""SELECT chc_id, coalesce(nation,'None')||'___'||coalesce(priority,'None') AS "NATION-priority", coalesce(nation,'None')||'___'||coalesce(segment,'None') AS "NATION-segment",
  coalesce(segment,'None')||'___'||coalesce(priority,'None') AS "SEGMENT-priority" FROM n5""",
    ),
)(lambda s, sf: ca.interactions(["segment", "nation"], ["nation", "segment", "priority"]).apply(_nulled(fx.wide(s, sf)), ["chc_id"]))
_SEG = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
query(
    "encode_ohe",
    with_views("v5", V5N, select="SELECT chc_id, " + ", ".join([f"CASE WHEN segment='{v}' THEN 1 ELSE 0 END AS \"segment_{v}\"" for v in _SEG] + [f"CASE WHEN priority='{v}' THEN 1 ELSE 0 END AS \"priority_{v}\"" for v in _PRI]) + " FROM n5"),
)(
    lambda s, sf: (
        lambda df: df.select("chc_id", *[c.alias(n) for n, c in prep.dummies(prep.level_lists(df, ["segment", "priority"])).items()])
    )(_nulled(fx.wide(s, sf)))
)

_FLOOR = "CASE WHEN {p} <= 0 THEN 0.00001 ELSE {p} END"
_ENC = {
    "pct": ("share", "0"), "count": ("CAST(n AS DOUBLE)", "0"), "ordinal": ("CAST(rp AS DOUBLE)", "0"), "y_mean": ("ym", "0"),
    "y_log_ratio": (f"ln(({_FLOOR.format(p='ym')})/({_FLOOR.format(p='(1-ym)')}))", "ln(0.00001/(1-0.00001))"),
    "y_ratio": (f"ym/({_FLOOR.format(p='(1-ym)')})", "0"),
}
_NAMES = {"pct": "encode_pct", "count": "encode_count", "ordinal": "encode_ordinal", "y_mean": "encode_y_mean", "y_log_ratio": "encode_log_ratio", "y_ratio": "encode_ratio"}
for _m, (_value, _default) in _ENC.items():
    # fitted on the earlier orders, applied to all
    query(
        _NAMES[_m],
        with_views(
            "v5", V5N, "tr AS (SELECT * FROM n5 WHERE yr <= 1996 AND nation <> 'NATION_7')", _stats_cte("tr"),
            *[f"e_{c} AS (SELECT level, {_value} AS code FROM st WHERE feature='{c}')" for c in LEVELS],
            select="SELECT chc_id, " + ", ".join(f"round(coalesce(e_{c}.code,{_default}),6)::DOUBLE AS {c}" for c in LEVELS) + " FROM n5 x " + " ".join(f"LEFT JOIN e_{c} ON e_{c}.level=x.{c}" for c in LEVELS),
        ),
    )(
        lambda s, sf, m=_m: (
            lambda df: r(ca.encode(df, df.filter("yr <= 1996 AND nation <> 'NATION_7'"), LEVELS, m, "status").select("chc_id", *LEVELS))
        )(_nulled(fx.wide(s, sf)))
    )

query(
    "clamp_levels",
    with_views("v5", V5N, "tr AS (SELECT * FROM n5 WHERE yr <= 1996 AND nation <> 'NATION_7')", select="SELECT chc_id, " + ", ".join(f"CASE WHEN x.{c} IN (SELECT {c} FROM tr WHERE {c} IS NOT NULL) THEN x.{c} ELSE 'ALL_OTHER' END AS {c}" for c in LEVELS) + " FROM n5 x"),
)(lambda s, sf: (lambda df: ca.clamp_levels(df, df.filter("yr <= 1996 AND nation <> 'NATION_7'"), LEVELS).select("chc_id", *LEVELS))(_nulled(fx.wide(s, sf))))

# --- group aggregates: kept features and their values ---

_GN, _GC = ["price", "acctbal_gap", "mon"], ["priority", "segment"]


def _group_sql():
    ln = f"ln AS ({long_numbers('v5', _GN, 'nation AS grp')})"
    stats = {"count": "CAST(count(value) AS DOUBLE)", "mean": "avg(value)", "median": "quantile_cont(value,0.5)", "max": "max(value)", "min": "min(value)", "std": "stddev_samp(value)", "sum": "sum(value)"}
    nums = " UNION ALL ".join(f"SELECT grp, 'NATION__*__'||feature||'__*__{k}' AS name, {v} AS value FROM ln GROUP BY grp, feature" for k, v in stats.items())
    lv = f"lvl AS ({long_levels('v5', _GC, 'nation AS grp')}), lc AS (SELECT grp, feature, level, count(*) AS n FROM lvl GROUP BY ALL)"
    grid = "lg AS (SELECT DISTINCT a.grp, b.feature, b.level FROM lc a JOIN (SELECT DISTINCT feature, level FROM lc) b USING (feature))"
    shares = "SELECT lg.grp, 'NATION__*__'||lg.feature||'__*__'||lg.level AS name, coalesce(lc.n,0)/sum(lc.n) OVER (PARTITION BY lg.grp, lg.feature) AS value FROM lg LEFT JOIN lc USING (grp, feature, level)"
    # joined back to the rows and correlated there, the long way round
    return [ln, lv, grid, f"ag AS MATERIALIZED ({nums} UNION ALL {shares})", f"cr AS MATERIALIZED (SELECT name, {corr('value', 'status')} AS corr FROM v5 JOIN ag ON ag.grp=v5.nation GROUP BY name)"]


query("group_aggregate_features_choice", with_views("v5", *_group_sql(), select="SELECT name, round(corr,6) AS corr FROM cr"))(
    lambda s, sf: (
        lambda df: r(ca.group_feature_correlation(ca.group_aggregates(df, "nation", _GN, _GC), df, "nation").select("name", "corr"))
    )(fx.wide(s, sf))
)
query(
    "group_aggregate_features",
    with_views(
        "v5", *_group_sql(),
        "kept AS (SELECT name FROM cr WHERE abs(corr) >= 0.01)",
        select="SELECT chc_id, name, round(coalesce(value,0),4) AS value FROM v5 JOIN ag ON ag.grp=v5.nation JOIN kept USING (name)",
    ),
)(lambda s, sf: _group_features(fx.wide(s, sf)))


def _group_features(df):
    fitted = ca.fit_group_features(df, ["nation"], _GN, _GC)
    return ca.group_feature_cells(df, fitted, ["chc_id"]).withColumn("value", F.round("value", 4))


# --- the whole categorical pipeline, in long form ---

_LEVEL_CTES = [
    "s0 AS (SELECT feature, level, count(*)/sum(count(*)) OVER (PARTITION BY feature) AS share, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, level) AS place FROM l0 WHERE level IS NOT NULL GROUP BY feature, level)",
    "lr AS (SELECT chc_id, status, l0.feature, CASE WHEN s0.level IS NOT NULL THEN l0.level ELSE 'all_other' END AS level FROM l0 LEFT JOIN s0 ON s0.feature=l0.feature AND s0.level=l0.level AND s0.place<=30 AND s0.share>=0.01)",
    """st AS (SELECT feature, level, count(*) AS n, sum(status) AS y, count(*)/sum(count(*)) OVER (PARTITION BY feature) AS share, avg(status) AS ym,
  row_number() OVER (PARTITION BY feature ORDER BY avg(status), level) - 1 AS rp FROM lr GROUP BY feature, level)""",
]
_PIPE_SQL = with_views(
    "v5", V5N,
    "i5 AS (SELECT *, coalesce(segment,'None')||'___'||coalesce(priority,'None') AS inter FROM n5)",
    f"l0 AS ({long_levels('i5', ['inter', 'nation', 'priority', 'segment'], 'chc_id, status')})",
    *_LEVEL_CTES,
    "en AS (" + " UNION ALL ".join(f"SELECT '{m.upper()}_'||feature AS name, n, y, CAST({v} AS DOUBLE) AS v FROM st" for m, (v, _) in _ENC.items()) + ")",
    "m AS (SELECT name, sum(n*v)/sum(n) AS mean FROM en GROUP BY name)",
    select="SELECT en.name, round(sum((v-mean)*y)/nullif(sqrt(sum(n*(v-mean)*(v-mean))*(sum(y)-sum(y)*sum(y)/CAST(sum(n) AS DOUBLE))),0),6) AS corr FROM en JOIN m USING (name) GROUP BY en.name",
)


def _categorical_stats(s, sf):
    df = _nulled(fx.wide(s, sf))
    inter = ca.interactions(["segment"], ["segment", "priority"]).outputs["SEGMENT-priority"]
    return r(ca.encoder_correlations(df.withColumn("inter", inter), ["inter", "nation", "priority", "segment"], "status").select("name", "corr"))


query("categorical_pipeline_stats", _PIPE_SQL)(_categorical_stats)


def _choice_sql():
    """Every output of encoders and one-hot for every row; the pair rule in each branch, then over all."""
    codes = " UNION ALL ".join(f"SELECT feature, level, '{m.upper()}_'||feature AS name, '{m}' AS branch, CAST({v} AS DOUBLE) AS v FROM st" for m, (v, _) in _ENC.items())
    hot = "SELECT a.feature, a.level, b.feature||'_'||b.level AS name, 'one_hot' AS branch, CASE WHEN a.level=b.level THEN 1.0 ELSE 0.0 END AS v FROM st a JOIN st b USING (feature)"
    return with_views(
        "v5", V5N,
        "i5 AS (SELECT *, coalesce(segment,'None')||'___'||coalesce(priority,'None') AS \"SEGMENT-priority\" FROM n5)",
        "l0 AS (" + " UNION ALL ".join(f"SELECT chc_id, status, '{c}' AS feature, CAST(\"{c}\" AS VARCHAR) AS level FROM i5" for c in ("SEGMENT-priority", "nation", "priority", "segment")) + ")",
        *_LEVEL_CTES,
        f"en AS ({codes} UNION ALL {hot})",
        "x AS MATERIALIZED (SELECT lr.chc_id, lr.status, en.name, en.branch, en.v FROM lr JOIN en ON en.feature=lr.feature AND en.level=lr.level)",
        f"ct AS (SELECT name, branch, {corr('v', 'status')} AS corr FROM x GROUP BY ALL)",
        "o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY abs(round(corr,9)) DESC NULLS LAST, name) AS pos FROM ct WHERE round(abs(corr),9) >= 0.005)",
        "z AS (SELECT x.chc_id, x.v, o.* FROM x JOIN o USING (name))",
        f"pp AS MATERIALIZED (SELECT b.name, a.name AS early, a.branch=b.branch AS same FROM z a JOIN z b ON a.chc_id=b.chc_id AND a.pos<b.pos GROUP BY ALL HAVING round(abs({corr('a.v', 'b.v')}),9) > 0.9)",
        "s1 AS (SELECT name FROM o WHERE name NOT IN (SELECT name FROM pp WHERE same))",
        select="SELECT name AS feature FROM s1 WHERE name NOT IN (SELECT name FROM pp WHERE early IN (SELECT name FROM s1))",
    )


def _categorical_choice(s, sf):
    df = _nulled(fx.wide(s, sf))
    out = ca.categorical_pipeline(df, df, ["segment"], ["segment", "priority"], ["nation", "priority", "segment"], tree_folds=0)
    return s.createDataFrame([(n,) for n in out.columns[2:]], "feature string")


query("categorical_pipeline_choice", _choice_sql())(_categorical_choice)


# --- the same as sparse vectors, and levels without number ---


def _named_cells(vectors, names):
    """(chc_id, name, value) of the non-zero slots of a vector column."""
    v = F.unwrap_udt("features")
    cells = vectors.select("chc_id", F.inline(F.arrays_zip(v["indices"].alias("slot"), v["values"].alias("value"))))
    return cells.join(names.select("slot", "name"), "slot").select("chc_id", "name", F.round("value", 6).alias("value"))


def _sparse_pipeline(s, sf):
    df = _nulled(fx.wide(s, sf))
    return sparse.categorical_pipeline(df, ["segment"], ["segment", "priority"], ["nation", "priority", "segment"])


query("categorical_sparse_choice", _choice_sql())(lambda s, sf: _sparse_pipeline(s, sf)[1].select(F.col("name").alias("feature")))
query(
    "categorical_sparse_rows",
    _choice_sql().replace("SELECT name AS feature FROM s1 WHERE", "SELECT x.chc_id, x.name, round(x.v,6) AS value FROM x WHERE x.v <> 0 AND name IN (SELECT name FROM s1) AND"),
)(lambda s, sf: _named_cells(*_sparse_pipeline(s, sf)))


def _many_levels(s, sf):
    """A text column with a level for every order, a copy, and one with two levels."""
    df = _nulled(fx.wide(s, sf)).withColumns({"half": F.when(F.col("mon") <= 6, "H1").otherwise("H2"), "order_text": F.col("chc_id").cast("string")})
    return r(sparse.one_hot_choice(df, _MANY_LEVELS))


_MANY_LEVELS = ["half", "nation", "order_text", "priority", "priority_dup", "segment"]
query(
    "one_hot_sparse_choice",
    with_views(
        "v5", V5N, "i5 AS (SELECT *, CASE WHEN mon <= 6 THEN 'H1' ELSE 'H2' END AS half, CAST(chc_id AS VARCHAR) AS order_text FROM n5)",
        f"l AS MATERIALIZED (SELECT * FROM ({long_levels('i5', _MANY_LEVELS, 'chc_id, status')}) WHERE level IS NOT NULL)",
        "t AS (SELECT CAST(count(*) AS DOUBLE) AS t, CAST(sum(status) AS DOUBLE) AS ones FROM v5)",
        "c AS (SELECT feature, level, CAST(count(*) AS DOUBLE) AS n, CAST(sum(status) AS DOUBLE) AS y FROM l GROUP BY ALL)",
        "o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY abs(round(corr,9)) DESC, feature, level) AS pos FROM (SELECT c.*, t, (t*y-n*ones)/nullif(sqrt(n*(t-n))*sqrt(ones*(t-ones)),0) AS corr FROM c, t) WHERE abs(round(corr,9)) >= 0.005)",
        "m AS (SELECT a.pos AS pa, b.pos AS pb, any_value(a.n) AS na, any_value(b.n) AS nb, any_value(a.t) AS t, CAST(count(*) AS DOUBLE) AS n FROM l x JOIN l y ON x.chc_id=y.chc_id AND x.feature<>y.feature JOIN o a ON a.feature=x.feature AND a.level=x.level JOIN o b ON b.feature=y.feature AND b.level=y.level WHERE a.pos<b.pos GROUP BY a.pos, b.pos)",
        # levels that never meet: only beside one with a good part of the rows
        "z AS (SELECT least(a.pos,b.pos) AS pa, greatest(a.pos,b.pos) AS pb, a.n AS na, b.n AS nb, a.t, 0.0 AS n FROM o a JOIN o b ON a.pos<>b.pos WHERE a.n > 0.4*a.t AND (least(a.pos,b.pos), greatest(a.pos,b.pos)) NOT IN (SELECT (pa, pb) FROM m))",
        "late AS (SELECT DISTINCT pb FROM (SELECT * FROM m UNION ALL SELECT * FROM z) WHERE round(abs((t*n-na*nb)/(sqrt(na*(t-na))*sqrt(nb*(t-nb)))),9) > 0.9)",
        select="SELECT feature, level, CAST(n AS BIGINT) AS n, round(corr,6) AS corr FROM o WHERE pos NOT IN (SELECT pb FROM late)",
    ),
)(_many_levels)


def _process_sparse(s, sf):
    from stayflow.catalog import Catalog

    df = fx.wide(s, sf).select("chc_id", "status", "price", "acctbal_gap", "const_num", "mon", "priority", "segment", F.col("chc_id").cast("string").alias("order_text"))
    return _named_cells(*sparse.process_sparse(df, Catalog.from_schema(df)))


query(
    "process_data_sparse",
    with_views(
        "v5", "i AS (SELECT *, CASE WHEN trim(segment)<>'' THEN segment ELSE 'UNKNOWN' END AS seg FROM v5)",
        select="""SELECT chc_id, 'price' AS name, price AS value FROM i WHERE price <> 0 UNION ALL SELECT chc_id, 'acctbal_gap', round(acctbal_gap,6) FROM i WHERE acctbal_gap <> 0
UNION ALL SELECT chc_id, 'mon', CAST(mon AS DOUBLE) FROM i UNION ALL SELECT chc_id, 'priority_'||priority, 1.0 FROM i UNION ALL SELECT chc_id, 'segment_'||seg, 1.0 FROM i
UNION ALL SELECT chc_id, 'order_text_'||CAST(chc_id AS VARCHAR), 1.0 FROM i""",
    ),
)(_process_sparse)

query("categorical_pipeline")(
    lambda s, sf: (
        lambda df: ca.categorical_pipeline(
            df, df, ["segment"], ["segment", "priority"], ["nation", "priority", "segment"], groups=["nation"], numbers=["price", "acctbal_gap", "mon"]
        )
    )(_nulled(fx.wide(s, sf)))
)
