"""Descriptive statistics and pre-processing."""
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.catalog import Catalog
from stayflow.operators import prep, screening as sc, stats as st
from stayflow.queries.registry import query
from stayflow.queries.views import corr, long_levels, long_numbers, pct2 as pct_sql, with_views
from stayflow.session import materialize_wide

NUMS = ["price", "acctbal_gap", "mostly_missing", "yr", "mon"]
CATS = ["priority", "segment", "nation"]
LN = f"ln AS ({long_numbers('v5', NUMS, 'chc_id, status, nation')})"


def r(df, places=6):
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


query("cat_distribution", with_views("v5", f"l AS ({long_levels('v5', CATS, 'chc_id, status')})", select="SELECT feature, status, level, count(DISTINCT chc_id) AS customers FROM l WHERE level IS NOT NULL GROUP BY ALL"))(
    lambda s, sf: st.level_distribution(fx.wide(s, sf), CATS)
)
MOMENTS = "round(avg(value),4) AS mean, round(stddev_samp(value),4) AS sd, min(value) AS min, max(value) AS max"
query("num_distribution", with_views("v5", LN, select=f"SELECT status, feature, {MOMENTS}, round(quantile_cont(value,0.5),4) AS median FROM ln GROUP BY ALL"))(
    lambda s, sf: r(st.number_summary(fx.wide(s, sf), NUMS, ["status"]), 4)
)
DESC = "count(value) AS n, " + MOMENTS + ", round(100.0*count(*) FILTER (value IS NULL)/count(*),4) AS missing_pct, " + ", ".join(f"round(quantile_cont(value,{p}),4) AS {n}" for n, p in st.DESCRIBE.items())
query("describe_percentiles", with_views("v5", LN, select=f"SELECT feature, {DESC} FROM ln GROUP BY feature"))(lambda s, sf: r(st.describe(fx.wide(s, sf), NUMS), 4))
query("missing_pct", with_views("v5", f"l AS ({long_levels('v5', ['price', 'acctbal_gap', 'mostly_missing', 'segment', 'priority'])})", select="SELECT feature, round(count(*) FILTER (level IS NULL)/count(*),6) AS missing_pct FROM l GROUP BY feature"))(
    lambda s, sf: r(st.missing_pct(fx.wide(s, sf), ["price", "acctbal_gap", "mostly_missing", "segment", "priority"]))
)

_POP = {"vol": "vol_pend_disco='Y'", "mover": "pending_mover='FALSE'"}
_POPNUMS = ["rev_m0", "rev_m1", "acctbal", "orders_6m"]


def _populations(s, sf):
    vol, mover = F.col("vol_pend_disco") == "Y", F.col("pending_mover") == "FALSE"
    pops = {"all": F.lit(True), "voluntary": vol, "false_mover": mover, "pool": F.coalesce(vol, F.lit(False)) | F.coalesce(mover, F.lit(False))}
    return r(st.describe(st.with_populations(fx.cust_month(s, sf), pops), _POPNUMS, ["population"]), 4)


query(
    "describe_by_population",
    with_views(
        "v1",
        f"p AS (SELECT 'all' AS population, * FROM v1 UNION ALL SELECT 'voluntary', * FROM v1 WHERE {_POP['vol']} UNION ALL SELECT 'false_mover', * FROM v1 WHERE {_POP['mover']} UNION ALL SELECT 'pool', * FROM v1 WHERE {_POP['vol']} OR {_POP['mover']})",
        f"ln AS ({long_numbers('p', _POPNUMS, 'population')})",
        select=f"SELECT population, feature, {DESC} FROM ln GROUP BY population, feature",
    ),
)(_populations)

_OUT = ["vol", "mover", "pool"]


def _level_outcomes(s, sf):
    vol, mover = F.coalesce(F.col("vol_pend_disco") == "Y", F.lit(False)), F.coalesce(F.col("pending_mover") == "FALSE", F.lit(False))
    df = fx.cust_month(s, sf).withColumns({"vol": vol.cast("int"), "mover": mover.cast("int"), "pool": (vol | mover).cast("int")})
    return st.level_outcomes(df, ["segment", "product", "area"], _OUT)


query(
    "level_outcome_table",
    with_views(
        "v1",
        "b AS (SELECT *, CASE WHEN vol_pend_disco='Y' THEN 1 ELSE 0 END AS vol, CASE WHEN pending_mover='FALSE' THEN 1 ELSE 0 END AS mover, CASE WHEN vol_pend_disco='Y' OR pending_mover='FALSE' THEN 1 ELSE 0 END AS pool FROM v1)",
        f"l AS ({long_levels('b', ['segment', 'product', 'area'], 'vol, mover, pool')})",
        "c AS (SELECT feature, coalesce(level,'None') AS level, count(*) AS customers, CAST(sum(vol) AS BIGINT) AS vol, CAST(sum(mover) AS BIGINT) AS mover, CAST(sum(pool) AS BIGINT) AS pool FROM l GROUP BY 1,2)",
        "t AS (SELECT feature, count(*) AS n_levels, " + ", ".join(f"sum({c}) AS t_{c}" for c in ["customers", *_OUT]) + " FROM c GROUP BY feature)",
        select="SELECT feature, level, n_levels, customers, vol, mover, pool, " + ", ".join(f"{pct_sql(c, 't_' + c)} AS {c}_share" for c in ["customers", *_OUT]) + ", "
        + ", ".join(f"{pct_sql(c, 'customers')} AS {c}_rate" for c in _OUT) + " FROM c JOIN t USING (feature)",
    ),
)(_level_outcomes)

query("nunique_all", with_views("v5", f"l AS ({long_levels('v5', NUMS + CATS + ['const_cat'])})", select="SELECT feature, count(DISTINCT level) AS n_unique FROM l GROUP BY feature"))(
    lambda s, sf: st.unique_counts(fx.wide(s, sf), NUMS + CATS + ["const_cat"])
)

# out-of-time check: earlier orders train, later ones test
TRAIN_TEST = "tr AS (SELECT * FROM v5 WHERE yr <= 1998), te AS (SELECT * FROM v5 WHERE yr > 1998)"


def split(s, sf):
    df = fx.wide(s, sf)
    return df.filter("yr <= 1998"), df.filter("yr > 1998")


def _rates_sql(ways: int) -> str:
    from itertools import combinations

    feats = ["priority", "segment", "mon"]
    parts = []
    for combo in combinations(feats, ways):
        cols = ", ".join(f"'{c}' AS feature{i + 1}, CAST({c} AS VARCHAR) AS level{i + 1}" for i, c in enumerate(combo))
        by = ", ".join(combo)
        parts.append((f"SELECT {cols}, count(*) AS n, sum(status) AS y FROM {{}} GROUP BY {by}"))
    keys = ", ".join(f"feature{i + 1}, level{i + 1}" for i in range(ways))
    a = " UNION ALL ".join(p.format("tr") for p in parts)
    b = " UNION ALL ".join(p.format("te") for p in parts)
    return with_views(
        "v5", TRAIN_TEST, f"a AS ({a})", f"b AS ({b})", "z AS (SELECT count(*) AS size FROM tr)",
        select=f"SELECT {keys}, a.n AS seg_count, {pct_sql('a.n', 'size')} AS seg_pct, {pct_sql('a.y', 'a.n')} AS rate_train, {pct_sql('b.y', 'b.n')} AS rate_test FROM a JOIN b USING ({keys}), z",
    )


for _w in (1, 2, 3):
    query(f"rate_{_w}way", _rates_sql(_w))(lambda s, sf, w=_w: st.outcome_rates(*split(s, sf), ["priority", "segment", "mon"], w))

query(
    "group_num_stats",
    with_views("v5", LN, select="SELECT nation AS grp, feature, count(value) AS count, round(avg(value),4) AS mean, max(value) AS max, min(value) AS min, round(stddev_samp(value),4) AS std, round(coalesce(sum(value),0),2) AS sum, round(quantile_cont(value,0.5),4) AS median FROM ln GROUP BY ALL"),
)(lambda s, sf: r(st.group_number_stats(fx.wide(s, sf), "nation", NUMS).withColumn("sum", F.round("sum", 2)), 4))
query(
    "group_level_share",
    with_views(
        "v5", f"l AS ({long_levels('v5', ['priority', 'segment'], 'nation AS grp')})",
        "c AS (SELECT grp, feature, level, count(*) AS n FROM l GROUP BY ALL)",
        "g AS (SELECT DISTINCT c.grp, c.feature, d.level FROM c JOIN (SELECT DISTINCT feature, level FROM c) d USING (feature))",
        select="SELECT g.grp, g.feature, g.level, round(coalesce(c.n,0)/sum(c.n) OVER (PARTITION BY g.grp, g.feature),6) AS share FROM g LEFT JOIN c USING (grp, feature, level)",
    ),
)(lambda s, sf: r(st.group_level_shares(fx.wide(s, sf), "nation", ["priority", "segment"])))

CNUMS = ["price", "price_x2", "price_dup", "acctbal_gap", "mostly_missing", "const_num", "yr", "mon"]


def corr_target_sql(cols, src="v5", y="status"):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {corr(f'CAST({c} AS DOUBLE)', y)} AS corr FROM {src}" for c in cols)


def pairs_sql(cols, src="v5"):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {corr(f'CAST({a} AS DOUBLE)', f'CAST({b} AS DOUBLE)')} AS corr FROM {src}" for i, a in enumerate(cols) for b in cols[i + 1 :]
    )


query(
    "target_correlation",
    with_views(
        "v5", TRAIN_TEST, f"a AS ({corr_target_sql(CNUMS, 'tr')})", f"b AS ({corr_target_sql(CNUMS, 'te')})",
        select="SELECT feature, round(a.corr,6) AS corr_train, round(b.corr,6) AS corr_test, row_number() OVER (ORDER BY abs(round(a.corr,9)) DESC NULLS LAST, feature) AS ranking_corr FROM a JOIN b USING (feature)",
    ),
)(lambda s, sf: r(sc.correlation_ranks(*split(s, sf), CNUMS)))
query("pairwise_correlation", with_views("v5", f"p AS ({pairs_sql(CNUMS)})", select="SELECT col_a, col_b, round(corr,6) AS corr FROM p"))(
    lambda s, sf: r(st.pair_correlations(fx.wide(s, sf), CNUMS))
)


# --- many columns: derived from the customers, with copies, multiples and gaps ---


def many_columns(k):
    """SQL of ``k`` number columns; of every ten three follow another one more or less closely."""
    out = []
    for i in range(k):
        base = f"CAST((c_custkey * {7919 + 104729 * (i // 10 * 10)} + {i // 10 * 31}) % {9973 + i // 10} AS DOUBLE)"
        own = f"CAST((c_custkey * {15485863 + 32452843 * i}) % {7919 + i} AS DOUBLE)"
        out.append({1: f"{base} * 2 + 3", 2: f"CASE WHEN c_custkey % 3 <> 0 THEN {base} END", 3: f"{base} + 0.9 * {own}", 4: f"0 - {base}"}.get(i % 10, base if i % 10 == 0 else own) + f" AS f{i:04d}")
    return ", ".join(out)


#: cells of the wide table that one task derives
CELLS = 40_000_000


def many(s, sf, k):
    """The customers fit in one small file, their columns do not: they are dealt to tasks first."""
    customers = fx.table(s, sf, "customer")
    n = customers.count()  # from the files' footers
    tasks = max(min(s.sparkContext.defaultParallelism, n * k // 1_000_000), -(-n * k // CELLS), 1)
    customers.repartition(tasks).createOrReplaceTempView("stayflow_many")
    return s.sql(f"SELECT c_custkey AS chc_id, CASE WHEN c_acctbal > 4500 THEN 1 ELSE 0 END AS status, {many_columns(k)} FROM stayflow_many")


_MANY = [f"f{i:04d}" for i in range(30)]
query(
    "pairwise_correlation_tiled",
    f"WITH w AS MATERIALIZED (SELECT {many_columns(30)} FROM customer), p AS ({pairs_sql(_MANY, 'w')}) SELECT col_a, col_b, round(corr,6) AS corr FROM p WHERE round(abs(corr),9) > 0.3",
)(lambda s, sf: r(st.pair_correlations(many(s, sf, 30), _MANY, least=0.3, tile=8)))
query("drop_correlated_1000")(lambda s, sf: prep.drop_correlated(materialize_wide(many(s, sf, 1000), "many"), 0.90, "status").report)

_T5 = ["price", "acctbal_gap", "yr", "mon", "mostly_missing", "status"]
query(
    "top5_correlated",
    with_views(
        "v5", f"p AS ({pairs_sql(_T5)})",
        "d AS (SELECT col_a AS feature, col_b AS partner, corr FROM p UNION ALL SELECT col_b, col_a, corr FROM p)",
        "k AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY abs(corr) DESC, partner) AS k FROM d WHERE corr IS NOT NULL)",
        select="SELECT feature, " + ", ".join(f"max(partner) FILTER (k={i}) AS feature_{i}, round(max(corr) FILTER (k={i}),6) AS corr_{i}" for i in range(1, 6)) + " FROM k WHERE k<=5 GROUP BY feature",
    ),
)(lambda s, sf: r(st.top_partners(st.pair_correlations(fx.wide(s, sf), _T5))))
_SUMCOLS = ["price", "acctbal_gap", "mostly_missing"]
query(
    "summarize_features",
    with_views(
        "v5", f"ln AS ({long_numbers('v5', _SUMCOLS, 'status')})",
        select=f"SELECT feature, count(value) AS n, {MOMENTS}, round(quantile_cont(value,0.25),4) AS p25, round(quantile_cont(value,0.5),4) AS p50, round(quantile_cont(value,0.75),4) AS p75, round(count(*) FILTER (value IS NULL)/count(*),4) AS missing_pct, round(avg(status) FILTER (value IS NOT NULL),4) AS rate FROM ln GROUP BY feature",
    ),
)(lambda s, sf: r(st.summarize_features(fx.wide(s, sf), _SUMCOLS, "status"), 4))

# --- pre-processing ---


def catalog(s, sf):
    """The wide view with two columns whose kind disagrees with their type."""
    made = Catalog.from_schema(fx.wide(s, sf))
    return Catalog({**made.kinds, "yr": "CAT", "mon_text": "NUM"}, {**made.defaults, "yr": "0", "mon_text": 0.0})


def mistyped(s, sf):
    text = F.when(F.col("mon") == 12, "n/a").when(F.col("mon") == 11, " ").otherwise(F.col("mon").cast("string"))
    return fx.wide(s, sf).withColumn("mon_text", text)


MIST = "m AS (SELECT *, CASE WHEN mon=12 THEN 'n/a' WHEN mon=11 THEN ' ' ELSE CAST(mon AS VARCHAR) END AS mon_text FROM v5)"
query("default_dtype", with_views("v5", MIST, select="SELECT chc_id, TRY_CAST(mon_text AS DOUBLE) AS mon_text, CAST(yr AS VARCHAR) AS yr, CASE WHEN trim(segment)<>'' THEN segment END AS segment, price FROM m"))(
    lambda s, sf: prep.use_default_types(mistyped(s, sf), catalog(s, sf)).select("chc_id", "mon_text", "yr", "segment", "price")
)
query(
    "dtype_report",
    with_views(
        "v5", MIST, "b AS (SELECT yr, CASE WHEN trim(mon_text)<>'' THEN mon_text END AS mt FROM m)",
        select="""SELECT 'mon_text' AS feature, 'NUM' AS default_dtype, 'string' AS actual_dtype, count(mt) AS n, count(TRY_CAST(mt AS DOUBLE)) AS n_convertible, count(DISTINCT mt) AS n_unique FROM b
UNION ALL SELECT 'yr', 'CAT', 'int', count(yr), count(yr), count(DISTINCT yr) FROM b""",
    ),
)(
    lambda s, sf: prep.dtype_report(mistyped(s, sf), catalog(s, sf))
)
FEATS = ["acctbal_gap", "const_cat", "const_num", "mon", "mostly_missing", "nation", "price", "price_dup", "price_x2", "priority", "priority_dup", "segment", "yr"]
MISS = f"ms AS (SELECT feature, count(*) FILTER (level IS NULL)/count(*) AS missing_pct, count(DISTINCT level) AS n_unique FROM ({long_levels('v5', FEATS)}) GROUP BY feature)"


def _applied(choice, df):
    """Counts of the non-null values in the columns a fitted choice keeps."""
    kept = choice.apply(df)
    return st.per_column(kept, kept.columns, {"n": F.count})


query("drop_missing", with_views("v5", MISS, select="SELECT feature, round(missing_pct,6) AS missing_pct, missing_pct > 0.99 AS dropped FROM ms"))(
    lambda s, sf: r(prep.drop_missing(fx.wide(s, sf)).report)
)
query("drop_constant", with_views("v5", MISS, f"k AS (SELECT feature, count(level) AS n FROM ({long_levels('v5', FEATS)}) GROUP BY feature)", select="SELECT feature, n FROM k WHERE feature NOT IN (SELECT feature FROM ms WHERE n_unique <= 1 AND missing_pct <= 0)"))(
    lambda s, sf: (lambda df: _applied(prep.drop_constant(df), df))(fx.wide(s, sf))
)
DROP = """o AS (SELECT feature, corr, row_number() OVER (ORDER BY abs(round(corr,9)) DESC NULLS LAST, feature) AS pos FROM ct),
h AS (SELECT b.feature AS drop_feature, a.feature AS corr_feature, p.corr AS pairwise_corr, b.corr AS corr_drop_target, a.corr AS corr_kept_target
  FROM o a JOIN o b ON a.pos < b.pos JOIN pr p ON (p.col_a=a.feature AND p.col_b=b.feature) OR (p.col_a=b.feature AND p.col_b=a.feature) WHERE round(abs(p.corr),9) > {t})"""
DROP_SELECT = "SELECT drop_feature, corr_feature, round(pairwise_corr,6) AS pairwise_corr, round(corr_drop_target,6) AS corr_drop_target, round(corr_kept_target,6) AS corr_kept_target FROM h"
query("drop_correlated", with_views("v5", f"ct AS ({corr_target_sql(CNUMS)})", f"pr AS ({pairs_sql(CNUMS)})", DROP.format(t=0.9), select=DROP_SELECT))(
    lambda s, sf: r(prep.drop_correlated(fx.wide(s, sf), 0.90, "status").report)
)
query(
    "drop_irrelevant_collinear",
    with_views("v5", f"ct0 AS ({corr_target_sql(CNUMS)})", "ct AS (SELECT * FROM ct0 WHERE abs(round(corr,9)) >= 0.005)", f"pr AS ({pairs_sql(CNUMS)})", DROP.format(t=0.9),
               select="SELECT feature, feature NOT IN (SELECT drop_feature FROM h) AND feature IN (SELECT feature FROM ct) AS kept FROM ct0"),
)(lambda s, sf: _kept(s, prep.drop_irrelevant_collinear(fx.wide(s, sf), 0.005, 0.90)))


def _kept(s, choice):
    return s.createDataFrame([(c, c in choice.kept) for c in CNUMS], "feature string, kept boolean")


_TYPED = [["acctbal_gap", "const_num", "mostly_missing", "price", "price_dup", "price_x2"], ["mon", "yr"], ["const_cat", "nation", "priority", "priority_dup", "segment"]]
query(
    "drop_duplicate_columns",
    with_views(
        "v5",
        select=" UNION ALL ".join(
            f"SELECT '{b}' AS drop_feature, '{a}' AS duplicate_feature FROM v5 HAVING bool_and({a} IS NOT DISTINCT FROM {b})" for g in _TYPED for i, a in enumerate(g) for b in g[i + 1 :]
        ),
    ),
)(
    lambda s, sf: prep.drop_duplicate_columns(fx.wide(s, sf), numbers=True).report
)


def _imputed(c):
    return f"coalesce({c}, 0)" if c in NUMS + ["const_num"] else f"coalesce(CASE WHEN trim({c})<>'' THEN {c} END, 'UNKNOWN')"


query("default_impute", with_views("v5", select=f"SELECT chc_id, status, {', '.join(f'{_imputed(c)} AS {c}' for c in ['price', 'acctbal_gap', 'mostly_missing', 'segment', 'priority', 'mon'])} FROM v5"))(
    lambda s, sf: prep.impute(fx.wide(s, sf), Catalog.from_schema(fx.wide(s, sf))).select("chc_id", "status", "price", "acctbal_gap", "mostly_missing", "segment", "priority", "mon")
)
_ISUM = ["acctbal_gap", "mostly_missing", "price", "segment"]


def _impute_summary(s, sf):
    df = fx.wide(s, sf).select("chc_id", "status", *_ISUM)
    return r(prep.impute_summary(df, Catalog.from_schema(df)), 4)


def _isum(c):
    text = c == "segment"
    before = "CASE WHEN trim(segment)<>'' THEN segment END" if text else c
    nums = f"round(avg({c}),4), round(stddev_samp({c}),4), round(avg(coalesce({c},0)),4), round(stddev_samp(coalesce({c},0)),4)" if not text else "NULL, NULL, NULL, NULL"
    return f"SELECT '{c}', '{'UNKNOWN' if text else '0.0'}', round(count(*) FILTER ({before} IS NULL)/count(*),4), 0.0::DOUBLE, {nums} FROM v5"


query(
    "impute_summary",
    with_views("v5", select="SELECT * FROM (" + " UNION ALL ".join(_isum(c) for c in _ISUM) + ") t(feature, default_value, missing_before, missing_after, mean_before, sd_before, mean_after, sd_after)"),
)(_impute_summary)


def _impute_dropna(s, sf):
    df = fx.wide(s, sf).select("chc_id", "segment", "acctbal_gap", "mostly_missing")
    partly = Catalog({}, {"segment": "UNKNOWN", "mostly_missing": 0.0})  # no default for the balance
    return prep.impute(df, partly).na.drop("any")


query("impute_dropna", with_views("v5", select="SELECT chc_id, CASE WHEN trim(segment)<>'' THEN segment ELSE 'UNKNOWN' END AS segment, acctbal_gap, coalesce(mostly_missing,0) AS mostly_missing FROM v5 WHERE acctbal_gap IS NOT NULL"))(
    _impute_dropna
)
_PD = ["price", "acctbal_gap", "const_num", "mon", "priority", "segment"]
_PRI, _SEG = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "UNKNOWN"]


def _process(s, sf):
    df = fx.wide(s, sf).select("chc_id", "status", *_PD)
    return prep.process_data(df, Catalog.from_schema(df))


query(
    "process_data",
    with_views(
        "v5", "i AS (SELECT *, CASE WHEN trim(segment)<>'' THEN segment ELSE 'UNKNOWN' END AS seg FROM v5)",
        select="SELECT chc_id, status, price, coalesce(acctbal_gap,0) AS acctbal_gap, CAST(mon AS DOUBLE) AS mon, "
        + ", ".join([f"CASE WHEN priority='{v}' THEN 1 ELSE 0 END AS \"priority_{v}\"" for v in _PRI] + [f"CASE WHEN seg='{v}' THEN 1 ELSE 0 END AS \"segment_{v}\"" for v in _SEG]) + " FROM i",
    ),
)(_process)
query("drop_zero_variance", with_views("v5", select=" UNION ALL ".join(f"SELECT '{c}' AS feature, var_samp({c}) = 0 AS dropped FROM v5" for c in ["price", "price_x2", "price_dup", "acctbal_gap", "mostly_missing", "const_num", "yr", "mon"])))(
    lambda s, sf: prep.drop_zero_variance(fx.wide(s, sf)).report.select("feature", "dropped")
)
query(
    "winsorize",
    with_views("v5", "q AS (SELECT quantile_cont(price,0.05) AS a, quantile_cont(price,0.95) AS b, quantile_cont(acctbal_gap,0.05) AS c, quantile_cont(acctbal_gap,0.95) AS d FROM v5)",
               select="SELECT chc_id, round(least(greatest(price,a),b),4) AS price, round(CASE WHEN acctbal_gap IS NOT NULL THEN greatest(0,least(greatest(acctbal_gap,c),d)) END,4) AS acctbal_gap FROM v5, q"),
)(
    lambda s, sf: (
        lambda df: df.select("chc_id", *[F.round(c, 4).alias(n) for n, c in prep.winsorize(df, ["price", "acctbal_gap"], 0.05, 0.95, True).items()])
    )(fx.wide(s, sf))
)
query(
    "preprocess_num",
    with_views("v5", "q AS (SELECT min(price) AS a, quantile_cont(price,0.995) AS b, min(acctbal_gap) AS c, quantile_cont(acctbal_gap,0.995) AS d, quantile_cont(CAST(mon AS DOUBLE),0.995) AS e FROM v5)",
               select="SELECT chc_id, round(greatest(0,least(greatest(price,a),b)),4) AS price, round(coalesce(CASE WHEN acctbal_gap IS NOT NULL THEN greatest(0,least(greatest(acctbal_gap,c),d)) END,0),4) AS acctbal_gap, round(least(CAST(mon AS DOUBLE),e),4) AS mon, CAST(status AS DOUBLE) AS flag_status FROM v5, q"),
)(
    lambda s, sf: r(
        prep.preprocess_numbers(fx.wide(s, sf).withColumnRenamed("status", "flag_status"), ["price", "acctbal_gap", "mon", "const_num", "flag_status"], negatives_to_zero=True), 4
    )
)


def _pipeline(s, sf):
    df = fx.wide(s, sf)
    cat = Catalog.from_schema(df)
    fitted = prep.fit_pipeline(df, cat)[()]
    return prep.run_pipeline(df, fitted, cat, ["chc_id", "status"])


def _fate(s, sf):
    df = fx.wide(s, sf)
    rows = prep.fit_pipeline(df, Catalog.from_schema(df))[()]
    return s.createDataFrame(rows, "feature string, fate string")


_FATE_NUMS = ["acctbal_gap", "const_num", "mon", "mostly_missing", "price", "price_dup", "price_x2", "yr"]
_FATE_TEXTS = ["const_cat", "nation", "priority", "priority_dup", "segment"]


def fate_sql(group, texts):
    """All eight stages decided from the values, for each level of ``group`` (a column or a constant)."""
    feats = _FATE_NUMS + texts
    raw = "r5 AS (SELECT *, " + f"{group} AS grp" + " FROM (SELECT * REPLACE (CASE WHEN trim(segment)<>'' THEN segment END AS segment) FROM v5))"
    full = "f5 AS (SELECT grp, status, " + ", ".join(f"coalesce({c}, {0 if c in _FATE_NUMS else "'UNKNOWN'"}) AS {c}" for c in feats) + " FROM r5)"

    def basic(name, src):
        rows = " UNION ALL ".join(f"SELECT grp, '{c}' AS feature, CAST({c} AS VARCHAR) AS level FROM {src}" for c in feats)
        return f"{name} AS MATERIALIZED (SELECT grp, feature, count(*) FILTER (level IS NULL)/count(*) AS missing, coalesce(min(level)=max(level), false) AS one FROM ({rows}) GROUP BY ALL)"

    def target(name, src):
        return f"{name} AS (" + " UNION ALL ".join(f"SELECT grp, '{c}' AS feature, {corr(f'CAST({c} AS DOUBLE)', 'status')} AS corr FROM {src} GROUP BY grp" for c in _FATE_NUMS) + ")"

    def pairs(name, src, least):
        body = " UNION ALL ".join(
            f"SELECT grp, '{a}' AS col_a, '{b}' AS col_b, {corr(f'CAST({a} AS DOUBLE)', f'CAST({b} AS DOUBLE)')} AS corr FROM {src} GROUP BY grp" for i, a in enumerate(_FATE_NUMS) for b in _FATE_NUMS[i + 1 :]
        )
        return f"{name} AS (SELECT * FROM ({body}) WHERE round(abs(corr),9) > {least})"

    def late(name, target, pairs, gone):
        return f"""o{name} AS MATERIALIZED (SELECT grp, feature, row_number() OVER (PARTITION BY grp ORDER BY abs(round(corr,9)) DESC NULLS LAST, feature) AS pos FROM {target} ANTI JOIN {gone} USING (grp, feature)),
{name} AS MATERIALIZED (SELECT DISTINCT b.grp, b.feature FROM o{name} a JOIN o{name} b ON a.grp=b.grp AND a.pos<b.pos JOIN {pairs} p ON p.grp=a.grp AND ((p.col_a=a.feature AND p.col_b=b.feature) OR (p.col_a=b.feature AND p.col_b=a.feature)))"""

    equal = " UNION ALL ".join(f"SELECT grp, '{b}' AS feature FROM r5 GROUP BY grp HAVING bool_and({a} IS NOT DISTINCT FROM {b})" for i, a in enumerate(texts) for b in texts[i + 1 :])
    return [
        raw, full, basic("b1", "r5"), basic("b2", "f5"), target("t1", "r5"), target("t2", "f5"), pairs("p1", "r5", 0.99), pairs("p2", "f5", 0.90),
        "g1 AS MATERIALIZED (SELECT grp, feature, CASE WHEN missing > 0.99 THEN 'missing' ELSE 'constant' END AS fate FROM b1 WHERE missing > 0.99 OR one AND missing <= 0)",
        late("c1", "t1", "p1", "g1"),
        f"e1 AS (SELECT DISTINCT * FROM ({equal}))",
        "g2 AS MATERIALIZED (SELECT * FROM g1 UNION ALL SELECT grp, feature, 'correlated' FROM c1 UNION ALL SELECT grp, feature, 'duplicate' FROM e1 ANTI JOIN g1 USING (grp, feature))",
        "g3 AS MATERIALIZED (SELECT * FROM g2 UNION ALL SELECT grp, feature, 'constant after imputing' FROM b2 ANTI JOIN g2 USING (grp, feature) WHERE one)",
        late("c2", "t2", "p2", "g3"),
        "fates AS (SELECT * FROM g3 UNION ALL SELECT grp, feature, 'correlated after imputing' FROM c2)",
    ]


query("preprocess_fate", with_views("v5", *fate_sql("'all'", _FATE_TEXTS), select="SELECT feature, coalesce(fate, 'kept') AS fate FROM b1 LEFT JOIN fates USING (grp, feature)"))(_fate)
query(
    "preprocess_pipeline",
    with_views("v5", select="SELECT chc_id, status, coalesce(acctbal_gap,0) AS acctbal_gap, mon, nation, price, priority, CASE WHEN trim(segment)<>'' THEN segment ELSE 'UNKNOWN' END AS segment, yr FROM v5"),
)(_pipeline)


def _by_market(s, sf):
    df = fx.wide(s, sf)
    return prep.fit_pipeline_by(df, Catalog.from_schema(df), ["nation"]).withColumnRenamed("nation", "market")


query(
    "preprocess_by_market",
    with_views("v5", *fate_sql("nation", [c for c in _FATE_TEXTS if c != "nation"]), select="SELECT grp AS market, feature, coalesce(fate, 'kept') AS fate FROM b1 LEFT JOIN fates USING (grp, feature)"),
)(_by_market)
_VIEWS = {"NUM": [], "CAT": ["priority", "segment"], "ALL": ["priority", "segment"]}


def _selection_views(s, sf):
    """The columns of each view, with the rows that are complete in them."""
    df = fx.wide(s, sf)
    cat, out = Catalog.from_schema(df), None
    for view in _VIEWS:
        made = prep.selection_view(df, cat, view, ["price", "acctbal_gap", "const_num", "priority", "segment", "const_cat", "unknown"])
        one = st.per_column(made, made.columns[2:], {"n": F.count, "total": lambda c: F.round(F.sum(c.cast("double")), 2)}).select(F.lit(view).alias("view"), "feature", "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


query(
    "selection_views",
    with_views(
        "v5", "i AS (SELECT price, coalesce(acctbal_gap, 0) AS acctbal_gap, priority, CASE WHEN trim(segment)<>'' THEN segment ELSE 'UNKNOWN' END AS segment FROM v5)",
        "n AS (SELECT 'price' AS feature, count(*) AS n, round(sum(price),2) AS total FROM i UNION ALL SELECT 'acctbal_gap', count(*), round(sum(acctbal_gap),2) FROM i)",
        "c AS (SELECT 'priority_'||priority AS feature, (SELECT count(*) FROM i) AS n, CAST(count(*) AS DOUBLE) AS total FROM i GROUP BY priority UNION ALL SELECT 'segment_'||segment, (SELECT count(*) FROM i), count(*) FROM i GROUP BY segment)",
        select="SELECT 'NUM' AS view, * FROM n UNION ALL SELECT 'CAT', * FROM c UNION ALL SELECT 'ALL', * FROM n UNION ALL SELECT 'ALL', * FROM c",
    ),
)(_selection_views)
