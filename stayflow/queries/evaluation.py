"""Evaluation, conversion reports and delivery."""
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.operators import evaluate as ev
from stayflow.plans import delivery as de, reports as re_
from stayflow.queries.registry import query
from stayflow.queries.views import with_views
from stayflow.session import materialize, new_folder

PROB = ev.PROB


def _r(df, places=6, skip=()):
    """Doubles rounded so that the last bits of a sum do not matter."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


FLIP = f"f AS (SELECT chc_id, original_labels, predicted_label, CASE WHEN predicted_label=0 THEN 1-{PROB} ELSE {PROB} END AS p FROM v2)"
CONF = """c AS (SELECT count(*) FILTER (original_labels=1 AND predicted_label=1) AS tp, count(*) FILTER (original_labels=0 AND predicted_label=0) AS tn,
  count(*) FILTER (original_labels=0 AND predicted_label=1) AS fp, count(*) FILTER (original_labels=1 AND predicted_label=0) AS fn FROM v2)"""
RATES = """round(tp/(tp+fn),6) AS tpr, round(tn/(tn+fp),6) AS tnr, round(fp/(tn+fp),6) AS fpr, round((tp+tn)/(tp+tn+fp+fn),6) AS accuracy,
  round((tp/(tp+fn)+tn/(tn+fp))/2,6) AS balanced_accuracy"""
CLASS = """round(p1,6) AS precision_1, round(r1,6) AS recall_1, round(f1,6) AS f1_1, round(p0,6) AS precision_0, round(r0,6) AS recall_0, round(f0,6) AS f1_0,
  round((p1*n1+p0*n0)/(n1+n0),6) AS precision_weighted, round((r1*n1+r0*n0)/(n1+n0),6) AS recall_weighted, round((f1*n1+f0*n0)/(n1+n0),6) AS f1_weighted, round(mcc,6) AS mcc"""
CLASS_CTE = """k AS (SELECT *, tp/(tp+fp) AS p1, tp/(tp+fn) AS r1, tn/(tn+fn) AS p0, tn/(tn+fp) AS r0, 2*tp/(2*tp+fp+fn) AS f1, 2*tn/(2*tn+fp+fn) AS f0,
  tp+fn AS n1, tn+fp AS n0, (CAST(tp AS DOUBLE)*tn-CAST(fp AS DOUBLE)*fn)/(sqrt(tp+fp)*sqrt(tp+fn)*sqrt(tn+fp)*sqrt(tn+fn)) AS mcc FROM c)"""

query("flip_probability", with_views("v2", FLIP, select="SELECT chc_id, round(p, 9) AS p FROM f"))(
    lambda s, sf: ev.flip_probability(fx.scored(s, sf)).select("chc_id", F.round(PROB, 9).alias("p"))
)
query("confusion_metrics", with_views("v2", CONF, select=f"SELECT tp, tn, fp, fn, {RATES} FROM c"))(
    lambda s, sf: _r(ev.rates(ev.confusion(fx.scored(s, sf))))
)
query("class_metrics", with_views("v2", CONF, CLASS_CTE, select=f"SELECT {CLASS} FROM k"))(
    lambda s, sf: _r(ev.class_metrics(ev.confusion(fx.scored(s, sf))))
)

AUC = """g AS (SELECT p, count(*) FILTER (original_labels=1) AS pos, count(*) FILTER (original_labels=0) AS neg FROM f GROUP BY p),
a AS (SELECT *, sum(neg) OVER (ORDER BY p) - neg AS below FROM g)"""

query("roc_auc", with_views("v2", FLIP, AUC, select="SELECT round(sum(pos*(below+neg/2.0))/(CAST(sum(pos) AS DOUBLE)*sum(neg)),6) AS auc FROM a"))(
    lambda s, sf: _r(ev.roc_auc(ev.flip_probability(fx.scored(s, sf))))
)

CURVE = """g AS (SELECT p AS score, count(*) FILTER (original_labels=1) AS pos, count(*) FILTER (original_labels=0) AS neg FROM f GROUP BY p),
t AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM g WINDOW w AS (ORDER BY score DESC))"""
query("roc_points", with_views("v2", FLIP, CURVE, select="SELECT round(score,9) AS score, round(CAST(fp AS DOUBLE)/nn,6) AS fpr, round(CAST(tp AS DOUBLE)/np,6) AS tpr FROM t"))(
    lambda s, sf: _r(ev.roc_points(ev.flip_probability(fx.scored(s, sf))), skip=["score"]).withColumn("score", F.round("score", 9))
)
query("pr_points", with_views("v2", FLIP, CURVE, select="SELECT round(score,9) AS score, round(CAST(tp AS DOUBLE)/(tp+fp),6) AS precision, round(CAST(tp AS DOUBLE)/np,6) AS recall FROM t"))(
    lambda s, sf: _r(ev.pr_points(ev.flip_probability(fx.scored(s, sf))), skip=["score"]).withColumn("score", F.round("score", 9))
)

THRESHOLDS = [0.55, 0.56, 0.57, 0.58, 0.59]
query(
    "threshold_sweep",
    with_views(
        "v2", FLIP,
        """c AS (SELECT threshold, count(*) FILTER (original_labels=1 AND p>=threshold) AS tp, count(*) FILTER (original_labels=0 AND p<threshold) AS tn,
  count(*) FILTER (original_labels=0 AND p>=threshold) AS fp, count(*) FILTER (original_labels=1 AND p<threshold) AS fn
  FROM f, (SELECT CAST(unnest([0.55,0.56,0.57,0.58,0.59]) AS DOUBLE) AS threshold) GROUP BY threshold)""",
        select=f"SELECT threshold, tp, tn, fp, fn, {RATES} FROM c",
    ),
)(lambda s, sf: _r(ev.threshold_sweep(ev.flip_probability(fx.scored(s, sf)), THRESHOLDS)))


def qcut_sql(src: str, p: str, out: str) -> str:
    """CTEs that add ``decile`` to ``src`` by distinct quantile edges."""
    return f"""{out}_q AS (SELECT quantile_cont(CAST({p} AS DOUBLE), [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) AS e FROM {src}),
{out}_e AS (SELECT list_sort(list_distinct(e))[2:-2] AS inner_edges FROM {out}_q),
{out} AS (SELECT s.*, CAST(1 + len(list_filter(inner_edges, lambda x: x < s.{p})) AS INT) AS decile FROM {src} s, {out}_e)"""


LIFT = """b AS (SELECT decile, min(p) AS min_prob, max(p) AS max_prob, CAST(sum(original_labels) AS BIGINT) AS count_leavers, count(*) AS count_subs FROM {src} GROUP BY decile),
w AS (SELECT *, sum(count_leavers) OVER o AS cc, sum(count_subs) OVER o AS cs, sum(count_leavers) OVER () AS c, sum(count_subs) OVER () AS n FROM b WINDOW o AS (ORDER BY max_prob DESC))"""
LIFT_SELECT = """SELECT decile, round(min_prob,6) AS min_prob, round(max_prob,6) AS max_prob, count_leavers, count_subs, CAST(cc AS BIGINT) AS cumu_leavers, CAST(cs AS BIGINT) AS cumu_subs,
  round(100.0*count_leavers/count_subs,6) AS conv_3m, round(CAST(100.0*c/n AS DOUBLE),6) AS avg_leaver_rate,
  round(CAST(count_leavers AS DOUBLE)/count_subs/(CAST(c AS DOUBLE)/n),6) AS lift, round(100.0*CAST(cc AS DOUBLE)/c,6) AS gain,
  round(100.0*CAST(cs AS DOUBLE)/n,6) AS cumu_subs_pct, round(CAST(cc AS DOUBLE)/c/(CAST(cs AS DOUBLE)/n),6) AS cumu_lift FROM w"""

query("lift_gain", with_views("v2", FLIP, qcut_sql("f", "p", "d"), LIFT.format(src="d"), select=LIFT_SELECT))(
    lambda s, sf: _r(ev.lift_all(fx.scored(s, sf)))
)
query(
    "lift_top_decile",
    with_views(
        "v2", FLIP, qcut_sql("f", "p", "d"), "top AS (SELECT chc_id, original_labels, p FROM d WHERE decile = 10)", qcut_sql("top", "p", "dd"),
        LIFT.format(src="dd"), select=LIFT_SELECT,
    ),
)(lambda s, sf: _r(ev.lift_top_decile(materialize(fx.scored(s, sf), "scored"))))
query(
    "lift_top_n",
    with_views(
        "v2", f"t AS (SELECT chc_id, original_labels, {PROB} AS p FROM v2 WHERE predicted_label=1 ORDER BY {PROB} DESC, chc_id LIMIT 10000)",
        qcut_sql("t", "p", "d"), "a AS (SELECT avg(original_labels) AS base FROM v2)",
        select="""SELECT decile, round(min(p),6) AS min_prob, round(max(p),6) AS max_prob, round(avg(original_labels),6) AS conv_3m, count(*) AS count_subs,
  round(any_value(base),6) AS avg_leaver_rate, round(avg(original_labels)/any_value(base),6) AS lift FROM d, a GROUP BY decile""",
    ),
)(lambda s, sf: _r(ev.lift_top_n(fx.scored(s, sf))))
query("qcut_decile", with_views("v2", qcut_sql("v2", PROB, "d"), select="SELECT chc_id, decile FROM d"))(
    lambda s, sf: ev.with_decile(fx.scored(s, sf)).select("chc_id", "decile")
)

RANK = "r AS (SELECT *, row_number() OVER (ORDER BY p DESC, chc_id) AS rn, count(*) OVER () AS n FROM f)"
query("percentile_rank_bucket", with_views("v2", FLIP, RANK, select="SELECT chc_id, CAST((rn-1)*100//n+1 AS INT) AS Rank, CAST(((rn-1)*10//n)*10+10 AS INT) AS ten, CAST(((rn-1)*20//n)*5+5 AS INT) AS five FROM r"))(
    lambda s, sf: _rank_buckets(ev.flip_probability(fx.scored(s, sf)).select("chc_id", PROB))
)


def _rank_buckets(df):
    from stayflow.operators.ordered import rank_slice

    r, n = F.col("rank_no"), F.col("n")
    return ev.with_rank(df, PROB).select(
        "chc_id", rank_slice(r, n, 100).alias("Rank"), (rank_slice(r, n, 10) * 10).alias("ten"), (rank_slice(r, n, 20) * 5).alias("five")
    )


def slices_sql(k: int, out: str) -> str:
    return f"""{out}_s AS (SELECT CAST((rn*{k}-1)//(n+1) AS INT) AS slice, original_labels AS y FROM r),
{out}_b AS (SELECT slice, count(*) AS subs, CAST(sum(y) AS BIGINT) AS leavers FROM {out}_s GROUP BY slice),
{out} AS (SELECT slice, CAST(slice*{100 // k} AS VARCHAR)||'% - '||CAST((slice+1)*{100 // k} AS VARCHAR)||'%' AS bucket, subs, leavers,
  round((CAST(leavers AS DOUBLE)/subs)/(sum(leavers) OVER ()/CAST(sum(subs) OVER () AS DOUBLE)),6) AS lift, round(CAST(leavers AS DOUBLE)/sum(leavers) OVER (),6) AS leaver_share FROM {out}_b)"""


for _k in (10, 20, 100):
    query(f"lift_slices_{_k}", with_views("v2", FLIP, RANK, slices_sql(_k, "z"), select="SELECT * FROM z"))(
        lambda s, sf, k=_k: _r(ev.lift_slices(ev.flip_probability(fx.scored(s, sf)), k))
    )
query("lift_stitched", with_views("v2", FLIP, RANK, slices_sql(20, "a"), slices_sql(10, "b"), select="SELECT * FROM a WHERE slice < 4 UNION ALL SELECT * FROM b WHERE slice >= 2"))(
    lambda s, sf: _r(ev.lift_stitched(ev.flip_probability(fx.scored(s, sf))))
)


def _splits_sql():
    # two splits by the predicted label stand for train and test
    parts, joins = [], []
    for name, cond in (("0", "predicted_label=0"), ("1", "predicted_label=1"), ("all", "1=1")):
        t = f"x{name}"
        parts.append(f"{t}_r AS (SELECT *, row_number() OVER (ORDER BY p DESC, chc_id) AS rn, count(*) OVER () AS n FROM f WHERE {cond})")
        parts.append(slices_sql(20, f"{t}_a").replace("FROM r)", f"FROM {t}_r)"))
        parts.append(slices_sql(10, f"{t}_b").replace("FROM r)", f"FROM {t}_r)"))
        parts.append(f"{t} AS (SELECT bucket, lift AS \"{name}_lift\", leavers AS \"{name}_leavers\", leaver_share AS \"{name}_share\" FROM (SELECT * FROM {t}_a WHERE slice<4 UNION ALL SELECT * FROM {t}_b WHERE slice>=2))")
        joins.append(t)
    return with_views("v2", FLIP, *parts, select=f"SELECT * FROM (SELECT unnest({list(ev.STITCHED)}) AS bucket) LEFT JOIN {joins[0]} USING (bucket) LEFT JOIN {joins[1]} USING (bucket) LEFT JOIN {joins[2]} USING (bucket)")


query("lift_stitched_splits", _splits_sql())(
    lambda s, sf: _r(ev.stitched_splits(materialize(ev.flip_probability(fx.scored(s, sf)).withColumn("split", F.col("predicted_label").cast("string")), "scored"), "split"))
)

# --- conversion reports ---

BASE = 200003
MONTHS6 = "(200004,200005,200006,200007,200008,200009)"
PENDING = "(pending_drform='VOLUNTARY' OR pending_mover='FALSE')"
LEFT = "drform = 'LAPSED'"  # the stand-in snapshot knows no other leaving status
BAND = f"CASE WHEN {PROB}<0.6 THEN 'GTE_0.5 and LT_0.6' WHEN {PROB}<0.7 THEN 'GTE_0.6 and LT_0.7' WHEN {PROB}<0.8 THEN 'GTE_0.7 and LT_0.8' WHEN {PROB}<0.9 THEN 'GTE_0.8 and LT_0.9' ELSE 'GTE_0.9' END"
CALLED = f"p AS (SELECT chc_id, {PROB}, {BAND} AS band FROM v2 WHERE predicted_label=1)"
COUNTS = f"""bc AS (SELECT band, count(*) AS hh_count FROM p GROUP BY band UNION ALL SELECT 'GTE_0.7', count(*) FROM p WHERE {PROB}>=0.7 HAVING count(*)>0
  UNION ALL SELECT 'GTE_0.8', count(*) FROM p WHERE {PROB}>=0.8 HAVING count(*)>0)"""
DATES = f"""pd AS (SELECT chc_id, min(dt) AS month FROM v1 WHERE {PENDING} AND dt IN {MONTHS6} GROUP BY 1),
vd AS (SELECT chc_id, min(dt) AS month FROM v1 WHERE {LEFT} AND dt IN {MONTHS6} GROUP BY 1)"""
MONTHLY = f"""mo AS (SELECT band, 'Pending Disconnect' AS kind, month, count(*) AS hh_count FROM p JOIN pd USING (chc_id) GROUP BY ALL
  UNION ALL SELECT band, 'Voluntary Disconnect', month, count(*) FROM p JOIN vd USING (chc_id) GROUP BY ALL
  UNION ALL SELECT 'GTE_0.7', 'Pending Disconnect', month, count(*) FROM p JOIN pd USING (chc_id) WHERE {PROB}>=0.7 GROUP BY ALL
  UNION ALL SELECT 'GTE_0.8', 'Pending Disconnect', month, count(*) FROM p JOIN pd USING (chc_id) WHERE {PROB}>=0.8 GROUP BY ALL)"""
GRID = """g AS (SELECT band, kind, CAST(200003+k AS INT) AS month, CAST(k AS INT) AS month_no FROM
  (SELECT 'Pending Disconnect' AS kind, unnest(['GTE_0.5 and LT_0.6','GTE_0.6 and LT_0.7','GTE_0.7 and LT_0.8','GTE_0.8 and LT_0.9','GTE_0.9','GTE_0.7','GTE_0.8']) AS band
   UNION ALL SELECT 'Voluntary Disconnect', unnest(['GTE_0.5 and LT_0.6','GTE_0.6 and LT_0.7','GTE_0.7 and LT_0.8','GTE_0.8 and LT_0.9','GTE_0.9'])), (SELECT unnest([1,2,3,4,5,6]) AS k)),
gg AS (SELECT g.*, coalesce(hh_count,0) AS hh_count FROM g LEFT JOIN mo USING (band, kind, month))"""
SUMS = "sm AS (SELECT band, kind, CAST(sum(hh_count) FILTER (month IN (200004,200005,200006)) AS BIGINT) AS conv_3m, CAST(sum(hh_count) AS BIGINT) AS conv_6m FROM mo GROUP BY band, kind)"
CLEAN = "regexp_replace({x}, '[!@#$%^&*()\\[\\]{{}};:,./<>?\\\\|`~\\-=+ ]', '_', 'g')"
REPORT = f"""rp AS (SELECT {CLEAN.format(x='item')} AS item, CAST(value AS BIGINT) AS value FROM (
  SELECT b||' Count(Counts)' AS item, coalesce(hh_count,0) AS value FROM (SELECT unnest(['GTE_0.5 and LT_0.6','GTE_0.6 and LT_0.7','GTE_0.7 and LT_0.8','GTE_0.8 and LT_0.9','GTE_0.9','GTE_0.7','GTE_0.8']) AS b) LEFT JOIN bc ON bc.band=b
  UNION ALL SELECT band||' '||kind||'(month_'||month_no||')', hh_count FROM gg
  UNION ALL SELECT band||' '||kind||' (3m CR)', conv_3m FROM sm WHERE conv_3m IS NOT NULL UNION ALL SELECT band||' '||kind||' (6m CR)', conv_6m FROM sm))"""


def _monthly(s, sf):
    return re_.conversion_monthly(fx.scored(s, sf), fx.cust_month(s, sf), BASE, left=LEFT)


query("band_counts", with_views("v2", CALLED, COUNTS, select="SELECT * FROM bc"))(lambda s, sf: re_.band_counts(fx.scored(s, sf)))
query("conversion_join", with_views("v1 v2", CALLED, DATES, select=f"SELECT p.chc_id, round({PROB},9) AS p, month AS disco_month FROM p JOIN pd USING (chc_id)"))(
    lambda s, sf: re_.converted(fx.scored(s, sf), fx.cust_month(s, sf), re_.next_months(BASE), re_.PENDING).select("chc_id", F.round(PROB, 9).alias("p"), "disco_month")
)
query("conversion_monthly", with_views("v1 v2", CALLED, DATES, MONTHLY, select="SELECT * FROM mo"))(_monthly)
query("conversion_grid", with_views("v1 v2", CALLED, DATES, MONTHLY, GRID, select="SELECT * FROM gg"))(lambda s, sf: re_.conversion_grid(_monthly(s, sf), BASE))
query("conversion_3m_6m", with_views("v1 v2", CALLED, DATES, MONTHLY, SUMS, select="SELECT * FROM sm"))(lambda s, sf: re_.conversion_sums(_monthly(s, sf), BASE))
query("conversion_report", with_views("v1 v2", CALLED, COUNTS, DATES, MONTHLY, GRID, SUMS, REPORT, select="SELECT * FROM rp"))(
    lambda s, sf: re_.conversion_report(fx.scored(s, sf), fx.cust_month(s, sf), BASE, left=LEFT)
)
query(
    "conversion_wide",
    with_views(
        "v1 v2", CALLED, COUNTS, DATES, MONTHLY, GRID, SUMS, REPORT,
        select="SELECT " + ", ".join(f"coalesce(max(value) FILTER (item = '{i}'), 0) AS {i}" for i in re_.report_items()) + " FROM rp",
    ),
)(lambda s, sf: re_.conversion_wide(re_.conversion_report(fx.scored(s, sf), fx.cust_month(s, sf), BASE, left=LEFT)))

RECORD = f"""SELECT 'run-1' AS unique_identifier, 'all' AS segment, '215' AS no_of_variables, (SELECT count(*) FROM v5 WHERE status=0) AS train_actives, (SELECT count(*) FROM v5 WHERE status=1) AS train_leavers,
  tn+fp AS test_actives, tp+fn AS test_leavers, tp, tn, fp, fn, {RATES}, {CLASS}, (SELECT round(sum(pos*(below+neg/2.0))/(CAST(sum(pos) AS DOUBLE)*sum(neg)),6) FROM a) AS auc FROM k"""
IDENTITY = {"unique_identifier": "run-1", "segment": "all", "no_of_variables": "215"}

query("run_record", with_views("v2 v5", FLIP, CONF, CLASS_CTE, AUC, select=RECORD))(
    lambda s, sf: _r(re_.run_record(fx.scored(s, sf), fx.wide(s, sf), IDENTITY))
)


def _run_log(s, sf):
    path = new_folder(s, "log")
    for i in (1, 2):
        one = ev.confusion(fx.scored(s, sf).filter(F.col("predicted_label") >= i - 1)).select(F.lit(f"run-{i}").alias("run_id"), "tp", "tn", "fp", "fn")
        re_.append_log(one, path)
    return s.read.parquet(path)


query(
    "run_log",
    with_views("v2", CONF, select="SELECT 'run-1' AS run_id, tp, tn, fp, fn FROM c UNION ALL SELECT 'run-2', tp, 0, fp, 0 FROM c"),
)(_run_log)

# --- delivery ---

query(
    "target_list",
    with_views(
        "v2",
        f"""t AS (SELECT *, concat('0701', concat(repeat('0', CAST(greatest(0, 6 - length(CAST(chc_id AS VARCHAR))) AS INT)), CAST(chc_id AS VARCHAR)), concat(repeat('0', CAST(greatest(0, 2 - length(CAST(chc_id%100 AS VARCHAR))) AS INT)), CAST(chc_id%100 AS VARCHAR))) AS k FROM v2 WHERE predicted_label=1
  ORDER BY {PROB} DESC, chc_id LIMIT 30000)""",
        select="SELECT '2000-04-01' AS time_run, '200004' AS run_month, substr(k,1,4) AS corp, substr(k,5,6) AS house, substr(k,11,2) AS cust, k AS corp_house_cust FROM t",
    ),
)(lambda s, sf: _target(fx.scored(s, sf)))


def _target(df):
    from stayflow.functions.keys import build_key

    keyed = df.withColumn("corp_house_cust", build_key(F.lit("0701"), F.col("chc_id"), F.col("chc_id") % 100, grow=True))
    return de.target_list(keyed, 200004, "2000-04-01")


def _interactions(s, sf):
    e = F.col("event_type")
    return fx.table(s, sf, "events").select(
        F.when(F.col("user_id") % 10 == 0, F.concat(F.lit("x"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string")).alias("srcCustomerAccountID"),
        F.col("ts").cast("date").alias("reportdate"),
        F.when(e == "signup", "MOBILE").otherwise("FIXED").alias("lob"),
        F.when(e == "view", "Outbound").otherwise("Inbound").alias("interactiontype"),
        F.when(F.col("value") < 5, "Y").when(F.col("value") < 20, "N").alias("callexcludeflag"),
        F.lit("Voice").alias("interactionchannel"),
        F.when(e == "error", "Retention desk").otherwise("Sales").alias("dept"),
    )


query(
    "retention_calls",
    """SELECT CASE WHEN user_id%10<>0 THEN user_id END AS chc_id, CAST(ts AS DATE) AS reportdate FROM events
WHERE event_type='error' AND value >= 5 AND CAST(ts AS DATE) >= DATE '2024-01-05' AND CAST(ts AS DATE) < DATE '2024-01-25'""",
)(lambda s, sf: de.retention_calls(_interactions(s, sf), "2024-01-05", "2024-01-25"))

SCORE3 = "sc AS (SELECT chc_id, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS p FROM v3 GROUP BY 1)"
RANK3 = "rk AS (SELECT chc_id, CAST((row_number() OVER (ORDER BY p DESC, chc_id)-1)*100//count(*) OVER ()+1 AS INT) AS Rank FROM sc), rt AS (SELECT * FROM rk WHERE Rank <= 20)"
CALLS3 = """od AS (SELECT chc_id, min(reportdate) AS order_date FROM v3 WHERE event_type='purchase' AND reportdate >= DATE '2024-01-10' AND chc_id%5<>0 GROUP BY 1),
cl AS (SELECT chc_id, reportdate FROM v3 WHERE event_type='error'),
pc AS (SELECT rt.chc_id, rt.Rank, sum(CASE WHEN cl.reportdate >= DATE '2024-01-01' AND cl.reportdate <= coalesce(od.order_date, DATE '2024-01-30') THEN 1 ELSE 0 END) AS n
  FROM rt LEFT JOIN od ON od.chc_id=rt.chc_id LEFT JOIN cl ON cl.chc_id=rt.chc_id GROUP BY 1,2),
cr AS (SELECT Rank, CAST(sum(n) AS BIGINT) AS retention_calls, count(*) AS customer_count, round(sum(n)/count(*),3) AS retention_callrate FROM pc GROUP BY Rank)"""


def _scores3(s, sf):
    return fx.calls(s, sf).groupBy("chc_id").agg(F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias(PROB))


def _call_rate(s, sf):
    v3 = fx.calls(s, sf)
    ranked = ev.with_percentile(_scores3(s, sf), PROB).filter(F.col("Rank") <= 20).select("chc_id", "Rank")
    bought = v3.filter((F.col("event_type") == "purchase") & (F.col("reportdate") >= F.lit("2024-01-10").cast("date")) & (F.col("chc_id") % 5 != 0))
    orders = bought.groupBy("chc_id").agg(F.min("reportdate").alias("order_date"))
    calls = v3.filter(F.col("event_type") == "error").select("chc_id", "reportdate")
    return de.call_rate(de.calls_until_order(ranked, orders, calls, "2024-01-01", "2024-01-30"))


query("retention_call_rate", with_views("v3", SCORE3, RANK3, CALLS3, select="SELECT * FROM cr"))(_call_rate)


def _scored_list(s, sf):
    from stayflow.operators.rules import competition_label, tenure_bucket

    attributes = fx.customer_attributes(s, sf).join(fx.text_history(s, sf), "chc_id")
    c = F.col
    columns = {
        "local_market": c("area"), "segment_desc": c("segment"), "balance_current": c("acctbal"), "order_count": c("n_orders"),
        "competition": competition_label({"FIBER": (c("tier_m0") == "1-URGENT").cast("int"), "COAX": (c("tier_m1") == "1-URGENT").cast("int")}),
        "cust_tenure": tenure_bucket(c("n_orders") * 60, missing=None),
    }
    return de.scored_list(_scores3(s, sf), attributes, _call_rate(s, sf), columns)


query(
    "scored_list",
    with_views(
        "v3 v4", SCORE3, RANK3, CALLS3,
        """atr AS (SELECT c_custkey AS chc_id, CASE WHEN c_custkey%13<>0 THEN c_acctbal END AS acctbal,
  CASE WHEN c_custkey%17=0 THEN NULL WHEN c_custkey%19=0 THEN '  ' ELSE c_mktsegment END AS segment, r_name AS area FROM customer
  JOIN nation ON n_nationkey=c_nationkey JOIN region ON r_regionkey=n_regionkey)""",
        select="""SELECT rt.chc_id, rt.Rank, area AS local_market, coalesce(segment,'0') AS segment_desc, coalesce(acctbal,0) AS balance_current, n_orders AS order_count,
  coalesce(nullif(concat_ws(',', CASE WHEN tier_m0='1-URGENT' THEN 'FIBER' END, CASE WHEN tier_m1='1-URGENT' THEN 'COAX' END),''),'NONE') AS competition,
  CASE WHEN n_orders*60<=182 THEN '0_6mon' WHEN n_orders*60<=365 THEN '6_12mon' WHEN n_orders*60<=730 THEN '12_24mon' WHEN n_orders*60<=1825 THEN '24_60mon' ELSE 'morethan_60mon' END AS cust_tenure,
  retention_callrate FROM rt JOIN atr USING (chc_id) JOIN v4 USING (chc_id) LEFT JOIN cr ON cr.Rank=rt.Rank""",
    ),
)(_scored_list)

_MASKS = {"avg_proportion": "1=1"} | {f"top_{k}": f"p1={k}" for k in range(1, 21)} | {f"step5_{5 * k}": f"p5={k}" for k in range(1, 5)}
_MASKS |= {f"step10_{10 * k}": f"p10={k}" for k in range(3, 11)} | {"actual_proportion": "y=1"}

query(
    "profile_levels",
    with_views(
        "v2 v5", FLIP, RANK,
        "j AS (SELECT r.original_labels AS y, (rn-1)*100//n+1 AS p1, (rn-1)*20//n+1 AS p5, (rn-1)*10//n+1 AS p10, priority, segment FROM r JOIN v5 USING (chc_id))",
        "l AS (SELECT 'priority' AS feature, priority AS level, y, p1, p5, p10 FROM j UNION ALL SELECT 'segment', segment, y, p1, p5, p10 FROM j)",
        "c AS (SELECT feature, level, " + ", ".join(f"nullif(count(*) FILTER ({m}),0) AS {k}" for k, m in _MASKS.items() if k != "actual_proportion") + ", CAST(sum(y) AS BIGINT) AS actual_proportion FROM l GROUP BY feature, level)",
        select="SELECT feature, level, " + ", ".join(f"round(CAST({k} AS DOUBLE)/nullif(sum({k}) OVER (PARTITION BY feature),0),6) AS {k}" for k in _MASKS) + " FROM c",
    ),
)(
    lambda s, sf: _r(de.profile_levels(ev.flip_probability(fx.scored(s, sf)), fx.wide(s, sf), ["priority", "segment"], "original_labels"))
)
