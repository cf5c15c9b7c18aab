"""Cohorts, joins, filters and sampling."""
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.operators import cohort as co, sampling as sa
from stayflow.queries.registry import ORACLES as ORACLE_OF, query  # noqa: F401 - the same SQL serves other forms of a query
from stayflow.queries.views import with_views

MONTH = 200003
RULES = co.CohortRules(products=("A", "B"), product_col="product")
ATTS = ["tenure", "product", "rev_m0", "orders_6m", "acctbal", "segment", "nation"]

ELIGIBLE = f"""dt = {MONTH} AND drform IN ('ACTIVE') AND product IN ('A','B')
  AND coalesce(pending_drform,'XX') NOT IN ('VOLUNTARY','MOVE AND TRANSFER')"""
GONE = "(vol_pend_disco = 'Y' OR pending_mover = 'FALSE') AND dt IN (200004, 200005, 200006)"
GONE_TEST = "(pending_drform = 'VOLUNTARY' OR pending_mover = 'FALSE') AND dt IN (200004, 200005, 200006)"
CLEAN = "coalesce(vol_pend_disco,'XX') <> 'Y' AND coalesce(pending_mover,'XX') <> 'FALSE' AND drform IN ('ACTIVE')"
STAYED = " AND ".join(f"chc_id IN (SELECT chc_id FROM v1 WHERE {CLEAN} AND dt = {m})" for m in (200004, 200005, 200006))
COLS = ", ".join(["chc_id", *ATTS])

TRAIN_SQL = f"""SELECT 1 AS status, {COLS} FROM v1 WHERE {ELIGIBLE} AND chc_id IN (SELECT chc_id FROM v1 WHERE {GONE})
UNION SELECT 0 AS status, {COLS} FROM v1 WHERE {ELIGIBLE} AND {STAYED}"""


def train(spark, sf):
    return co.train_cohort(fx.snapshot(spark, sf), MONTH, RULES, ATTS)


query("label_cohort", with_views("v1", select=TRAIN_SQL))(train)

query(
    "label_cohort_test",
    with_views(
        "v1",
        select=f"""SELECT 1 AS status, {COLS} FROM v1 WHERE {ELIGIBLE} AND chc_id IN (SELECT chc_id FROM v1 WHERE {GONE_TEST})
UNION SELECT 0 AS status, {COLS} FROM v1 a WHERE {ELIGIBLE} AND NOT EXISTS (SELECT 1 FROM v1 b WHERE b.chc_id = a.chc_id AND {GONE_TEST.replace('(pending', '(b.pending').replace('OR pending', 'OR b.pending').replace('dt IN', 'b.dt IN')})""",
    ),
)(lambda s, sf: co.holdout_cohort(fx.snapshot(s, sf), MONTH, RULES, ATTS))

query("infer_cohort", with_views("v1", select=f"SELECT {COLS} FROM v1 WHERE {ELIGIBLE} AND tenure > 12 AND tenure <= 48"))(
    lambda s, sf: co.score_cohort(
        fx.snapshot(s, sf), MONTH, RULES, ATTS, co.segment_predicate("tenure", above=12, upto=48)
    )
)

query("eligible_base", with_views("v1", select=f"SELECT chc_id, dt, drform, product, pending_drform FROM v1 WHERE {ELIGIBLE}"))(
    lambda s, sf: co.eligible(fx.snapshot(s, sf), MONTH, RULES).select("chc_id", "dt", "drform", "product", "pending_drform")
)

query("label_positive", with_views("v1", select=f"SELECT chc_id, tenure FROM v1 WHERE {ELIGIBLE} AND chc_id IN (SELECT chc_id FROM v1 WHERE {GONE})"))(
    lambda s, sf: co.positives(fx.snapshot(s, sf), MONTH, RULES).select("chc_id", "tenure")
)

# one grouping per customer: the months of the window in which it is active and clean
STAY_CTE = f"st AS (SELECT chc_id FROM v1 WHERE {CLEAN} AND dt IN (200004, 200005, 200006) GROUP BY chc_id HAVING count(DISTINCT dt) = 3)"
query("label_negative", with_views("v1", STAY_CTE, select=f"SELECT v1.chc_id, v1.tenure FROM v1 JOIN st ON st.chc_id = v1.chc_id WHERE {ELIGIBLE}"))(
    lambda s, sf: co.negatives(fx.snapshot(s, sf), MONTH, RULES).select("chc_id", "tenure")
)

query(
    "label_negative_test",
    with_views("v1", select=f"SELECT chc_id, tenure FROM v1 WHERE {ELIGIBLE} AND chc_id NOT IN (SELECT chc_id FROM v1 WHERE {GONE_TEST})"),
)(lambda s, sf: co.negatives_test(fx.snapshot(s, sf), MONTH, RULES).select("chc_id", "tenure"))

SEGMENT = co.segment_predicate("tenure", above=12, upto=48, lists={"area": ["ASIA", "EUROPE"]}, nullable={"segment": ["", "BUILDING"]})

query(
    "segment_filter",
    with_views(
        "v1",
        select=f"""SELECT chc_id, tenure, area, segment FROM v1 WHERE dt = {MONTH} AND tenure > 12 AND tenure <= 48
  AND area IN ('ASIA','EUROPE') AND coalesce(segment,'') IN ('','BUILDING')""",
    ),
)(lambda s, sf: fx.snapshot(s, sf).filter(F.col("dt") == MONTH).filter(SEGMENT).select("chc_id", "tenure", "area", "segment"))

query("population_filter", with_views("v5", select="SELECT chc_id, segment, nation FROM v5 WHERE upper(segment)='BUILDING' AND upper(nation)='NATION_3'"))(
    lambda s, sf: co.population(fx.wide(s, sf), {"segment": "building", "nation": "nation_3"}).select("chc_id", "segment", "nation")
)

SEGMENTS = {
    "long_europe": "tenure > 48 AND area = 'EUROPE'",
    "long": "tenure > 36",
    "europe": "area IN ('EUROPE', 'ASIA')",
    "furniture": "segment = 'FURNITURE'",
}

query(
    "segments_union_dedupe",
    with_views(
        "v1",
        f"e AS (SELECT * FROM v1 WHERE {ELIGIBLE})",
        "u AS (" + " UNION ALL ".join(f"SELECT {i} AS pr, '{n}' AS segment_name, * FROM e WHERE {p}" for i, (n, p) in enumerate(SEGMENTS.items())) + ")",
        "k AS (SELECT *, row_number() OVER (PARTITION BY chc_id ORDER BY pr) AS rn FROM u)",
        select="SELECT segment_name, chc_id, tenure, area, segment FROM k WHERE rn = 1",
    ),
)(
    lambda s, sf: co.stack_segments(co.eligible(fx.snapshot(s, sf), MONTH, RULES), SEGMENTS).select(
        "segment_name", "chc_id", "tenure", "area", "segment"
    )
)

query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")(
    lambda s, sf: co.duplicate_keys(fx.table(s, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
)

query(
    "outcome_flag",
    with_views("v1", select="SELECT chc_id, dt, CASE WHEN vol_pend_disco='Y' OR pending_mover='FALSE' THEN 1 ELSE 0 END AS outcome FROM v1"),
)(
    lambda s, sf: fx.snapshot(s, sf).select(
        "chc_id", "dt", co.outcome_flag((F.col("vol_pend_disco") == "Y").cast("int"), (F.col("pending_mover") == "FALSE").cast("int")).alias("outcome")
    )
)

query(
    "class_counts",
    with_views(
        "v1", f"t AS ({TRAIN_SQL})",
        select="SELECT status, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM t GROUP BY status",
    ),
)(lambda s, sf: _class_counts(train(s, sf)))


def _class_counts(df):
    from stayflow.operators.stats import class_counts

    return class_counts(df).select("status", "n", F.round("share", 6).alias("share"))


query(
    "assemble_features",
    with_views(
        "v1 v4", f"t AS ({TRAIN_SQL})",
        select="SELECT t.status, t.chc_id, t.tenure, t.rev_m0, h.tier_m0, h.n_orders, upper(t.segment) AS seg FROM t JOIN v4 h ON h.chc_id = t.chc_id",
    ),
)(
    lambda s, sf: train(s, sf)
    .join(fx.text_history(s, sf), "chc_id")
    .select("status", "chc_id", "tenure", "rev_m0", "tier_m0", "n_orders", F.upper("segment").alias("seg"))
)

query(
    "downsample",
    with_views("v5", select="SELECT status, least(count(*), (SELECT count(*) FROM v5 WHERE status=1)) AS n FROM v5 GROUP BY status"),
)(lambda s, sf: sa.downsample(fx.wide(s, sf).select("chc_id", "status")).groupBy("status").agg(F.count(F.lit(1)).alias("n")))

query(
    "stratified_split",
    with_views(
        "v5", "c AS (SELECT status, count(*) AS n FROM v5 GROUP BY status)",
        select="""SELECT status, 'test' AS split, CAST(ceil(n*0.25) AS BIGINT) AS n FROM c
UNION ALL SELECT status, 'train' AS split, n - CAST(ceil(n*0.25) AS BIGINT) AS n FROM c""",
    ),
)(
    lambda s, sf: sa.stratified_split(fx.wide(s, sf).select("chc_id", "status")).groupBy("status", "split").agg(F.count(F.lit(1)).alias("n"))
)

query(
    "stratified_folds",
    with_views(
        "v5", "c AS (SELECT status, count(*) AS n FROM v5 GROUP BY status)",
        select="SELECT status, CAST(f.k AS INT) AS fold, (n - f.k + 4)//5 AS n FROM c, (SELECT unnest([0,1,2,3,4]) AS k) f",
    ),
)(
    lambda s, sf: sa.stratified_folds(fx.wide(s, sf).select("chc_id", "status"), 5).groupBy("status", "fold").agg(F.count(F.lit(1)).alias("n"))
)
query(
    "shuffle_splits",
    with_views(
        "v5", "c AS (SELECT status, count(*) AS n, CAST(floor(count(*)*0.8) AS BIGINT) AS k FROM v5 GROUP BY status)",
        select="SELECT status, CAST(i AS INT) AS split, k AS n_train, n - k AS n_test FROM c, (SELECT unnest([0,1,2]) AS i)",
    ),
)(lambda s, sf: _split_sizes(sa.shuffle_splits(fx.wide(s, sf).select("chc_id", "status"), 3, 0.8)))


def _split_sizes(splits):
    sizes = [F.struct(F.lit(i).alias("split"), F.sum(f"train_{i}").alias("n_train"), F.sum(1 - F.col(f"train_{i}")).alias("n_test")) for i in range(3)]
    return splits.groupBy("status").agg(F.array(*sizes).alias("rows")).select("status", F.inline("rows"))
