"""Stored statistics, checked loads, reruns, cohorts as text and bucketed tables."""
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.functions.months import next_months
from stayflow.operators import cohort as co, cohort_text, sketches as sk, stats as st
from stayflow.queries import cohorts as cq
from stayflow.queries.registry import query
from stayflow.queries.statistics import MOMENTS, NUMS, r
from stayflow.queries.views import long_levels, long_numbers, with_views
from stayflow.session import new_folder
from stayflow.sources import files, guarded

# --- describe any span of months from stored sketches ---

FIRST, LAST = 200001, 200012
#: largest rank error the registered reports may show; three times what one percentile may be off
RANK_BOUND = 0.005
_NUMBERS = ["rev_m0", "rev_m1", "acctbal", "orders_6m"]


def _within(errors, by):
    worst = errors.groupBy(*by, "feature").agg((F.max("error") <= RANK_BOUND).alias("ranks_within_bound"))
    return worst


def _stored_describe(s, sf):
    """Months are stored one after the other, one of them twice; the report reads sketches only."""
    rows = fx.snapshot(s, sf).withColumn("active", F.when(F.col("drform") == "ACTIVE", "yes").otherwise("no"))
    path = new_folder(s, "number-sketches")
    sk.store_numbers(rows, path, _NUMBERS, "dt", ["active"])
    sk.store_numbers(rows.filter(F.col("dt") == FIRST), path, _NUMBERS, "dt", ["active"])  # a rerun
    kept = s.read.parquet(path).filter(F.col("dt").between(FIRST, LAST))
    found = sk.describe_sketches(kept, ["active"])
    errors = sk.rank_errors(rows.filter(F.col("dt").between(FIRST, LAST)), found, _NUMBERS, ["active"])
    exact = r(found.select("active", "feature", "n", "mean", "sd", "min", "max", "missing_pct"), 4)
    return exact.join(_within(errors, ["active"]), ["active", "feature"])


query(
    "describe_from_sketches",
    with_views(
        "v1", f"p AS (SELECT *, CASE WHEN drform='ACTIVE' THEN 'yes' ELSE 'no' END AS active FROM v1 WHERE dt BETWEEN {FIRST} AND {LAST})",
        f"ln AS ({long_numbers('p', _NUMBERS, 'active')})",
        select=f"SELECT active, feature, count(value) AS n, {MOMENTS}, round(100.0*count(*) FILTER (value IS NULL)/count(*),4) AS missing_pct, true AS ranks_within_bound FROM ln GROUP BY ALL",
    ),
)(_stored_describe)


def _group_sketch(s, sf):
    df = fx.wide(s, sf)
    found = sk.group_number_sketches(df, "nation", NUMS)
    errors = sk.rank_errors(df.withColumn("grp", F.col("nation")), found, NUMS, ["grp"], {"median": 0.5})
    out = r(found.drop("median").withColumn("sum", F.round("sum", 1)), 4)
    return out.join(_within(errors, ["grp"]), ["grp", "feature"], "left").withColumn("ranks_within_bound", F.coalesce("ranks_within_bound", F.lit(True)))


query(
    "group_num_stats_sketch",
    with_views("v5", f"ln AS ({long_numbers('v5', NUMS, 'nation AS grp')})", select="SELECT grp, feature, count(value) AS count, round(avg(value),4) AS mean, max(value) AS max, min(value) AS min, round(stddev_samp(value),4) AS std, round(coalesce(sum(value),0),1) AS sum, true AS ranks_within_bound FROM ln GROUP BY ALL"),
)(_group_sketch)
_SUMCOLS = ["price", "acctbal_gap", "mostly_missing"]


def _summary_sketch(s, sf):
    df = fx.wide(s, sf)
    found = sk.summarize_sketches(df, _SUMCOLS, "status")
    errors = sk.rank_errors(df, found, _SUMCOLS, (), {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return r(found.drop("p25", "p50", "p75"), 4).join(_within(errors, []), "feature")


query(
    "summarize_features_sketch",
    with_views("v5", f"ln AS ({long_numbers('v5', _SUMCOLS, 'status')})", select=f"SELECT feature, count(value) AS n, {MOMENTS}, round(count(*) FILTER (value IS NULL)/count(*),4) AS missing_pct, round(avg(status) FILTER (value IS NOT NULL),4) AS rate, true AS ranks_within_bound FROM ln GROUP BY feature"),
)(_summary_sketch)

# --- cohort sizes and level counts from stored key sketches ---

_STORED_CONDITIONS = {
    "eligible": "drform IN ('ACTIVE') AND product IN ('A','B') AND coalesce(pending_drform,'XX') NOT IN ('VOLUNTARY','MOVE AND TRANSFER')",
    "left": cq.RULES.leaves,
    "clean": f"({cq.RULES.clean}) AND drform IN ('ACTIVE')",
}


def _near(estimate, exact, share):
    return F.abs(F.col(estimate) - F.col(exact)) <= F.ceil(share * F.col(exact))


def _cohort_estimates(s, sf):
    snapshot = fx.snapshot(s, sf)
    path = new_folder(s, "key-sketches")
    files.replace_parts(sk.key_sketches(snapshot, "chc_id", _STORED_CONDITIONS), path, ["dt"])
    found = sk.cohort_estimates(s.read.parquet(path), cq.MONTH, next_months(cq.MONTH, 3))
    base = co.eligible(snapshot, cq.MONTH, cq.RULES)
    gone = co.leavers(snapshot, cq.MONTH, cq.RULES, cq.RULES.leaves)
    exact = {
        "eligible": base, "left": co.positives(snapshot, cq.MONTH, cq.RULES), "stayed": co.negatives(snapshot, cq.MONTH, cq.RULES),
        "lost_sight_of": base.join(gone, "chc_id", "left_anti"),
    }
    counts = None
    for name, df in exact.items():
        one = df.agg(F.count(F.lit(1)).alias("exact")).select(F.lit(name).alias("measure"), "exact")
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(found, "measure").select("measure", "exact", _near("customers", "exact", 0.02).alias("within_2_pct"))


query(
    "cohort_counts_estimated",
    with_views(
        "v1", f"e AS (SELECT chc_id FROM v1 WHERE {cq.ELIGIBLE})", f"g AS (SELECT DISTINCT chc_id FROM v1 WHERE {cq.GONE})", cq.STAY_CTE,
        select="""SELECT 'eligible' AS measure, count(*) AS exact, true AS within_2_pct FROM e UNION ALL SELECT 'left', count(*), true FROM e JOIN g USING (chc_id)
UNION ALL SELECT 'stayed', count(*), true FROM e JOIN st USING (chc_id) UNION ALL SELECT 'lost_sight_of', count(*), true FROM e WHERE chc_id NOT IN (SELECT chc_id FROM g)""",
    ),
)(_cohort_estimates)
_LEVELS = ["segment", "product", "area", "drform"]


def _level_estimates(s, sf):
    snapshot = fx.snapshot(s, sf)
    path = new_folder(s, "level-sketches")
    files.replace_parts(sk.level_sketches(snapshot, _LEVELS, "chc_id"), path, ["dt"])
    found = sk.distinct_customers(s.read.parquet(path), ["feature", "level"])
    exact = st.long_levels(snapshot, _LEVELS, ["chc_id"]).filter("level IS NOT NULL").distinct().groupBy("feature", "level").agg(F.count(F.lit(1)).alias("exact"))
    return exact.join(found, ["feature", "level"]).select("feature", "level", "exact", _near("customers", "exact", 0.05).alias("within_5_pct"))


query(
    "level_customers_estimated",
    with_views("v1", f"l AS ({long_levels('v1', _LEVELS, 'chc_id')})", select="SELECT feature, level, count(DISTINCT chc_id) AS exact, true AS within_5_pct FROM l WHERE level IS NOT NULL GROUP BY ALL"),
)(_level_estimates)

# --- cohorts as SQL text ---


def _view(s, sf):
    fx.snapshot(s, sf).createOrReplaceTempView("stayflow_snapshot")
    return "stayflow_snapshot"


for _name, _make, _segment in (("label_cohort", cohort_text.train_cohort, None), ("label_cohort_test", cohort_text.holdout_cohort, None), ("infer_cohort", cohort_text.score_cohort, "tenure > 12 AND tenure <= 48")):
    query(f"{_name}_text", cq.ORACLE_OF[_name])(lambda s, sf, make=_make, segment=_segment: make(s, _view(s, sf), cq.MONTH, cq.RULES, cq.ATTS, segment))

# --- guards, reruns, bad lines ---


def _guarded(s, sf):
    path = new_folder(s, "guarded")
    metrics = guarded.write_guarded(cq.train(s, sf).filter("status = 0"), path, ["chc_id"], "stayers")
    kept = s.read.parquet(path)
    return kept.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", *(F.lit(metrics[m]).cast("bigint").alias(m) for m in ("rows", "duplicates", "missing_keys")))


query("guarded_cohort", with_views("v1", f"t AS ({cq.TRAIN_SQL})", select="SELECT count(*) AS n_rows, count(*) AS rows, count(*) - count(DISTINCT chc_id) AS duplicates, count(*) FILTER (chc_id IS NULL) AS missing_keys FROM t WHERE status = 0"))(_guarded)


def _rerun(s, sf):
    """Three months are stored, then one of them again with other rows."""
    months = fx.snapshot(s, sf).filter("dt IN (200003, 200004, 200005)").select("chc_id", "dt", "tenure", F.lit("first").alias("run"))
    path = new_folder(s, "rerun")
    files.replace_parts(months, path, ["dt"])
    files.replace_parts(months.filter("dt = 200004 AND tenure > 12").withColumn("run", F.lit("second")), path, ["dt"])
    return s.read.parquet(path).select("chc_id", "dt", "tenure", "run")


query("rerun_replaces_month", with_views("v1", select="SELECT chc_id, dt, tenure, CASE WHEN dt = 200004 THEN 'second' ELSE 'first' END AS run FROM v1 WHERE dt IN (200003, 200005) OR dt = 200004 AND tenure > 12"))(_rerun)
_ORDER_TYPES = {"o_orderkey": "INT64", "o_totalprice": "FLOAT64", "o_orderstatus": "STRING"}


def _lines(s, sf, fmt):
    """An export of the orders as text, with amounts that are no numbers and lines that end early."""
    orders = fx.table(s, sf, "orders")
    price = F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(F.format_string("%.2f", "o_totalprice"))
    if fmt == "csv":
        line, cut = F.concat_ws(",", "o_orderkey", price, "o_orderstatus"), F.concat_ws(",", "o_orderkey", price)
    else:
        price = F.when(F.col("o_orderkey") % 97 == 0, F.lit('"n/a"')).otherwise(F.format_string("%.2f", "o_totalprice"))
        line = F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"), F.lit(',"o_totalprice":'), price, F.lit(',"o_orderstatus":"'), F.col("o_orderstatus"), F.lit('"}'))
        cut = F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"))
    path = new_folder(s, "lines")
    orders.select(F.when(F.col("o_orderkey") % 101 == 0, cut).otherwise(line).alias("value")).write.text(path)
    return path


def _quarantine(s, sf, fmt):
    schema = files.schema_of(_ORDER_TYPES)
    source = _lines(s, sf, fmt)
    if fmt == "csv":  # sharded exports have a header in every shard
        headed = new_folder(s, "headed")
        files.export(s.read.text(source).select(F.split("value", ",").alias("v")).select(*(F.get("v", F.lit(i)).alias(c) for i, c in enumerate(_ORDER_TYPES))), headed)
        source = headed
    good, bad = files.load_checked(s, source, schema, new_folder(s, f"checked-{fmt}"), fmt)
    total = good.agg(F.round(F.sum("o_totalprice"), 0).alias("total")).scalar()
    return files.quarantine_report(good, bad).withColumn("total", F.when(F.col("part") == "good", total))


query("quarantine_json", """SELECT 'good' AS part, count(*) AS rows, round(sum(o_totalprice), 0) AS total FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 101 <> 0
UNION ALL SELECT 'quarantined', count(*), NULL FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 101 = 0""")(lambda s, sf: _quarantine(s, sf, "json"))
# a missing last field is an empty one in CSV, so only the amounts are bad there
query("quarantine_csv", """SELECT 'good' AS part, count(*) AS rows, round(sum(o_totalprice), 0) AS total FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL SELECT 'quarantined', count(*), NULL FROM orders WHERE o_orderkey % 97 = 0""")(lambda s, sf: _quarantine(s, sf, "csv"))

# --- joins of bucketed tables ---

BUCKETS = 8
_TABLES: dict[tuple[str, str, str], str] = {}


def bucketed(s, sf, kind):
    """The snapshot, or the text history, in buckets of the key; stored once for a session."""
    place = s.sparkContext.applicationId, sf, kind
    if place not in _TABLES:
        df = fx.snapshot(s, sf) if kind == "snapshot" else fx.text_history(s, sf)
        name = f"stayflow_{kind}_{len(_TABLES)}"
        guarded.store_bucketed(df, name, new_folder(s, f"bucketed-{kind}"), "chc_id", "dt" if kind == "snapshot" else None, BUCKETS)
        _TABLES[place] = name
    return s.table(_TABLES[place])


query("label_negative_bucketed", cq.ORACLE_OF["label_negative"])(lambda s, sf: co.negatives(bucketed(s, sf, "snapshot"), cq.MONTH, cq.RULES).select("chc_id", "tenure"))


def _assemble(s, sf):
    labelled = co.train_cohort(bucketed(s, sf, "snapshot"), cq.MONTH, cq.RULES, cq.ATTS)
    joined = labelled.join(bucketed(s, sf, "history"), "chc_id")
    return joined.select("status", "chc_id", "tenure", "rev_m0", "tier_m0", "n_orders", F.upper("segment").alias("seg"))


query("assemble_features_bucketed", cq.ORACLE_OF["assemble_features"])(_assemble)
