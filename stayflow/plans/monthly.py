"""The monthly run from stored artefacts, and the check of a model on later months.

A model is fitted and stored with the columns it reads. The monthly run loads it, builds the
cohort of the month, scores it, and writes scores and the target list by month and run: a
run that is repeated replaces its own rows and leaves the others.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayflow.functions.keys import build_key
from stayflow.operators import evaluate, prep
from stayflow.operators.cohort import CohortRules, score_cohort, train_cohort
from stayflow.operators.stage import load_state, save_state
from stayflow.plans import delivery, models
from stayflow.session import materialize
from stayflow.sources import files, guarded


def store_model(snapshot: DataFrame, month: int, rules: CohortRules, texts: Sequence[str], numbers: Sequence[str], path: str, segment: str | None = None, seed: int = 0, **params) -> dict:
    """Fit on the labelled cohort of ``month`` and store model and columns; returns the guard's metrics.

    The cohort is checked while it is written: an empty one, or one with repeated keys, is no
    base for a model.
    """
    spark = snapshot.sparkSession
    rows = prep.blanks_to_null(train_cohort(snapshot, month, rules, [*texts, *numbers], segment))
    # a customer may leave and be back within the window: it counts as leaving
    rows = rows.groupBy(rules.key).agg(F.max_by(F.struct(*(F.col(c) for c in rows.columns if c != rules.key)), "status").alias("r")).select(rules.key, "r.*")
    metrics = guarded.write_guarded(rows, f"{path}/cohort", [rules.key], f"training of {month}")
    model = models.train_gbt(spark.read.parquet(f"{path}/cohort"), texts, numbers, "status", rules.key, seed, **params)
    model.write().overwrite().save(f"{path}/model")
    save_state(spark, {"month": month, "texts": list(texts), "numbers": list(numbers)}, f"{path}/columns")
    return metrics


def _scores(spark: SparkSession, snapshot: DataFrame, month: int, rules: CohortRules, model_path: str, segment: str | None, extra: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    kept = load_state(spark, f"{model_path}/columns")
    model = PipelineModel.load(f"{model_path}/model")
    rows = prep.blanks_to_null(score_cohort(snapshot, month, rules, [*kept["texts"], *kept["numbers"]], segment))
    return models.score(model, rows, kept["texts"], kept["numbers"], [rules.key, *extra]), kept


def run_month(
    snapshot: DataFrame, month: int, rules: CohortRules, model_path: str, out_path: str, corp: str, run_id: str, time_run: str, segment: str | None = None, n: int = delivery.TARGETS,
) -> dict:
    """Scores and target list of ``month`` by the stored model, below ``out_path``; returns the guard's metrics.

    One pass builds, scores and checks the cohort; the list is taken from the stored
    scores. Both tables are partitioned by month and run id.
    """
    spark = snapshot.sparkSession
    scored, kept = _scores(spark, snapshot, month, rules, model_path, segment)
    composite = build_key(F.lit(corp), F.col(rules.key), F.col(rules.key) % 100, grow=True)
    tagged = scored.withColumns({"corp_house_cust": composite, "trained_on": F.lit(kept["month"]), "run_month": F.lit(month), "run_id": F.lit(run_id)})
    staged = f"{out_path}/staged/{run_id}-{month}"
    metrics = guarded.write_guarded(tagged, staged, [rules.key], f"run of {month}")
    rows = spark.read.parquet(staged)
    files.replace_parts(rows, f"{out_path}/scores", ["run_month", "run_id"])
    listed = delivery.target_list(rows, month, time_run, n, rules.key)
    listed = listed.withColumns({"run_month": F.lit(month), "run_id": F.lit(run_id)})
    files.replace_parts(listed, f"{out_path}/targets", ["run_month", "run_id"])
    return metrics


def out_of_time(snapshot: DataFrame, month: int, rules: CohortRules, model_path: str, segment: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(scores with outcomes, decile lift) of a stored model on the customers of a later month.

    The outcome is that of the holdout cohort: every eligible customer counts, the ones
    that are pending in the window as 1.
    """
    from stayflow.operators.cohort import holdout_cohort

    spark = snapshot.sparkSession
    kept = load_state(spark, f"{model_path}/columns")
    model = PipelineModel.load(f"{model_path}/model")
    rows = prep.blanks_to_null(holdout_cohort(snapshot, month, rules, [*kept["texts"], *kept["numbers"]], segment))
    scored = models.score(model, rows, kept["texts"], kept["numbers"], [rules.key, "status"])
    scored = materialize(scored.withColumnRenamed("status", "original_labels"), "out-of-time")
    return scored, evaluate.lift_all(scored)
