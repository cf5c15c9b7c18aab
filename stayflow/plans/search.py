"""Model searches that pay for what they learn: halving over settings, racing over features.

Both fold the customers once, write the feature vectors once, and run their fits side by
side on the cluster. Every trial is a row of a log in the shared folder, written when it is
done: a search that is started again with the same log goes on where it stopped.
"""
from __future__ import annotations

import json
import math
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, functions as F

from stayflow.operators.sampling import stratified_folds
from stayflow.plans.models import FULL_GRID, feature_stages, gbt, model_input, random_draws, with_class_weight
from stayflow.session import materialize, new_folder
from stayflow.sources.files import replace_parts

_LOG = "name string, rung int, trial string, aucs array<double>, auc double, seconds double"


def grid_settings(grid: Mapping[str, Sequence] = FULL_GRID) -> list[dict]:
    """All combinations of the grid, in its order."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def drawn_settings(space: Mapping[str, Sequence] = FULL_GRID, draws: int = 50, seed: int = 0) -> list[dict]:
    """Seeded settings drawn from the space, repeats left out."""
    return [{p.name: v for p, v in pick.items()} for pick in random_draws(gbt(), space, draws, seed)]


def _spelled(setting: Mapping) -> str:
    return json.dumps(setting, sort_keys=True)


class TrialLog:
    """Trials that are done, by (name of the search, rung, trial); each is one partition of a small table."""

    def __init__(self, spark, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.done: dict[tuple[int, str], list[float]] = {}
        try:
            rows = spark.read.parquet(path).filter(F.col("name") == name).select("rung", "trial", "aucs").collect()
        except Exception as missing:  # noqa: BLE001 - a new search has no log yet
            if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
                raise
            rows = []
        for r in rows:
            self.done[r["rung"], r["trial"]] = list(r["aucs"])

    def add(self, rung: int, trial: str, aucs: list[float], seconds: float) -> None:
        row = self.spark.createDataFrame([(self.name, rung, trial, aucs, sum(aucs) / len(aucs), seconds)], _LOG)
        replace_parts(row.withColumn("part", F.xxhash64("name", "rung", "trial")), self.path, ["part"])
        self.done[rung, trial] = aucs


def _side_by_side(spark, work, items: Sequence, parallelism: int) -> list:
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def halving_search(
    df: DataFrame, texts: Sequence[str], numbers: Sequence[str], settings: Sequence[Mapping], budgets: Sequence[int | None] = (5, 20, None), keep: float = 1 / 3,
    k: int = 3, label: str = "status", key: str = "chc_id", seed: int = 0, parallelism: int = 4, tolerance: float = 0.001, log: str | None = None, name: str = "search",
) -> tuple[PipelineModel, DataFrame]:
    """(best model, trial table): successive halving over boosted-tree settings.

    In each rung the settings that are left are cross-validated with at most so many trees
    (None: their own number), and the best ``keep`` of them go on. Settings that are the
    same under a rung's limit are one trial. Trees stop early once the held-out fold gains
    less than ``tolerance``. Ties go to the earlier setting. The table has (rung, settings,
    auc) of every trial, and the best of the last rung is fitted on all rows.
    """
    spark = df.sparkSession
    rows = with_class_weight(stratified_folds(model_input(df, texts, numbers, [key, label]), k, key, label, seed), label)
    prepared = Pipeline(stages=feature_stages(texts, numbers)).fit(rows)
    vectors = materialize(prepared.transform(rows).select(F.col(label).cast("double").alias(label), "weight", "fold", "features"), "vectors")
    judge = BinaryClassificationEvaluator(labelCol=label)
    trials = TrialLog(spark, log or new_folder(spark, "trials"), name)

    def limited(setting: Mapping, budget: int | None) -> str:
        return _spelled(dict(setting) | ({"maxIter": min(setting.get("maxIter", budget), budget)} if budget else {}))

    def run(work: tuple[int, str]) -> None:
        rung, spelled = work
        start, aucs = time.time(), []
        for i in range(k):
            learner = gbt(label, seed=seed, validationIndicatorCol="held", validationTol=tolerance, **json.loads(spelled))
            fit = learner.fit(vectors.withColumn("held", F.col("fold") == i))
            aucs.append(judge.evaluate(fit.transform(vectors.filter(F.col("fold") == i))))
        trials.add(rung, spelled, aucs, time.time() - start)

    left, table = [dict(s) for s in settings], []
    for rung, budget in enumerate(budgets):
        wanted = list(dict.fromkeys(limited(s, budget) for s in left))
        _side_by_side(spark, run, [(rung, s) for s in wanted if (rung, s) not in trials.done], parallelism)
        score = {s: sum(trials.done[rung, s]) / k for s in wanted}
        table += [(rung, s, score[s]) for s in wanted]
        if rung + 1 < len(budgets):
            best = sorted(wanted, key=lambda s: (-score[s], wanted.index(s)))[: max(1, math.ceil(keep * len(wanted)))]
            left = [s for s in left if limited(s, budget) in best]
    last = {s: a for r, s, a in table if r == len(budgets) - 1}
    winner = max(last, key=last.get)
    model = gbt(label, seed=seed, **json.loads(winner)).fit(vectors)
    out = spark.createDataFrame(table, "rung int, settings string, auc double").orderBy(F.desc("rung"), F.desc("auc"), "settings")
    return PipelineModel([*prepared.stages, model]), out


def racing_selection(
    df: DataFrame, numbers: Sequence[str], smallest: int = 3, largest: int = 25, k: int = 3, reach: float = 1.0, label: str = "status", key: str = "chc_id",
    seed: int = 0, parallelism: int = 4, log: str | None = None, name: str = "backward", **params,
) -> DataFrame:
    """(n_features, features, auc): backward selection, one row per size from ``largest`` down.

    At each step the candidates (each leaves out one feature) run side by side, fold by
    fold, on vectors that are written once and sliced. A candidate leaves the race when it
    cannot catch up: when it is further behind the leader than ``reach`` for each fold
    that is left. ``reach`` is the most that one fold can favour one candidate over
    another; at 1, the span of an AUC, no candidate ever leaves unduly and the order is that
    of the full loop.
    """
    spark = df.sparkSession
    numbers = list(numbers)
    rows = with_class_weight(stratified_folds(model_input(df, [], numbers, [key, label]), k, key, label, seed), label)
    filled = [f"{c}__f" for c in numbers]
    stages = [Imputer(inputCols=numbers, outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="every")]
    vectors = materialize(Pipeline(stages=stages).fit(rows).transform(rows).select(F.col(label).cast("double").alias(label), "weight", "fold", "every"), "race")
    judge, trials = BinaryClassificationEvaluator(labelCol=label), TrialLog(spark, log or new_folder(spark, "trials"), name)

    def run(work: tuple[int, tuple[str, ...]]) -> None:
        fold, cols = work
        start = time.time()
        sliced = VectorSlicer(inputCol="every", outputCol="features", indices=[numbers.index(c) for c in cols]).transform(vectors)
        fit = gbt(label, seed=seed, **params).fit(sliced.filter(F.col("fold") != fold))
        trials.add(fold, _spelled(list(cols)), [judge.evaluate(fit.transform(sliced.filter(F.col("fold") == fold)))], time.time() - start)

    def race(candidates: dict[str, tuple[str, ...]]) -> tuple[str, float]:
        total = dict.fromkeys(candidates, 0.0)
        for fold in range(k):
            todo = [(fold, candidates[c]) for c in total if (fold, _spelled(list(candidates[c]))) not in trials.done]
            _side_by_side(spark, run, todo, parallelism)
            total = {c: t + trials.done[fold, _spelled(list(candidates[c]))][0] for c, t in total.items()}
            ahead = max(total.values())
            total = {c: t for c, t in total.items() if ahead - t <= reach * (k - 1 - fold) or t == ahead}
        best = max(sorted(total), key=total.get)
        return best, total[best] / k

    current, steps = tuple(numbers), []
    if len(current) <= largest:
        steps.append((len(current), ",".join(current), race({"": current})[1]))
    while len(current) > smallest:
        left_out, auc = race({c: tuple(x for x in current if x != c) for c in current})
        current = tuple(x for x in current if x != left_out)
        if len(current) <= largest:
            steps.append((len(current), ",".join(current), auc))
    return spark.createDataFrame(steps, "n_features int, features string, auc double")
